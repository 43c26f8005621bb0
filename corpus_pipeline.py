"""Documents to packed training sequences, in five stages.

Each stage works on all rows that the stage before it left, written as Parquet
to the shared folder and read again.

1. quality: lines that break a rule are cut from the texts, and documents that
   lose too much, or fail the base rules, go.
2. language: documents whose language cannot be told go; a missing lang is
   filled in with the prediction.
3. near_duplicates: of each group of documents linked by at least 0.8 of their
   five-word shingles, the row of the smallest doc_id stays.
4. mixing: documents are put in the order of the Pfair schedule of sources.
5. packing: documents become pieces of token ids, placed in sequences.  Each
   stretch of the order in which they stand is packed on its own, and
   sequence_id follows the stretches.

Defined cases: rows, not ids, go: another text under the id of a row that goes
stays.  Of rows of equal doc_id and words one stays from stage 3 on; rows without
a doc_id follow the same rule and come last in their group.  A null or empty text
is rejected by stage 1.  Ties are broken by set hashes (stage 3), by md5 of the id
(stage 4) and by place (stage 5).  A null lang is filled in, a null source is a
source of its own.  Texts are taken whole, however long; a task holds one text
and a few times its size.  Columns beyond those of documents pass through all
stages but the last, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewrack.llm.common import stored
from tidewrack.llm.language import fit, predict, train_rows
from tidewrack.llm.mixing import mix_sources
from tidewrack.llm.ngram_join import one_per_group
from tidewrack.llm.packing import pack, tokenize
from tidewrack.llm.quality import clean_lines

SHINGLE, PERCENT = 5, 80
#: Short texts are clean as often as long ones, so any with a word may stay.
LEAST_WORDS = 1


def _apart(docs: DataFrame, *used: str) -> tuple[DataFrame, str]:
    """docs with the columns `used` as they are and all others in one, under a name that no column has.

    So no column of docs has the name of one that an operator adds.
    """
    rest = "_rest"
    while rest.lower() in [c.lower() for c in docs.columns]:
        rest += "_"
    others = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(F.lit(0).alias("_"), *others).alias(rest)), rest


def _whole(kept: DataFrame, docs: DataFrame, rest: str, *used: str) -> DataFrame:
    """The columns of docs again."""
    return kept.select([F.col(c) if c in used else F.col(f"{rest}.`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    narrow, rest = _apart(docs, "text")
    kept = clean_lines(narrow, least_words=LEAST_WORDS).where("kept").select(rest, F.col("clean_text").alias("text"), F.length("clean_text").cast("long").alias("n_chars"))
    return _whole(kept, docs, rest, "text", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    narrow, rest = _apart(docs, "text", "lang")
    kept = predict(narrow, fit(train_rows(docs))).where(~F.col("rejected")).withColumn("lang", F.coalesce("lang", "lang_pred"))
    return _whole(kept, docs, rest, "text", "lang")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    narrow, rest = _apart(docs, "doc_id", "text")
    return _whole(one_per_group(narrow, k=SHINGLE, percent=PERCENT), docs, rest, "doc_id", "text")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    narrow, rest = _apart(docs, "doc_id", "source")
    return _whole(mix_sources(narrow).orderBy("mix_position"), docs, rest, "doc_id", "source")


def _numbered(docs: DataFrame) -> DataFrame:
    """docs with _position, each row's place in the order of the written files (from 0, gapless).

    A table that is not read from Parquet as it stands is written first, in its own order.
    """
    if not docs._jdf.queryExecution().analyzed().children().isEmpty() or "row_index" not in _metadata_of(docs):
        docs = stored(docs, "ordered")
    rows = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # a row per file; writers number files by partition, in more digits where they are many
    files = rows.groupBy("_file").agg(F.count("*").alias("n"))
    before = Window.orderBy(F.length("_file"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    rows = rows.join(F.broadcast(files), "_file")
    return rows.withColumn("_position", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


def _metadata_of(docs: DataFrame) -> list[str]:
    """Names of the fields that a read of files gives besides its columns."""
    try:
        return docs.select("_metadata.*").columns
    except AnalysisException:
        return []


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _numbered(docs).select("doc_id", "text", "_position")
    return pack(stored(tokenize(docs), "pieces"), position="_position").drop("_position")


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]
#: Language ID and tokenizing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
