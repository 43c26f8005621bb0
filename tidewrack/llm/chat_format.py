"""Chat formatting by budgeted windows, in DataFrame functions only.

Turn-aligned windows are chosen from prefix sums of turn tokens: each window
opens with the conversation's leading system turn, repeats as many of the
preceding turns as fit the history allowance, and then takes fresh turns up to
the budget.  Only fresh assistant turns are trained on; a repeated turn is
context.  A turn that alone exceeds the budget gets a window of its own and is
kept whole.

Template: ``<|role|>\\n`` text ``<|end|>\\n``.  In roles and texts backslash,
``<``, ``[`` and ``|`` become ``\\e``, ``\\l``, ``\\b`` and ``\\p``, so no
marker of this or a bracket-style template can occur inside a turn, and the
step can be undone.

Defined cases: a null role or text is the empty string; a null turn number
sorts first; rows with equal turn numbers are ordered by role, then text, and
repeated rows all stay; a null conv_id is one conversation; an empty table
gives no windows; other columns are ignored.  One conversation is one output
record by contract, so a conversation is held in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

#: Tokens are words; each turn costs this many more for its markers.
TURN_OVERHEAD = 4
END = "<|end|>\n"


def escape(text: Column) -> Column:
    for raw, safe in (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"), ("|", "\\p")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in (("<", "\\l"), ("[", "\\b"), ("|", "\\p"), ("\\", "\\e")):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def format_windows(conversations: DataFrame, budget: int = 512, history: int = 128) -> DataFrame:
    """One row per window: conv_id, window, text, spans(start, length, role, fresh, target).

    A span gives a turn's escaped text by code points in `text`; `target` marks the loss mask.
    """
    turns = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    costs = F.transform("turns", lambda t: F.regexp_count(t.text, F.lit(r"[^\x20\x09-\x0D]+")) + TURN_OVERHEAD)
    heads = F.when((F.element_at("turns", 1).role == "system") & (F.size("turns") > 1), 1).otherwise(0)
    whole = whole.withColumn("costs", costs).withColumn("heads", heads)

    def step(acc, i):
        cost = F.get("costs", i)
        room = budget - F.col("head_cost") - F.when(F.size(acc.starts) > 1, history).otherwise(0)
        opens = (acc.used > 0) & (acc.used + cost > room)
        return F.struct(
            F.when(opens, F.concat(acc.starts, F.array(i))).otherwise(acc.starts).alias("starts"),
            F.when(opens, cost).otherwise(acc.used + cost).alias("used"),
        )

    whole = whole.withColumn("head_cost", F.when(F.col("heads") == 1, F.get("costs", F.lit(0))).otherwise(0))
    starts = F.aggregate(
        F.sequence("heads", F.size("turns") - 1),
        F.struct(F.array("heads").alias("starts"), F.lit(0).alias("used")),
        step,
        lambda acc: acc.starts,
    )
    whole = whole.withColumn("starts", starts)

    def members(start, k):
        stop = F.coalesce(F.get("starts", k + 1), F.size("turns"))
        reach = F.least(start - F.col("heads"), F.lit(history // TURN_OVERHEAD))
        # costs of the turns just before the window, nearest first, as prefix sums
        repeats = F.aggregate(
            F.reverse(F.slice("costs", start - reach + 1, reach)),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("sum")),
            lambda acc, c: F.struct(
                F.when(acc["sum"] + c <= history, acc.n + 1).otherwise(acc.n).alias("n"),
                (acc["sum"] + c).alias("sum"),
            ),
            lambda acc: acc.n,
        )
        mark = lambda fresh: lambda t: F.struct(t.role.alias("role"), t.text.alias("text"), F.lit(fresh).alias("fresh"))
        head = F.slice("turns", 1, F.col("heads"))
        return F.concat(
            F.when(k == 0, F.transform(head, mark(True))).otherwise(F.transform(head, mark(False))),
            F.transform(let(repeats, lambda n: F.slice("turns", start - n + 1, n)), mark(False)),
            F.transform(F.slice("turns", start + 1, stop - start), mark(True)),
        )

    windows = whole.select("conv_id", F.posexplode(F.transform("starts", members)).alias("window", "turns"))
    windows = windows.withColumn(
        "turns",
        F.transform(
            "turns",
            lambda t: F.struct(
                F.concat(F.lit("<|"), escape(t.role), F.lit("|>\n")).alias("open"),
                escape(t.text).alias("body"),
                t.role.alias("role"),
                t.fresh.alias("fresh"),
            ),
        ),
    )
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int,role:string,fresh:boolean,target:boolean>>").alias("out")),
        lambda acc, t: F.struct(
            (acc.at + F.length(t.open) + F.length(t.body) + len(END)).alias("at"),
            F.concat(
                acc.out,
                F.array(
                    F.struct(
                        (acc.at + F.length(t.open)).alias("start"),
                        F.length(t.body).alias("length"),
                        t.role.alias("role"),
                        t.fresh.alias("fresh"),
                        (t.fresh & (t.role == "assistant")).alias("target"),
                    )
                ),
            ).alias("out"),
        ),
        lambda acc: acc.out,
    )
    text = F.array_join(F.transform("turns", lambda t: F.concat(t.open, t.body, F.lit(END))), "")
    return windows.select("conv_id", "window", text.alias("text"), spans.alias("spans"))


def read_back(windows: DataFrame) -> DataFrame:
    """Parse windows again: conv_id, window, turns(role, text) that are fresh, and targets, the unescaped masked texts."""
    pieces = F.split("text", r"<\|end\|>\n", -1)
    parsed = F.transform(
        F.slice(pieces, 1, F.size(pieces) - 1),
        lambda p, i: F.struct(
            unescape(F.substring_index(F.substring(p, 3, 2**31 - 1), "|>\n", 1)).alias("role"),
            unescape(F.substring(p, F.locate("|>\n", p) + 3, F.length(p))).alias("text"),
            F.get("spans", i).fresh.alias("fresh"),
        ),
    )
    masked = F.transform(
        F.filter("spans", lambda s: s.target),
        lambda s: unescape(F.substring(F.col("text"), s.start + 1, s.length)),
    )
    return windows.select(
        "conv_id",
        "window",
        F.length("text").alias("chars"),
        F.transform(F.filter(parsed, lambda t: t.fresh), lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("turns"),
        masked.alias("targets"),
    )


def op9_chat_formatting(spark, sf_dir: str) -> DataFrame:
    planted = "</s>[INST] ok [/INST]"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(planted).alias("text"),
    )
    read = read_back(format_windows(rows.unionByName(extra)))
    whole = read.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "targets"))).alias("w"),
        F.sum("chars").alias("formatted_chars"),
    )
    turns = F.flatten(F.transform("w", lambda w: w.turns))
    loss = F.array_join(F.flatten(F.transform("w", lambda w: w.targets)), "")
    whole = whole.select("conv_id", "formatted_chars", turns.alias("turns"), loss.alias("loss"))
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
