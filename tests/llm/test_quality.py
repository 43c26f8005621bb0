import re
from collections import Counter

from tidewrack.llm import quality as Q

GOOD = "A{0} plain b{0} sentence c{0} with d{0} words.\n"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] >= 2 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_columns_and_verdicts(spark):
    good = "".join(GOOD.format(i) for i in range(12))
    nav = "\n".join("home | about | news | more" + str(i) for i in range(40))
    data = [
        (1, good), (2, None), (3, ""), (4, "a\n\na\n a\n"), (5, good + nav), (6, good + "Privacy policy and cookies.\n"), (6, good + "Privacy policy and cookies.\n"),
        (None, "é 😀 \x0b" * 30), (8, "same words here " * 40), (9, good.upper().replace("0", "ZERO")), (10, "\n\n\n"), (11, good * 20000), (12, "x"), (13, good.replace(" ", " ### ")),
    ]
    docs = spark.createDataFrame([(a, b, 5, "z") for a, b in data], "doc_id long, text string, n_words int, other string")
    got = Q.clean_lines(docs).collect()
    assert len(got) == len(data) and got[0].other == "z"
    for (_, text), r in zip(sorted(data, key=str), sorted(got, key=lambda r: str((r.doc_id, r.text)))):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text)
    kept = {r.doc_id: r.kept for r in got}
    assert kept[1] and kept[6] and not any(kept[i] for i in (2, 3, 5, 8, 9, 10, 11, 12, 13))
    clean = {r.doc_id: r.clean_text for r in got}
    assert clean[1] == good and "Privacy" not in clean[6] and clean[5].strip() == good.strip()


def test_lines_of_other_languages_and_separators(spark):
    good = "".join(GOOD.format(i) for i in range(12))
    bad = ["Alle Rechte vorbehalten", "CLIQUEZ ICI pour lire la suite", "Todos los derechos reservados.", "a \u00bb b \u00bb c \u00bb d", "a \u2022 b\u203a c \u00b7", "conditions d'utilisation"]
    stays = ["one \u00bb two.", "caf\u00e9 \u2014 b \u20ac c \u2026 d.", "one two three | four five."]
    docs = spark.createDataFrame([(good + "\n".join([*bad, *stays]),)], "text string")
    row = Q.clean_lines(docs).first()
    assert row.n_failed_lines == len(bad) and row.clean_text == good + "\n".join(stays)


def test_limits(spark):
    docs = spark.createDataFrame([("a b c.",), ("",), (None,)], "text string")
    assert [r.kept for r in Q.clean_lines(docs, least_words=3).collect()] == [True, False, False]
    assert [r.kept for r in Q.clean_lines(docs, least_words=4, texts_too=False).collect()] == [False] * 3


def test_empty_table(spark):
    assert Q.clean_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
