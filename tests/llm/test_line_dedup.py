"""Line deduplication: brute force over words, odd rows, documents left without lines."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F
from tests_paths import SF001

from strandline.llm import line_dedup as d


def words(line):
    return re.findall(r"[^\x20\x09-\x0D]+", line)


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    """(doc_id, n_exact, n_near, text) of texts with distinct ids."""
    first = {}
    lines = [(i, n, line) for i, t in rows for n, line in enumerate((t or "").split("\n"))]
    for i, n, line in sorted(lines):
        first.setdefault(tuple(words(line)), (i, n))
    near = {w for w, p in first.items() if len(w) >= 8
            and any(q < p and len(v) >= 8 and v != w and one_edit(list(v), list(w)) for v, q in first.items())}
    out = []
    for i, t in rows:
        keep, exact, close = [], 0, 0
        for n, line in enumerate((t or "").split("\n")):
            w = tuple(words(line))
            if len(w) >= 3 and first[w] < (i, n):
                exact += 1
            elif w in near:
                close += 1
            else:
                keep.append(line)
        out.append((i, exact, close, "\n".join(keep) if t is not None else None))
    return sorted(out)


def got(df):
    return sorted((r["doc_id"], r["n_exact"], r["n_near"], r["text"]) for r in d.dedup_lines(df).collect())


def test_random_edits(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(12)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([2, 3, 7, 8, 9, 10, 11, 12]))] for _ in range(25)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 4)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(w) + 1)
                w = rng.choice([w[:k] + [rng.choice(vocabulary)] + w[k:], w[:k] + w[k + 1:], w[:k] + ["x"] + w[k + 1:]])
            lines.append(rng.choice([" ", "\t", "  "]).join(w) + rng.choice(["", " ", "\r"]))
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)


def test_many_lines_that_differ_at_one_place(spark):
    rows = [(i, f"entry number {i} of the list that all share these words") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r[2] for r in got(df)] == [0] + [1] * 299


@pytest.mark.parametrize("a,b,near", [
    ("a b c d e f g h", "a b c d e f g X", True), ("a b c d e f g h", "b c d e f g h", False),
    ("a b c d e f g h i", "b c d e f g h i", True), ("a b c d e f g h", "a b X Y e f g h", False),
    ("a b c d e f g h", "b a c d e f g h", False), ("x x x x x x x x", "x x x x x x x x x", True),
])
def test_pairs(spark, a, b, near):
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert got(df)[1][2] == int(near)


def test_within_one(spark):
    rng = random.Random(1)
    rows = [([rng.choice("abc") for _ in range(rng.randint(1, 6))], [rng.choice("abc") for _ in range(rng.randint(1, 6))]) for _ in range(500)]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    for r in df.select("a", "b", d.within_one(F.col("a"), F.col("b")).alias("x")).collect():
        assert r["x"] == one_edit(r["a"], r["b"]), r


def test_query_on_table(spark):
    import __spark_entry__ as se
    from oracle import compare, duck

    ok, why = compare(se.queries()["op1_line_dedup"](spark, SF001), duck(SF001), se.oracle_sql()["op1_line_dedup"])
    assert ok, why


def test_odd_rows(spark, edge, empty):
    rows = d.dedup_lines(edge).collect()
    assert len(rows) == edge.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert [r["n_exact"] for r in by[1]] == [0, 0, 0]            # a repeated row does not remove its own lines
    assert by[8][0]["n_exact"] == 1 and by[8][0]["copied"]
    assert by[2][0]["text"] is None and by[3][0]["text"] == "" and by[2][0]["n_lines"] == 0
    assert by[7][0]["n_exact"] == 0                              # two-word lines stay
    kept = d.clean_lines(edge)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 1, 1, 2, 3, 4, 5, 6, 7, 9]
    assert d.dedup_lines(empty).count() == 0 and d.clean_lines(empty).count() == 0


def test_length_follows(spark):
    df = spark.createDataFrame([(1, "one two three\nfour five six", 27), (2, "one two three\nseven eight nine", 31)], "doc_id long, text string, n_chars long")
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in d.clean_lines(df).collect()) == [
        (1, "one two three\nfour five six", 27), (2, "seven eight nine", 16)]


def test_a_text_is_split_once_and_a_line_put_in_order_once(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    plan = d.occurrences(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("regexp_replace(") == 1


def test_white_space_between_words_does_not_count(spark):
    line = "one two three four five six seven eight nine"
    odd = ["  one  two three four five six seven eight nine ", line.replace(" ", "\t"), line.replace(" ", "\x0b", 2),
           line.replace(" ", "\x0c\r"), line + "\r", line.replace("two", "\u00a0two")]
    rows = [(0, line), *((i + 1, x) for i, x in enumerate(odd)), (90, None), (91, ""), (92, "\n\n \t\n")]
    got = {r["doc_id"]: r for r in d.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(got[i]["n_exact"], got[i]["n_near"]) for i in range(7)] == [(0, 0), *5 * [(1, 0)], (0, 1)]  # a no-break space is part of a word
    assert [got[i]["n_lines"] for i in (90, 91, 92)] == [0, 0, 0]
