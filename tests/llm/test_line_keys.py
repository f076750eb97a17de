"""The first keys of lines: four a line, made in generated code, and what they say of lines that meet."""

import random

from pyspark.sql import functions as F

from docweave.llm import line_dedup


def test_lines_have_four_keys_in_generated_code(spark, monkeypatch):
    """Two halves as one of equal length or the shorter, two as the longer; a text is hashed once, not for each of its lines."""
    plans, stored = [], line_dedup.stored

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    monkeypatch.setattr(line_dedup, "stored", seen)
    docs = spark.createDataFrame([(1, "one line of text that is long enough\nand another one of such a length"), (2, "one line of text that is long enouch")], "doc_id long, text string")
    assert [(x.doc_id, x.n_removed) for x in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()] == [(1, 0), (2, 1)]
    first = [p for p in plans if "posexplode" in p]
    assert len(first) >= 3 and not [p for p in first if "lambda" in p]
    texts = [line for p in first for line in p.splitlines() if "xxhash64(coalesce(text" in line]
    assert texts and not [x for x in texts if "pos#" in x or "line#" in x]
    keys = docs.select(F.explode(F.split("text", "\n")).alias("line")).select(F.inline(line_dedup._halves(F.col("line"), F.lit(0), None)))
    assert keys.count() == 4 * 3 and "part" not in keys.columns


def test_keys_tell_equal_lengths_from_one_more(spark):
    """Of two lines one edit apart some key says how they meet: by substitution, or by one character more."""
    r = random.Random(4)
    pairs = {}
    for n in (20, 21, 22, 23, 40, 41, 200, 201):
        for at in (0, n // 2 - 1, n // 2, n // 2 + 1, n - 1):
            for more in (0, 1):
                line = "".join(r.choice("abé 한") for _ in range(n))
                pairs[len(pairs)] = (line, line[:at] + "Z" + line[at + 1 - more :], more)
    lines = spark.createDataFrame([(i, x) for i, (a, b, _) in pairs.items() for x in (a, b)], "pair long, line string")
    lines = lines.select("pair", F.struct(F.xxhash64("line").alias("a")).alias("id"), "line")
    got = {}
    for x in line_dedup._meeting(lines.select("pair", "line", "id", F.inline(line_dedup._halves(F.col("line"), F.lit(0), None)))).collect():
        got.setdefault(x.pair, set()).add((x.line, x.role, x.same, x.roles))
    for i, (a, b, more) in pairs.items():
        assert got[i] == ({(a, 0, False, True), (b, 2, False, True)} if more else {(a, 0, True, False), (b, 0, True, False)})


def test_lines_of_bytes_meet_lines_of_characters(spark):
    """A line of one byte a character and one with a longer character in it have the keys of what they share."""
    line = "a plain line of one byte a character, long enough for halves"
    texts = [line, line[:9] + "é" + line[10:], line[:50] + "한" + line[50:], line[:-1] + "é", "é" + line]
    for other in texts[1:]:
        docs = spark.createDataFrame([(1, line), (2, other)], "doc_id long, text string")
        assert [x.n_removed for x in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()] == [0, 1]


def test_keys_too_many_to_broadcast(spark, monkeypatch):
    """Lines come by a join of their own then, with the same result."""
    lines = ["a line of text that is long enough", "a line of text that is long enouch", "b line of text that is long enough!", "another line of about such a length"]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    for most in (1_000_000, 0):
        monkeypatch.setattr(line_dedup, "MOST_BROADCAST", most)
        assert [x.n_removed for x in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()] == [0, 1, 0, 0]
