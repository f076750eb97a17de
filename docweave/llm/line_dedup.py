"""Line dedup by a deletion-neighbourhood join, for lines within one edit.

Lines of equal length within one substitution are equal once the same place is deleted
from both; a line one character shorter equals the longer one with a character
deleted. Variants are emitted as hashed keys, equal ones meet, and the edit distance of
those that meet is verified. Deleting every place of long lines would be quadratic, so
a line is first halved, but for short ones: an edit leaves one half as it is. Only lines that share a half with
another are halved again, down to parts short enough to delete every place of.

A group of equal variants is aggregated to its earliest line, never paired. DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, own_columns, stored

#: Parts up to this length are not halved again.
LEAF = 24
#: Pairs whose shorter line is shorter than this are not halved at all: halves of such lines are too common to tell much.
WHOLE = 20
#: A line on more rows than this, and than a ten-thousandth, is taken from its first row alone.
HOT_LINES = 500
#: As many lines' hashes are broadcast at most, 16 bytes each; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
SAME, SHORT, LONG = 0, 1, 2


def _lines(docs: DataFrame) -> DataFrame:
    """(id, doc, pos, digest, line) of every line that is not blank."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(_order_of(F.col("doc_id")).alias("doc"), F.xxhash64(text).alias("digest"), F.split(text, "\n", -1).alias("all"))  # once a text, not a line
    return (
        texts.select("doc", "digest", F.posexplode("all").alias("pos", "line"))
        .filter(F.col("line").rlike(r"\S")).select(F.struct(F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b")).alias("id"), "doc", "pos", "digest", "line")
    )


def _cut(text: Column, role: int, left: bool) -> tuple[Column, Column, Column]:
    """(m, kept, part) of `text` with its left or right half kept: m is the length of the shorter of a pair, part what remains."""
    n, extra = F.char_length(text), 1 if role == LONG else 0
    m = n - extra
    half = F.shiftright(m, 1)
    if left:  # the left half stays
        return m, F.substring(text, F.lit(1), half), F.substring(text, half + 1, n)
    return m, F.substring(text, half + 1 + extra, n), F.substring(text, F.lit(1), half + extra)


def _halves(text: Column, before: Column, roles: Column | None) -> Column:
    """Both ways to keep a half of `text` in its role: array<struct<key, role, left, part>>; key: hash of what is kept,
    part: what remains. before: hash of what was kept. Of whole lines (roles is None) parts are not cut, as few lines need
    them, and there are two roles: as the shorter a line keeps what it keeps as one of two of equal length, so SAME is both.
    Those of one byte a character are cut as bytes, which have the same hashes and are not walked through."""

    def of(text: Column, role: int, left: bool) -> Column:
        m, kept, part = _cut(text, role, left)
        tag = F.lit(left if roles is None else 10 * (role == SAME) + left)
        key = F.xxhash64(before, tag, m, kept)
        return F.struct(key.alias("key"), F.lit(role).alias("role"), F.lit(left).alias("left"), *([] if roles is None else [part.alias("part")]))

    if roles is None:
        raw, chars = (F.array(*(of(x, role, left) for role in (SAME, LONG) for left in (True, False))) for x in (text.cast("binary"), text))
        return F.when(F.octet_length(text) == F.char_length(text), raw).otherwise(chars)
    same, short, long = (F.array(of(text, role, True), of(text, role, False)) for role in (SAME, SHORT, LONG))
    return F.when(roles == SAME, same).when(roles == SHORT, short).otherwise(long)


def _met(rows: DataFrame) -> DataFrame:
    """(key, same, roles) of the keys at which lines meet: same if several have the role SAME, roles if one is the longer and one
    not. Keys are aggregated before they are shuffled, so a half that very many lines share is one row a task."""
    alike = F.when(F.col("role") == SAME, F.col("id.a"))
    had = F.when(F.col("role") == SAME, 1 << SAME).when(F.col("role") == SHORT, 1 << SHORT).otherwise(1 << LONG)
    met = rows.groupBy("key").agg(F.min(alike).alias("i0"), F.max(alike).alias("i1"), F.bit_or(had).alias("had"))
    both = (F.col("had") >= 1 << LONG) & (F.col("had") != 1 << LONG)
    return met.select("key", F.coalesce(F.col("i0") != F.col("i1"), F.lit(False)).alias("same"), both.alias("roles")).filter("same or roles")


def _meeting(rows: DataFrame, met: DataFrame | None = None) -> DataFrame:
    """Rows (id, key, role, ...) whose key another line has, in the other role if roles differ, with what _met says of the key.
    The join brings rows to keys; where keys are too many to broadcast, the tasks of a key with very many rows are split."""
    met = stored(_met(rows)) if met is None else met
    met = F.broadcast(met) if met.count() <= MOST_BROADCAST else met
    return rows.join(met, "key").filter((F.col("role") == SAME) | F.col("roles"))


def _variants(leaves: DataFrame) -> DataFrame:
    """(id, key, role): each place of a part deleted, or a shorter line's part as it is."""
    part, n = F.col("part"), F.char_length("part")
    without = lambda p: F.concat(F.substring(part, F.lit(1), p), F.substring(part, p + 2, n))
    places = F.sequence(F.lit(0), n - 1)
    keys = (
        F.when(F.col("role") == SHORT, F.array(F.xxhash64("key", part)))
        .when(n == 0, F.array().cast("array<bigint>"))
        .when(F.col("role") == LONG, F.array_distinct(F.transform(places, lambda p: F.xxhash64("key", without(p)))))
        .otherwise(F.transform(places, lambda p: F.xxhash64("key", p, without(p))))
    )
    return leaves.select("id", "role", F.explode(keys).alias("key"))


def _short_leaves(firsts: DataFrame) -> DataFrame:
    """(id, key, role, part) of the short lines, whole, in each role whose pairs' shorter line is shorter than WHOLE."""
    n = F.char_length("short")
    roles = F.when(n < WHOLE, F.array(*map(F.lit, (SAME, SHORT, LONG)))).otherwise(F.array(F.lit(LONG)))
    rows = firsts.filter("short is not null").select("id", F.col("short").alias("part"), F.explode(roles).alias("role"))
    m = F.char_length("part") - F.when(F.col("role") == LONG, 1).otherwise(0)  # alike for both of a pair
    return rows.select("id", F.xxhash64(F.lit(0), F.col("role") == SAME, m).alias("key"), "role", "part")


def near_lines(docs: DataFrame, least_chars: int = 0) -> tuple[DataFrame, DataFrame]:
    """(firsts, later): firsts is (id, doc, pos, digest) of the earliest row of each
    distinct line; later is (id) of lines within one edit of an earlier one."""
    lines = _lines(docs)
    least = max(least_chars, WHOLE)
    short = F.char_length("line").between(least_chars, WHOLE)  # one longer than the longest of WHOLE's pairs' shorter lines
    kept = F.min(F.when(short, F.col("line"))).alias("short")
    firsts = stored(lines.groupBy("id").agg(F.min(F.struct("doc", "pos", "digest")).alias("first"), F.count("*").alias("rows"), kept))
    total = firsts.agg(F.sum("rows")).first()[0] or 0
    hot = firsts.filter(F.col("rows") > max(HOT_LINES, total // 10_000)).select("id", F.col("first").alias("hot"))  # under 10,000
    once = lines.join(F.broadcast(hot), "id", "left").filter(F.col("hot").isNull() | (F.col("hot") == F.struct("doc", "pos", "digest")))
    once = once.filter(F.char_length("line") >= least)
    halves = once.select("id", "line", _halves(F.col("line"), F.lit(0), None).alias("halves"))  # not in the generator: so n is counted once
    keys = halves.select("id", F.inline("halves"))
    met = stored(_met(keys))
    if met.count() <= MOST_BROADCAST:  # rows that meet none end where they are made, so lines may go along
        near = stored(_meeting(halves.select("id", "line", F.inline("halves")), met).distinct())
    else:
        near = stored(_meeting(keys, met).distinct())
        ids = near.select("id").distinct()
        ids = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
        near = stored(near.join(once.select("id", "line").join(ids, "id").distinct(), "id"))
    texts = near.select("id", "line").distinct()
    taken = F.when(F.col("role") == LONG, F.array(F.lit(LONG))).when(~F.col("roles"), F.array(F.lit(SAME)))
    taken = taken.when(~F.col("same"), F.array(F.lit(SHORT))).otherwise(F.array(F.lit(SAME), F.lit(SHORT)))
    level = near.withColumn("role", F.explode(taken))
    rest = [F.when(F.col("left"), _cut(F.col("line"), role, True)[2]).otherwise(_cut(F.col("line"), role, False)[2]) for role in (SAME, LONG)]
    level = level.select("id", "key", "role", F.when(F.col("role") == LONG, rest[1]).otherwise(rest[0]).alias("part"))
    leaves, deep = [_short_leaves(firsts)], level
    shorter = F.char_length("part") - F.when(F.col("role") == LONG, 1).otherwise(0)  # alike for both of a pair
    while True:
        leaves.append(deep.filter(shorter <= LEAF))
        deep = deep.filter(shorter > LEAF)
        if deep.isEmpty():
            break
        parts = deep.select("id", F.inline(_halves(F.col("part"), F.col("key"), F.col("role")))).select("id", "key", "role", "part")
        deep = stored(_meeting(parts).select("id", "key", "role", "part"))
    variants = _variants(_union(leaves))
    order = stored(variants.join(firsts.select("id", "first"), "id").select("id", "key", "role", "first"))
    best = order.groupBy("key").agg(*(F.min(F.when(F.col("role") == r, F.struct("first", "id"))).alias(f"r{r}") for r in (SAME, SHORT, LONG)))
    rival = F.when(F.col("role") == SAME, F.col("r0")).when(F.col("role") == SHORT, F.col("r2")).otherwise(F.col("r1"))
    claims = order.join(best, "key").withColumn("rival", rival).filter(F.col("rival.first") < F.col("first")).select("id", F.col("rival.id").alias("by")).distinct()
    texts = texts.unionByName(firsts.filter("short is not null").select("id", F.col("short").alias("line")))
    a, b = texts.select("id", F.col("line").alias("a")), texts.select(F.col("id").alias("by"), F.col("line").alias("b"))
    verified = claims.join(a, "id").join(b, "by").filter(F.levenshtein("a", "b", 1) == 1)
    return firsts, verified.select("id").distinct()


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def dedup_lines(docs: DataFrame, least_chars: int = 0) -> DataFrame:
    """docs with two more columns n_lines and n_removed, and with text less the lines
    of which an equal one, or one within one edit (insertion, deletion or substitution
    of a character), comes earlier: at a smaller doc_id, or in the same document before.

    Lines end at newlines. Blank ones stay and are not compared; lines under
    `least_chars` characters, if it is set above 1, are compared for equality only. Lines are judged on the
    input, and equal by a 128-bit hash. A null text counts as empty and stays null; a null doc_id counts as larger than all.
    Rows that share doc_id and text count as one. Columns that docs has of
    those two names are replaced. An empty table gives an empty result."""
    firsts, later = near_lines(docs, least_chars)
    doc, digest, pos, own, own_digest, lines, stays, n, gone = fresh(docs, "kept_doc", "kept_digest", "kept_pos", "own_doc", "own_digest", "own_lines", "own_stays", "all_lines", "gone_lines")
    kept = firsts.join(later, "id", "left_anti").groupBy(F.col("first.doc").alias(doc), F.col("first.digest").alias(digest)).agg(F.collect_list("first.pos").alias(pos))
    base = docs.select(*own_columns(docs, "n_lines", "n_removed"))
    rows = base.withColumns({own: _order_of(F.col("doc_id")), own_digest: F.xxhash64(F.coalesce("text", F.lit("")))})
    rows = rows.join(kept, (F.col(own) == F.col(doc)) & (F.col(own_digest) == F.col(digest)), "left").withColumn(lines, F.split("text", "\n", -1))
    rows = rows.withColumn(stays, F.filter(lines, lambda x, i: ~x.rlike(r"\S") | F.array_contains(F.coalesce(F.col(pos), F.array().cast("array<int>")), i)))
    count = lambda c: F.when(F.col("text").isNull(), 0).otherwise(c).cast("long")
    rows = rows.withColumns({n: count(F.size(lines)), gone: count(F.size(lines) - F.size(stays))}).withColumn("text", F.array_join(stays, "\n"))
    return rows.select(*own_columns(base), F.col(n).alias("n_lines"), F.col(gone).alias("n_removed"))


def _order_of(doc_id: Column) -> Column:
    """doc_id as a value that sorts like it, null last, and that no id shares with null."""
    return F.struct(doc_id.isNull().alias("none"), F.coalesce(doc_id.cast("long"), F.lit(0)).alias("id"))
