"""Edits of paragraphs, templates, fields, styles and package entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.text import replace_keys, xml_escape


def append_paragraph(paras: Column, text: Column) -> Column:
    return F.array_append(paras, text)


def delete_paragraph(paras: Column, n: Column) -> Column:
    """Out of range: unchanged."""
    return F.filter(paras, lambda _, i: i != n)


def set_paragraph(paras: Column, n: Column, text: Column) -> Column:
    return F.transform(paras, lambda p, i: F.when(i == n, text).otherwise(p))


def fill_template(nodes: DataFrame, pairs: list[tuple[str, str]], text: str = "text") -> DataFrame:
    """nodes with `text` filled and a boolean column hit_i for each ordered pair."""
    filled, hits = replace_keys(F.col(text), pairs)
    return nodes.select(*(filled.alias(c) if c == text else c for c in nodes.columns), *(h.alias(f"hit_{i}") for i, h in enumerate(hits)))


def template_counts(nodes: DataFrame, pairs: list[tuple[str, str]], text: str = "text") -> DataFrame:
    """(ord, key, hits) of all pairs, those without a hit too: one row a pair."""
    filled = fill_template(nodes, pairs, text).agg(*(F.count_if(f"hit_{i}").alias(f"n{i}") for i in range(len(pairs))))
    rows = F.array(*(F.struct(F.lit(i).alias("ord"), F.lit(k).alias("key"), F.col(f"n{i}").alias("hits")) for i, (k, _) in enumerate(pairs)))
    return filled.select(F.inline(rows))


def set_field(xml: Column, name: str, value: str) -> Column:
    """Plain text nodes between the markers of the field get the value; null without such a field."""
    start = F.position(F.lit(f'name="{name}"'), xml)
    stop = F.position(F.lit("<hp:fldEnd"), xml, start)
    before, span, after = F.substring(xml, F.lit(1), start - 1), F.substring(xml, start, stop - start), F.substring(xml, stop, F.char_length(xml))
    safe = xml_escape(F.lit(value))
    body = F.regexp_replace(span, F.lit(r"<hp:t>[^<]*</hp:t>"), F.concat(F.lit("<hp:t>"), F.regexp_replace(safe, r"([\\$])", r"\\$1"), F.lit("</hp:t>")))
    return F.when((start > 0) & (stop > 0), F.concat(before, body, after))


def next_id(styles: DataFrame, key: list[str], ident: str = "id") -> DataFrame:
    """The id of a new style of each document: the largest plus one."""
    return styles.groupBy(*key).agg((F.max(ident) + 1).alias("new_id"))


def free_name(entries: DataFrame, ext: str) -> DataFrame:
    """(doc, entry): the first BinData/imageN.ext that a document does not have, N from 1."""
    n = F.regexp_extract("entry", rf"^BinData/image(\d+)\.{ext}$", 1)
    used = entries.groupBy("doc").agg(F.collect_set(F.when(n != "", n.cast("int"))).alias("used"))
    free = F.array_min(F.array_except(F.sequence(F.lit(1), F.size("used") + 1), F.col("used")))
    return used.select("doc", F.format_string(f"BinData/image%d.{ext}", free).alias("entry"))


def match_entry(entries: DataFrame, target: str) -> DataFrame:
    """(doc, entry): the first BinData entry by seq that is the target, or ends in it after a slash."""
    e = F.col("entry")
    hit = e.startswith("BinData/") & ((e == target) | e.endswith("/" + target))
    return entries.filter(hit).groupBy("doc").agg(F.min_by("entry", "seq").alias("entry"))


def replace_entry(entries: DataFrame, target: str, content: Column) -> DataFrame:
    found = match_entry(entries, target).withColumn("_hit", F.lit(True))
    return entries.join(found, ["doc", "entry"], "left").withColumn("bytes", F.when(F.col("_hit"), content).otherwise(F.col("bytes"))).drop("_hit")


def delete_entry(entries: DataFrame, target: str) -> DataFrame:
    return entries.join(match_entry(entries, target), ["doc", "entry"], "left_anti")
