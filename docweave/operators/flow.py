"""Ordered text and Markdown of documents, from views of paragraphs, blocks and notes.

Views: paragraphs (doc, section, paragraph, text); blocks (doc, ord, kind, text,
heading_level, table_md, image_ref, script); footnotes (doc, ord, number, text).
Each operator has one shuffle, on doc; order is data, imposed by `ord`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.text import trimmed


def joined(text: Column, order: Column, sep: str) -> Column:
    """Aggregate: texts joined in order; null texts are left out. A document's lines
    are gathered in one row, as its text is."""
    rows = F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct(order.alias("o"), text.alias("t")))))
    return F.array_join(F.transform(rows, lambda r: r["t"]), sep)


def block_chunk(body: Column) -> Column:
    """A block as Markdown, its trimmed text being `body`; null where it leaves no chunk."""
    para = F.when(body != "", F.when(F.col("heading_level").isNotNull(), F.concat(F.repeat(F.lit("#"), F.col("heading_level")), F.lit(" "), body)).otherwise(body))
    return (
        F.when(F.col("kind") == "para", para).when(F.col("kind") == "table", F.col("table_md"))
        .when(F.col("kind") == "image", F.col("image_ref")).when(F.col("kind") == "equation", F.concat(F.lit("$"), F.col("script"), F.lit("$")))
    )


def flow_markdown(blocks: DataFrame, footnotes: DataFrame | None = None) -> DataFrame:
    """(doc, markdown): chunks parted by a blank line, notes after a rule."""
    bodies = blocks.withColumn("_body", trimmed(F.col("text")))
    chunks = bodies.select("doc", F.lit(0).alias("grp"), F.col("ord").cast("long").alias("ord"), block_chunk(F.col("_body")).alias("chunk"))
    if footnotes is not None:
        line = F.concat(F.lit("[^"), F.col("number").cast("string"), F.lit("]: "), F.col("text"))
        notes = footnotes.groupBy("doc").agg(joined(line, F.col("ord"), "\n").alias("lines"))
        chunks = chunks.unionByName(notes.select("doc", F.lit(1).alias("grp"), F.lit(0).cast("long").alias("ord"), F.concat(F.lit("---\n\n"), "lines").alias("chunk")))
    return chunks.groupBy("doc").agg(joined(F.col("chunk"), F.struct("grp", "ord"), "\n\n").alias("markdown"))


def text_dump(groups: dict[str, DataFrame]) -> DataFrame:
    """(doc, text) of line sets (doc, ord, line) named headers, body, footers, footnotes
    and equations, in this order; all but the body under a banner and parted by blank lines."""
    every = None
    for at, name in enumerate(("headers", "body", "footers", "footnotes", "equations")):
        if name not in groups:
            continue
        text = groups[name].groupBy("doc").agg(joined(F.col("line"), F.col("ord"), "\n").alias("text"))
        if name != "body":
            text = text.withColumn("text", F.concat(F.lit(f"--- {name} ---\n"), "text"))
        text = text.select("doc", F.lit(at).alias("at"), "text")
        every = text if every is None else every.unionByName(text)
    return every.groupBy("doc").agg(joined(F.col("text"), F.col("at"), "\n\n").alias("text"))


def first_of_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")


def distinct_headers(items: DataFrame) -> DataFrame:
    """Headers and footers (doc, section, kind, apply_to, ord, exists, label, text): of
    each key the first counts, and then only if it exists; text trimmed."""
    kept = first_of_key(items, ["doc", "section", "kind", "apply_to"], ["ord"])
    return kept.filter("exists").withColumn("text", trimmed(F.col("text"))).drop("exists")


def flow_blocks(paragraphs: DataFrame, controls: DataFrame) -> DataFrame:
    """(doc, section, paragraph, sub, kind): a para block for each paragraph, then its
    controls, each an equation, else a table, else an image, else dropped."""
    kind = F.when(F.coalesce(F.col("script"), F.lit("")) != "", "equation").when((F.col("rows") > 0) & (F.col("cols") > 0), "table").when(F.coalesce(F.col("mime"), F.lit("")) != "", "image")
    a = paragraphs.select("doc", "section", "paragraph", F.lit(-1).alias("sub"), F.lit("para").alias("kind"))
    b = controls.select("doc", "section", "paragraph", F.col("control_idx").alias("sub"), kind.alias("kind")).filter("kind is not null")
    return a.unionByName(b)
