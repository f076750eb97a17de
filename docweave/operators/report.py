"""What a reader asks of documents: their text, Markdown, tables, images, notes, fields and facts.

Each takes views (see sources.views) and gives rows by document. Every document of `docs`
(column doc) has a row, with the fixed message where it has nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.text import size_label, trimmed
from docweave.operators.flow import flow_markdown, joined, text_dump

#: Messages for documents that have nothing of a kind.
NO_TEXT, NO_MARKDOWN = "(텍스트가 비어있습니다 / empty)", "(문서가 비어있습니다 / empty document)"
NO_TABLES, NO_IMAGES, NO_FIELDS, NO_ENTRIES = "(표가 없습니다 / no tables)", "(이미지가 없습니다 / no images)", "(필드가 없습니다 / no fields)", "(BinData 엔트리 없음 / no BinData entries)"
_PLACE = ["section", "paragraph", "control"]


def _order(*of: str) -> Column:
    return F.struct(*(of or _PLACE))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows with `n`, their number in their document from 1."""
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("doc").orderBy(*order)))


def with_all(docs: DataFrame, found: DataFrame, column: str, message: str) -> DataFrame:
    """(doc, column) of every document; the message where the column is missing or blank."""
    return or_message(docs.select("doc").distinct().join(found.select("doc", column), "doc", "left"), column, message)


def full_text(docs: DataFrame, paragraphs: DataFrame, headers_footers: DataFrame, footnotes: DataFrame, equations: DataFrame) -> DataFrame:
    """(doc, text): headers, body, footers, footnotes and equations as lines, all but the body
    under a banner. Empty paragraphs are empty lines."""
    hf = headers_footers.withColumn("line", F.format_string("[section %d %s] %s", "section", "label", "text"))
    hf = hf.select("doc", F.struct("section", "ord").alias("ord"), "line", "kind")
    body = paragraphs.select("doc", F.struct("section", "paragraph").alias("ord"), F.col("text").alias("line"))
    notes = footnotes.select("doc", _order().alias("ord"), F.format_string("[%d] %s", "number", "text").alias("line"))
    return text_dump({
        "headers": hf.filter("kind = 'header'"), "body": docs.select("doc").distinct().join(body, "doc", "left"), "footers": hf.filter("kind = 'footer'"), "footnotes": notes,
        "equations": equation_lines(equations).select("doc", _order().alias("ord"), "line"),
    })


def full_text_of(texts: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """(doc, text) of full_text() from part_views.texts(), with one shuffle on doc; docs may name documents without a section."""
    kinds = ("headers", "body", "footers", "footnotes", "equations")
    every = texts if docs is None else texts.unionByName(docs.select("doc"), allowMissingColumns=True)
    rows = F.array_sort(F.collect_list(F.when(F.col("section").isNotNull(), F.struct("section", *kinds))))
    g = every.groupBy("doc").agg(rows.alias("r"))
    of = lambda k: F.array_join(F.transform("r", lambda x: x[k]), "\n")
    some = lambda k: F.exists("r", lambda x: x[k].isNotNull())
    return g.select("doc", F.concat_ws("\n\n", *(of(k) if k == "body" else F.when(some(k), F.concat(F.lit(f"--- {k} ---\n"), of(k))) for k in kinds)).alias("text"))


def or_message(found: DataFrame, column: str, message: str) -> DataFrame:
    """found with the message where the column is missing or blank."""
    return found.withColumn(column, F.when(trimmed(F.coalesce(column, F.lit(""))) == "", message).otherwise(F.col(column)))


def text(docs: DataFrame, dump: DataFrame) -> DataFrame:
    """(doc, text) of full_text(), with the message for blank ones."""
    return with_all(docs, dump, "text", NO_TEXT)


def equation_lines(equations: DataFrame) -> DataFrame:
    return equations.withColumn("line", F.format_string("[eq %d/%d/%d] %s", "section", "paragraph", "control", "script"))


def dump_lines(dump: DataFrame) -> DataFrame:
    """(doc, n): lines of the whole text, banners and blank ones too, which is what the combined view calls paragraphs."""
    return dump.select("doc", _line_count().alias("n"))


def _line_count() -> Column:
    return F.size(F.split("text", "\n", -1)).cast("long")


def table_blocks(tables: DataFrame) -> DataFrame:
    """(doc, n, heading, markdown) of tables (n_rows, n_cols, markdown) by place."""
    t = numbered(tables, *_PLACE)
    return t.select("doc", "n", F.format_string("### 표 %d (%d행 x %d열)", "n", "n_rows", "n_cols").alias("heading"), "markdown")


def tables_text(docs: DataFrame, tables: DataFrame) -> DataFrame:
    """(doc, text): each table under its heading, followed by an empty line."""
    lines = F.concat("heading", F.lit("\n"), "markdown", F.lit("\n"))
    return with_all(docs, table_blocks(tables).groupBy("doc").agg(joined(lines, F.col("n"), "\n").alias("text")), "text", NO_TABLES)


def image_lines(images: DataFrame, suffix: bool = True) -> DataFrame:
    """(doc, n, line, name) of images by place."""
    end = F.concat(F.lit(" bytes, ."), "ext", F.lit(")")) if suffix else F.lit(" bytes)")
    line = F.concat(F.format_string("%d. [section %d, para %d, ctrl %d] %s (%d", "n", "section", "paragraph", "control", "mime", "byte_length"), end)
    return numbered(images, *_PLACE).select("doc", *_PLACE, "n", line.alias("line"), F.format_string("img_%03d", "n").alias("name"))


def images_text(docs: DataFrame, images: DataFrame) -> DataFrame:
    return with_all(docs, image_lines(images).groupBy("doc").agg(joined(F.col("line"), F.col("n"), "\n").alias("text")), "text", NO_IMAGES)


def combined(dump: DataFrame, tables: DataFrame, images: DataFrame) -> DataFrame:
    """(doc, text): title, counts, the whole text, tables under headings, then the images."""
    t = table_blocks(tables).groupBy("doc").agg(F.count("*").alias("n_tables"), joined(F.concat(F.lit("\n"), "heading", F.lit("\n"), "markdown"), F.col("n"), "\n").alias("tables"))
    i = image_lines(images, suffix=False).groupBy("doc").agg(F.count("*").alias("n_images"), joined(F.col("line"), F.col("n"), "\n").alias("images"))
    d = dump.withColumn("n", _line_count()).join(t.hint("merge"), "doc", "left").join(i.hint("merge"), "doc", "left")
    title = F.concat(F.lit("# "), F.regexp_extract("doc", r"([^/]*)$", 1))
    counts = F.format_string("형식: %s | 문단: %d개 | 표: %d개 | 이미지: %d개", F.upper(F.regexp_extract("doc", r"(\.[^./]*)$", 1)), "n", F.coalesce("n_tables", F.lit(0)), F.coalesce("n_images", F.lit(0)))
    return d.select("doc", F.concat_ws("\n", title, counts, F.lit(""), "text", "tables", F.when(F.col("images").isNotNull(), F.concat(F.lit("\n---\n## 포함된 이미지\n"), "images"))).alias("text"))


def markdown(docs: DataFrame, flow: DataFrame, footnotes: DataFrame, folder: str | None = None) -> DataFrame:
    """(doc, markdown) of flow blocks. An image is a placeholder with its kind and size or, with the
    folder of its files, a link to <folder>/img_001.ext."""
    images = numbered(flow.filter("kind = 'image'"), "section", "paragraph", "sub")
    label = F.concat(F.lit("[image: "), "ext", F.lit(", "), size_label(F.col("byte_length")), F.lit("]"))
    if folder is not None:
        label = F.concat(F.format_string("![img_%03d](", "n"), F.lit(folder + "/"), F.format_string("img_%03d.%s", "n", "ext"), F.lit(")"))
    refs = images.withColumn("image_ref", label)
    blocks = flow.filter("kind <> 'image'").withColumn("image_ref", F.lit(None).cast("string")).unionByName(refs.drop("n"))
    ordered = blocks.withColumn("ord", F.row_number().over(Window.partitionBy("doc").orderBy("section", "paragraph", "sub")))
    notes = footnotes.withColumn("ord", F.row_number().over(Window.partitionBy("doc").orderBy(*_PLACE)))
    return with_all(docs, flow_markdown(ordered, notes.select("doc", "ord", "number", "text")), "markdown", NO_MARKDOWN)


def kind_counts(rows: DataFrame, kinds: list[str], kind: str = "kind") -> DataFrame:
    """(doc, a count for each kind, kinds: how many different ones)."""
    return rows.groupBy("doc").agg(*(F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in kinds), F.count_distinct(kind).alias("kinds"))


def info(docs: DataFrame, sections: DataFrame, counts: DataFrame, fonts: DataFrame, version: DataFrame, encrypted: DataFrame | None = None) -> DataFrame:
    """(doc, text): version, sections, whether it is encrypted (by the codes (doc, code) of opening it, else ?), fonts (ten at most, then ?) and what the document holds. counts is (doc, kind)
    with a row for each table, image, footnote, equation, header and footer; pages need a layout engine and are `?`."""
    kinds = ["table", "image", "footnote", "equation", "header", "footer"]
    c = kind_counts(counts, kinds)
    f = fonts.groupBy("doc").agg(joined(F.when(F.col("n") <= 10, F.col("font")), F.col("n"), ", ").alias("fonts"))
    d = docs.select("doc").distinct().join(sections.groupBy("doc").agg(F.count_distinct("section").alias("sections")), "doc", "left").join(c, "doc", "left").join(f, "doc", "left").join(version, "doc", "left")
    codes = encrypted.select("doc", F.when(F.col("code") == "encrypted", "true").when(F.col("code") == "ok", "false").otherwise("?").alias("_encrypted")) if encrypted is not None else None
    d = d.withColumn("_encrypted", F.lit("?")) if codes is None else d.join(codes, "doc", "left")
    of = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("string")
    labels = zip(("표 (tables)", "이미지 (images)", "각주 (footnotes)", "수식 (equations)", "머리말 (headers)", "꼬리말 (footers)"), kinds, strict=True)
    said = lambda name: F.when(F.coalesce(F.col(name), F.lit("")) == "", "?").otherwise(F.col(name))
    return d.select("doc", F.concat_ws(
        "\n", F.concat(F.lit("# "), "doc"), F.concat(F.lit("버전 (version): "), said("version")), F.concat(F.lit("섹션 (sections): "), of("sections")), F.lit("페이지 (pages): ?"),
        F.concat(F.lit("암호화 (encrypted): "), F.coalesce("_encrypted", F.lit("?"))), F.concat(F.lit("사용 글꼴 (fonts): "), said("fonts")), F.lit(""), *(F.concat(F.lit(f"{label}: "), of(f"n_{k}")) for label, k in labels)).alias("text"))


def page_lines(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, text): page and section properties of each section."""
    lines = F.concat(F.format_string("# section %d\npageDef: ", "section"), F.coalesce("page", F.lit("{}")), F.lit("\nsectionDef: "), F.coalesce("section_def", F.lit("{}")), F.lit("\n"))
    return docs.select("doc").distinct().join(pages.groupBy("doc").agg(joined(lines, F.col("section"), "\n").alias("text")), "doc", "left")


def field_lines(fields: DataFrame) -> DataFrame:
    """(doc, n, line): number, name, type and the first 40 characters of the value, where there are any."""
    kind = F.when(F.coalesce("type", F.lit("")) != "", F.concat(F.lit(" ["), "type", F.lit("]"))).otherwise("")
    value = F.when(F.coalesce("value", F.lit("")) != "", F.concat(F.lit(" = "), F.substring("value", 1, 40))).otherwise("")
    return numbered(fields, "section", "ord").select("doc", "n", F.concat(F.col("n").cast("string"), F.lit(". "), F.coalesce("name", F.lit("?")), kind, value).alias("line"))


def fields_text(docs: DataFrame, fields: DataFrame) -> DataFrame:
    return with_all(docs, field_lines(fields).groupBy("doc").agg(joined(F.col("line"), F.col("n"), "\n").alias("text")), "text", NO_FIELDS)


def field_value(fields: DataFrame, name: str) -> DataFrame:
    """(doc, value): the first field of that name; documents without it have no row."""
    return fields.filter(F.col("name") == name).groupBy("doc").agg(F.min_by("value", F.struct("section", "ord")).alias("value"))


def binary_entries(members: DataFrame) -> DataFrame:
    """(doc, n, entry): BinData members by name."""
    return numbered(members.filter(F.col("entry").startswith("BinData/")).select("doc", "entry").distinct(), "entry")


def entries_text(docs: DataFrame, members: DataFrame) -> DataFrame:
    lines = F.concat(F.col("n").cast("string"), F.lit(". "), "entry")
    return with_all(docs, binary_entries(members).groupBy("doc").agg(joined(lines, F.col("n"), "\n").alias("text")), "text", NO_ENTRIES)


def first_rows(rows: DataFrame, limit: int, *order: str) -> DataFrame:
    """The first `limit` rows of each document, none if it is negative."""
    return numbered(rows, *order).filter(F.col("n") <= max(0, limit))


def preview(rows: DataFrame, column: str, limit: int = 10) -> DataFrame:
    """(doc, text): the first values by n, then how many more there are."""
    n = F.count("*")
    head = joined(F.when(F.col("n") <= limit, F.concat(F.lit("  - "), column)), F.col("n"), "\n")
    return rows.groupBy("doc").agg(F.concat(head, F.when(n > limit, F.format_string("\n  ... and %d more", n - limit)).otherwise("")).alias("text"))
