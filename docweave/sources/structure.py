"""Sections as nested structures: elements as JSON with their children, and the flow as semantic HTML.

Both are written token by token: what a token adds depends on itself, on the token before it and on the element around it,
so one shuffle on the part puts any nesting together, however deep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.text import xml_escape, xml_unescape
from docweave.sources.markup import attribute
from docweave.sources.views import _KEY, _said, manifest, styles

#: HTML elements of controls that hold paragraphs, and of tables.
BLOCKS = {"hp:tbl": "table", "hp:footNote": "aside", "hp:endNote": "aside", "hp:header": "header", "hp:footer": "footer"}
#: Kinds of pieces of HTML: as they are, a paragraph's start and end, a picture.
PLAIN, START, END, PICTURE = range(4)


def _string(x: Column) -> Column:
    """A JSON string."""
    whole = F.to_json(F.array(x))
    return F.substring(whole, F.lit(2), F.char_length(whole) - 2)


def _attributes(tok: Column) -> Column:
    """A JSON object of a tag's attributes in their order."""
    pairs = F.regexp_extract_all(tok, F.lit(r"""\s([\w:.-]+\s*=\s*(?:"[^"]*"|'[^']*'))"""), 1)

    def member(p: Column) -> Column:
        name = F.regexp_extract(p, r"^([\w:.-]+)", 1)
        value = F.regexp_extract(p, r"(?s)^[^=]*=\s*(.*)$", 1)
        return F.concat(_string(name), F.lit(":"), _string(xml_unescape(F.substring(value, F.lit(2), F.char_length(value) - 2))))

    return F.concat(F.lit("{"), F.array_join(F.transform(pairs, member), ","), F.lit("}"))


def nested_json(t: DataFrame, own: Column, name: str) -> DataFrame:
    """(doc, section, json): the first element `name` of each section, at any depth, with all it holds, as
    {"name", "attributes", "children"}; text is a JSON string among the children, blank text, comments and the like are left
    out. `own` tells the tokens of such elements; sections without one have no row."""
    kind, tok = F.col("kind"), F.col("tok")
    data = tok.startswith("<![CDATA[")
    raw = F.substring(tok, F.lit(len("<![CDATA[") + 1), F.char_length(tok) - len("<![CDATA[]]>"))
    text = F.when(kind == "text", xml_unescape(tok)).when(data, raw)
    said = F.when(text.rlike(r"\S"), _string(text))
    start = F.concat(F.lit('{"name":'), _string(F.col("name")), F.lit(',"attributes":'), _attributes(tok), F.lit(',"children":['))
    piece = F.when(kind == "open", start).when(kind == "empty", F.concat(start, F.lit("]}"))).when(kind == "close", "]}").otherwise(said)
    rows = t.filter(own).select(*_KEY, "at", kind.alias("kind"), piece.alias("piece"), ((F.col("name") == name) & kind.isin("close", "empty") & ~data).alias("ends")).filter("piece is not null")
    whole = rows.groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("at", "kind", "piece"))).alias("r"), F.min(F.when(F.col("ends"), F.col("at"))).alias("stop"))
    whole = whole.withColumn("r", F.filter("r", lambda x: F.col("stop").isNull() | (x["at"] <= F.col("stop"))))

    def placed(x: Column, i: Column) -> Column:
        first = (i == 0) | (x["kind"] == "close") | (F.get(F.col("r"), i - 1)["kind"] == "open")
        return F.concat(F.when(first, "").otherwise(","), x["piece"])

    return whole.select(*_KEY, F.array_join(F.transform("r", placed), "").alias("json"))


def page_definitions(t: DataFrame) -> DataFrame:
    """(doc, section, json): each section's first hp:secPr with its children at every depth (page, margins, notes, borders),
    as nested_json() gives them."""
    return nested_json(t, F.col("in_props") > 0, "hp:secPr")


def _cells(t: DataFrame) -> DataFrame:
    """(doc, entry, section, at, tag): the HTML start of each cell at any nesting. A cell's span stands behind its content, as
    a child of the cell; of cells and spans of one depth in order, each span is that of the cell before it."""
    has = (F.col("name") == "hp:tc") & F.col("kind").isin("open", "empty")
    span = (F.col("name") == "hp:cellSpan") & (F.col("kind") != "close")
    marks = t.filter(has | span).select("doc", "entry", "section", "at", "tok", "kind", has.alias("has"), (F.col("depth") - span.cast("int")).alias("_level"))
    follow = F.lead(F.struct("has", "tok")).over(Window.partitionBy("doc", "entry", "_level").orderBy("at"))
    tag = F.when(~follow["has"], follow["tok"]).otherwise(F.col("tok"))
    n = lambda name: F.coalesce(attribute(tag, name).cast("int"), F.lit(1))
    told = lambda name, html: F.when(n(name) > 1, F.format_string(f' {html}="%d"', n(name))).otherwise("")
    html = F.concat(F.lit("<td"), told("rowSpan", "rowspan"), told("colSpan", "colspan"), F.when(F.col("kind") == "empty", "></td>").otherwise(">"))
    return marks.withColumn("html", html).filter("has").select("doc", "entry", "section", "at", "html")


def html(t: DataFrame, members: DataFrame) -> DataFrame:
    """(doc, section, html): a section's paragraphs as p, or h1 to h6 by outline styles, tables with their spans at any
    nesting, notes as aside, page headers and footers, equations as code, pictures as img with their member's name. A
    table or note ends the paragraph it stands in, which goes on behind it; paragraphs with nothing in them are left
    out, a section of such alone is an empty string."""
    name, kind, tok = F.col("name"), F.col("kind"), F.col("tok")
    starts, ends = kind == "open", kind == "close"
    p, block = name == "hp:p", name.isin(*BLOCKS)
    # The style of the paragraph around each paragraph mark and block: of marks in equally many paragraphs, the last start's.
    marks = t.filter((p | block) & (starts | ends))
    around = F.last(F.when(p & starts, F.coalesce(attribute(tok, "styleIDRef"), F.lit(""))), True).over(Window.partitionBy("doc", "entry", "in_p").orderBy("at"))
    marks = marks.withColumn("style", around)
    tag = F.create_map(*(F.lit(x) for kv in BLOCKS.items() for x in kv))[name]

    def pieces(rows: DataFrame, *parts: tuple[int, Column | str]) -> DataFrame:
        """A row for each of a token's parts (kind of piece, HTML)."""
        each = F.array(*(F.struct(F.lit(i).alias("nth"), F.lit(k).alias("role"), (F.lit(x) if isinstance(x, str) else x).alias("html")) for i, (k, x) in enumerate(parts)))
        return rows.select("doc", "entry", "section", "at", F.col("style") if "style" in rows.columns else F.lit(None).cast("string").alias("style"), F.inline(each))

    within = F.col("in_p") > 0
    tags = F.when(starts, F.concat(F.lit("<"), tag, F.lit(">"))).otherwise(F.concat(F.lit("</"), tag, F.lit(">")))
    out = pieces(marks.filter(p & starts), (START, "")).unionByName(pieces(marks.filter(p & ends), (END, "")))
    out = out.unionByName(pieces(marks.filter(block & starts & within), (END, ""), (PLAIN, tags))).unionByName(pieces(marks.filter(block & ends & within), (PLAIN, tags), (START, "")))
    out = out.unionByName(pieces(marks.filter(block & ~within), (PLAIN, tags))).unionByName(pieces(_cells(t), (PLAIN, F.col("html"))))
    said = F.when((name == "hp:lineBreak") & (F.col("in_t") > 0), "<br>").otherwise(xml_escape(F.coalesce(_said(), F.when((F.col("in_script") > 0) & (kind == "text"), xml_unescape(tok)))))
    plain = (
        F.when(name == "hp:tr", F.when(starts, "<tr>").when(ends, "</tr>").otherwise("<tr></tr>")).when((name == "hp:tc") & ends, "</td>")
        .when(name == "hp:script", F.when(starts, "<code>").when(ends, "</code>")).otherwise(said)
    )
    out = out.unionByName(pieces(t.withColumn("_html", plain).filter("_html is not null"), (PLAIN, F.col("_html"))))
    item = attribute(tok, "binaryItemIDRef")
    out = out.unionByName(pieces(t.filter((name == "hc:img") & ~ends & item.isNotNull()), (PICTURE, item)))

    parts = out.groupBy("doc", "entry", "section").agg(F.array_sort(F.collect_list(F.struct("at", "nth", "role", "html", "style"))).alias("r"))
    level = F.regexp_extract("style_name", r"(?i)(?:개요|Outline)\s*([1-7])", 1)
    heads = styles(members).filter((level != "") & F.col("style").isNotNull()).groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("style", F.least(level.cast("int"), F.lit(6)).alias("n")))).alias("heads"))
    held = manifest(members).filter("item is not null and entry is not null").groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("item", "entry"))).alias("held"))
    parts = parts.join(heads, "doc", "left").join(held, "doc", "left")

    def written(x: Column) -> Column:
        own = F.coalesce(F.concat(F.lit("h"), F.col("heads")[F.coalesce(x["style"], F.lit(""))].cast("string")), F.lit("p"))
        source = F.replace(xml_escape(F.coalesce(F.col("held")[x["html"]], x["html"])), F.lit('"'), F.lit("&quot;"))
        return (
            F.when(x["role"] == START, F.concat(F.lit("<"), own, F.lit(">"))).when(x["role"] == END, F.concat(F.lit("</"), own, F.lit(">")))
            .when(x["role"] == PICTURE, F.concat(F.lit('<img src="'), source, F.lit('">'))).otherwise(x["html"])
        )

    made = parts.select(*_KEY, F.regexp_replace(F.array_join(F.transform("r", written), ""), r"<(p|h[1-6])></\1>", "").alias("html"))
    every = t.select(*_KEY).distinct()
    return every.join(made, _KEY, "left").withColumn("html", F.coalesce("html", F.lit("")))
