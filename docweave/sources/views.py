"""Views of packages: paragraphs, tables, images, notes, headers, equations, fields, pages.

All come from one table of tokens (markup.tokens) and the package's members. Body views
hold what stands in top-level paragraphs; text inside tables, notes and headers belongs to those.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.text import extension, heading_level, trimmed, xml_unescape
from docweave.operators.flow import distinct_headers
from docweave.operators.tables import markdown
from docweave.sources.markup import attribute, tokens

#: Media types by suffix.
MEDIA = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "bmp": "image/bmp", "svg": "image/svg+xml", "webp": "image/webp", "emf": "image/x-emf", "wmf": "image/x-wmf"}
#: Which pages a header is for, as numbers.
PAGES = {"BOTH": 0, "EVEN": 1, "ODD": 2}
#: Marks of a field's start and end.
FIELD_STARTS, FIELD_ENDS = ("hp:fldBegin", "hp:fieldBegin"), ("hp:fldEnd", "hp:fieldEnd")
_KEY = ["doc", "section"]
_PLACE = [*_KEY, "paragraph", "control"]


def body_tokens(members: DataFrame, *only: str) -> DataFrame:
    """Tokens of all body sections, the number in the entry's name as section; of their columns those named, else all."""
    number = F.regexp_extract("entry", r"(?i)^Contents/section(\d+)\.xml$", 1)
    return tokens(members.filter(number != "").select("doc", number.cast("int").alias("section"), "entry", F.decode("bytes", "UTF-8").alias("xml")), *only)


def _said() -> Column:
    """What a token adds to its paragraph's text: text and character data in hp:t, line breaks and tabs; else null."""
    within, tok = F.col("in_t") > 0, F.col("tok")
    raw = F.substring(tok, F.lit(len("<![CDATA[") + 1), F.char_length(tok) - len("<![CDATA[]]>"))
    return (
        F.when(within & (F.col("kind") == "text"), xml_unescape(tok)).when(within & tok.startswith("<![CDATA["), raw)
        .when(within & (F.col("name") == "hp:lineBreak"), "\n").when(within & (F.col("name") == "hp:tab"), "\t")
    )


def _joined(value: Column, sep: str) -> Column:
    rows = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct("at", value.alias("v")))))
    return F.array_join(F.transform(rows, lambda r: r["v"]), sep)


def styles(members: DataFrame) -> DataFrame:
    """(doc, style, style_name) of paragraph styles in the header."""
    head = members.filter(F.lower("entry") == "contents/header.xml")
    tags = head.select("doc", F.explode(F.regexp_extract_all(F.decode("bytes", "UTF-8"), F.lit(r"(<hh:style\s[^>]*>)"), 1)).alias("tag"))
    return tags.select("doc", attribute(F.col("tag"), "id").alias("style"), xml_unescape(attribute(F.col("tag"), "name")).alias("style_name")).dropDuplicates(["doc", "style"])


def paragraphs(t: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(doc, section, paragraph, flat_para_idx, style, style_name, heading_level, text) of top-level
    paragraphs. flat_para_idx counts paragraph elements by their ends, nested ones too."""
    body = t.filter("paragraph is not null")
    opens = (F.col("name") == "hp:p") & (F.col("in_p") == 1) & F.col("kind").isin("open", "empty")
    own = (F.col("in_p") == 1) & (F.col("in_tbl") == 0) & (F.col("in_note") == 0)
    out = body.groupBy(*_KEY, "paragraph").agg(
        F.min(F.when(opens, F.col("flat"))).alias("flat_para_idx"), F.max(F.when(opens, attribute(F.col("tok"), "styleIDRef"))).alias("style"), _joined(F.when(own, _said()), "").alias("text"))
    if names is None:
        return out.withColumns({"style_name": F.lit(None).cast("string"), "heading_level": F.lit(None).cast("int")})
    return out.join(names, ["doc", "style"], "left").withColumn("heading_level", heading_level(F.col("style_name")))


def _lines(t: DataFrame, of: list[str], depth: Column) -> DataFrame:
    """(*of, text): the text of tokens by paragraph, paragraphs joined by newlines, trimmed."""
    nth = F.sum(((F.col("name") == "hp:p") & (F.col("kind") == "open") & depth).cast("int")).over(Window.partitionBy(*of).orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    paras = t.withColumn("_nth", nth).filter((F.col("_nth") > 0) | _said().isNotNull()).groupBy(*of, "_nth").agg(F.min("at").alias("at"), _joined(F.when(depth, _said()), "").alias("line"))
    return paras.groupBy(*of).agg(trimmed(_joined(F.col("line"), "\n")).alias("text"))


def grid_columns(rows: list[int], addresses: list[int | None], row_spans: list[int], col_spans: list[int]) -> list[int]:
    """The grid column of each cell of a table, cells being in order of row and place: its address, else the first column
    behind the row's cell before it that no cell from a row above reaches into. What such cells cover is kept as intervals, so
    time and memory do not grow with the spans."""
    out: list[int] = []
    above: list[tuple[int, int, int]] = []  # (first column, column behind the last, row behind the last) of cells of earlier rows
    here: list[tuple[int, int, int]] = []
    row = col = i = 0
    for r, address, down, wide in zip(rows, addresses, row_spans, col_spans, strict=True):
        if not out or r != row:
            above = sorted(x for x in above + here if x[2] > r)
            here, row, col, i = [], r, 0, 0
        if address is not None:
            col, i = address, i if address >= col else 0
        else:
            while i < len(above) and above[i][0] <= col:
                col = max(col, above[i][1])
                i += 1
        out.append(col)
        here.append((col, col + max(wide, 1), r + max(down, 1)))
        col += max(wide, 1)
    return out


def _grid_columns(cells: pd.Series) -> pd.Series:
    def of(table) -> list[int]:
        number = lambda x: None if x is None or x != x else int(x)
        values = [[number(c[k]) for c in table] for k in ("row", "address", "row_span", "col_span")]
        return grid_columns(*values)

    return cells.map(of)


def table_cells(t: DataFrame) -> DataFrame:
    """(doc, section, paragraph, control, table, n_rows, n_cols, cell_idx, row, col, row_span, col_span,
    text) of the physical cells of outermost tables. Addresses come from the cell, else from its row's
    place and the first column that no span from above or before covers; nested tables' text is left out."""
    inside = t.filter("table is not null")
    head = inside.filter("name = 'hp:tbl' and in_tbl = 1 and kind <> 'close'").select(
        *_KEY, "table", "paragraph", "control", attribute(F.col("tok"), "rowCnt").cast("int").alias("said_rows"), attribute(F.col("tok"), "colCnt").cast("int").alias("said_cols"))
    cells = inside.filter("cell is not null and in_tbl = 1")
    of = [*_KEY, "table", "row", "cell"]
    first = lambda name, *tags: F.max(F.when(F.col("name").isin(*tags) & (F.col("kind") != "close"), attribute(F.col("tok"), name))).cast("int")
    facts = cells.groupBy(*of).agg(
        first("rowAddr", "hp:cellAddr").alias("row_addr"), first("colAddr", "hp:cellAddr").alias("col_addr"),
        F.coalesce(first("rowSpan", "hp:cellSpan", "hp:tc"), F.lit(1)).alias("row_span"), F.coalesce(first("colSpan", "hp:cellSpan", "hp:tc"), F.lit(1)).alias("col_span"))
    texts = _lines(cells, of, F.lit(True))
    every = facts.join(texts, of, "left").join(head, [*_KEY, "table"])
    cell = F.struct(F.coalesce("row_addr", "row").cast("int").alias("row"), F.col("row").alias("nth"), "cell", F.col("col_addr").alias("address"), "row_span", "col_span", F.coalesce("text", F.lit("")).alias("text"))
    whole = every.groupBy(*_KEY, "paragraph", "control", "table", "said_rows", "said_cols").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    whole = whole.withColumn("cols", F.pandas_udf(_grid_columns, "array<int>")(F.transform("cells", lambda c: F.struct(c["row"].alias("row"), c["address"].alias("address"), c["row_span"].alias("row_span"), c["col_span"].alias("col_span")))))
    whole = whole.withColumn("cells", F.arrays_zip("cells", "cols"))
    most = lambda x: F.array_max(F.transform("cells", x)).cast("int")
    n_cols = most(lambda c: c["cols"] + F.when(c["cells"]["address"].isNull(), c["cells"]["col_span"]).otherwise(1))
    out = whole.select(*_KEY, "paragraph", "control", "table", F.coalesce("said_rows", most(lambda c: c["cells"]["row"] + 1)).alias("n_rows"), F.coalesce("said_cols", n_cols).alias("n_cols"), F.inline("cells"))
    return out.select(
        *_KEY, "paragraph", "control", "table", "n_rows", "n_cols", (F.row_number().over(Window.partitionBy(*_KEY, "table").orderBy("cells.nth", "cells.cell")) - 1).alias("cell_idx"),
        F.col("cells.row").alias("row"), F.col("cols").alias("col"), "cells.row_span", "cells.col_span", "cells.text")


def tables(t: DataFrame) -> DataFrame:
    """(doc, section, paragraph, control, table, n_rows, n_cols, cells): dense grids of tables
    with rows and columns; the last cell of a place counts, missing ones are empty, cells outside are dropped."""
    cells = table_cells(t).filter("n_rows > 0 and n_cols > 0")
    of = [*_PLACE, "table", "n_rows", "n_cols"]
    placed = cells.groupBy(*of, (F.col("row") * F.col("n_cols") + F.when(F.col("col") < F.col("n_cols"), F.col("col"))).alias("slot")).agg(F.max_by("text", "cell_idx").alias("text"))
    maps = placed.groupBy(*of).agg(F.map_from_entries(F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "text")))).alias("m"))
    line = lambda r: F.transform(F.sequence(F.lit(0), F.col("n_cols") - 1), lambda c: F.coalesce(F.col("m")[r * F.col("n_cols") + c], F.lit("")))
    return maps.select(*of, F.transform(F.sequence(F.lit(0), F.col("n_rows") - 1), line).alias("cells"))


def equations(t: DataFrame) -> DataFrame:
    """(doc, section, paragraph, control, script, font_size, font_name) of equations with a script."""
    own = t.filter("paragraph is not null and in_note > 0")
    last = F.last(F.when(F.col("starts_control"), F.col("name")), True).over(Window.partitionBy("doc", "entry", "paragraph", "control").orderBy("at"))
    own = own.withColumn("_of", last).filter("_of = 'hp:equation'")
    script = F.when((F.col("kind") == "text") & (F.col("in_script") > 0), xml_unescape(F.col("tok")))
    order = Window.partitionBy("doc", "entry", "paragraph", "control").orderBy("at")
    up, down = (F.sum(((F.col("name") == "hp:script") & (F.col("kind") == k)).cast("int")).over(order) for k in ("open", "close"))
    tag = F.when(F.col("starts_control"), F.col("tok"))
    out = own.withColumn("in_script", up - down).groupBy(*_PLACE).agg(
        _joined(script, "").alias("script"), F.max(attribute(tag, "baseUnit")).cast("double").alias("font_size"), F.max(attribute(tag, "font")).alias("font_name"))
    return out.filter("script <> ''")


def _notes(t: DataFrame, *names: str) -> DataFrame:
    """(doc, section, paragraph, control, tag, name, text) of controls that hold paragraphs."""
    last = lambda c: F.last(F.when(F.col("starts_control"), c), True).over(Window.partitionBy("doc", "entry", "paragraph", "control").orderBy("at"))
    own = t.filter("paragraph is not null and in_note > 0").withColumns({"_tag": last(F.col("tok")), "_name": last(F.col("name"))}).filter(F.col("_name").isin(*names))
    texts = _lines(own, [*_PLACE, "_tag", "_name"], (F.col("in_p") == 2) & (F.col("in_tbl") == 0))
    heads = own.filter("starts_control").select(*_PLACE, F.col("tok").alias("tag"), "name")
    return heads.join(texts.select(*_PLACE, "text"), _PLACE, "left").withColumn("text", F.coalesce("text", F.lit("")))


def footnotes(t: DataFrame) -> DataFrame:
    """(doc, section, paragraph, control, number, text); a note without a number has 0."""
    return _notes(t, "hp:footNote").select(*_PLACE, F.coalesce(attribute(F.col("tag"), "number").cast("int"), F.lit(0)).alias("number"), "text")


def headers_footers(t: DataFrame) -> DataFrame:
    """(doc, section, kind, apply_to, ord, exists, label, text): the first header and footer of each
    section and kind of pages; label is that kind's name."""
    named = attribute(F.col("tag"), "applyPageType")
    apply_to = F.coalesce(F.create_map(*(F.lit(x) for kv in PAGES.items() for x in kv))[named], F.lit(0))
    rows = _notes(t, "hp:header", "hp:footer").select(
        *_KEY, F.regexp_replace("name", "^hp:", "").alias("kind"), apply_to.alias("apply_to"), (F.col("paragraph").cast("long") * (1 << 20) + F.col("control")).alias("ord"),
        F.lit(True).alias("exists"), F.coalesce(named, F.lit("")).alias("label"), "text")
    return distinct_headers(rows)


def manifest(members: DataFrame) -> DataFrame:
    """(doc, item, entry) of the package's manifest; without one, binary members by their name's stem."""
    hpf = members.filter("entry = 'Contents/content.hpf'").select("doc", F.explode(F.regexp_extract_all(F.decode("bytes", "UTF-8"), F.lit(r"(<opf:item\s[^>]*>)"), 1)).alias("tag"))
    said = hpf.select("doc", attribute(F.col("tag"), "id").alias("item"), attribute(F.col("tag"), "href").alias("entry"), F.lit(0).alias("rank"))
    stems = members.filter(F.col("entry").startswith("BinData/")).select("doc", F.regexp_extract("entry", r"([^/]*?)(?:\.[^./]*)?$", 1).alias("item"), "entry", F.lit(1).alias("rank"))
    return said.unionByName(stems).groupBy("doc", "item").agg(F.min_by("entry", F.struct("rank", "entry")).alias("entry"))


def media_type(entry: Column) -> Column:
    suffix = F.lower(F.regexp_extract(entry, r"\.([^./]*)$", 1))
    return F.coalesce(F.create_map(*(F.lit(x) for kv in MEDIA.items() for x in kv))[suffix], F.concat(F.lit("image/"), suffix))


def images(t: DataFrame, members: DataFrame) -> DataFrame:
    """(doc, section, paragraph, control, entry, mime, ext, byte_length) of pictures whose
    bytes the package holds; join the entry to members for the bytes."""
    refs = t.filter("paragraph is not null and in_p = 1").groupBy(*_PLACE).agg(
        F.max(F.when(F.col("starts_control"), F.col("name"))).alias("name"), F.max(F.when(F.col("name") == "hc:img", attribute(F.col("tok"), "binaryItemIDRef"))).alias("item")).filter("name = 'hp:pic'")
    sizes = members.filter(F.col("entry").startswith("BinData/")).select("doc", "entry", F.octet_length("bytes").cast("long").alias("byte_length"))
    found = refs.join(manifest(members), ["doc", "item"]).join(sizes, ["doc", "entry"])
    mime = media_type(F.col("entry"))
    return found.select(*_PLACE, "entry", mime.alias("mime"), extension(mime).alias("ext"), "byte_length")


def field_spans(t: DataFrame, *more: str) -> DataFrame:
    """(doc, entry, section, ord, name, type, start, stop, after): the token at each field's start and the one at its own
    end, as structs of `at` and the columns `more`. Ends close the latest open start, as brackets do: of marks at one
    depth, each start goes with the end that follows it. A start without end has a null stop, and after, the next mark of
    any kind, null at the last; an end without start is nobody's."""
    begin = F.col("name").isin(*FIELD_STARTS) & (F.col("kind") != "close")
    end = F.col("name").isin(*FIELD_ENDS) & (F.col("kind") != "close")
    place = F.struct("at", *more)
    marks = t.filter(begin | end).select("doc", "entry", "section", "at", place.alias("place"), begin.alias("begin"), attribute(F.col("tok"), "name").alias("name"), attribute(F.col("tok"), "type").alias("type"))
    part = Window.partitionBy("doc", "entry").orderBy("at")
    line = part.rowsBetween(Window.unboundedPreceding, 0)
    marks = marks.withColumns({"_level": F.sum(F.when(F.col("begin"), 1).otherwise(-1)).over(line), "ord": F.sum(F.col("begin").cast("int")).over(line), "after": F.lead("place").over(part)})
    # An end with nothing open takes the level to a new low: from there on that low is depth 0.
    marks = marks.withColumn("_depth", F.col("_level") - F.least(F.min("_level").over(line), F.lit(0)) + F.when(F.col("begin"), 0).otherwise(1))
    follow = F.lead(F.struct("place", "begin")).over(Window.partitionBy("doc", "entry", "_depth").orderBy("at"))
    marks = marks.withColumn("stop", F.when(~follow["begin"], follow["place"]))
    return marks.filter("begin").select("doc", "entry", "section", F.col("ord").cast("long").alias("ord"), xml_unescape(F.coalesce("name", F.lit("?"))).alias("name"), F.coalesce("type", F.lit("")).alias("type"), F.col("place").alias("start"), "stop", "after")


def fields(t: DataFrame) -> DataFrame:
    """(doc, section, ord, name, type, value): fields in order, the value being all text up to the field's own end, that of
    fields within it included. Without an end it is the text up to the next mark. A part's text is joined once, and each
    value is cut from it."""
    before = Window.partitionBy("doc", "entry").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("_text", _said()).withColumn("_off", F.coalesce(F.sum(F.char_length("_text")).over(before), F.lit(0)))
    spans = field_spans(t, "_off").groupBy("doc", "entry").agg(F.collect_list(F.struct("section", "ord", "name", "type", F.col("start._off").alias("a"), F.coalesce(F.col("stop"), F.col("after"))["_off"].alias("b"))).alias("f"))
    texts = t.filter("_text is not null").groupBy("doc", "entry").agg(_joined(F.col("_text"), "").alias("text"))
    out = spans.join(texts, ["doc", "entry"], "left").select("doc", F.inline("f"), F.coalesce("text", F.lit("")).alias("text"))
    value = F.substring(F.col("text"), F.col("a").cast("int") + 1, F.coalesce(F.col("b") - F.col("a"), F.char_length("text")).cast("int"))
    return out.select(*_KEY, "ord", "name", "type", value.alias("value"))


def pages(t: DataFrame) -> DataFrame:
    """(doc, section, page, margin, section_def): attributes of a section's first page and section
    properties as JSON; null where it has none."""
    pairs = F.regexp_extract_all("tok", F.lit(r'\s([\w:]+="[^"]*)"'), 1)
    json = F.to_json(F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.substring_index(p, '="', 1), F.substring_index(p, '="', -1)))))
    of = lambda name: F.min_by(F.when(F.col("name") == name, json), F.when(F.col("name") == name, F.col("at")))
    return t.filter("kind <> 'close'").groupBy(*_KEY).agg(of("hp:pagePr").alias("page"), of("hp:margin").alias("margin"), of("hp:secPr").alias("section_def"))


def flow(t: DataFrame, members: DataFrame) -> DataFrame:
    """Blocks (doc, section, paragraph, sub, kind, text, heading_level, table_md, entry, ext, byte_length, script)
    in order of section, paragraph and sub: each paragraph, then its controls, an equation, else a table, else an image."""
    none = lambda kind: F.lit(None).cast(kind)
    blank = {"text": none("string"), "heading_level": none("int"), "table_md": none("string"), "entry": none("string"), "ext": none("string"), "byte_length": none("long"), "script": none("string")}

    def block(df: DataFrame, kind: str, sub: Column, **have: Column) -> DataFrame:
        return df.select(*_KEY, "paragraph", sub.cast("int").alias("sub"), F.lit(kind).alias("kind"), *(have.get(k, v).alias(k) for k, v in blank.items()))

    out = block(paragraphs(t, styles(members)), "para", F.lit(-1), text=F.col("text"), heading_level=F.col("heading_level"))
    out = out.unionByName(block(tables(t), "table", F.col("control"), table_md=markdown(F.col("cells"))))
    out = out.unionByName(block(equations(t), "equation", F.col("control"), script=F.col("script")))
    return out.unionByName(block(images(t, members), "image", F.col("control"), entry=F.col("entry"), ext=F.col("ext"), byte_length=F.col("byte_length")))


def counted(t: DataFrame, members: DataFrame) -> DataFrame:
    """(doc, kind): a row for each table, image, footnote, equation, header and footer."""
    tops = t.filter("name = 'hp:tbl' and in_tbl = 1 and kind <> 'close'").select("doc", F.lit("table").alias("kind"))
    for kind, rows in (("image", images(t, members)), ("footnote", footnotes(t)), ("equation", equations(t))):
        tops = tops.unionByName(rows.select("doc", F.lit(kind).alias("kind")))
    return tops.unionByName(headers_footers(t).select("doc", "kind"))


def fonts(members: DataFrame) -> DataFrame:
    """(doc, n, font): names of the header's fonts, each once, in the order of their first place."""
    head = members.filter(F.lower("entry") == "contents/header.xml")
    tags = head.select("doc", F.posexplode(F.regexp_extract_all(F.decode("bytes", "UTF-8"), F.lit(r"(<hh:font\s[^>]*>)"), 1)).alias("at", "tag"))
    first = tags.select("doc", "at", xml_unescape(attribute(F.col("tag"), "face")).alias("font")).filter("font is not null").groupBy("doc", "font").agg(F.min("at").alias("at"))
    return first.select("doc", F.row_number().over(Window.partitionBy("doc").orderBy("at")).alias("n"), "font")


def versions(members: DataFrame) -> DataFrame:
    """(doc, version) of packages that say one."""
    xml = F.decode("bytes", "UTF-8")
    return members.filter(F.lower("entry") == "version.xml").select("doc", attribute(xml, "xmlVersion").alias("version"))
