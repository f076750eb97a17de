"""The document views built from the driver's tables, in Spark and in SQL.

Values that those tables do not have (blank and padded paragraphs, escapable cells,
missing cells, large sizes) are derived from keys, alike in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.functions.text import xml_escape
from docweave.operators.edit_script import SCRIPT
from docweave.sources import package

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, section, paragraph, text): lines of documents, some blanked or padded."""
    lines = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n", -1)).alias("paragraph", "line"))
    p = F.col("paragraph") % 7
    text = F.when(p == 3, "  ").when(p == 5, F.concat(F.lit("\t "), "line", F.lit(" "))).otherwise(F.col("line"))
    return lines.select("doc", F.lit(0).alias("section"), "paragraph", text.alias("text"))


PARAGRAPHS = """l AS (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS paragraph FROM documents),
p AS (SELECT doc, paragraph, CASE WHEN paragraph % 7 = 3 THEN '  ' WHEN paragraph % 7 = 5 THEN chr(9) || ' ' || line || ' ' ELSE line END AS text FROM l)"""
TRIM = r"regexp_replace({}, '^[\s\x0B\x{{00A0}}\x{{3000}}\x{{FEFF}}]+|[\s\x0B\x{{00A0}}\x{{3000}}\x{{FEFF}}]+$', '', 'g')"


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_id, cells): orders as tables of four columns, a row for each line item."""
    rows = read(spark, sf_dir, "lineitem")
    flag = F.when(F.col("l_partkey") % 5 == 0, F.concat("l_returnflag", F.lit("|\n"), "l_linestatus")).otherwise(F.col("l_returnflag"))
    cells = F.array(F.col("l_linenumber").cast("string"), flag, F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    packed = rows.groupBy(F.col("l_orderkey").alias("table_id")).agg(F.array_sort(F.collect_list(F.struct(*LINE_ORDER, cells.alias("cells")))).alias("r"))
    return packed.select("table_id", F.transform("r", lambda x: x["cells"]).alias("cells"))


CELLS = f"""r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)}) - 1 AS row, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
c AS (SELECT l_orderkey AS table_id, row, n, 0 AS col, CAST(l_linenumber AS VARCHAR) AS text FROM r
UNION ALL SELECT l_orderkey, row, n, 1, CASE WHEN l_partkey % 5 = 0 THEN l_returnflag || '|' || chr(10) || l_linestatus ELSE l_returnflag END FROM r
UNION ALL SELECT l_orderkey, row, n, 2, CAST(l_partkey AS VARCHAR) FROM r
UNION ALL SELECT l_orderkey, row, n, 3, CAST(l_suppkey AS VARCHAR) FROM r)"""


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, seq, mime, byte_length): mime by label, sizes that reach KB and exact ties."""
    e = read(spark, sf_dir, "embeddings")
    mime = F.element_at(F.array(*map(F.lit, ("image/png", "image/JPEG", "image/x-emf", "image/svg+xml", "application/pdf"))), (F.col("label") % 5 + 1).cast("int"))
    size = F.when(F.col("vec_id") % 10 == 0, 1280).otherwise(F.col("vec_id") * 37)
    return e.select((F.col("vec_id") % 50).alias("doc"), F.col("vec_id").alias("seq"), mime.alias("mime"), size.cast("long").alias("byte_length"))


IMAGES = """i AS (SELECT vec_id % 50 AS doc, vec_id AS seq, ['image/png', 'image/JPEG', 'image/x-emf', 'image/svg+xml', 'application/pdf'][CAST(label % 5 + 1 AS INT)] AS mime,
CAST(CASE WHEN vec_id % 10 = 0 THEN 1280 ELSE vec_id * 37 END AS BIGINT) AS byte_length FROM embeddings)"""


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers and footers with repeated keys: turns of conversations by role."""
    c = read(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").alias("doc"), F.lit(0).alias("section"), F.col("role").alias("kind"), F.lit(0).alias("apply_to"), F.col("turn").alias("ord"),
        (F.col("conv_id") % 5 != 0).alias("exists"), F.concat(F.lit(" "), "text", F.lit("\n")).alias("text"),
    )


def entry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, seq, entry, bytes): package entries by document; names leave gaps."""
    e = read(spark, sf_dir, "events")
    n = F.col("event_id") % 7 + 1
    return e.select((F.col("user_id")).alias("doc"), F.col("event_id").alias("seq"), F.format_string("BinData/image%d.%s", n, F.when(F.col("event_id") % 3 == 0, "jpg").otherwise("png")).alias("entry"), F.col("event_type").cast("binary").alias("bytes")).dropDuplicates(["doc", "seq"])


ENTRIES = "e AS (SELECT user_id AS doc, event_id AS seq, 'BinData/image' || (event_id % 7 + 1) || '.' || CASE WHEN event_id % 3 = 0 THEN 'jpg' ELSE 'png' END AS entry, event_type AS bytes FROM events)"


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of a new package for each document, a paragraph for each line, named by doc_id."""
    d = read(spark, sf_dir, "documents")
    none = F.lit(None)
    items = d.select(
        F.concat(F.lit("/docs/"), F.col("doc_id").cast("string"), F.lit(".hwpx")).alias("doc"), F.lit(0).alias("pos"), F.lit("text").alias("type"), "text",
        none.cast("array<string>").alias("headers"), none.cast("array<array<string>>").alias("rows"))
    return package.create(items)


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc): the names of members()'s documents."""
    return read(spark, sf_dir, "documents").select(F.concat(F.lit("/docs/"), F.col("doc_id").cast("string"), F.lit(".hwpx")).alias("doc"))


def run_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """members() with runs that end within words: before the last letter of each "the", and of every other document before each r."""
    # Escaped text holds no <, so that it can stand for a cut until both kinds are made; all text stands in hp:t.
    again, start = '</hp:t></hp:run><hp:run charPrIDRef="0"><hp:t>', "hp:t>"

    def cut(x: F.Column) -> F.Column:
        text = F.replace(F.substring(x, F.lit(len(start) + 1), F.char_length(x)), F.lit("the"), F.lit("th<e"))
        text = F.when(doc_id() % 2 == 0, F.replace(text, F.lit("r"), F.lit("<r"))).otherwise(text)
        return F.when(x.startswith(start), F.concat(F.lit(start), F.replace(text, F.lit("<"), F.lit(again)))).otherwise(x)

    cut = F.array_join(F.transform(F.split(F.decode("bytes", "UTF-8"), "<"), cut), "<")
    section = F.col("entry").rlike(r"^Contents/section\d+\.xml$")
    return members(spark, sf_dir).withColumn("bytes", F.when(section, F.encode(cut, "UTF-8")).otherwise(F.col("bytes")))


def doc_id():
    return F.regexp_extract("doc", r"(\d+)\.hwpx$", 1).cast("long").alias("doc")


LINES = """l AS (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS paragraph FROM documents)"""


def by_order(key: str, *order: str) -> Window:
    return Window.partitionBy(key).orderBy(*order)


def table_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of a package for each document: a paragraph, a table of three rows and columns whose first cell holds the
    whole text, and a field within another; a manifest and a picture that nothing shows."""
    d = read(spark, sf_dir, "documents")
    number = F.col("doc_id").cast("string")

    def cell(r: int, c: int):
        text = xml_escape(F.coalesce("text", F.lit(""))) if r == c == 0 else F.concat(F.lit(f"r{r}c{c}-"), number)
        return F.concat(F.lit(f'<hp:tc><hp:subList><hp:p id="{10 + 3 * r + c}"><hp:run charPrIDRef="0"><hp:t>'), text,
                        F.lit(f'</hp:t></hp:run></hp:p></hp:subList><hp:cellAddr colAddr="{c}" rowAddr="{r}"/><hp:cellSpan colSpan="1" rowSpan="1"/></hp:tc>'))

    rows = [p for r in range(3) for p in (F.lit("<hp:tr>"), *(cell(r, c) for c in range(3)), F.lit("</hp:tr>"))]
    mark = lambda x: f"<hp:ctrl>{x}</hp:ctrl>"
    xml = F.concat(
        F.lit('<hs:sec><hp:p id="1"><hp:run charPrIDRef="0"><hp:t>first</hp:t></hp:run></hp:p><hp:p id="2"><hp:run charPrIDRef="0"><hp:tbl id="3" rowCnt="3" colCnt="3">'), *rows, F.lit("</hp:tbl></hp:run></hp:p>"),
        F.lit('<hp:p id="4"><hp:run charPrIDRef="0">' + mark('<hp:fieldBegin name="outer" type="CLICK_HERE"/>') + "<hp:t>A</hp:t>" + mark('<hp:fieldBegin name="inner" type="DATE"/>') + "<hp:t>"), number,
        F.lit("</hp:t>" + mark("<hp:fieldEnd/>") + "<hp:t>C</hp:t>" + mark("<hp:fieldEnd/>") + "</hp:run></hp:p></hs:sec>"))
    part = lambda seq, entry, content: F.struct(F.lit(seq).alias("seq"), F.lit(entry).alias("entry"), F.lit(8).alias("method"), content.cast("binary").alias("bytes"))
    hpf = '<opf:package><opf:manifest><opf:item id="image1" href="BinData/image1.png" media-type="image/png"/></opf:manifest></opf:package>'
    parts = F.array(part(0, "Contents/content.hpf", F.lit(hpf)), part(1, "Contents/section0.xml", xml), part(2, "BinData/image1.png", F.lit("png")))
    return d.select(F.concat(F.lit("/docs/"), number, F.lit(".hwpx")).alias("doc"), F.inline(parts))


#: The cells of table_members().
GRID = f"""g AS (SELECT doc_id AS doc, CAST(r AS BIGINT) AS row, CAST(c AS BIGINT) AS col, CASE WHEN r = 0 AND c = 0 THEN coalesce({TRIM.format("text")}, '') ELSE 'r' || r || 'c' || c || '-' || doc_id END AS text
FROM documents, range(3) AS a(r), range(3) AS b(c))"""


def script(spark: SparkSession, sf_dir: str, *steps) -> DataFrame:
    """An edit script of table_members(): steps (condition on doc_id, op, what it needs) in order, for the documents that meet their condition."""
    fields = [c.split(" ") for c in SCRIPT.split(", ")]
    rows = [F.when(when, F.struct(F.lit(i).alias("ord"), *((F.lit(op) if name == "op" else k.get(name, F.lit(None))).cast(kind).alias(name) for name, kind in fields))) for i, (when, op, k) in enumerate(steps)]
    d = read(spark, sf_dir, "documents").select(F.concat(F.lit("/docs/"), F.col("doc_id").cast("string"), F.lit(".hwpx")).alias("doc"), F.explode(F.array_compact(F.array(*rows))).alias("s"))
    return d.select("doc", "s.*")


def spanned_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of a package for each document: a section definition with children, a heading, and a table whose cells have
    spans and no addresses, the first with the whole text, one with a table within; a picture and an equation."""
    d = read(spark, sf_dir, "documents")
    number = F.col("doc_id").cast("string")
    p = lambda i, *body: F.concat(F.lit(f'<hp:p id="{i}" styleIDRef="0"><hp:run>'), *body, F.lit("</hp:run></hp:p>"))
    t = lambda x: F.concat(F.lit("<hp:t>"), x, F.lit("</hp:t>"))

    def cell(i: int, down: int, wide, *body) -> F.Column:
        return F.concat(F.lit("<hp:tc><hp:subList>"), p(i, *body), F.lit(f'</hp:subList><hp:cellSpan rowSpan="{down}" colSpan="'), F.lit(wide).cast("string") if isinstance(wide, int) else wide, F.lit('"/></hp:tc>'))

    row = lambda *cells: F.concat(F.lit("<hp:tr>"), *cells, F.lit("</hp:tr>"))
    said = lambda s: t(F.concat(F.lit(f"{s}-"), number))
    inner = F.concat(F.lit("<hp:tbl>"), row(cell(30, 1, 1, said("x")), cell(31, 1, 2, said("y"))), F.lit("</hp:tbl>"))
    wide = (F.col("doc_id") % 3 + 1).cast("string")
    table = F.concat(
        F.lit('<hp:tbl id="9">'), row(cell(10, 2, 1, t(xml_escape(F.coalesce("text", F.lit(""))))), cell(11, 1, 2, said("top"))), row(cell(12, 1, 1, said("a")), cell(13, 1, 1, said("b"))),
        row(cell(14, 1, wide, said("c"), inner), cell(15, 1, 1, said("d"))), F.lit("</hp:tbl>"))
    xml = F.concat(
        F.lit('<hs:sec><hp:p id="1" styleIDRef="1"><hp:run><hp:secPr id="" columns="2"><!-- c --><hp:pagePr width="'), number, F.lit('" note="a &lt; &quot;b&quot;"><hp:margin left="1" top="2"/></hp:pagePr> <hp:label>x &amp; y</hp:label></hp:secPr><hp:t>head</hp:t></hp:run></hp:p>'),
        p(2, t(F.lit("before")), table), p(3, F.lit('<hp:t>A<hp:lineBreak/>B &amp; C</hp:t><hp:pic><hc:img binaryItemIDRef="image1"/></hp:pic><hp:equation><hp:script>a &lt; b</hp:script></hp:equation>')), F.lit("</hs:sec>"))
    part = lambda seq, entry, content: F.struct(F.lit(seq).alias("seq"), F.lit(entry).alias("entry"), F.lit(8).alias("method"), content.cast("binary").alias("bytes"))
    head = '<hh:head><hh:style id="0" type="PARA" name="Normal"/><hh:style id="1" type="PARA" name="Outline 2"/></hh:head>'
    parts = F.array(part(0, "Contents/header.xml", F.lit(head)), part(1, "Contents/section0.xml", xml), part(2, "BinData/image1.png", F.lit("png")))
    return d.select(F.concat(F.lit("/docs/"), number, F.lit(".hwpx")).alias("doc"), F.inline(parts))


def arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, replacements): JSON arguments of template fills, one for each document: integer keys behind others, a repeated key,
    values that later keys find again; of every fifth document broken."""
    number = F.col("doc_id").cast("string")
    good = F.concat(F.lit('{"zz": "\\u0041", "the": "gone", "10": "ten & <'), number, F.lit('>", "1": "10", "the": "T-'), number, F.lit('", "ten": "the"}'))
    return read(spark, sf_dir, "documents").select(
        F.concat(F.lit("/docs/"), number, F.lit(".hwpx")).alias("doc"), F.when(F.col("doc_id") % 5 == 0, '{"the": }').otherwise(good).alias("replacements"))


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, content): JSON content of new documents: the text, and a table; of every fifth document an object in place of an array."""
    number = F.col("doc_id").cast("string")
    text = F.to_json(F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text")))
    table = F.concat(F.lit('{"type": "table", "headers": ["id", 2], "rows": [['), number, F.lit(', "x & y"], [null]]}'))
    good = F.concat(F.lit("["), text, F.lit(', {"type": "other"}, '), table, F.lit("]"))
    return read(spark, sf_dir, "documents").select(F.concat(F.lit("/docs/"), number, F.lit(".hwpx")).alias("doc"), F.when(F.col("doc_id") % 5 == 0, "{}").otherwise(good).alias("content"))
