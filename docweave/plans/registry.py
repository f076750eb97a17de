"""Queries over the driver's tables by name, with DuckDB SQL for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.functions import text as T
from docweave.operators import edit as E
from docweave.operators import edit_script as S
from docweave.operators import flow as O
from docweave.operators import package_edit as P
from docweave.operators import report as R
from docweave.operators import run_fill
from docweave.operators import tables as B
from docweave.sources import package, part_views, structure, views
from docweave.sources.storage import stored

from . import carriers as C

QUERIES: dict = {}
ORACLE_SQL: dict = {}
PAIRS = [("the", "THE & co"), ("and", "$1 <and>"), ("THE", "x"), ("{{none}}", "y")]


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _long(tables: DataFrame, cells: Column) -> DataFrame:
    """(table_id, row, col, text) of row arrays."""
    rows = tables.select("table_id", F.posexplode(cells).alias("row", "r")).select("table_id", "row", F.posexplode("r").alias("col", "text"))
    return rows.select("table_id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "text")


_P = f"WITH {C.PARAGRAPHS} "
_C = f"WITH {C.CELLS} "
_I = f"WITH {C.IMAGES} "
_E = f"WITH {C.ENTRIES} "
_CELL = "SELECT table_id, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col, text FROM "


@query(_P + f"""SELECT doc, string_agg(CASE WHEN paragraph % 4 = 0 AND {C.TRIM.format("text")} <> '' THEN '## ' ELSE '' END || {C.TRIM.format("text")}, chr(10) || chr(10) ORDER BY paragraph)
FILTER ({C.TRIM.format("text")} <> '') AS markdown FROM p GROUP BY doc""")
def flow_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = C.paragraphs(spark, sf_dir)
    none = F.lit(None).cast("string")
    blocks = p.select("doc", F.col("paragraph").alias("ord"), F.lit("para").alias("kind"), "text", F.when(F.col("paragraph") % 4 == 0, 2).alias("heading_level"), none.alias("table_md"), none.alias("image_ref"), none.alias("script"))
    return O.flow_markdown(blocks).select("doc", F.when(F.col("markdown") != "", F.col("markdown")).alias("markdown"))


@query("""WITH n AS (SELECT doc_id % 50 AS doc, row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id) AS number, doc_id FROM labels)
SELECT doc, '---' || chr(10) || chr(10) || string_agg('[^' || number || ']: note ' || doc_id, chr(10) ORDER BY number) AS markdown FROM n GROUP BY doc""")
def footnote_block(spark, sf_dir):
    n = C.read(spark, sf_dir, "labels").select((F.col("doc_id") % 50).alias("doc"), "doc_id")
    n = n.withColumn("number", F.row_number().over(C.by_order("doc", "doc_id"))).select("doc", F.col("number").alias("ord"), "number", F.concat(F.lit("note "), F.col("doc_id").cast("string")).alias("text"))
    none = F.lit(None).cast("string")
    blocks = n.filter("false").select("doc", "ord", none.alias("kind"), none.alias("text"), F.lit(1).alias("heading_level"), none.alias("table_md"), none.alias("image_ref"), none.alias("script"))
    return O.flow_markdown(blocks, n)


@query("""WITH h AS (SELECT conv_id AS doc, turn, role, text FROM conversations),
b AS (SELECT doc, string_agg(text, chr(10) ORDER BY turn) AS t FROM h WHERE role <> 'system' GROUP BY doc),
s AS (SELECT doc, '--- headers ---' || chr(10) || string_agg(text, chr(10) ORDER BY turn) AS t FROM h WHERE role = 'system' GROUP BY doc)
SELECT coalesce(b.doc, s.doc) AS doc, concat_ws(chr(10) || chr(10), s.t, b.t) AS text FROM b FULL JOIN s ON b.doc = s.doc""")
def text_dump(spark, sf_dir):
    c = C.read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("ord"), F.col("text").alias("line"), "role")
    return O.text_dump({"headers": c.filter("role = 'system'"), "body": c.filter("role <> 'system'")})


@query(_P + "SELECT doc, CAST(count(*) AS BIGINT) AS n FROM p GROUP BY doc")
def paragraph_count(spark, sf_dir):
    dump = O.text_dump({"body": C.paragraphs(spark, sf_dir).select("doc", F.col("paragraph").alias("ord"), F.col("text").alias("line"))})
    return R.dump_lines(dump)


@query(_P + f"SELECT doc, CAST(paragraph AS BIGINT) AS paragraph, {C.TRIM.format('text')} AS text FROM p WHERE {C.TRIM.format('text')} <> ''")
def nonblank_paragraphs(spark, sf_dir):
    p = C.paragraphs(spark, sf_dir).withColumn("text", T.trimmed(F.col("text")))
    return p.filter("text <> ''").select("doc", F.col("paragraph").cast("long").alias("paragraph"), "text")


@query(_P + "SELECT doc, string_agg(text, chr(10) ORDER BY paragraph) AS text FROM p GROUP BY doc")
def section_text(spark, sf_dir):
    return C.paragraphs(spark, sf_dir).groupBy("doc").agg(O.joined(F.col("text"), F.col("paragraph"), "\n").alias("text"))


@query(f"""WITH h AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS nth FROM conversations)
SELECT conv_id AS doc, role AS kind, turn AS ord, {C.TRIM.format("text")} AS text FROM h WHERE nth = 1 AND conv_id % 5 <> 0""")
def hf_dedupe(spark, sf_dir):
    return O.distinct_headers(C.headers(spark, sf_dir)).select("doc", "kind", "ord", "text")


@query("""SELECT event_id AS doc, '[eq ' || user_id || '/' || event_id % 3 || '/0] ' || props AS line FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def equation_lines(spark, sf_dir):
    e = C.read(spark, sf_dir, "events").filter(F.from_json("props", "k INT")["k"].isNotNull())
    e = e.select(F.col("event_id").alias("doc"), F.col("user_id").alias("section"), (F.col("event_id") % 3).alias("paragraph"), F.lit(0).alias("control"), F.col("props").alias("script"))
    return R.equation_lines(e).select("doc", "line")


@query(_P + """, k AS (SELECT doc, paragraph, CASE WHEN paragraph % 5 = 1 THEN 'equation' WHEN paragraph % 5 = 2 THEN 'table' WHEN paragraph % 5 = 3 THEN 'image' END AS kind FROM p)
SELECT doc, CAST(paragraph AS BIGINT) AS paragraph, CAST(-1 AS BIGINT) AS sub, 'para' AS kind FROM p UNION ALL SELECT doc, paragraph, 0, kind FROM k WHERE kind IS NOT NULL""")
def flow_blocks(spark, sf_dir):
    p = C.paragraphs(spark, sf_dir)
    k = F.col("paragraph") % 5
    controls = p.withColumns({"control_idx": F.lit(0), "script": F.when(k == 1, "x"), "rows": F.when(k.isin(1, 2), 1), "cols": F.when(k.isin(1, 2), 1), "mime": F.when(k == 3, "image/png")})
    return O.flow_blocks(p, controls).select("doc", F.col("paragraph").cast("long").alias("paragraph"), F.col("sub").cast("long").alias("sub"), "kind")


@query(_C + _CELL + "c WHERE (row + col) % 4 <> 1 UNION ALL SELECT table_id, CAST(row AS BIGINT), CAST(col AS BIGINT), '' FROM c WHERE (row + col) % 4 = 1")
def table_grid(spark, sf_dir):
    t = C.tables(spark, sf_dir)
    cells = _long(t, F.col("cells")).filter((F.col("row") + F.col("col")) % 4 != 1).withColumn("cell_idx", F.col("row") * 4 + F.col("col"))
    dims = t.select("table_id", F.size("cells").alias("rows"), F.lit(4).alias("cols"))
    g = B.grid(cells, dims)
    return g.select("table_id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "text")


@query(_C + r""", x AS (SELECT table_id, row, '| ' || string_agg(replace(replace(text, '|', '\|'), chr(10), ' '), ' | ' ORDER BY col) || ' |' AS line FROM c GROUP BY ALL),
y AS (SELECT table_id, row * 2 AS o, line FROM x UNION ALL SELECT table_id, 1, '| --- | --- | --- | --- |' FROM x WHERE row = 0)
SELECT table_id, string_agg(line, chr(10) ORDER BY o) AS markdown FROM y GROUP BY table_id""")
def table_markdown(spark, sf_dir):
    return C.tables(spark, sf_dir).select("table_id", B.markdown(F.col("cells")).alias("markdown"))


@query(_C + _CELL + "c UNION ALL SELECT DISTINCT table_id, CAST(n AS BIGINT), CAST(k AS BIGINT), CASE WHEN k = 0 THEN 'new' WHEN k = 1 THEN 'row' ELSE '' END FROM c, unnest([0, 1, 2, 3]) AS u(k)")
def append_row(spark, sf_dir):
    return _long(C.tables(spark, sf_dir), B.append_row(F.col("cells"), F.array(F.lit("new"), F.lit("row"))))


@query(_C + "SELECT table_id, CAST(CASE WHEN row > 1 THEN row - 1 ELSE row END AS BIGINT) AS row, CAST(col AS BIGINT) AS col, text FROM c WHERE row <> 1")
def delete_row(spark, sf_dir):
    return _long(C.tables(spark, sf_dir), B.delete_row(F.col("cells"), F.lit(1)))


@query(_C + _CELL + "c UNION ALL SELECT DISTINCT table_id, CAST(row AS BIGINT), CAST(4 AS BIGINT), CASE row WHEN 0 THEN 'h' WHEN 1 THEN 'v' ELSE '' END FROM c")
def append_column(spark, sf_dir):
    return _long(C.tables(spark, sf_dir), B.append_column(F.col("cells"), F.array(F.lit("h"), F.lit("v"))))


@query(_C + "SELECT table_id, CAST(row AS BIGINT) AS row, CAST(CASE WHEN col > 1 THEN col - 1 ELSE col END AS BIGINT) AS col, text FROM c WHERE col <> 1")
def delete_column(spark, sf_dir):
    return _long(C.tables(spark, sf_dir), B.delete_column(F.col("cells"), F.lit(1)))


@query(_C + "SELECT table_id, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col, CASE WHEN row = 1 AND col = 2 THEN 'set $1' ELSE text END AS text FROM c")
def set_cell(spark, sf_dir):
    return _long(C.tables(spark, sf_dir), B.set_cell(F.col("cells"), F.lit(1), F.lit(2), F.lit("set $1")))


@query(_C + "SELECT table_id, CAST(row AS BIGINT) AS row, CAST(CASE WHEN row = 0 AND col > 2 THEN col - 2 ELSE col END AS BIGINT) AS col, text FROM c WHERE NOT (row = 0 AND col IN (1, 2))")
def merge_horizontal(spark, sf_dir):
    return _long(C.tables(spark, sf_dir), B.merge_horizontal(F.col("cells"), F.lit(0), F.lit(0), F.lit(3)))


@query(_C + "SELECT table_id, CAST(row AS BIGINT) AS row, CAST(CASE WHEN row IN (1, 2) AND col > 1 THEN col - 1 ELSE col END AS BIGINT) AS col, text FROM c WHERE NOT (row IN (1, 2) AND col = 1)")
def merge_vertical(spark, sf_dir):
    return _long(C.tables(spark, sf_dir), B.merge_vertical(F.col("cells"), F.lit(1), F.lit(0), F.lit(3)))


@query(_I + """SELECT doc, seq, lower(CASE WHEN contains(lower(mime), 'png') THEN 'png' WHEN contains(lower(mime), 'jpeg') THEN 'jpg' WHEN contains(lower(mime), 'svg') THEN 'svg' WHEN contains(lower(mime), 'emf') THEN 'emf' ELSE 'bin' END) AS ext FROM i""")
def image_ext(spark, sf_dir):
    return C.images(spark, sf_dir).select("doc", "seq", T.extension(F.col("mime")).alias("ext"))


@query(_I + """SELECT seq, CASE WHEN byte_length < 1024 THEN byte_length || 'B' ELSE printf('%.1f', round(byte_length / 1024.0::DOUBLE, 1)) || 'KB' END AS label FROM i""")
def image_placeholder(spark, sf_dir):
    return C.images(spark, sf_dir).select("seq", T.size_label(F.col("byte_length")).alias("label"))


@query(_I + """SELECT doc, seq, row_number() OVER (PARTITION BY doc ORDER BY seq) || '. [section 0, para ' || seq || ', ctrl 0] ' || mime || ' (' || byte_length || ' bytes, .' || ext || ')' AS line,
printf('img_%03d', row_number() OVER (PARTITION BY doc ORDER BY seq)) AS name
FROM (SELECT *, CASE WHEN contains(lower(mime), 'png') THEN 'png' WHEN contains(lower(mime), 'jpeg') THEN 'jpg' WHEN contains(lower(mime), 'svg') THEN 'svg' WHEN contains(lower(mime), 'emf') THEN 'emf' ELSE 'bin' END AS ext FROM i)""")
def image_list(spark, sf_dir):
    i = C.images(spark, sf_dir).select("doc", F.lit(0).alias("section"), F.col("seq").alias("paragraph"), F.lit(0).alias("control"), "mime", "byte_length", T.extension(F.col("mime")).alias("ext"))
    return R.image_lines(i).select("doc", F.col("paragraph").alias("seq"), "line", "name")


@query(r"""WITH s AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '개요 ' WHEN 1 THEN 'outline' WHEN 2 THEN 'Heading ' ELSE 'My Outline  ' END || page_id % 12 AS style FROM pages)
SELECT page_id, style, CASE WHEN l = '7' THEN 6 ELSE CAST(nullif(l, '') AS INT) END AS level FROM (SELECT *, regexp_extract(style, '(?i)(?:개요|Outline)\s*([1-7])', 1) AS l FROM s)""")
def heading_levels(spark, sf_dir):
    n = F.col("page_id") % 5
    style = F.concat(F.when(n == 0, "개요 ").when(n == 1, "outline").when(n == 2, "Heading ").otherwise("My Outline  "), (F.col("page_id") % 12).cast("string"))
    return C.read(spark, sf_dir, "pages").select("page_id", style.alias("style")).withColumn("level", T.heading_level(F.col("style")))


@query("""SELECT user_id AS doc, CAST(count(*) FILTER (event_type = 'click') AS BIGINT) AS clicks, CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS views, CAST(count(DISTINCT event_type) AS BIGINT) AS kinds FROM events GROUP BY user_id""")
def doc_info(spark, sf_dir):
    e = C.read(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), F.col("event_type").alias("kind"))
    return R.kind_counts(e, ["click", "view"]).select("doc", F.col("n_click").alias("clicks"), F.col("n_view").alias("views"), "kinds")


@query("""SELECT conv_id AS doc, row_number() OVER (PARTITION BY conv_id ORDER BY turn) || '. ' || role || ' [clickhere] = ' || substring(text, 1, 40) AS line FROM conversations""")
def field_list(spark, sf_dir):
    c = C.read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), F.lit(0).alias("section"), F.col("turn").alias("ord"), F.col("role").alias("name"), F.lit("clickhere").alias("type"), F.col("text").alias("value"))
    return R.field_lines(c).select("doc", "line")


@query("SELECT conv_id AS doc, min_by(text, turn) AS value FROM conversations WHERE role = 'user' GROUP BY conv_id")
def field_lookup(spark, sf_dir):
    c = C.read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), F.lit(0).alias("section"), F.col("turn").alias("ord"), F.col("role").alias("name"), F.col("text").alias("value"))
    return R.field_value(c, "user")


@query(_E + "SELECT DISTINCT doc, entry, CAST(dense_rank() OVER (PARTITION BY doc ORDER BY entry) AS BIGINT) AS n FROM e")
def bindata_sorted(spark, sf_dir):
    return R.binary_entries(C.entry_rows(spark, sf_dir)).select("doc", "entry", F.col("n").cast("long").alias("n"))


@query("SELECT conv_id AS doc, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, count(*) OVER (PARTITION BY conv_id) AS pages FROM conversations) WHERE n <= greatest(0, least(3, pages))")
def page_limit(spark, sf_dir):
    c = C.read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), "turn", "text")
    return R.first_rows(c, 3, "turn").drop("n")


def _last_sql(s: str, k: str, v: str) -> str:
    back = f"instr(reverse({s}), reverse({k}))"
    at = f"(length({s}) - {back} - length({k}) + 2)"
    return f"CASE WHEN {back} > 0 THEN substring({s}, 1, {at} - 1) || {v} || substring({s}, {at} + length({k})) ELSE {s} END"


_FILL = "WITH " + C.PARAGRAPHS + f""", f1 AS (SELECT doc, paragraph, instr(text, 'the') > 0 AS h0, {_last_sql("text", "'the'", "'THE &amp; co'")} AS t FROM p),
f2 AS (SELECT *, instr(t, 'and') > 0 AS h1, {_last_sql("t", "'and'", "'$1 &lt;and&gt;'")} AS u FROM f1), f3 AS (SELECT *, instr(u, 'THE') > 0 AS h2, {_last_sql("u", "'THE'", "'x'")} AS text FROM f2) """


@query(_FILL + "SELECT doc, CAST(paragraph AS BIGINT) AS paragraph, text FROM f3")
def template_fill(spark, sf_dir):
    f = E.fill_template(C.paragraphs(spark, sf_dir), PAIRS)
    return f.select("doc", F.col("paragraph").cast("long").alias("paragraph"), "text")


@query(_FILL + """SELECT 'the' AS key, CAST(count(*) FILTER (h0) AS BIGINT) AS hits FROM f3 UNION ALL SELECT 'and', count(*) FILTER (h1) FROM f3 UNION ALL SELECT 'THE', count(*) FILTER (h2) FROM f3 UNION ALL SELECT '{{none}}', 0""")
def template_counts(spark, sf_dir):
    return E.template_counts(C.paragraphs(spark, sf_dir), PAIRS).select("key", "hits")


@query(_P + f"SELECT doc, CAST(paragraph AS BIGINT) AS paragraph, instr(text, 'the') > 0 AS hit, {_last_sql('text', chr(39) + 'the' + chr(39), chr(39) + '[T]' + chr(39))} AS text FROM p")
def replace_last(spark, sf_dir):
    p = C.paragraphs(spark, sf_dir)
    return p.select("doc", F.col("paragraph").cast("long").alias("paragraph"), (F.position(F.lit("the"), F.col("text")) > 0).alias("hit"), T.replace_last(F.col("text"), F.lit("the"), F.lit("[T]")).alias("text"))


@query("SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM pages")
def xml_escape(spark, sf_dir):
    return C.read(spark, sf_dir, "pages").select("page_id", T.xml_escape(F.col("html")).alias("escaped"))


def _paras(spark, sf_dir, change) -> DataFrame:
    p = C.paragraphs(spark, sf_dir).groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("paragraph", "text"))), lambda x: x["text"]).alias("paras"))
    return p.select("doc", F.posexplode(change(F.col("paras"))).alias("paragraph", "text")).select("doc", F.col("paragraph").cast("long").alias("paragraph"), "text")


@query(_P + "SELECT doc, CAST(paragraph AS BIGINT) AS paragraph, text FROM p UNION ALL SELECT doc, count(*), 'appended' FROM p GROUP BY doc")
def append_paragraph(spark, sf_dir):
    return _paras(spark, sf_dir, lambda p: E.append_paragraph(p, F.lit("appended")))


@query(_P + "SELECT doc, CAST(CASE WHEN paragraph > 2 THEN paragraph - 1 ELSE paragraph END AS BIGINT) AS paragraph, text FROM p WHERE paragraph <> 2")
def delete_paragraph(spark, sf_dir):
    return _paras(spark, sf_dir, lambda p: E.delete_paragraph(p, F.lit(2)))


@query(_P + "SELECT doc, CAST(paragraph AS BIGINT) AS paragraph, CASE WHEN paragraph = 1 THEN 'set $& text' ELSE text END AS text FROM p")
def set_paragraph(spark, sf_dir):
    return _paras(spark, sf_dir, lambda p: E.set_paragraph(p, F.lit(1), F.lit("set $& text")))


@query("""SELECT conv_id, turn, '<hp:fldBegin name="f"/><hp:t>v &amp; $1</hp:t><hp:x/><hp:t>v &amp; $1</hp:t><hp:fldEnd/><hp:t>' || turn || '</hp:t>' AS xml FROM conversations""")
def field_set(spark, sf_dir):
    xml = F.concat(F.lit('<hp:fldBegin name="f"/><hp:t>'), F.replace(F.replace(F.col("text"), F.lit("<"), F.lit("")), F.lit("&"), F.lit("")), F.lit("</hp:t><hp:x/><hp:t></hp:t><hp:fldEnd/><hp:t>"), F.col("turn").cast("string"), F.lit("</hp:t>"))
    return C.read(spark, sf_dir, "conversations").select("conv_id", "turn", E.set_field(xml, "f", "v & $1").alias("xml"))


@query("SELECT user_id AS doc, max(event_id) + 1 AS new_id FROM events GROUP BY user_id")
def style_alloc(spark, sf_dir):
    return E.next_id(C.read(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), F.col("event_id").alias("id")), ["doc"])


@query(_E + ", m AS (SELECT doc, min_by(entry, seq) AS entry FROM e WHERE entry = 'BinData/image2.png' GROUP BY doc) SELECT e.doc, seq, e.entry, CASE WHEN m.entry IS NOT NULL THEN 'new' ELSE bytes END AS bytes FROM e LEFT JOIN m ON e.doc = m.doc AND e.entry = m.entry")
def replace_image(spark, sf_dir):
    return E.replace_entry(C.entry_rows(spark, sf_dir), "image2.png", F.lit("new").cast("binary")).select("doc", "seq", "entry", F.col("bytes").cast("string").alias("bytes"))


@query(_E + "SELECT doc, seq, entry FROM e WHERE entry <> 'BinData/image2.png'")
def delete_image(spark, sf_dir):
    return E.delete_entry(C.entry_rows(spark, sf_dir), "image2.png").select("doc", "seq", "entry")


@query(_E + """, d AS (SELECT DISTINCT doc FROM e), n AS (SELECT doc, k FROM d, range(1, 9) AS r(k)) SELECT n.doc, 'BinData/image' || min(k) || '.jpg' AS entry FROM n LEFT JOIN e ON e.doc = n.doc AND e.entry = 'BinData/image' || k || '.jpg' WHERE e.doc IS NULL GROUP BY n.doc""")
def insert_image_name(spark, sf_dir):
    return E.free_name(C.entry_rows(spark, sf_dir), "jpg")


@query("""SELECT doc_id, CAST(length(regexp_replace(text, '[^\\x{3000}-\\x{303F}\\x{3040}-\\x{30FF}\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{AC00}-\\x{D7A3}\\x{FF00}-\\x{FFEF}]', '', 'g')) AS BIGINT) AS wide,
round((length(regexp_replace(text, '[^\\x{3000}-\\x{303F}\\x{3040}-\\x{30FF}\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{AC00}-\\x{D7A3}\\x{FF00}-\\x{FFEF}]', '', 'g')) * 0.45::DOUBLE + length(text) * 0.55::DOUBLE) * 12, 3) AS width FROM (SELECT doc_id, text || '한글' || chr(12289) AS text FROM documents)""".replace("\\\\", "\\"))
def text_width(spark, sf_dir):
    s = F.concat("text", F.lit("한글、"))
    return C.read(spark, sf_dir, "documents").select("doc_id", F.regexp_count(s, F.lit(T.WIDE)).cast("long").alias("wide"), F.round(T.text_width(s, F.lit(12)), 3).alias("width"))


# Whole packages: made of documents, zipped, read again, reported on and edited.

_L = f"WITH {C.LINES} "
_BLANK = C.TRIM.format("text") + " = ''"


def _tokens(members: DataFrame) -> DataFrame:
    """Body tokens, cut once for all views."""
    return stored(views.body_tokens(members))


def _dump(members: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    return R.full_text_of(part_views.texts(members), docs)


@query(f"SELECT doc_id AS doc, CASE WHEN {_BLANK} THEN '{R.NO_TEXT}' ELSE text END AS text FROM documents")
def package_text(spark, sf_dir):
    zipped = package.packages(C.members(spark, sf_dir)).withColumnRenamed("doc", "path")
    return R.or_message(_dump(package.entries(zipped), C.names(spark, sf_dir)), "text", R.NO_TEXT).select(C.doc_id(), "text")


@query(_L + f"""SELECT doc, coalesce(string_agg({C.TRIM.format("line")}, chr(10) || chr(10) ORDER BY paragraph) FILTER ({C.TRIM.format("line")} <> ''), '{R.NO_MARKDOWN}') AS markdown FROM l GROUP BY doc""")
def package_markdown(spark, sf_dir):
    members = C.members(spark, sf_dir)
    t = _tokens(members)
    return R.markdown(C.names(spark, sf_dir), views.flow(t, members), views.footnotes(t)).select(C.doc_id(), "markdown")


@query(_FILL.replace(C.PARAGRAPHS, C.LINES + ", p AS (SELECT doc, paragraph, replace(replace(replace(line, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS text FROM l)") + """SELECT doc,
replace(replace(replace(string_agg(text, chr(10) ORDER BY paragraph), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS text, CAST(count(*) FILTER (h0) + count(*) FILTER (h1) + count(*) FILTER (h2) AS BIGINT) AS n FROM f3 GROUP BY doc""")
def package_fill(spark, sf_dir):
    members = C.members(spark, sf_dir)
    edits = stored(P.fill(members, PAIRS))
    counts = edits.groupBy("doc").agg(F.sum("n").alias("n"))
    return _dump(P.applied(members, edits), C.names(spark, sf_dir)).join(counts.hint("merge"), "doc").select(C.doc_id(), "text", "n")


@query(_L + """SELECT doc, string_agg(CASE WHEN paragraph = 1 THEN 'set $& text' ELSE line END, chr(10) ORDER BY paragraph) AS text, CASE WHEN count(*) > 1 THEN 'ok' ELSE 'index_range' END AS code FROM l GROUP BY doc""")
def package_set_paragraph(spark, sf_dir):
    members = C.members(spark, sf_dir)
    edits = stored(P.set_paragraph_text(members, 1, "set $& text"))
    return _dump(P.applied(members, edits), C.names(spark, sf_dir)).join(edits.select("doc", "code").hint("merge"), "doc").select(C.doc_id(), "text", "code")


@query(_L + """SELECT doc, coalesce(string_agg(line, chr(10) ORDER BY paragraph) FILTER (paragraph <> 2), '') AS text, CASE WHEN count(*) > 2 THEN 'ok' ELSE 'index_range' END AS code, CAST(count(*) AS BIGINT) AS n FROM l GROUP BY doc""")
def package_delete_paragraph(spark, sf_dir):
    members = C.members(spark, sf_dir)
    edits = stored(P.delete_paragraph(members, 2))
    return _dump(P.applied(members, edits), C.names(spark, sf_dir)).join(edits.select("doc", "code", "n"), "doc").select(C.doc_id(), "text", "code", "n")


_TABLE = (["item", "a|b"], [["1", "x & y"], ["2", "<z>"]])


@query("""SELECT doc_id AS doc, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col, v.text AS text FROM documents CROSS JOIN (VALUES (0, 0, 'item'), (0, 1, 'a|b'), (1, 0, '1'), (1, 1, 'x & y'), (2, 0, '2'), (2, 1, '<z>')) AS v(row, col, text)""")
def insert_table(spark, sf_dir):
    members = C.members(spark, sf_dir)
    return part_views.table_cells(P.applied(members, P.insert_table(members, *_TABLE))).select(C.doc_id(), F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "text")


@query(r"""SELECT doc_id AS doc, '# ' || doc_id || '.hwpx' || chr(10) || '형식: .HWPX | 문단: ' || (len(string_split(text, chr(10))) + 1) || '개 | 표: 1개 | 이미지: 0개' || chr(10) || chr(10) || text || chr(10) || chr(10) || chr(10) ||
'### 표 1 (3행 x 2열)' || chr(10) || '| item | a\|b |' || chr(10) || '| --- | --- |' || chr(10) || '| 1 | x & y |' || chr(10) || '| 2 | <z> |' AS text FROM documents""")
def read_combined(spark, sf_dir):
    made = C.members(spark, sf_dir)
    members = stored(P.applied(made, P.insert_table(made, *_TABLE)))
    tables = part_views.tables(members).withColumn("markdown", B.markdown(F.col("cells")))
    return R.combined(_dump(members, C.names(spark, sf_dir)), tables, part_views.images(members)).select(C.doc_id(), "text")


@query("SELECT doc_id AS doc, CASE WHEN contains(text, 'the') THEN 'ok' ELSE 'target_missing' END AS code, CAST(CASE WHEN contains(text, 'the') THEN 1 ELSE 0 END AS BIGINT) AS runs FROM documents")
def char_style_alloc(spark, sf_dir):
    members = C.members(spark, sf_dir)
    edits = stored(P.apply_text_style(members, "the", color="FF0000", bold=True))
    t = views.body_tokens(P.applied(members, edits), "tok")
    runs = t.groupBy("doc").agg(F.count_if(F.col("tok").contains('charPrIDRef="1"')).alias("runs"))
    return edits.filter(F.col("entry").contains("section")).select("doc", "code").join(runs, "doc").select(C.doc_id(), "code", "runs")


@query("SELECT doc_id AS doc, CASE WHEN len(string_split(text, chr(10))) > 2 THEN 'ok' ELSE 'index_range' END AS code, CAST(CASE WHEN len(string_split(text, chr(10))) > 2 THEN 2 ELSE -1 END AS BIGINT) AS styled FROM documents")
def para_style_alloc(spark, sf_dir):
    members = C.members(spark, sf_dir)
    edits = stored(P.apply_paragraph_style(members, 2, align="CENTER", indent=10))
    t = views.body_tokens(P.applied(members, edits), "tok", "paragraph")
    styled = t.groupBy("doc").agg(F.coalesce(F.max(F.when(F.col("tok").contains('paraPrIDRef="1"'), F.col("paragraph"))), F.lit(-1)).cast("long").alias("styled"))
    return edits.filter(F.col("entry").contains("section")).select("doc", "code").hint("merge").join(styled, "doc").select(C.doc_id(), "code", "styled")


@query(_L + "SELECT doc, CAST(6 AS BIGINT) AS entries, CAST(count(*) AS BIGINT) AS paragraphs FROM l GROUP BY doc")
def create_document(spark, sf_dir):
    members = C.members(spark, sf_dir)
    n = views.paragraphs(views.body_tokens(members)).groupBy("doc").agg(F.count("*").alias("paragraphs"))
    return members.groupBy("doc").agg(F.count("*").alias("entries")).join(n, "doc").select(C.doc_id(), "entries", "paragraphs")


# Edits on packages' markup that differ by document, and what is then read from them.

_G = f"WITH {C.GRID} "


def _n() -> Column:
    return F.col("doc_id")


def _scripted(spark, sf_dir, *steps) -> DataFrame:
    """Members of packages with tables after each document's own edits."""
    members = C.table_members(spark, sf_dir)
    return S.scripted(members, C.script(spark, sf_dir, *steps))[0]


def _grid_cells(members: DataFrame, *more: str) -> DataFrame:
    return part_views.table_cells(members).select(C.doc_id(), F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), *(F.col(c).cast("long").alias(c) for c in more), "text")


def _texts(*x: str) -> Column:
    return F.array(*map(F.lit, x))


@query(_G + """SELECT doc, row, col, text FROM g WHERE doc % 4 = 0 UNION ALL
SELECT doc, CASE WHEN row > 1 THEN row - 1 ELSE row END, col, text FROM g WHERE doc % 4 IN (1, 3) AND row <> 1 UNION ALL
SELECT doc, row, col, text FROM g WHERE doc % 4 = 2 UNION ALL
SELECT doc, CASE WHEN doc % 4 = 3 THEN 2 ELSE 3 END, col, CASE col WHEN 0 THEN '$1 & ' || doc WHEN 1 THEN '<b>' ELSE '' END FROM g WHERE doc % 4 IN (2, 3) AND row = 0""")
def package_rows(spark, sf_dir):
    n = _n() % 4
    return _grid_cells(_scripted(
        spark, sf_dir, (n.isin(1, 3), "delete_row", {"table": F.lit(0), "row": F.lit(1)}), (n.isin(2, 3), "append_row", {"table": F.lit(0), "texts": F.array(F.concat(F.lit("$1 & "), _n().cast("string")), F.lit("<b>"))}),
        (n == 0, "delete_row", {"table": F.lit(0), "row": F.lit(3)})))


@query(_G + """SELECT doc, row, CASE WHEN doc % 3 = 0 AND col > 1 THEN col - 1 WHEN doc % 3 = 2 THEN col - 1 ELSE col END AS col, text FROM g WHERE NOT (doc % 3 = 0 AND col = 1) AND NOT (doc % 3 = 2 AND col = 0) UNION ALL
SELECT doc, row, CASE WHEN doc % 3 = 2 THEN 2 ELSE 3 END, CASE row WHEN 0 THEN 'h' WHEN 1 THEN 'v' ELSE '' END FROM g WHERE doc % 3 > 0 AND col = 0""")
def package_columns(spark, sf_dir):
    n = _n() % 3
    return _grid_cells(_scripted(
        spark, sf_dir, (n == 0, "delete_column", {"table": F.lit(0), "col": F.lit(1)}), (n == 2, "delete_column", {"table": F.lit(0), "col": F.lit(0)}),
        (n > 0, "append_column", {"table": F.lit(0), "texts": _texts("h", "v")})))


@query(_G + "SELECT doc, row, col, CASE WHEN row = doc % 3 AND col = doc % 2 THEN 'set $& ' || doc ELSE text END AS text FROM g")
def package_cells(spark, sf_dir):
    return _grid_cells(_scripted(spark, sf_dir, (F.lit(True), "set_cell", {"table": F.lit(0), "row": _n() % 3, "col": _n() % 2, "text": F.concat(F.lit("set $& "), _n().cast("string"))})))


@query(_G + """SELECT doc, row, col, CAST(CASE WHEN doc % 2 = 1 AND row = 1 AND col = 0 THEN 2 ELSE 1 END AS BIGINT) AS row_span, CAST(CASE WHEN doc % 2 = 0 AND row = 1 AND col = 0 THEN 2 ELSE 1 END AS BIGINT) AS col_span, text
FROM g WHERE NOT (doc % 2 = 0 AND row = 1 AND col = 1) AND NOT (doc % 2 = 1 AND row = 2 AND col = 0)""")
def package_merges(spark, sf_dir):
    at = {"table": F.lit(0), "row": F.lit(1), "col": F.lit(0), "count": F.lit(2)}
    return _grid_cells(_scripted(spark, sf_dir, (_n() % 2 == 0, "merge_horizontal", at), (_n() % 2 == 1, "merge_vertical", at)), "row_span", "col_span")


@query(f"""SELECT doc_id AS doc, CASE WHEN doc_id % 2 = 0 THEN 'overlap' ELSE 'ok' END AS code, v.row, v.col, v.down AS row_span, CASE WHEN v.nth = 2 AND doc_id % 2 = 1 THEN CAST(2 AS BIGINT) ELSE v.wide END AS col_span,
CASE v.nth WHEN 0 THEN coalesce({C.TRIM.format("text")}, '') ELSE v.said || '-' || doc_id END AS text FROM documents, (VALUES (0, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(2 AS BIGINT), CAST(1 AS BIGINT), ''), (1, 0, 1, 1, 2, 'top'), (2, 1, 1, 1, 1, 'a'), (3, 1, 2, 1, 1, 'b')) AS v(nth, row, col, down, wide, said)
WHERE NOT (v.nth = 3 AND doc_id % 2 = 1)""")
def package_merge_overlaps(spark, sf_dir):
    """A cell over two rows takes none of one row beside it; two cells of one row become one."""
    at = {"table": F.lit(0), "col": F.lit(0), "count": F.lit(2)}
    members = C.spanned_members(spark, sf_dir)
    edited, report = S.scripted(members, C.script(spark, sf_dir, (F.lit(True), "merge_horizontal", at | {"row": _n() % 2})))
    cells = _grid_cells(edited, "row_span", "col_span").filter("row < 2")
    return cells.join(report.select(C.doc_id(), "code").hint("merge"), "doc")


@query("""SELECT doc_id AS doc, CASE doc_id % 3 WHEN 0 THEN chr(10) || 'A' || doc_id || 'C' || chr(10) || 'more ' || doc_id WHEN 1 THEN 'new' || chr(10) || chr(10) || 'A' || doc_id || 'C'
ELSE 'first' || chr(10) || chr(10) || 'A' || doc_id || 'C' || chr(10) || 'set again' END AS text FROM documents""")
def package_script(spark, sf_dir):
    """Paragraph and table edits in turns; each refers to what earlier ones left. Paragraphs: the first, those of nine cells, the
    field's, those at the end."""
    n, say = _n() % 3, lambda s: {"text": F.lit(s)}
    members = _scripted(
        spark, sf_dir, (n == 0, "delete_paragraph", {"index": F.lit(0)}), (n == 0, "append_paragraph", {"text": F.concat(F.lit("more "), _n().cast("string"))}), (n == 1, "set_paragraph", {"index": F.lit(0)} | say("new")),
        (n == 2, "append_paragraph", say("at the end")), (n == 2, "delete_row", {"table": F.lit(0), "row": F.lit(2)}), (n == 2, "set_paragraph", {"index": F.lit(8)} | say("set")), (n == 2, "set_paragraph", {"index": F.lit(8)} | say("set again")),
        (n == 1, "append_row", {"table": F.lit(0), "texts": _texts("r")}), (n == 1, "append_paragraph", say("gone")), (n == 1, "delete_paragraph", {"index": F.lit(14)}))
    return _dump(members).select(C.doc_id(), "text")


@query("SELECT doc_id AS doc, 1 AS ord, 'outer' AS name, 'CLICK_HERE' AS type, 'A' || doc_id || 'C' AS value FROM documents UNION ALL SELECT doc_id, 2, 'inner', 'DATE', CAST(doc_id AS VARCHAR) FROM documents")
def package_fields(spark, sf_dir):
    return part_views.fields(C.table_members(spark, sf_dir)).select(C.doc_id(), F.col("ord").cast("int").alias("ord"), "name", "type", "value")


@query("SELECT doc_id AS doc, 'ok' AS code, CAST(2 AS BIGINT) AS n, name, CASE name WHEN 'outer' THEN 'v & $1' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS value FROM documents, (VALUES ('outer'), ('inner')) AS f(name)")
def package_set_field(spark, sf_dir):
    """The outer field's own nodes are set; the field within it stays whole."""
    members = C.table_members(spark, sf_dir)
    edits = stored(P.set_field(members, "outer", "v & $1"))
    f = part_views.fields(P.applied(members, edits)).join(edits.select("doc", "code", "n").hint("merge"), "doc")
    return f.select(C.doc_id(), "code", "n", "name", "value")


@query("""SELECT doc_id AS doc, entry, mime, size AS byte_length FROM documents, (VALUES ('BinData/image2.png', 'image/png', CAST(3 AS BIGINT)), ('BinData/image3.jpg', 'image/jpeg', 4)) AS i(entry, mime, size)""")
def package_images(spark, sf_dir):
    """A png, then a jpg, each under a number that no item has; both are read back."""
    members = stored(P.insert_image(C.table_members(spark, sf_dir), F.lit(b"new"), "png"))
    members = stored(P.insert_image(members, F.lit(b"more"), "jpg"))
    return part_views.images(members).select(C.doc_id(), "entry", "mime", "byte_length")


# Nested structure: section definitions, HTML, grids of cells without addresses.

@query("""SELECT doc_id AS doc, '{"name":"hp:secPr","attributes":{"id":"","columns":"2"},"children":[{"name":"hp:pagePr","attributes":{"width":"' || doc_id || '","note":"a < \\"b\\""},"children":[' ||
'{"name":"hp:margin","attributes":{"left":"1","top":"2"},"children":[]}]},{"name":"hp:label","attributes":{},"children":["x & y"]}]}' AS json FROM documents""")
def page_definition(spark, sf_dir):
    return structure.page_definitions(views.body_tokens(C.spanned_members(spark, sf_dir))).select(C.doc_id(), "json")


@query("""SELECT doc_id AS doc, '<h2>head</h2><p>before</p><table><tr><td rowspan="2">' || CASE WHEN text = '' OR text IS NULL THEN '' ELSE '<p>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p>' END || '</td><td colspan="2"><p>top-' || doc_id ||
'</p></td></tr><tr><td><p>a-' || doc_id || '</p></td><td><p>b-' || doc_id || '</p></td></tr><tr><td' || CASE doc_id % 3 WHEN 0 THEN '' ELSE ' colspan="' || (doc_id % 3 + 1) || '"' END || '><p>c-' || doc_id ||
'</p><table><tr><td><p>x-' || doc_id || '</p></td><td colspan="2"><p>y-' || doc_id || '</p></td></tr></table></td><td><p>d-' || doc_id || '</p></td></tr></table>' ||
'<p>A<br>B &amp; C<img src="BinData/image1.png"><code>a &lt; b</code></p>' AS html FROM documents""")
def flow_html(spark, sf_dir):
    members = C.spanned_members(spark, sf_dir)
    return structure.html(_tokens(members), members).select(C.doc_id(), "html")


@query(f"""SELECT doc_id AS doc, CAST(CASE doc_id % 3 WHEN 2 THEN 4 ELSE 3 END AS BIGINT) AS n_cols, v.row, CASE v.nth WHEN 5 THEN doc_id % 3 + 1 ELSE v.col END AS col, v.down AS row_span, CASE v.nth WHEN 4 THEN doc_id % 3 + 1 ELSE v.wide END AS col_span,
CASE v.nth WHEN 0 THEN coalesce({C.TRIM.format("text")}, '') ELSE v.said || '-' || doc_id END AS text FROM documents, (VALUES (0, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(2 AS BIGINT), CAST(1 AS BIGINT), ''), (1, 0, 1, 1, 2, 'top'), (2, 1, 1, 1, 1, 'a'), (3, 1, 2, 1, 1, 'b'), (4, 2, 0, 1, 1, 'c'), (5, 2, 1, 1, 1, 'd')) AS v(nth, row, col, down, wide, said)""")
def spanned_grid(spark, sf_dir):
    cells = views.table_cells(views.body_tokens(C.spanned_members(spark, sf_dir)))
    return cells.select(C.doc_id(), *(F.col(c).cast("long").alias(c) for c in ("n_cols", "row", "col", "row_span", "col_span")), "text")


# Arguments in JSON, each document its own.

def _steps_sql(*pairs: tuple[str, str]) -> str:
    """CTEs s1, s2, ... of l's lines, XML-escaped, after each pair (SQL of key and value), h1, h2, ... telling hits."""
    out = "s0 AS (SELECT *, replace(replace(replace(line, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS t0 FROM l)"
    for i, (k, v) in enumerate(pairs, 1):
        done = f"CASE WHEN doc % 5 > 0 THEN {_last_sql(f't{i - 1}', k, v)} ELSE t{i - 1} END"
        out += f", s{i} AS (SELECT *, doc % 5 > 0 AND instr(t{i - 1}, {k}) > 0 AS h{i}, {done} AS t{i} FROM s{i - 1})"
    return out


@query(_L + ", " + _steps_sql(("'1'", "'10'"), ("'10'", "'ten &amp; &lt;' || doc || '&gt;'"), ("'zz'", "'A'"), ("'the'", "'T-' || doc"), ("'ten'", "'the'")) + """,
c AS (SELECT doc, string_agg(t5, chr(10) ORDER BY paragraph) AS t, count(*) FILTER (h1) AS n1, count(*) FILTER (h2) AS n2, count(*) FILTER (h3) AS n3, count(*) FILTER (h4) AS n4, count(*) FILTER (h5) AS n5 FROM s5 GROUP BY doc),
k AS (SELECT doc, string_agg('  ' || chr(39) || key || chr(39) || ' → ' || n || '건', chr(10) ORDER BY NOT idx, CASE WHEN idx THEN 0 WHEN n > 0 THEN 1 ELSE 2 END, i) AS lines
FROM (SELECT doc, unnest(['1', '10', 'zz', 'the', 'ten']) AS key, unnest([n1, n2, n3, n4, n5]) AS n, unnest([true, true, false, false, false]) AS idx, unnest([1, 2, 3, 4, 5]) AS i FROM c) GROUP BY doc)
SELECT c.doc, CASE WHEN c.doc % 5 = 0 THEN 'bad_json' ELSE 'ok' END AS code, CAST(n1 + n2 + n3 + n4 + n5 AS BIGINT) AS n,
CASE WHEN c.doc % 5 > 0 THEN '총 ' || (n1 + n2 + n3 + n4 + n5) || '건 치환 (' || (n1 + n2 + n3 + n4 + n5) || ' replacements)' || chr(10) || chr(10) || lines END AS report,
replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS text FROM c JOIN k ON c.doc = k.doc""")
def package_fill_json(spark, sf_dir):
    members = C.members(spark, sf_dir)
    edits, outcome = P.fill_each(members, C.arguments(spark, sf_dir))
    return _dump(P.applied(members, edits), C.names(spark, sf_dir)).join(outcome, "doc").select(C.doc_id(), "code", "n", "report", "text")


@query("""SELECT doc_id AS doc, CASE WHEN doc_id % 5 = 0 THEN 'bad_json' ELSE 'ok' END AS code,
CASE WHEN doc_id % 5 > 0 THEN coalesce(text, '') || chr(10) || 'id | 2' || chr(10) || '--- | ---' || chr(10) || doc_id || ' | x & y' || chr(10) END AS text FROM documents""")
def create_json(spark, sf_dir):
    members, outcome = package.create_each(C.contents(spark, sf_dir))
    return outcome.join(_dump(members), "doc", "left").select(C.doc_id(), "code", "text")


# Keys split over runs.

def _runs_sql(second: str) -> str:
    """Each document's lines after `second` (SQL of t1) replaces the second key, and how many lines hold each key."""
    return f"""{_L}, s1 AS (SELECT *, contains(line, 'the') AS h1, replace(line, 'the', 'T<') AS t1 FROM l), s2 AS (SELECT *, contains(t1, 'T<r') AS h2, {second} AS t2 FROM s1)
SELECT doc, CAST(count(*) FILTER (h1) AS BIGINT) AS n_first, CAST(count(*) FILTER (h2) AS BIGINT) AS n_second, string_agg(t2, chr(10) ORDER BY paragraph) AS text FROM s2 GROUP BY doc"""


@query(_runs_sql("replace(t1, 'T<r', '$1 th\\r')"))
def package_fill_runs(spark, sf_dir):
    """Keys that lie in several runs, all their places, the second in what the first left."""
    members = C.run_members(spark, sf_dir)
    edits = stored(run_fill.fill_across_runs(members, [("the", "T<"), ("T<r", "$1 th\\r")], all_occurrences=True))
    n = edits.groupBy("doc").agg(F.sum(F.col("hits")[0]).alias("n_first"), F.sum(F.col("hits")[1]).alias("n_second"))
    return _dump(P.applied(members, edits), C.names(spark, sf_dir)).join(n.hint("merge"), "doc").select(C.doc_id(), "n_first", "n_second", "text")
