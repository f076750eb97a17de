"""Packages read, reported on and edited end to end; expected values are worked out by hand."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from docweave.operators import package_edit as P
from docweave.operators import report as R
from docweave.sources import markup, package, sinks, views

HEAD = ('<?xml version="1.0"?><hh:head><hh:fontface lang="HANGUL"><hh:font id="0" face="Batang"/><hh:font id="1" face="Dotum"/></hh:fontface><hh:charPrList><hh:charPr id="0" height="1000"><hc:color val="#000000"/></hh:charPr>'
        '<hh:charPr id="4" height="900"/></hh:charPrList><hh:paraPr id="0" align="LEFT" indent="0"/><hh:paraPr id="7" indent="1"/>'
        '<hh:style id="0" type="PARA" name="Normal"/><hh:style id="1" type="PARA" name="Outline 2"/></hh:head>')


def _p(i, body, style=0):
    return f'<hp:p id="{i}" paraPrIDRef="0" styleIDRef="{style}">{body}</hp:p>'


def _r(text, ref=0):
    return f'<hp:run charPrIDRef="{ref}"><hp:t>{text}</hp:t></hp:run>'


def _tc(r, c, text, inner=""):
    return f'<hp:tc name="a&gt;b"><hp:subList>{_p(50 + r * 10 + c, _r(text) + inner)}</hp:subList><hp:cellAddr colAddr="{c}" rowAddr="{r}"/><hp:cellSpan colSpan="1" rowSpan="1"/></hp:tc>'


NESTED = f'<hp:run charPrIDRef="0"><hp:tbl id="9" rowCnt="1" colCnt="1"><hp:tr>{_tc(0, 0, "inner")}</hp:tr></hp:tbl></hp:run>'
TABLE = ('<hp:tbl id="100" rowCnt="2" colCnt="2"><hp:tr>' + _tc(0, 0, "A1", NESTED) + _tc(0, 1, "B|1") + "</hp:tr><hp:tr>" + _tc(1, 0, "A2") + _tc(1, 1, "A2") + "</hp:tr></hp:tbl>")
SECTION = (
    '<?xml version="1.0"?><hs:sec xmlns:hs="x" xmlns:hp="y"><!-- <hp:p> -->'
    + _p(1, '<hp:secPr textDirection="HORIZONTAL"><hp:pagePr width="59528" height="84188"><hp:margin left="10"/></hp:pagePr></hp:secPr>'
         '<hp:run charPrIDRef="0"><hp:ctrl><hp:header applyPageType="BOTH"><hp:subList>' + _p(2, _r(" top ")) + '</hp:subList></hp:header></hp:ctrl>'
         '<hp:ctrl><hp:header applyPageType="BOTH"><hp:subList>' + _p(3, _r("again")) + "</hp:subList></hp:header></hp:ctrl></hp:run>" + _r("Title &amp; more"), 1)
    + _p(4, '<hp:run charPrIDRef="0"><hp:t>before</hp:t>' + TABLE + "</hp:run>" + _r("after"))
    + _p(5, '<hp:run charPrIDRef="2"><hp:t>x<hp:tab/>y</hp:t><hp:ctrl><hp:footNote number="3"><hp:subList>' + _p(6, _r("note one")) + _p(7, _r("line two")) + "</hp:subList></hp:footNote></hp:ctrl></hp:run>")
    + _p(8, '<hp:run charPrIDRef="0"><hp:equation baseUnit="1100" font="HYhwpEQ"><hp:script>a over b</hp:script></hp:equation><hp:pic id="5"><hc:img binaryItemIDRef="image1"/></hp:pic></hp:run>')
    + _p(9, '<hp:run charPrIDRef="0"><hp:ctrl><hp:fldBegin name="who" type="CLICK_HERE"/></hp:ctrl><hp:t>nobody</hp:t><hp:ctrl><hp:fldEnd/></hp:ctrl></hp:run>')
    + "</hs:sec>"
)
HPF = '<opf:package><opf:manifest><opf:item id="image1" href="BinData/image1.png" media-type="image/png"/></opf:manifest></opf:package>'


def _zip(section=SECTION, **more):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("mimetype", "application/hwp+zip", zipfile.ZIP_STORED)
        for name, content in {"Contents/header.xml": HEAD, "Contents/section0.xml": section, "Contents/content.hpf": HPF, "BinData/image1.png": b"png!" * 300, **more}.items():
            z.writestr(name, content)
    return out.getvalue()


@pytest.fixture(scope="module")
def members(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("packages")
    (folder / "a.hwpx").write_bytes(_zip())
    (folder / "empty.hwpx").write_bytes(_zip('<hs:sec xmlns:hs="x"></hs:sec>'))
    return package.entries(package.read_files(spark, str(folder))).cache()


@pytest.fixture(scope="module")
def t(members):
    return views.body_tokens(members).cache()


def _of(df, column, name="a"):
    return [r[column] for r in df.collect() if r["doc"].endswith(f"/{name}.hwpx")]


def test_tokens_make_the_part_again(spark, t):
    got = {r.doc.rsplit("/", 1)[1]: r.xml for r in markup.assembled(t).collect()}
    assert got["a.hwpx"] == SECTION
    tag = spark.sql("""SELECT '<a b="1" id="2" c="x>y"/>' AS tok""")
    assert tag.select(markup.with_attribute(F.col("tok"), "id", F.lit("$9")).alias("x")).first().x == '<a b="1" id="$9" c="x>y"/>'
    assert tag.select(markup.with_attribute(F.col("tok"), "z", F.lit("\\1")).alias("x")).first().x == '<a z="\\1" b="1" id="2" c="x>y"/>'


def test_views(t, members):
    p = views.paragraphs(t, views.styles(members)).orderBy("paragraph").collect()
    assert [(r.text, r.heading_level) for r in p] == [("Title & more", 2), ("beforeafter", None), ("x\ty", None), ("", None), ("nobody", None)]
    # Spans end at the next paragraph end: the outer ones of headers, the table and the note are cut short.
    assert [r.flat_para_idx for r in p] == [0, 2, 6, 8, 9]
    cells = views.table_cells(t).orderBy("cell_idx").collect()
    assert [(c.row, c.col, c.text) for c in cells] == [(0, 0, "A1"), (0, 1, "B|1"), (1, 0, "A2"), (1, 1, "A2")]
    one = views.tables(t).collect()
    assert [(x.n_rows, x.n_cols, x.cells, x.paragraph, x.control) for x in one] == [(2, 2, [["A1", "B|1"], ["A2", "A2"]], 1, 0)]
    assert [(x.number, x.text) for x in views.footnotes(t).collect()] == [(3, "note one\nline two")]
    assert [(x.kind, x.label, x.apply_to, x.text) for x in views.headers_footers(t).collect()] == [("header", "BOTH", 0, "top")]
    assert [(x.paragraph, x.control, x.script, x.font_size, x.font_name) for x in views.equations(t).collect()] == [(3, 0, "a over b", 1100.0, "HYhwpEQ")]
    assert [(x.paragraph, x.control, x.mime, x.ext, x.byte_length) for x in views.images(t, members).collect()] == [(3, 1, "image/png", "png", 1200)]
    assert [(x.name, x.type, x.value) for x in views.fields(t).collect()] == [("who", "CLICK_HERE", "nobody")]
    assert '"width":"59528"' in _of(views.pages(t), "page")[0]
    flow = views.flow(t, members).orderBy("paragraph", "sub").collect()
    assert [x.kind for x in flow if x.doc.endswith("/a.hwpx")] == ["para", "para", "table", "para", "para", "equation", "image", "para"]


def test_reports(t, members, spark):
    names, docs = views.styles(members), members.select("doc").distinct()
    dump = R.full_text(docs, views.paragraphs(t, names), views.headers_footers(t), views.footnotes(t), views.equations(t)).cache()
    want = "--- headers ---\n[section 0 BOTH] top\n\nTitle & more\nbeforeafter\nx\ty\n\nnobody\n\n--- footnotes ---\n[3] note one\nline two\n\n--- equations ---\n[eq 0/3/0] a over b"
    assert _of(dump, "text") == [want]
    assert _of(R.text(docs, dump), "text", "empty") == [R.NO_TEXT]
    grids = views.tables(t)
    from docweave.operators.tables import markdown

    tables = grids.withColumn("markdown", markdown(F.col("cells")))
    table = "| A1 | B\\|1 |\n| --- | --- |\n| A2 | A2 |"
    assert _of(R.tables_text(docs, tables), "text") == [f"### 표 1 (2행 x 2열)\n{table}\n"] and _of(R.tables_text(docs, tables), "text", "empty") == [R.NO_TABLES]
    images = views.images(t, members)
    assert _of(R.images_text(docs, images), "text") == ["1. [section 0, para 3, ctrl 1] image/png (1200 bytes, .png)"]
    both = _of(R.combined(dump, tables, images), "text")[0]
    assert both == f"# a.hwpx\n형식: .HWPX | 문단: 15개 | 표: 1개 | 이미지: 1개\n\n{want}\n\n### 표 1 (2행 x 2열)\n{table}\n\n---\n## 포함된 이미지\n1. [section 0, para 3, ctrl 1] image/png (1200 bytes)"
    flow, notes = views.flow(t, members), views.footnotes(t)
    body = f"## Title & more\n\nbeforeafter\n\n{table}\n\nx\ty\n\n$a over b$\n\n{{}}\n\nnobody\n\n---\n\n[^3]: note one\nline two"
    assert _of(R.markdown(docs, flow, notes), "markdown") == [body.format("[image: png, 1.2KB]")] and _of(R.markdown(docs, flow, notes), "markdown", "empty") == [R.NO_MARKDOWN]
    assert _of(R.markdown(docs, flow, notes, "pics"), "markdown") == [body.format("![img_001](pics/img_001.png)")]
    assert _of(R.fields_text(docs, views.fields(t)), "text") == ["1. who [CLICK_HERE] = nobody"] and _of(R.field_value(views.fields(t), "who"), "value") == ["nobody"]
    assert _of(R.entries_text(docs, members), "text") == ["1. BinData/image1.png"]
    assert _of(R.page_lines(docs, views.pages(t)), "text")[0].startswith("# section 0\npageDef: {")
    counts = views.counted(t, members)
    info = _of(R.info(docs, t, counts, views.fonts(members), views.versions(members)), "text")[0]
    assert "섹션 (sections): 1" in info and "글꼴 (fonts): Batang, Dotum" in info and "표 (tables): 1" in info and "머리말 (headers): 1" in info and "꼬리말 (footers): 0" in info and "version): ?" in info


def test_preview_and_limit(spark):
    rows = spark.createDataFrame([("d", i, f"p{i}") for i in range(1, 13)], "doc string, n int, name string")
    assert R.preview(rows, "name").first().text.splitlines()[-2:] == ["  - p10", "  ... and 2 more"]
    assert R.first_rows(rows.drop("n"), -1, "name").count() == 0 and R.first_rows(rows.drop("n"), 3, "name").count() == 3


def test_files(t, members, tmp_path):
    docs, flow, notes = members.select("doc").distinct(), views.flow(t, members), views.footnotes(t)
    sinks.write_files(sinks.markdown_files(docs, flow, notes, members), str(tmp_path))
    sinks.write_files(sinks.image_files(views.images(t, members), members), str(tmp_path))
    made = {str(f.relative_to(tmp_path)) for f in tmp_path.rglob("*") if f.is_file()}
    assert {"a_images/img_001.png", "a_images/image_001.png"} <= made and len(made) == 4
    text = next(f for f in tmp_path.rglob("a.md")).read_text()
    assert "![img_001](a_images/img_001.png)" in text and (tmp_path / "a_images/img_001.png").read_bytes() == b"png!" * 300


def _after(members, edits, doc="a"):
    """(code, n, section XML written back and zipped, header XML)"""
    rows = [r for r in edits.collect() if r.doc.endswith(f"/{doc}.hwpx")]
    body = next(r for r in rows if "section" in r.entry)
    content = next(r.content for r in package.packages(P.applied(members, edits)).collect() if r.doc.endswith(f"/{doc}.hwpx"))
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        assert z.infolist()[0].filename == "mimetype" and z.infolist()[0].compress_type == zipfile.ZIP_STORED
        return body.code, body.n, z.read("Contents/section0.xml").decode(), z.read("Contents/header.xml").decode()


def _cells(xml, spark):
    t = markup.tokens(spark.createDataFrame([("d", "e", 0, xml)], "doc string, entry string, section int, xml string"))
    return [(c.row, c.col, c.row_span, c.col_span, c.text) for c in views.table_cells(t).filter("table = 0").orderBy("cell_idx").collect()]


def test_paragraph_edits(members):
    code, n, xml, _ = _after(members, P.append_paragraph(members, "new <1>"))
    assert code == "ok" and xml.endswith("<hp:t>new &lt;1&gt;</hp:t></hp:run></hp:p></hs:sec>") and xml.startswith(SECTION[: -len("</hs:sec>")])
    assert _after(members, P.append_paragraph(members, "x"), "empty")[0] == "target_missing"
    code, n, xml, _ = _after(members, P.delete_paragraph(members, 9))
    assert (code, n) == ("ok", 10) and "nobody" not in xml and xml.count("<hp:p ") == SECTION.count("<hp:p ") - 1
    assert _after(members, P.delete_paragraph(members, 10))[0] == "index_range" and _after(members, P.delete_paragraph(members, 2))[:3:2] == ("nested_target", SECTION)
    code, _, xml, _ = _after(members, P.set_paragraph_text(members, 7, "$1 & two"))
    assert code == "ok" and xml == SECTION.replace(_p(7, _r("line two")), _p(7, _r("$1 &amp; two")))


def test_table_edits(members, spark):
    base = [(0, 0, 1, 1, "A1"), (0, 1, 1, 1, "B|1"), (1, 0, 1, 1, "A2"), (1, 1, 1, 1, "A2")]
    code, n, xml, _ = _after(members, P.append_row(members, 0, ["one"]))
    assert (code, n) == ("ok", 2) and _cells(xml, spark) == base + [(2, 0, 1, 1, "one"), (2, 1, 1, 1, "")] and 'rowCnt="3"' in xml
    code, n, xml, _ = _after(members, P.delete_row(members, 0, 0))
    assert (code, n) == ("ok", 1) and _cells(xml, spark) == [(0, 0, 1, 1, "A2"), (0, 1, 1, 1, "A2")] and 'rowCnt="1"' in xml
    assert _after(members, P.delete_row(members, 0, 2))[:3:2] == ("index_range", SECTION)
    code, n, xml, _ = _after(members, P.append_column(members, 0, ["C1", "C2"]))
    assert (code, n) == ("ok", 2) and [c for c in _cells(xml, spark) if c[1] == 2] == [(0, 2, 1, 1, "C1"), (1, 2, 1, 1, "C2")] and 'colCnt="3"' in xml
    code, n, xml, _ = _after(members, P.delete_column(members, 0, 0))
    assert (code, n) == ("ok", 2) and _cells(xml, spark) == [(0, 0, 1, 1, "B|1"), (1, 0, 1, 1, "A2")]
    assert _after(members, P.delete_column(members, 0, 9))[0] == "index_range"
    code, _, xml, _ = _after(members, P.set_cell_text(members, 0, 1, 1, "<b>"))  # of two equal cells the second
    assert code == "ok" and _cells(xml, spark) == base[:3] + [(1, 1, 1, 1, "<b>")]
    assert _after(members, P.set_cell_text(members, 1, 0, 0, "x"))[0] == "index_range"
    code, _, xml, _ = _after(members, P.merge_horizontal(members, 0, 1, 0, 2))
    assert code == "ok" and _cells(xml, spark) == base[:2] + [(1, 0, 1, 2, "A2")]
    assert _after(members, P.merge_horizontal(members, 0, 1, 1, 2))[0] == "bad_span" and _after(members, P.merge_vertical(members, 0, 0, 1, 2))[0] == "bad_span"
    code, _, xml, _ = _after(members, P.merge_vertical(members, 0, 1, 0, 2))
    assert code == "ok" and _cells(xml, spark) == [base[0], (0, 1, 2, 1, "B|1"), base[2]]
    code, n, xml, _ = _after(members, P.insert_table(members, ["h", "i&j"], [["1", "2"], ["3"]]))
    t = views.tables(markup.tokens(spark.createDataFrame([("d", "e", 0, xml)], "doc string, entry string, section int, xml string")))
    assert (code, n) == ("ok", 3) and {x.table: x.cells for x in t.collect()}[1] == [["h", "i&j"], ["1", "2"], ["3", ""]]


def test_merge_vertical_goes_by_the_grid(spark):
    """Row 0 has one cell over columns 0 and 1: the cell under column 2 goes, not the one that stands second."""
    wide = _tc(0, 0, "wide").replace('colSpan="1"', 'colSpan="2"')
    xml = f'<hs:sec>{_p(1, "<hp:run><hp:tbl>" + "<hp:tr>" + wide + _tc(0, 2, "c") + "</hp:tr><hp:tr>" + _tc(1, 0, "x") + _tc(1, 1, "y") + _tc(1, 2, "z") + "</hp:tr></hp:tbl></hp:run>")}</hs:sec>'
    members = spark.createDataFrame([("d", 0, "Contents/section0.xml", 8, bytearray(xml.encode()))], package.ENTRIES)
    got = P.merge_vertical(members, 0, 1, 0, 2).first()
    assert got.code == "ok" and [c[4] for c in _cells(got.xml, spark)] == ["wide", "c", "x", "y"]


def test_fill_and_fields(members):
    pairs = [("A2", "$1<v>"), ("zz", "1"), ("Title & more", "T"), ("1<v>", "cascade")]
    edits = P.fill(members, pairs)
    row = next(r for r in edits.collect() if r.doc.endswith("/a.hwpx") and "section" in r.entry)
    assert (row.n, row.hits) == (5, [2, 0, 1, 2]) and row.xml == SECTION.replace("<hp:t>A2<", "<hp:t>$cascade<").replace("Title &amp; more", "T")
    assert _of(P.fill_report(edits, pairs), "report") == ["총 5건 치환 (5 replacements)\n\n  'A2' → 2건\n  'Title & more' → 1건\n  '1<v>' → 2건\n  'zz' → 0건"]
    code, n, xml, _ = _after(members, P.set_field(members, "who", "me & $2"))
    assert (code, n) == ("ok", 1) and xml == SECTION.replace("nobody", "me &amp; $2")
    assert _after(members, P.set_field(members, "ho", "x"))[:3:2] == ("target_missing", SECTION)


def test_styles_and_images(members):
    code, _, xml, head = _after(members, P.apply_text_style(members, "x", color="FF0000", bold=True, font_size=1300, underline=True))
    assert code == "ok" and xml == SECTION.replace('<hp:run charPrIDRef="2"><hp:t>x', '<hp:run charPrIDRef="5"><hp:t>x')
    assert '</hh:charPr><hh:charPr bold="1" id="5" height="1300"><hc:color val="#FF0000"/></hh:charPr><hh:charPr id="4"' in head
    assert _after(members, P.apply_text_style(members, "not there", italic=True))[::3] == ("target_missing", HEAD)
    code, _, xml, head = _after(members, P.apply_paragraph_style(members, 9, align="CENTER", indent=20, line_spacing=160))
    assert code == "ok" and '<hp:p id="9" paraPrIDRef="8"' in xml and '<hh:paraPr id="8" align="CENTER" indent="20"/><hh:paraPr id="7"' in head
    assert _after(members, P.apply_paragraph_style(members, 99, align="LEFT"))[0] == "index_range"
    out = {r.entry: bytes(r.bytes) for r in P.insert_image(members, F.lit(b"new"), "png").collect() if r.doc.endswith("/a.hwpx")}
    assert out["BinData/image2.png"] == b"new" and b'id="image2" href="BinData/image2.png" media-type="image/png"' in out["Contents/content.hpf"]
    assert b'binaryItemIDRef="image2"' in out["Contents/section0.xml"] and out["Contents/section0.xml"].endswith(b"</hp:pic></hp:run></hp:p></hs:sec>")
    with pytest.raises(ValueError):
        P.insert_image(members, F.lit(b"x"), "tiff")


def test_create_is_a_whole_package(spark):
    items = spark.createDataFrame([("d", 0, "text", "a <b>\nc", None, None), ("d", 1, "table", None, ["h", "i"], [["1", "2"]])], "doc string, pos int, type string, text string, headers array<string>, rows array<array<string>>")
    made = package.create(items)
    assert {"mimetype", "Contents/section0.xml", "Contents/header.xml", "Contents/content.hpf", "META-INF/container.xml", "version.xml"} <= {r.entry for r in made.collect()}
    code = P.append_paragraph(made, "more").first()
    assert code.code == "ok"
    again = views.paragraphs(views.body_tokens(P.applied(made, P.append_paragraph(made, "more")))).orderBy("paragraph")
    assert [r.text for r in again.collect()] == ["a <b>", "c", "h | i", "--- | ---", "1 | 2", "more"]
    assert views.versions(made).first().version == "1.4"
