import io
import zipfile

from pyspark.sql import functions as F

from docweave.functions import text as T
from docweave.operators import edit, flow, tables
from docweave.sources import package

SECTION = """<?xml version="1.0"?><hs:sec><hp:p id="1" styleIDRef="0"><hp:run charPrIDRef="0"><hp:t>one &amp; two</hp:t></hp:run></hp:p>
<hp:tbl rowCnt="2" colCnt="2"><hp:tr><hp:tc><hp:t>A1</hp:t></hp:tc><hp:tc><hp:t>B1</hp:t></hp:tc></hp:tr><hp:tr><hp:tc><hp:t>A2</hp:t></hp:tc><hp:tc><hp:t>B2</hp:t></hp:tc></hp:tr></hp:tbl></hs:sec>"""


def _package() -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("mimetype", "application/hwp+zip", zipfile.ZIP_STORED)
        z.writestr("Contents/section0.xml", SECTION)
        z.writestr("BinData/image1.png", b"png!")
    return out.getvalue()


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_read_package_and_write_it_again(spark, tmp_path):
    (tmp_path / "a.hwpx").write_bytes(_package())
    (tmp_path / "b.HWPX").write_bytes(b"no package")
    (tmp_path / "c.hwp").write_bytes(b"old")
    members = package.entries(package.read_files(spark, str(tmp_path)))
    assert members.filter("entry is null").count() == 1
    parts = package.sections(members)
    assert [r.text for r in package.paragraphs(parts).collect()] == ["one & two"]
    assert package.tables(parts).first().cells == [["A1", "B1"], ["A2", "B2"]]
    assert [(r.ext, r.byte_length) for r in package.images(members).collect()] == [("png", 4)]
    assert package.skipped_files(spark, str(tmp_path)).first().reason == "unsupported format"
    content = package.packages(members).first().content
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        assert z.infolist()[0].filename == "mimetype" and z.infolist()[0].compress_type == zipfile.ZIP_STORED
        assert z.read("Contents/section0.xml").decode() == SECTION


def test_create_reads_back(spark):
    items = spark.createDataFrame(
        [("d", 0, "text", "a <b>\nc", None, None), ("d", 1, "table", None, ["h", "i"], [["1", "2"]]), ("d", 2, "other", "z", None, None)],
        "doc string, pos int, type string, text string, headers array<string>, rows array<array<string>>",
    )
    made = package.create(items)
    again = package.paragraphs(package.sections(made)).orderBy("flat_para_idx")
    assert [r.text for r in again.collect()] == ["a <b>", "c", "h | i", "--- | ---", "1 | 2"]


def test_markdown_golden(spark):
    t = _one(spark, tables.markdown(F.array(F.array(F.lit("a|b"), F.lit("x")), F.array(F.lit("1\n2"), F.lit("3")))))
    assert t == "| a\\|b | x |\n| --- | --- |\n| 1 2 | 3 |"
    assert _one(spark, tables.markdown(F.array().cast("array<array<string>>"))) == ""
    blocks = spark.createDataFrame(
        [(1, 0, "para", " Title ", 1, None, None, None), (1, 1, "para", " 　", None, None, None, None), (1, 2, "table", None, None, t, None, None), (1, 3, "equation", None, None, None, None, "x^2")],
        "doc int, ord int, kind string, text string, heading_level int, table_md string, image_ref string, script string",
    )
    notes = spark.createDataFrame([(1, 0, 1, "first"), (1, 1, 2, "second")], "doc int, ord int, number int, text string")
    got = flow.flow_markdown(blocks, notes).first().markdown
    assert got == f"# Title\n\n{t}\n\n$x^2$\n\n---\n\n[^1]: first\n[^2]: second"


def test_template_counts_and_last_occurrence(spark):
    nodes = spark.createDataFrame([("a-K-b-K-c",), ("none",), ("A & B",)], "text string").select(T.xml_escape(F.col("text")).alias("text"))
    pairs = [("K", "<v>"), ("A & B", "$&"), ("zz", "1")]
    got = [r.text for r in edit.fill_template(nodes, pairs).collect()]
    assert got == ["a-K-b-&lt;v&gt;-c", "none", "$&amp;"]
    assert {r.key: r.hits for r in edit.template_counts(nodes, pairs).collect()} == {"K": 1, "A & B": 1, "zz": 0}


def test_labels(spark):
    assert _one(spark, T.size_label(F.lit(1280))) == "1.3KB" and _one(spark, T.size_label(F.lit(1023))) == "1023B"
    assert _one(spark, T.heading_level(F.lit("개요 7"))) == 6 and _one(spark, T.heading_level(F.lit("Body"))) is None
    assert _one(spark, T.output_path(F.lit("/x.y/doc.hwpx"), "filled")) == "/x.y/doc_filled.hwpx"
