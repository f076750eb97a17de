"""The package data source: pruned members, outcomes of opening, writing with a commit; and the file sinks."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from docweave.functions.text import xml_unescape
from docweave.operators import package_edit as P
from docweave.operators import report as R
from docweave.sources import datasource, package, sinks, views
from tests.test_packages import SECTION, _p, _r, _zip


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("in")
    (top / "한 글").mkdir()
    (top / "한 글/문서 1%20.hwpx").write_bytes(_zip())
    broken = bytearray(_zip())
    at = broken.index(b"png!")
    broken[at : at + 4] = b"????"  # a member that nobody asked for no longer meets its checksum
    (top / "b.HWPX").write_bytes(broken)
    (top / "c.hwp").write_bytes(b"\xd0\xcf\x11\xe0 old")
    (top / "d.hwpx").write_bytes(b"no archive")
    (top / "e.hwpx").write_bytes(_zip(**{"META-INF/manifest.xml": '<m><odf:file-entry><odf:encryption-data/></odf:file-entry></m>'}))
    (top / "f.txt").write_bytes(b"x")
    (top / "g.hwpx").write_bytes(b"\xd0\xcf\x11\xe0 old by another name")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("other.xml", "<a/>")
    (top / "h.hwpx").write_bytes(out.getvalue())
    (top / "_hidden.hwpx").write_bytes(b"")
    return top


def test_outcomes(spark, folder):
    got = {r.doc.rsplit("/", 1)[1]: r.code for r in datasource.outcomes(spark, str(folder)).collect()}
    assert got == {"문서 1%20.hwpx": "ok", "b.HWPX": "ok", "c.hwp": "format_unsupported", "d.hwpx": "bad_package", "e.hwpx": "encrypted", "f.txt": "bad_extension", "g.hwpx": "format_unsupported", "h.hwpx": "bad_package"}
    assert [(r.code, r.length) for r in datasource.outcomes(spark, str(folder / "none.hwpx")).collect()] == [("not_found", None)]


def test_members_are_pruned(spark, folder):
    got = datasource.read_members(spark, str(folder), r"Contents/section\d+\.xml").collect()
    found = {r.doc.rsplit("/", 1)[1]: r for r in got}
    assert {k for k, r in found.items() if r.entry} == {"문서 1%20.hwpx", "b.HWPX"} and {k for k, r in found.items() if r.entry is None} == {"d.hwpx", "e.hwpx", "g.hwpx"}  # h.hwpx has no such member
    assert all(bytes(found[k].bytes).decode() == SECTION for k in ("문서 1%20.hwpx", "b.HWPX"))
    every = datasource.read_members(spark, f"file://{folder}/한 글")
    assert every.orderBy("seq").collect() == [r for r in package.entries(spark.createDataFrame([(every.first().doc, bytearray(_zip()))], "path string, content binary")).orderBy("seq").collect()]
    assert [x.text for x in views.paragraphs(views.body_tokens(every)).orderBy("paragraph").collect()][0] == "Title & more"


def test_written_whole_or_not_at_all(spark, folder, tmp_path):
    members = datasource.read_members(spark, str(folder / "한 글"))
    packed = package.packages(members)
    datasource.write_packages(packed, str(tmp_path / "out"), str(folder))
    again = datasource.read_members(spark, str(tmp_path / "out"))
    assert [p.relative_to(tmp_path / "out").as_posix() for p in (tmp_path / "out").rglob("*") if p.is_file()] == ["한 글/문서 1%20.hwpx"]
    assert sorted((r.entry, bytes(r.bytes)) for r in again.collect()) == sorted((r.entry, bytes(r.bytes)) for r in members.collect())
    fails = spark.range(4).select(F.format_string("/x/%d.hwpx", "id").alias("doc"), F.when(F.col("id") < 3, F.lit(b"x")).otherwise(F.raise_error(F.lit("no"))).alias("content")).repartition(4)
    with pytest.raises(Exception, match="no"):
        datasource.write_packages(fails, str(tmp_path / "failed"))
    with pytest.raises(Exception, match="path_clash"):
        datasource.write_packages(packed.unionByName(packed), str(tmp_path / "failed"))
    assert not [p for p in (tmp_path / "failed").rglob("*") if p.is_file()]


def test_file_sink_keeps_folders_and_ends_on_clashes(spark, tmp_path):
    rows = [("/in/p/a/문서 1.hwpx", b"1"), ("/in/q/a/문서 1.hwpx", b"2"), ("/in/q/b.md", b"3"), ("/in/q/b.md", b"3")]
    files = spark.createDataFrame([(p, bytearray(c)) for p, c in rows], "path string, content binary")
    sinks.write_files(files, str(tmp_path / "o"))
    assert {p.relative_to(tmp_path / "o").as_posix(): p.read_bytes() for p in (tmp_path / "o").rglob("*") if p.is_file()} == {"p/a/문서 1.hwpx": b"1", "q/a/문서 1.hwpx": b"2", "q/b.md": b"3"}
    own = files.filter("path like '%b.md'").withColumn("path", F.lit(f"file:{tmp_path}/한 글/x y.md"))
    sinks.write_files(own)
    assert (tmp_path / "한 글/x y.md").read_bytes() == b"3"
    with pytest.raises(ValueError, match="path_clash"):
        sinks.write_files(files.withColumn("path", F.lit(f"{tmp_path}/z/same")))
    assert not (tmp_path / "z").exists()


def test_text_of_character_data_and_references(spark):
    raw = spark.createDataFrame([("&#44032;&#x41; &amp;#65; &lt;&bad; &#xD800; &#0; &#1114112; & &amp;lt;",), ("plain &amp;lt;",), (None,)], "s string")
    assert [r.x for r in raw.select(xml_unescape(F.col("s")).alias("x")).collect()] == ["가A &#65; <&bad; &#xD800; &#0; &#1114112; & &lt;", "plain &lt;", None]


def _members(spark, body, **more):
    parts = {"Contents/section0.xml": f"<hs:sec>{body}</hs:sec>", **more}
    return spark.createDataFrame([("d", i, e, 8, bytearray(x.encode())) for i, (e, x) in enumerate(parts.items())], package.ENTRIES)


def test_nested_fields(spark):
    b, e = (lambda n: f'<hp:ctrl><hp:fieldBegin name="{n}"/></hp:ctrl>'), "<hp:ctrl><hp:fieldEnd/></hp:ctrl>"
    t = lambda x: f"<hp:t>{x}</hp:t>"
    body = _p(1, "<hp:run>" + e + b("outer") + t("A") + b("inner") + t("<![CDATA[B<]]>") + e + t("C&#44032;") + e + e + b("next") + t("D") + e + b("open") + t("E") + b("late") + t("F") + "</hp:run>")
    m = _members(spark, body)
    assert [(f.ord, f.name, f.value) for f in views.fields(views.body_tokens(m)).orderBy("ord").collect()] == [(1, "outer", "AB<C가"), (2, "inner", "B<"), (3, "next", "D"), (4, "open", "E"), (5, "late", "F")]
    got = P.set_field(m, "outer", "new").first()
    assert (got.code, got.n) == ("ok", 2) and got.xml == f"<hs:sec>{body}</hs:sec>".replace(t("A"), t("new")).replace(t("C&#44032;"), t(""))
    inner = P.set_field(m, "inner", "<x>").first()
    assert (inner.code, inner.n) == ("ok", 1) and inner.xml == f"<hs:sec>{body}</hs:sec>".replace(t("<![CDATA[B<]]>"), t("&lt;x&gt;"))
    assert P.set_field(m, "open", "x").first().code == "target_missing"  # it has no end


def test_images_and_ids_do_not_clash(spark):
    hpf = '<opf:package><opf:manifest><opf:item id="image2" href="Contents/x.xml"/></opf:manifest></opf:package>'
    body = _p(7, _r("Name: {item} and {{item}}"))
    m = _members(spark, body, **{"Contents/content.hpf": hpf, "BinData/IMG1.jpg": "x", "BinData/image4.png": "y"})
    m = P.insert_image(P.insert_image(m, F.lit(b"p"), "png"), F.lit(b"q"), "jpg").cache()
    parts = {r.entry: bytes(r.bytes) for r in m.collect()}
    assert {"BinData/image3.png", "BinData/image5.jpg"} <= set(parts) and b"Name: {item} and {{item}}" in parts["Contents/section0.xml"]
    assert sorted((i.entry, i.byte_length) for i in views.images(views.body_tokens(m), m).collect()) == [("BinData/image3.png", 1), ("BinData/image5.jpg", 1)]
    once = P.applied(m, P.append_paragraph(m, "one"))
    twice = P.append_paragraph(once, "two").first().xml
    ids = [x for x in __import__("re").findall(r'\sid="(\d+)"', twice)]
    assert len(ids) == len(set(ids)) == 7
    with pytest.raises(ValueError):
        P.apply_text_style(m, "x", color='"/>')
    with pytest.raises(ValueError):
        P.apply_paragraph_style(m, 0, align="$1")


def test_info_says_what_is_encrypted(spark, folder):
    found = datasource.outcomes(spark, str(folder)).filter("code in ('ok', 'encrypted')").cache()
    none = spark.createDataFrame([], "doc string, section int, kind string, n int, font string, version string")
    text = {r.doc.rsplit("/", 1)[1]: r.text for r in R.info(found, none, none, none, none, encrypted=found).collect()}
    assert "(encrypted): true" in text["e.hwpx"] and "(encrypted): false" in text["b.HWPX"]
    assert all("(encrypted): ?" in r.text for r in R.info(found, none, none, none, none).collect())
