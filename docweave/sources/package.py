"""Zipped XML documents (.hwpx) as DataFrames, and back.

binaryFile rows become entries by a small stdlib step in each task; sources.views has the
views of paragraphs, tables, images, notes and fields.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docweave.functions.arguments import json_items
from docweave.functions.text import extension, xml_escape
from docweave.sources import views
from docweave.sources.markup import arrow_batches, tokens

ENTRIES = "doc string, seq int, entry string, method int, bytes binary"
#: The package's media type, stored uncompressed under this name.
MIMETYPE = ("mimetype", b"application/hwp+zip")
#: Name spaces of the format.
_NS = "http://www.hancom.co.kr/hwpml/2011/"
_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
#: Parts of a new document but its section: version, container, header with one style of each kind, manifest.
NEW_PARTS = (
    ("version.xml", f'{_XML}<hv:HCFVersion xmlns:hv="{_NS}version" targetApplication="WORDPROCESSOR" major="5" minor="1" micro="0" buildNumber="1" xmlVersion="1.4"/>'),
    ("META-INF/container.xml", f'{_XML}<ocf:container xmlns:ocf="urn:oasis:names:tc:opendocument:xmlns:container"><ocf:rootfiles><ocf:rootfile full-path="Contents/content.hpf" media-type="application/hwpml-package+xml"/></ocf:rootfiles></ocf:container>'),
    ("Contents/header.xml", f'{_XML}<hh:head xmlns:hh="{_NS}head" xmlns:hc="{_NS}core" version="1.4" secCnt="1"><hh:refList><hh:fontfaces itemCnt="1"><hh:fontface lang="HANGUL" fontCnt="1"><hh:font id="0" face="Batang" type="TTF" isEmbedded="0"/></hh:fontface></hh:fontfaces>'
     '<hh:charProperties itemCnt="1"><hh:charPr id="0" height="1000" textColor="#000000"><hh:fontRef hangul="0" latin="0"/></hh:charPr></hh:charProperties><hh:paraProperties itemCnt="1"><hh:paraPr id="0"><hh:align horizontal="JUSTIFY" vertical="BASELINE"/></hh:paraPr></hh:paraProperties>'
     '<hh:styles itemCnt="1"><hh:style id="0" type="PARA" name="Normal" paraPrIDRef="0" charPrIDRef="0" nextStyleIDRef="0"/></hh:styles></hh:refList></hh:head>'),
    ("Contents/content.hpf", f'{_XML}<opf:package xmlns:opf="http://www.idpf.org/2007/opf/"><opf:manifest><opf:item id="header" href="Contents/header.xml" media-type="application/xml"/><opf:item id="section0" href="Contents/section0.xml" media-type="application/xml"/></opf:manifest><opf:spine><opf:itemref idref="header"/><opf:itemref idref="section0"/></opf:spine></opf:package>'),
)


def read_files(spark: SparkSession, path: str, most_bytes: int = 1 << 28) -> DataFrame:
    """binaryFile rows of .hwpx files up to most_bytes; larger ones are left to the caller
    through skipped_files()."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.[hH][wW][pP][xX]").load(path).filter(F.col("length") <= most_bytes)


def skipped_files(spark: SparkSession, path: str, most_bytes: int = 1 << 28) -> DataFrame:
    """(path, length, reason) of files that read_files() leaves out: other formats, too long."""
    rows = spark.read.format("binaryFile").load(path).select("path", "length")
    packed = F.lower("path").endswith(".hwpx")
    reason = F.when(~packed, "unsupported format").when(F.col("length") > most_bytes, "too long")
    return rows.withColumn("reason", reason).filter("reason is not null")


def entries(files: DataFrame) -> DataFrame:
    """The members of each package in archive order. A file that is not a package gives one
    row with a null entry."""

    kind = StructType.fromDDL(ENTRIES)
    arrow = to_arrow_schema(kind)

    def rows(path: str, content: bytes) -> Iterator[tuple]:
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                yield from [(path, i, m.filename, m.compress_type, z.read(m)) for i, m in enumerate(z.infolist())]
        except zipfile.BadZipFile:
            yield path, 0, None, None, None

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = (r for path, content in zip(batch["path"], batch["content"], strict=True) for r in rows(path.as_py(), content.as_py()))
            yield from arrow_batches(every, arrow, lambda r: len(r[4] or b""))

    return files.select("path", "content").mapInArrow(unzip, kind)


def sections(members: DataFrame) -> DataFrame:
    """(doc, section, seq, entry, xml) of body sections; section is the number in the name."""
    number = F.regexp_extract("entry", r"(?i)^Contents/section(\d+)\.xml$", 1)
    return members.filter(number != "").select("doc", number.cast("int").alias("section"), "seq", "entry", F.decode("bytes", "UTF-8").alias("xml"))


def paragraphs(parts: DataFrame) -> DataFrame:
    """Top-level paragraphs of parts, as views.paragraphs() gives them."""
    return views.paragraphs(tokens(parts))


def tables(parts: DataFrame) -> DataFrame:
    """Dense grids of parts' outermost tables, as views.tables() gives them."""
    return views.tables(tokens(parts))


def images(members: DataFrame) -> DataFrame:
    """(doc, seq, entry, mime, ext, byte_length, bytes) of binary members; bytes prune if not asked for."""
    mime = views.media_type(F.col("entry"))
    return members.filter(F.col("entry").startswith("BinData/")).select("doc", "seq", "entry", mime.alias("mime"), extension(mime).alias("ext"), F.octet_length("bytes").cast("long").alias("byte_length"), "bytes")


def packages(members: DataFrame) -> DataFrame:
    """(doc, content): each document's entries zipped again, mimetype stored and first.
    One document's entries meet in one task, as they do in its file."""

    kind = StructType.fromDDL("doc string, content binary")
    arrow = to_arrow_schema(kind)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """A file for each document, whose members follow each other."""
        rows = (r for b in batches for r in zip(*(b[c] for c in ("doc", "entry", "bytes")), strict=True))
        for doc, members in groupby(rows, key=lambda r: r[0].as_py()):
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=6) as z:
                for _, entry, content in members:
                    name = entry.as_py()
                    z.writestr(zipfile.ZipInfo(name), content.as_py(), zipfile.ZIP_STORED if name == MIMETYPE[0] else zipfile.ZIP_DEFLATED)
            yield doc, out.getvalue()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return arrow_batches(packed(batches), arrow, lambda r: len(r[1]))

    rows = members.filter("entry is not null").repartition("doc").sortWithinPartitions("doc", "seq")
    return rows.select("doc", "entry", "bytes").mapInArrow(pack, kind)


def create(items: DataFrame) -> DataFrame:
    """Entries of new documents from content items (doc, pos, type, text, headers, rows):
    text paragraphs, tables as lines of cells; items of other types are left out."""
    row = lambda r: F.array_join(r, " | ")
    table = F.concat(F.array(row(F.col("headers")), F.array_join(F.transform("headers", lambda _: F.lit("---")), " | ")), F.transform("rows", row))
    lines = F.when(F.col("type") == "text", F.split("text", "\n")).when(F.col("type") == "table", table)
    para = F.transform(lines, lambda s: F.concat(F.lit('<hp:p id="0" paraPrIDRef="0" styleIDRef="0"><hp:run charPrIDRef="0"><hp:t>'), xml_escape(s), F.lit("</hp:t></hp:run></hp:p>")))
    body = items.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("pos", F.array_join(para, "").alias("x")))).alias("ps"))
    xml = F.concat(F.lit(f'{_XML}<hs:sec xmlns:hs="{_NS}section" xmlns:hp="{_NS}paragraph" xmlns:hc="{_NS}core">'), F.array_join(F.transform("ps", lambda p: p["x"]), ""), F.lit("</hs:sec>"))
    part = lambda seq, entry, method, content: F.struct(F.lit(seq).alias("seq"), F.lit(entry).alias("entry"), F.lit(method).alias("method"), content.alias("bytes"))
    parts = [*((entry, F.lit(xml.encode())) for entry, xml in NEW_PARTS), ("Contents/section0.xml", F.encode(xml, "UTF-8"))]
    rows = F.array(part(0, MIMETYPE[0], 0, F.lit(MIMETYPE[1])), *(part(i, entry, 8, content) for i, (entry, content) in enumerate(parts, 1)))
    return body.select("doc", F.inline(rows))


def create_each(arguments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, outcome): members of new documents, and (doc, code) of each row of arguments (doc, content), content being a
    JSON array of items of create(): ok, bad_json or bad_item. Without an item a document has no paragraph."""
    told = arguments.select("doc", json_items("content").alias("j")).select("doc", F.col("j.code").alias("code"), F.col("j.items").alias("items"))
    ok = told.filter("code = 'ok'")
    items = ok.select("doc", F.explode_outer("items").alias("x")).select("doc", F.coalesce("x.pos", F.lit(0)).alias("pos"), F.coalesce("x.type", F.lit("none")).alias("type"), "x.text", "x.headers", "x.rows")
    return create(items), told.select("doc", "code")


def write_packages(contents: DataFrame, folder: str) -> None:
    """Contents as Parquet rows (doc, content) in the folder: on a cluster files belong in a
    store that Spark writes; `doc` names them."""
    contents.write.mode("overwrite").parquet(folder)
