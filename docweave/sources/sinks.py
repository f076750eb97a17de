"""Files made of documents, as rows (doc, path, content), and their writing by tasks."""

from __future__ import annotations

import os
import re
import urllib.parse
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.operators.report import markdown, numbered


def base_path(doc: Column) -> Column:
    """The path without its suffix."""
    return F.regexp_replace(doc, r"\.[^./]*$", "")


def image_files(images: DataFrame, members: DataFrame, folder: str = "_images", name: str = "image_%03d.%s") -> DataFrame:
    """Each document's pictures in order, as <path without suffix><folder>/image_001.ext."""
    order = ["section", *(c for c in ("paragraph", "control", "sub") if c in images.columns)]
    path = F.concat(base_path(F.col("doc")), F.lit(folder + "/"), F.format_string(name, "n", "ext"))
    return numbered(images, *order).join(members.select("doc", "entry", F.col("bytes").alias("content")), ["doc", "entry"]).select("doc", path.alias("path"), "content")


def markdown_files(docs: DataFrame, flow: DataFrame, footnotes: DataFrame, members: DataFrame) -> DataFrame:
    """<path without suffix>.md of each document, and its pictures as <path without suffix>_images/img_001.ext,
    which the Markdown links to."""
    stem = F.regexp_extract(base_path(F.col("doc")), r"([^/]*)$", 1)
    text = markdown(docs, flow, footnotes, folder="{images}").withColumn("markdown", F.replace("markdown", F.lit("({images}/"), F.concat(F.lit("("), stem, F.lit("_images/"))))
    md = text.select("doc", F.concat(base_path(F.col("doc")), F.lit(".md")).alias("path"), F.encode("markdown", "UTF-8").alias("content"))
    return md.unionByName(image_files(flow.filter("kind = 'image'"), members, name="img_%03d.%s"))


def common_folder(paths: DataFrame, column: str) -> str:
    """The folder that all paths of the column are below, from the smallest and the largest of them; ends in a slash."""
    low, high = paths.agg(F.min(column), F.max(column)).first()
    same = os.path.commonprefix([low or "", high or ""])
    return same[: same.rfind("/") + 1]


def opened(uri: str):
    """(pyarrow file system, path in it) of a path or URI whose path is written as it is, spaces and all letters included."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if uri.startswith("/") or not re.fullmatch("[A-Za-z][A-Za-z0-9+.-]*", scheme):
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, path = rest.removeprefix("//").partition("/")
    return fs.FileSystem.from_uri(f"{scheme}://{authority}/{urllib.parse.quote(path)}")


def write_files(files: DataFrame, folder: str | None = None, root: str | None = None) -> None:
    """Writes rows (path, content), with doc or without. folder: where files go, each by its path below `root`, which unless
    given is the folder that all docs (without doc: all paths) share; else at their own paths. A file appears whole or not at
    all, so a task may run again. Paths are local ones or URIs of stores that pyarrow reads, unescaped. Equal rows are one
    file; rows of one path with other contents end the job before anything is written (ValueError)."""
    if folder is not None:
        top = common_folder(files, "doc" if "doc" in files.columns else "path") if root is None else root.rstrip("/") + "/"
        below = F.when(F.col("path").startswith(top), F.substring(F.col("path"), F.lit(len(top) + 1), F.char_length("path")))
        files = files.withColumn("path", F.concat(F.lit(folder.rstrip("/") + "/"), F.coalesce(below, F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:/*|^/+", ""))))
    clash = files.select("path", F.sha2("content", 256).alias("sha")).groupBy("path").agg(F.min("sha").alias("a"), F.max("sha").alias("b")).filter("a <> b").select("path").limit(1).collect()
    if clash:
        raise ValueError(f"path_clash: several contents for {clash[0]['path']}")

    def write(rows: Iterator) -> None:
        for row in rows:
            store, path = opened(row.path)
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            part = f"{path}.{uuid.uuid4().hex}.part"
            with store.open_output_stream(part) as out:
                out.write(row.content)
            store.move(part, path)

    files.select("path", "content").foreachPartition(write)
