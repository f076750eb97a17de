"""Packages as a Spark data source: members read by the archive's directory, whole packages written with a commit.

    spark.dataSource.register(PackageSource)
    spark.read.format("docweave_package").option("members", r"Contents/.*").load("/data/in")
    spark.read.format("docweave_package").option("rows", "outcomes").load("/data/in")
    packages.write.format("docweave_package").mode("append").save("/data/out")

A task opens a file, reads its directory and then only the members asked for, so no package is in memory whole and
there is no limit of its size; one member is a row. Files are dealt to tasks by size.
"""

from __future__ import annotations

import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from docweave.sources.sinks import opened

MEMBERS = "doc string, seq int, entry string, method int, bytes binary"
OUTCOMES = "doc string, length long, code string, message string"
#: A task gets files of about so many bytes.
TASK_BYTES = 1 << 26
#: How files of the format begin, and the part that says which members are encrypted.
ZIP_START, BINARY_START, MANIFEST = b"PK\x03\x04", b"\xd0\xcf\x11\xe0", "META-INF/manifest.xml"


@dataclass
class Files(InputPartition):
    paths: list[str]


def listed(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the file, or of all files below the folder, with the scheme that path has; names that start with
    a dot or an underscore are left out. A path that is not there has size -1."""
    from pyarrow import fs

    store, at = opened(path)
    head = path[: len(path) - len(at)] if path.endswith(at) else re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:/*[^/]*)?", path)[0] if ":" in path else ""
    info = store.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        return [(path, -1)]
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(at, recursive=True))
    base = len(at.rstrip("/")) + 1
    return [(head + f.path, f.size) for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.File and (f is info or not re.search(r"(^|/)[._]", f.path[base:]))]


def dealt(files: list[tuple[str, int]]) -> list[Files]:
    """Files by tasks of about TASK_BYTES, in order."""
    out, size = [Files([])], 0
    for path, n in files:
        if out[-1].paths and size + n > TASK_BYTES:
            out.append(Files([]))
            size = 0
        out[-1].paths.append(path)
        size += max(n, 0) + 4096
    return out


def _locked(z: zipfile.ZipFile) -> bool:
    return any(m.flag_bits & 1 for m in z.infolist()) or MANIFEST in z.namelist() and b"encryption-data" in z.read(MANIFEST)


def outcome(path: str) -> tuple[str, int | None, str, str]:
    """(path, bytes, code, message) of opening a file: not_found, bad_extension, format_unsupported (the binary format),
    bad_package (no archive, or one without a section), encrypted, internal, ok. Only the directory and the manifest are read."""
    low, size = path.lower(), None
    try:
        store, at = opened(path)
        info = store.get_file_info(at)
        if info.type.name == "NotFound":
            return path, None, "not_found", f"File not found: {path}"
        size = info.size
        if not low.endswith((".hwp", ".hwpx")):
            return path, size, "bad_extension", "expected .hwp or .hwpx"
        with store.open_input_file(at) as f:
            start = f.read(4)
            if low.endswith(".hwp") or start == BINARY_START:
                return path, size, "format_unsupported", "the binary format needs an engine of its own"
            if start != ZIP_START:
                return path, size, "bad_package", "not an archive"
            f.seek(0)
            with zipfile.ZipFile(f) as z:
                if _locked(z):
                    return path, size, "encrypted", "members are encrypted"
                if not any(re.fullmatch(r"(?i)Contents/section\d+\.xml", n) for n in z.namelist()):
                    return path, size, "bad_package", "no section"
        return path, size, "ok", ""
    except zipfile.BadZipFile as e:
        return path, size, "bad_package", str(e)
    except Exception as e:  # one file never ends a job: what it was is told
        return path, size, "internal", f"{type(e).__name__}: {e}"


class PackageReader(DataSourceReader):
    def __init__(self, path: str, rows: str, members: str):
        self.path, self.rows, self.members = path, rows, members

    def partitions(self) -> list[Files]:
        files = [f for f in listed(self.path) if self.rows == "outcomes" or f[0].lower().endswith(".hwpx")]
        return dealt(files)

    def read(self, partition: Files) -> Iterator[tuple]:
        for path in partition.paths:
            if self.rows == "outcomes":
                yield outcome(path)
            else:
                yield from self.of(path)

    def of(self, path: str) -> Iterator[tuple]:
        """The members asked for. A file that is no archive, or encrypted, has one row with a null entry; a store that does not
        answer ends the task, which Spark then runs again."""
        store, at = opened(path)
        if store.get_file_info(at).size < 22:  # an archive has 22 bytes at least
            yield path, 0, None, None, None
            return
        try:
            with store.open_input_file(at) as f, zipfile.ZipFile(f) as z:
                if _locked(z):
                    yield path, 0, None, None, None
                    return
                for i, m in enumerate(z.infolist()):
                    if re.fullmatch(self.members, m.filename):
                        yield path, i, m.filename, m.compress_type, z.read(m)
        except zipfile.BadZipFile:
            yield path, 0, None, None, None


@dataclass
class Written(WriterCommitMessage):
    folder: str | None


class PackageWriter(DataSourceWriter):
    """Rows (doc, content) as files below a folder, by doc's path below `root`. A task writes below a folder of its own;
    commit moves its files to their places, abort deletes them, so a failed job leaves no file."""

    def __init__(self, path: str, root: str):
        self.path, self.root = path.rstrip("/"), root
        self.job = f"{self.path}/_docweave-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Written:
        store, _ = opened(self.job)
        folder = f"{self.job}/{uuid.uuid4().hex}"
        at, some = opened(folder)[1], False
        for row in rows:
            below = row["doc"][len(self.root) :] if row["doc"].startswith(self.root) else re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*|^/+", "", row["doc"])
            name = f"{at}/{below.lstrip('/')}"
            store.create_dir(name.rsplit("/", 1)[0], recursive=True)
            if store.get_file_info(name).type.name != "NotFound":
                raise ValueError(f"path_clash: two packages for {below}")
            with store.open_output_stream(name) as out:
                out.write(row["content"])
            some = True
        return Written(folder if some else None)

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        store, top = opened(self.path)
        moves: dict[str, str] = {}
        for m in messages:
            if m is None or m.folder is None:
                continue
            at = opened(m.folder)[1]
            for f in store.get_file_info(fs.FileSelector(at, recursive=True)):
                if f.type == fs.FileType.File:
                    to = top + f.path[len(at) :]
                    if to in moves:
                        self._drop()
                        raise ValueError(f"path_clash: two packages for {to}")
                    moves[to] = f.path
        for to, path in moves.items():
            store.create_dir(to.rsplit("/", 1)[0], recursive=True)
            store.move(path, to)
        self._drop()

    def abort(self, messages: list) -> None:
        self._drop()

    def _drop(self) -> None:
        store, at = opened(self.job)
        if store.get_file_info(at).type.name != "NotFound":
            store.delete_dir(at)


class PackageSource(DataSource):
    """Options: rows = members (MEMBERS, as package.entries() gives them; what is no readable package has one row with a null
    entry) or outcomes (OUTCOMES, all files); members = pattern that a whole name meets; root = what doc's path is cut by in
    writing, else its folder is kept from the top. Paths are those that pyarrow reads, unescaped."""

    @classmethod
    def name(cls) -> str:
        return "docweave_package"

    def schema(self) -> str:
        return OUTCOMES if self.options.get("rows", "members") == "outcomes" else MEMBERS

    def reader(self, schema) -> PackageReader:
        return PackageReader(self.options["path"], self.options.get("rows", "members"), self.options.get("members", "(?s).*"))

    def writer(self, schema, overwrite: bool) -> PackageWriter:
        return PackageWriter(self.options["path"], self.options.get("root", ""))


def read_members(spark: SparkSession, path: str, members: str = "(?s).*") -> DataFrame:
    """Members whose name meets the pattern of all packages at path, of any size."""
    spark.dataSource.register(PackageSource)
    return spark.read.format(PackageSource.name()).option("members", members).load(path)


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """(doc, length, code, message) of opening each file at path; see outcome()."""
    spark.dataSource.register(PackageSource)
    return spark.read.format(PackageSource.name()).option("rows", "outcomes").load(path)


def write_packages(packages: DataFrame, folder: str, root: str = "") -> None:
    """Packages (doc, content) as files below the folder, all or none."""
    packages.sparkSession.dataSource.register(PackageSource)
    packages.select("doc", "content").write.format(PackageSource.name()).option("root", root).mode("append").save(folder)
