"""Files as tables: folders are listed, and contents hashed, in tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Bytes read at a time.
PIECE = 8 << 20
FILE = "folder string, name string, size long, modified_ms long"


def opened(uri: str):
    """(file system, path) of a URI or a local path, for tasks."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def folders(spark: SparkSession, root: str) -> list[str]:
    """A root and all folders below it, from folder names; files are not listed one by one here."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, todo = [], [at] if fs.exists(at) else []
    while todo:
        folder = todo.pop()
        found.append(folder.toString())
        todo += [s.getPath() for s in fs.listStatus(folder) if s.isDirectory()]
    return found


def listing(spark: SparkSession, paths: list[str] | DataFrame) -> DataFrame:
    """folder, name, size, modified_ms of the files in some folders (a list, or a table with path), listed in tasks.

    A folder that is gone holds no files.  Files below its subfolders are not its own.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as afs

        for pdf in batches:
            for folder in pdf["path"]:
                fs, where = opened(folder)
                found = fs.get_file_info(afs.FileSelector(where, allow_not_found=True))
                rows = [(folder, f.base_name, f.size, int(f.mtime.timestamp() * 1000) if f.mtime else None) for f in found if f.type == afs.FileType.File]
                yield pd.DataFrame(rows, columns=["folder", "name", "size", "modified_ms"])

    table = spark.createDataFrame([(p,) for p in paths], "path string") if isinstance(paths, list) else paths.select("path")
    return table.repartition(min(1000, max(1, table.count())), "path").mapInPandas(run, FILE)


def digest(uri: str) -> str:
    """SHA-256 of a file's bytes, read a piece at a time."""
    fs, where = opened(uri)
    h = hashlib.sha256()
    with fs.open_input_stream(where) as f:
        while piece := f.read(PIECE):
            h.update(piece)
    return h.hexdigest()


def tree(spark: SparkSession, root: str, checksum: bool = False) -> DataFrame:
    """path (relative to root), size, checksum of all files below a root, hidden ones left out; checksum is null unless asked for."""
    base = root.rstrip("/")
    rows = listing(spark, folders(spark, base))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            uris = (pdf["folder"] + "/" + pdf["name"]).tolist()
            full = [opened(u)[1] for u in uris]
            top = opened(base)[1].rstrip("/") + "/"
            kept = [(p[len(top) :], n, digest(u) if checksum else None) for u, p, n in zip(uris, full, pdf["size"].tolist()) if not any(x[:1] in "._" for x in p[len(top) :].split("/"))]
            yield pd.DataFrame(kept, columns=["path", "size", "checksum"])

    return rows.mapInPandas(run, "path string, size long, checksum string")
