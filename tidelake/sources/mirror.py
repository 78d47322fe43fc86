"""Mirrors with proof: two listings as tables, copies in tasks by bytes, deletion only after a second listing agrees."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.sources import files

#: Bytes that a task copies, about.
TASK_BYTES = 1 << 30


def compared(local: DataFrame, remote: DataFrame) -> DataFrame:
    """path, size, state of all files of two listings (path, size, checksum): same, differs, local (only) or remote (only).

    Files are the same if sizes agree and, where both listings have them, checksums do.
    """
    a, b = (x.select("path", F.col("size").alias(f"{n}_size"), F.col("checksum").alias(f"{n}_sum")) for x, n in ((local, "a"), (remote, "b")))
    alike = (F.col("a_size") == F.col("b_size")) & F.coalesce(F.col("a_sum") == F.col("b_sum"), F.lit(True))
    state = F.when(F.col("b_size").isNull(), "local").when(F.col("a_size").isNull(), "remote").when(alike, "same").otherwise("differs")
    return a.join(b, "path", "full").select("path", F.coalesce("a_size", "b_size").alias("size"), state.alias("state"))


def allowed_paths(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """rows (path) whose group= and source= folders are a pair on the allowlist; what names no pair is withheld."""
    part = lambda key: F.regexp_extract("path", f"(?:^|/){key}=([^/]+)", 1)
    named = rows.withColumns({"group": part("group"), "source": part("source")})
    return named.join(allowed.select("group", "source").distinct(), ["group", "source"], "left_semi").select(*rows.columns)


def tasks_of(rows: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """rows (path, size) with task: about ``task_bytes`` each, a larger file alone.

    Sums run within buckets of a hash of the path, so no window is over all files.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // (64 * task_bytes)))
    by = Window.partitionBy("bucket").orderBy("path").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("path"), F.lit(buckets)).cast("int"))
    return rows.withColumn("task", F.concat_ws("-", "bucket", F.floor((F.sum("size").over(by) - F.col("size")) / task_bytes))).drop("bucket")


def copied(rows: DataFrame, source: str, target: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """path, written, error of files (path, size) copied from below one root to below another, in tasks.

    A file is written beside its name and renamed once it is whole, so a copy that is cut
    short leaves no file under the name.  What fails is told, and stops no other.
    """
    spark = rows.sparkSession
    dealt = tasks_of(rows, task_bytes)
    n = min(10_000, max(1, dealt.select("task").distinct().count()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path in pdf["path"]:
                try:
                    out.append((path, copy(f"{source.rstrip('/')}/{path}", f"{target.rstrip('/')}/{path}"), None))
                except OSError as error:
                    out.append((path, None, str(error)[:300]))
            yield pd.DataFrame(out, columns=["path", "written", "error"]).astype({"written": "Int64"})

    return dealt.repartition(n, "task").select("path").mapInPandas(run, "path string, written long, error string")


def copy(source: str, target: str) -> int:
    """Copies a file in pieces; the bytes written."""
    a, x = files.opened(source)
    b, y = files.opened(target)
    folder, _, name = y.rpartition("/")
    b.create_dir(folder)
    part, n = f"{folder}/.{name}.part", 0
    with a.open_input_stream(x) as read, b.open_output_stream(part) as write:
        while piece := read.read(files.PIECE):
            write.write(piece)
            n += len(piece)
    b.move(part, y)
    return n


def deleted(rows: DataFrame, root: str) -> DataFrame:
    """path of files deleted below a root, in tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                fs, where = files.opened(f"{root.rstrip('/')}/{path}")
                fs.delete_file(where)
            yield pdf[["path"]]

    return rows.select("path").mapInPandas(run, "path string")


def settled_paths(rows: DataFrame, today: Column) -> DataFrame:
    """rows (path) whose date= is before today; files of no day are not settled."""
    return rows.where(F.regexp_extract("path", "(?:^|/)date=([0-9-]+)", 1).try_cast("date") < today)


def mirror(spark: SparkSession, source: str, target: str, allowed: DataFrame | None = None, checksum: bool = False) -> dict[str, int]:
    """Copies what a target lacks or holds otherwise: copied, skipped, failed.  Nothing is ever deleted.

    allowed: group, source pairs that may be there; other files are withheld.
    """
    local = files.tree(spark, source, checksum)
    state = compared(allowed_paths(local, allowed) if allowed is not None else local, files.tree(spark, target, checksum)).where("state <> 'remote'").persist()
    try:
        done = copied(state.where("state <> 'same'"), source, target).persist()
        counts = {"copied": done.where("error IS NULL").count(), "failed": done.where("error IS NOT NULL").count(), "skipped": state.where("state = 'same'").count()}
        done.unpersist()
        return counts
    finally:
        state.unpersist()


def sync(spark: SparkSession, source: str, target: str, today: Column, checksum: bool = True) -> dict[str, int]:
    """Moves settled days to a target: copied, deleted, kept.

    After copying both sides are listed anew, and only files that the target then holds with
    the same size (and checksum) are deleted at the source; others stay, for the next run.
    """
    sent = settled_paths(files.tree(spark, source, checksum), today)
    todo = compared(sent, files.tree(spark, target, checksum)).where("state IN ('local', 'differs')")
    n = copied(todo, source, target).where("error IS NULL").count()
    proof = compared(settled_paths(files.tree(spark, source, checksum), today), files.tree(spark, target, checksum)).where("state <> 'remote'").persist()
    try:
        kept = proof.where("state <> 'same'").count()
        return {"copied": n, "deleted": deleted(proof.where("state = 'same'"), source).count(), "kept": kept}
    finally:
        proof.unpersist()
