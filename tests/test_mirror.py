"""Mirrors: what is copied, what is withheld, and that nothing goes without proof."""

import os

import pytest
from pyspark.sql import functions as F

from tidelake.sources import files, mirror


@pytest.fixture()
def root(tmp_path):
    for group, source, day, name, body in (("bars", "a", "2024-01-01", "x", "one"), ("bars", "a", "2024-01-02", "x", "two"), ("bars", "b", "2024-01-01", "y", "three"), ("series", "a", "2024-01-01", "z", "four" * 1000)):
        folder = tmp_path / "src" / f"group={group}" / f"source={source}" / f"date={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.parquet").write_text(body)
    (tmp_path / "src" / "_SUCCESS").write_text("")
    (tmp_path / "src" / "loose.txt").write_text("loose")
    return tmp_path


def names(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs)


def test_a_mirror_skips_equal_files_withholds_and_never_deletes(spark, root):
    allowed = spark.createDataFrame([("bars", "a")], "group string, source string")
    src, out = str(root / "src"), str(root / "out")
    (root / "out").mkdir()
    (root / "out" / "old.txt").write_text("stays")
    assert mirror.mirror(spark, src, out, allowed) == {"copied": 2, "failed": 0, "skipped": 0}
    assert mirror.mirror(spark, src, out, allowed) == {"copied": 0, "failed": 0, "skipped": 2}
    assert names(out) == ["group=bars/source=a/date=2024-01-01/x.parquet", "group=bars/source=a/date=2024-01-02/x.parquet", "old.txt"]
    (root / "out/group=bars/source=a/date=2024-01-01/x.parquet").write_text("ONE")  # of the same size
    assert mirror.mirror(spark, src, out, allowed)["copied"] == 0 and mirror.mirror(spark, src, out, allowed, checksum=True)["copied"] == 1
    assert (root / "out/group=bars/source=a/date=2024-01-01/x.parquet").read_text() == "one"
    (root / "out/group=bars/source=a/date=2024-01-02/x.parquet").write_text("longer")
    assert mirror.mirror(spark, src, out, allowed)["copied"] == 1


def test_settled_days_go_only_with_proof(spark, root, monkeypatch):
    src, out, today = str(root / "src"), str(root / "out"), F.lit("2024-01-02").cast("date")
    real = mirror.copied

    def cut_short(rows, source, target, task_bytes=mirror.TASK_BYTES):
        done = real(rows, source, target, task_bytes).collect()
        short = root / "out/group=series/source=a/date=2024-01-01/z.parquet"
        short.write_text(short.read_text()[:10])  # a store that says yes and holds less
        return rows.sparkSession.createDataFrame(done, "path string, written long, error string")

    monkeypatch.setattr(mirror, "copied", cut_short)
    assert mirror.sync(spark, src, out, today) == {"copied": 3, "deleted": 2, "kept": 1}
    assert names(src) == ["_SUCCESS", "group=bars/source=a/date=2024-01-02/x.parquet", "group=series/source=a/date=2024-01-01/z.parquet", "loose.txt"]
    monkeypatch.setattr(mirror, "copied", real)
    assert mirror.sync(spark, src, out, today) == {"copied": 1, "deleted": 1, "kept": 0}
    assert (root / "out/group=series/source=a/date=2024-01-01/z.parquet").read_text() == "four" * 1000
    assert mirror.sync(spark, src, out, today) == {"copied": 0, "deleted": 0, "kept": 0}


def test_a_copy_that_fails_is_told_and_leaves_no_file(spark, root):
    rows = spark.createDataFrame([("loose.txt", 5), ("gone.txt", 7)], "path string, size long")
    done = {r.path: (r.written, r.error) for r in mirror.copied(rows, str(root / "src"), str(root / "out")).collect()}
    assert done["loose.txt"] == (5, None) and done["gone.txt"][0] is None and "gone" in done["gone.txt"][1]
    assert names(root / "out") == ["loose.txt"]


def test_copies_are_cut_to_tasks_by_bytes(spark):
    rows = spark.range(1000).select(F.concat(F.lit("f"), F.col("id")).alias("path"), F.when(F.col("id") == 3, 900).otherwise(10).cast("long").alias("size"))
    tasks = mirror.tasks_of(rows, 100).groupBy("task").agg(F.sum("size").alias("size"), F.max("size").alias("most")).collect()
    assert sum(t.size for t in tasks) == 10_890 and all(t.size <= 110 or t.most == 900 for t in tasks) and len(tasks) > 80


def test_listing_is_a_table(spark, root):
    rows = {r.path: (r.size, r.checksum is not None) for r in files.tree(spark, str(root / "src"), True).collect()}
    assert rows["loose.txt"] == (5, True) and len(rows) == 5 and "_SUCCESS" not in rows
    assert files.tree(spark, str(root / "nothing")).count() == 0
    states = {r.path: r.state for r in mirror.compared(spark.createDataFrame([("a", 1, None), ("b", 2, "x"), ("c", 3, "x")], "path string, size long, checksum string"), spark.createDataFrame([("a", 1, "y"), ("b", 2, "z"), ("d", 4, None)], "path string, size long, checksum string")).collect()}
    assert states == {"a": "same", "b": "differs", "c": "local", "d": "remote"}
