"""Every registered query against its SQL in DuckDB."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from tidelake.plans import catalogue, catalogue_lake, catalogue_streams, catalogue_updates, catalogue_verify  # noqa: F401
from tidelake.plans import standins

TABLES = "region nation customer supplier part orders lineitem events".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(rows):
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(plain(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    wanted = {r[0]: r[1] for r in duck.execute("DESCRIBE " + catalogue.SQL[name]).fetchall()}
    assert {c: KINDS[k] for c, k in df.dtypes} == wanted
    names = ", ".join(f'"{c}"' for c in columns)
    assert canon(tuple(r) for r in df.select(*columns).collect()) == canon(duck.execute(f"SELECT {names} FROM ({catalogue.SQL[name]})").fetchall())


def test_bars_read_four_columns_and_shuffle_once_for_all_windows(spark, sf_dir):
    plan = catalogue.QUERIES["bars_daily_features"](spark, sf_dir)._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "l_comment" not in scan and "l_discount" not in scan
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("hashpartitioning(source") <= 2


def test_quotes_have_the_milliseconds_of_the_sql(spark, tmp_path):
    ends = ["2024-01-01 00:59:59.9994", "2024-01-01 00:59:59.9995", "2024-01-01 00:59:59.9999", "2024-01-01 01:00:00", "1969-12-31 22:59:59.9995", "1969-12-31 22:59:59.999501"]
    con = duckdb.connect()
    con.execute(f"COPY (SELECT i AS event_id, CAST(t AS TIMESTAMP) AS ts, 0::BIGINT AS user_id, 'view' AS event_type, 1.0::DOUBLE AS value, '' AS props FROM (SELECT unnest({ends}) AS t, unnest(range({len(ends)})) AS i)) TO '{tmp_path}/events.parquet'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    got = standins.quotes(spark, str(tmp_path)).select("update_id", "received_at")
    assert canon(map(tuple, got.collect())) == canon(con.execute(f"WITH {standins.QUOTES} SELECT update_id, received_at FROM quotes").fetchall())
    (tmp_path / "later").mkdir()
    con.execute(f"COPY (SELECT * FROM events WHERE ts > '2000-01-01') TO '{tmp_path}/later/events.parquet'")
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM '{tmp_path}/later/events.parquet'")
    for name in ("tumbling_counts", "decode_book"):
        df = catalogue.QUERIES[name](spark, f"{tmp_path}/later")
        assert canon(map(tuple, df.collect())) == canon(con.execute(f"SELECT {', '.join(df.columns)} FROM ({catalogue.SQL[name]})").fetchall())


def test_prints_are_dealt_to_tasks_by_their_number(spark, sf_dir, monkeypatch):
    wide = standins.prints(spark, sf_dir).count()
    monkeypatch.setattr(standins, "TASK_ROWS", 250)
    rows = standins.prints(spark, sf_dir).groupBy(F.spark_partition_id().alias("task"), "series_id").agg(F.count("*").alias("n"), F.max("revision_seq").alias("last")).collect()
    tasks = {}
    for r in rows:
        tasks[r.task] = tasks.get(r.task, 0) + r.n
    assert sum(tasks.values()) == wide and all(r.n == r.last + 1 for r in rows)
    assert len(tasks) >= 25 and max(tasks.values()) < 600
