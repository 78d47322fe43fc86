"""The shared folder: plain sessions, clusters without one, scratch that goes."""

import os
import subprocess
import sys
import types

import pytest

from tidelake.llm import shared

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
PLAIN = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from tidelake.llm import media, tokens
from tidelake.llm.queries import tokenizer_path
docs = spark.createDataFrame([(1, "one"), (2, None)], "doc_id long, text string")
assert media.media_columns(docs).count() == 2
assert tokens.tokenized(docs, tokenizer_path()).count() == 2
print("done")
"""


def test_operators_run_on_a_plain_session(tmp_path):
    env = {**os.environ, "PYTHONPATH": ROOT, "TMPDIR": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", PLAIN], env=env, capture_output=True, text=True, timeout=300)
    assert "done" in out.stdout, out.stderr[-2000:]


def stub(master, folder=None):
    context = types.SimpleNamespace(master=master, applicationId=master, getCheckpointDir=lambda: folder)
    return types.SimpleNamespace(sparkContext=context, conf=types.SimpleNamespace(get=lambda name, default: default))


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(stub("yarn"))
    assert shared.shared_dir(stub("yarn", "hdfs:///shared/x/")) == "hdfs:///shared/x"
    local = stub("local[3]")
    assert shared.shared_dir(local) == shared.shared_dir(local)


def test_scratch_goes_with_its_space_and_products_stay(spark):
    with shared.scratch_space(spark):
        gone = shared.table(spark.range(3).toDF("x"), "gone").inputFiles()
        stays = shared.product(spark, "stays")
        spark.range(2).write.parquet(stays)
        assert all(os.path.exists(f.removeprefix("file://")) for f in gone)
    assert gone and not any(os.path.exists(f.removeprefix("file://")) for f in gone)
    assert spark.read.parquet(stays).count() == 2
