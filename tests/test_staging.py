import os

import pytest
from pyspark.sql import functions as F

from quire import staging
from quire.operators.packing import segments
from quire.operators.tokens import ByteTokenizer


class _Context:
    applicationId = "app"

    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder


class _Session:
    def __init__(self, setting, master, folder=None):
        self.sparkContext = _Context(master, folder)
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}


def test_the_session_names_the_folder():
    assert staging.shared_folder(_Session("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    assert staging.shared_folder(_Session(None, "yarn", "hdfs:///set")) == "hdfs:///set"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(_Session(None, "yarn"))
    local = staging.shared_folder(_Session(None, "local[2]"))
    assert os.path.isdir(local) and staging.shared_folder(_Session(None, "local[2]")) == local


def test_staged_table(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    table = staging.stage(df, "numbers")
    assert sorted(r.x for r in table.collect()) == list(range(0, 20, 2))
    files = table.inputFiles()
    assert files and all(f"/quire/{spark.sparkContext.applicationId}/numbers-" in f for f in files)


def test_drop_removes_one_table(spark):
    kept, gone = (staging.stage(spark.range(5), name) for name in ("kept", "gone"))
    staging.drop(gone)
    assert not os.path.exists(gone.staged_path) and kept.count() == 5


def test_retire_removes_what_was_written(spark):
    table = staging.stage(spark.range(5), "gone")
    assert table.count() == 5
    path = table.inputFiles()[0]
    staging.retire(spark)
    assert not os.path.exists(path.removeprefix("file://"))



def test_tokenizer_runs_once(spark):
    df = spark.createDataFrame([("train", "a", "x")], "split string, doc_id string, text string")
    plan = segments(ByteTokenizer().transform(df), 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
