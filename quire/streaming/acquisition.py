"""Resuming acquisition as a stream: what was asked for, what is there, what is still missing.

Requests and arrivals are two streams of ids. Per id the state is two flags that only ever go from
false to true, so the order in which files of the two arrive does not matter. Each batch writes the
flags of the ids it touched to a folder of its own number; a batch that is repeated after a failure overwrites
that folder with the same rows, so a restarted job neither loses nor repeats anything.

State is one row of two flags per id, spread over the shuffle partitions of the first start. For hundreds
of millions of ids set Spark's RocksDB state store, which keeps it out of the heap.

Defined cases: ids may repeat within and between batches; null ids are ignored; an id that is there without having
been asked for is neither missing nor reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

ID = "book_id string"
FLAGS = "book_id string, asked boolean, there boolean, batch bigint"


def read_ids_stream(spark: SparkSession, path: str, files_per_batch: int = 1_000) -> DataFrame:
    """New Parquet files of a table with a column ``book_id``."""
    return spark.readStream.schema(ID).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def known_ids(asked: DataFrame, there: DataFrame) -> DataFrame:
    """``(book_id, asked, there)``; on streams with state per id."""
    requests = asked.select("book_id", F.lit(True).alias("asked"), F.lit(False).alias("there"))
    arrivals = there.select("book_id", F.lit(False).alias("asked"), F.lit(True).alias("there"))
    events = requests.unionByName(arrivals).filter("book_id is not null")
    return events.groupBy("book_id").agg(F.bool_or("asked").alias("asked"), F.bool_or("there").alias("there"))


def write_batch(changed: DataFrame, path: str, batch: int) -> None:
    changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def follow_available(asked: DataFrame, there: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take in what has arrived since the last run and write the changed flags below ``path``."""
    return (
        known_ids(asked, there)
        .writeStream.outputMode("update")
        .foreachBatch(lambda changed, batch: write_batch(changed, path, batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _flags(spark: SparkSession, path: str) -> DataFrame:
    """The latest flags. They only ever go up, so the batches need no order."""
    written = spark.read.schema(FLAGS).option("basePath", path).parquet(path)
    return written.groupBy("book_id").agg(F.bool_or("asked").alias("asked"), F.bool_or("there").alias("there"))


def still_missing(spark: SparkSession, path: str) -> DataFrame:
    """``(book_id)`` of what was asked for and is not there."""
    return _flags(spark, path).filter("asked and not there").select("book_id")


def running_report(spark: SparkSession, path: str) -> DataFrame:
    """``(outcome, n_ids)`` of what was asked for: ``downloaded`` or ``missing``."""
    outcome = F.when(F.col("there"), "downloaded").otherwise("missing")
    return _flags(spark, path).filter("asked").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n_ids"))
