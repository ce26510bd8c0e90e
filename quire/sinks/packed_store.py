"""A packed dataset that grows: added stories are packed behind those that are there.

The store is a folder of generations. Each holds chunks in one folder per split, and a ledger with, per
split, the length of the stream so far, the number of full chunks, and the open chunk behind them, fewer than
``max_length`` tokens, whether or not it is long enough to count. So adding stories reads only the open chunks and
the new stories, and writes only new chunks; nothing written before is read or changed. Readers take
the full chunks of all generations and the open ones of the last.

A generation counts once its mark is there, which is created last and at once. A job that fails before
leaves a folder that readers ignore and the next try replaces. Batches have names: adding a batch again does
nothing. One writer at a time; readers may go on meanwhile, as what they read never changes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.fixed_values import MAX_LENGTH, OVERLAP
from quire.operators.packing import pack
from quire.sinks.committed import Committed
from quire.staging import stage

LEDGER = "split string, total bigint, full bigint, tail array<int>"
CHUNKS = "chunk_id bigint, input_ids array<int>, split string, is_open boolean"


class PackedStore(Committed):
    def __init__(self, spark: SparkSession, path: str, max_length: int = MAX_LENGTH, overlap: int = OVERLAP):
        super().__init__(spark, path)
        self.max_length, self.overlap = max_length, overlap
        known = {(m["max_length"], m["overlap"]) for m in self.generations()}
        if known - {(max_length, overlap)}:
            raise ValueError(f"this store was packed with {sorted(known)}, not with {(max_length, overlap)}")

    def ledger(self) -> DataFrame:
        """``(split, total, full, tail)`` after the last committed generation: a row per split."""
        marks = self.generations()
        if not marks:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger/{marks[-1]['generation']}")

    def append(self, tokens: DataFrame, batch: str, key: str = "doc_id", then_by: tuple[str, ...] = ()) -> bool:
        """Add ``(split, key, tokens)`` behind the stream of each split; False if ``batch`` is there already.

        Within the batch, stories are in the order of ``pack``.
        """
        marks = self.generations()
        if any(m["batch"] == batch for m in marks):
            return False
        number = len(marks)
        before = self.ledger()
        # The open chunk goes first: a story without a name, before other such stories.
        new = tokens.select("split", F.col(key).cast("string").alias("_key"), *then_by, F.lit(1).alias("_is_story"), "tokens")
        tails = before.filter("size(tail) > 0").select("split", F.lit(0).alias("_is_story"), F.col("tail").alias("tokens"))
        story = stage(new.unionByName(tails, allowMissingColumns=True), "appended")
        packed = pack(story, self.max_length, self.overlap, key="_key", then_by=("_is_story", *then_by), least_rest=0)

        # The ledger has a row per split, of which there are few.
        done = F.broadcast(before.select(F.col("split").alias("_split"), F.col("full").alias("_full"), F.col("total").alias("_total"), F.size("tail").alias("_open")))
        same = F.col("split").eqNullSafe(F.col("_split"))
        zero = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint"))
        is_open = F.size("input_ids") < self.max_length
        chunks = packed.join(done, same, "left").select((F.col("chunk_id") + zero("_full")).alias("chunk_id"), "input_ids", "split", is_open.alias("is_open"))
        path = f"{self.path}/chunks/{number}"
        chunks.write.mode("overwrite").partitionBy("split", "is_open").parquet(path)

        n, stride = F.col("_n"), self.max_length - self.overlap
        full = F.when(n < self.max_length, 0).otherwise(F.floor((n - self.max_length) / stride) + 1).cast("bigint")
        lengths = story.groupBy("split").agg(F.sum(F.size("tokens").cast("bigint")).alias("_n"))
        grown = lengths.join(done, same, "left").select("split", (zero("_total") - zero("_open") + n).alias("total"), (zero("_full") + full).alias("full"))
        kept = before.join(F.broadcast(lengths.select(F.col("split").alias("_split"))), same, "left_anti").select("split", "total", "full")
        opened = self.spark.read.schema(CHUNKS).parquet(path).filter("is_open").select(F.col("split").alias("_split"), F.col("input_ids").alias("tail"))
        ledger = grown.unionByName(kept).join(F.broadcast(opened), same, "left")
        tail = F.coalesce("tail", F.array().cast("array<int>")).alias("tail")
        ledger.select("split", "total", "full", tail).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/{number}")
        self._mark(number, batch=batch, max_length=self.max_length, overlap=self.overlap)
        return True

    def read(self) -> DataFrame:
        """``(split, chunk_id, input_ids)`` of all committed generations, as if packed at once."""
        marks = self.generations()
        chunks = self.spark.createDataFrame([], CHUNKS)
        if marks:
            # A read per generation: folders of one read would have to share a root.
            parts = [self.spark.read.schema(CHUNKS).parquet(f"{self.path}/chunks/{m['generation']}") for m in marks]
            last = parts[-1].filter(F.col("is_open") & (F.size("input_ids") > self.max_length // 2))
            chunks = reduce(DataFrame.unionByName, [p.filter(~F.col("is_open")) for p in parts] + [last])
        return chunks.select("split", "chunk_id", "input_ids")
