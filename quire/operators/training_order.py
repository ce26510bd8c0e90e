"""Order in which packed chunks are trained on: epoch part, batches, padding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.fixed_values import ACCUMULATION, DEVICE_BATCH, EPOCHS, IGNORED_LABEL, SEED
from quire.operators.ranking import seeded_rank
from quire.staging import stage


def epoch_plan(
    packed: DataFrame,
    fraction: float = EPOCHS,
    batch: int = DEVICE_BATCH,
    accumulation: int = ACCUMULATION,
    seed: int = SEED,
    by: str = "split",
) -> DataFrame:
    """``(by, chunk_id, n_tokens, rank, batch_id, step_id)`` of the chunks that are trained on.

    Chunks are put in a seeded order and the first ``ceil(fraction * n)`` are used. ``batch``
    chunks form a device batch and ``accumulation`` batches a step. The sizes are written once,
    so that ``packed`` is not computed again for each of the two reads of the ranking.
    """
    if fraction <= 0:
        raise ValueError(f"fraction must be positive, got {fraction}")
    narrow = stage(packed.select(by, "chunk_id", F.size("input_ids").alias("n_tokens")), "sizes")
    return (
        seeded_rank(narrow, ["chunk_id"], by, seed)
        .filter(F.col("rank") < F.ceil(F.lit(float(fraction)) * F.col("total")))
        .drop("total")
        .withColumn("batch_id", F.floor(F.col("rank") / batch).cast("bigint"))
        .withColumn("step_id", F.floor(F.col("rank") / (batch * accumulation)).cast("bigint"))
    )


def _padded(values: Column, missing: Column, filler: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(filler), missing))


def collate(
    packed: DataFrame, plan: DataFrame, pad_id: int, by: str = "split", mask_pad_by: str = "position"
) -> DataFrame:
    """Pad the chunks of a batch to its longest one.

    Adds ``attention_mask`` and ``labels``. Padding gets no attention and no loss; with
    ``mask_pad_by="token"`` every occurrence of ``pad_id`` gets no loss, also genuine ones.
    """
    if mask_pad_by not in ("position", "token"):
        raise ValueError(f"mask_pad_by must be position or token, got {mask_pad_by!r}")
    longest = F.max("n_tokens").over(Window.partitionBy(by, "batch_id"))
    rows = packed.select(by, "chunk_id", "input_ids").join(
        plan.withColumn("_longest", longest), [by, "chunk_id"]
    )
    missing = (F.col("_longest") - F.col("n_tokens")).cast("int")
    if mask_pad_by == "token":
        labels = F.transform(
            "input_ids", lambda t: F.when(t == pad_id, F.lit(IGNORED_LABEL)).otherwise(t)
        )
    else:
        labels = F.col("input_ids")
    return rows.select(
        by,
        "step_id",
        "batch_id",
        "rank",
        "chunk_id",
        _padded(F.col("input_ids"), missing, pad_id).alias("input_ids"),
        _padded(F.array_repeat(F.lit(1), F.col("n_tokens")), missing, 0).alias("attention_mask"),
        _padded(labels, missing, IGNORED_LABEL).alias("labels"),
    )
