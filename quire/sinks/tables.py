"""Where results are written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.cleaning import accepted
from quire.operators.packing import with_labels
from quire.operators.splitting import VALIDATION

PACKED_VALIDATION = "validation"


def write_catalog(ebooks: DataFrame, path: str) -> None:
    """Land parsed catalog entries so that questions do not parse XML again."""
    ebooks.write.parquet(path)


def write_ids(ids: DataFrame, path: str) -> bool:
    """Distinct ids in text order, one per line. Writes nothing when there is none."""
    unique = ids.select("book_id").distinct()
    if unique.isEmpty():
        return False
    # The sorted parts keep their order in the numbered files they are written to.
    unique.orderBy("book_id").write.text(path)
    return True


def write_documents(documents: DataFrame, path: str, key: str = "doc_id") -> None:
    """Raw documents."""
    documents.select(key, "text").write.parquet(path)


def write_cleaned(gated: DataFrame, path: str, key: str = "doc_id") -> None:
    """The documents that passed the gate."""
    accepted(gated, key).write.parquet(path)


def write_split(split: DataFrame, path: str) -> None:
    """Documents in one folder per split."""
    split.write.partitionBy("split").parquet(path)


def write_packed(packed: DataFrame, path: str, labels: bool = True) -> None:
    """Packed chunks of all splits in one dataset, in one folder per split.

    Labels repeat the input; leave them out where the reader can copy the input itself.
    """
    name = F.when(F.col("split") == VALIDATION, PACKED_VALIDATION).otherwise(F.col("split"))
    named = packed.withColumn("split", name)
    (with_labels(named) if labels else named).write.partitionBy("split").parquet(path)


def bundle(train: DataFrame, validation: DataFrame) -> DataFrame:
    """Two separately packed splits as one dataset."""
    return train.withColumn("split", F.lit("train")).unionByName(
        validation.withColumn("split", F.lit(VALIDATION))
    )
