"""What several operators share: tables, words, batches and written intermediate tables."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import materialise, scratch_copies, settled

#: a word: a run without ASCII white space; ``bytes.split()`` cuts UTF-8 text the same way
WORD = r"[^\x20\x09-\x0D]+"

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: rows per Arrow batch: a batch of long texts must still fit a worker
BATCH_ROWS = 1000

__all__ = ["BATCH_ROWS", "WORD", "carried", "materialise", "python_batches", "read", "restored", "scratch_copies", "settled",
           "text_bytes"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows that a Python worker holds at once; holds for jobs started later in this session.

    Workers also learn where the package lies, for a driver that was started elsewhere.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """The UTF-8 bytes of every text, one at a time; null counts as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def carried(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and the whole row as ``carried_row``, so that no other column of the input can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("carried_row")
    return docs.select(row, *[F.col(f"`{c}`") for c in needed])


def restored(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The rows that ``carried`` packed, in their own columns; those in ``changed`` get a new value."""
    return df.select(*[changed.get(c, F.col(f"carried_row.`{c}`")).alias(c) for c in columns])
