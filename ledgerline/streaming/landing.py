"""Load newly landed files into a core table, each file exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.schemas import Table
from ledgerline.sources.staging import landed_options, split_valid


def landed_stream(spark: SparkSession, table: Table, path: str, fmt: str = "csv") -> DataFrame:
    """Files under ``path`` as a stream, read like :func:`ledgerline.sources.staging.read_landed`."""
    return landed_options(spark.readStream, table, fmt).load(path)


def load_landed(
    spark: SparkSession, table: Table, landing: str, core: str, rejects: str, progress: str, fmt: str = "csv"
) -> list[StreamingQuery]:
    """Append every file not seen before: valid rows to ``core``, the others to ``rejects``.

    The run ends when the files present at its start are done. ``progress`` keeps what
    has been read; with it the file sink commits a batch once even if a run is repeated.
    """
    valid, broken = split_valid(landed_stream(spark, table, landing, fmt), table)
    started = []
    for name, rows, target in (
        ("core", table.conform(valid), core),
        ("rejects", broken.withColumn("broken_rules", F.array_join("broken_rules", ",")), rejects),
    ):
        writer = rows.writeStream.format("parquet").outputMode("append").trigger(availableNow=True).option(
            "checkpointLocation", f"{progress}/{name}")
        if name == "core" and table.partition_by:
            writer = writer.partitionBy(*table.partition_by)
        started.append(writer.start(target))
    for query in started:
        query.awaitTermination()
    return started
