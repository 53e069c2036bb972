"""Incremental ingest: new landing files -> typed rows -> merged raw version.

The steps are the batch ones; only the trigger differs.  A repeated micro-batch gives
the same table, since the merge is idempotent and each batch writes its own version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.bronze import accepted, judge_provider_a, rejects, staged
from ..plans.jobs import REJECTS_TABLE
from ..schemas import PROVIDER_A_SCHEMA
from ..sources import catalog, rawstore, sinks
from ..sources.landing import with_station
from ..workspace import materialise


def provider_a_stream(spark: SparkSession, folder: str, stations: DataFrame) -> DataFrame:
    """Staged rows of provider A from JSON-lines files as they land."""
    reader = spark.readStream.schema(with_station(PROVIDER_A_SCHEMA)).option("columnNameOfCorruptRecord", "corrupt")
    landed = reader.json(folder).withColumn("file", F.col("_metadata.file_path"))
    return staged(judge_provider_a(landed), "aemet", stations)


def store_batch(rows: DataFrame, batch_id: int) -> None:
    """Merge one micro-batch into the months it holds, as a new version (K4).

    The batch is stored first, as it is read twice; rows that cannot be loaded are stored beside
    the version.
    """
    spark = rows.sparkSession
    stored = materialise(rows)
    version = sinks.new_raw_version()
    sinks.write_table(rejects(stored), f"{version}.{REJECTS_TABLE}")
    rawstore.store_load(accepted(stored), version, catalog.newest_raw_version(spark))


def ingest(stream: DataFrame, checkpoint: str) -> StreamingQuery:
    """Store everything that has landed so far, then stop."""
    return (
        stream.writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
