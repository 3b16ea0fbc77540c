"""Incremental file load as a stream: each run takes in the files that arrived since the last."""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stockyard.session import configure
from stockyard.sources.landing import append_new, holds_load, to_stored
from stockyard.sources.schemas import stored_schema

FILES_PER_TRIGGER = 10_000


def load_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    raw: str,
    checkpoint: str,
    files_per_trigger: int = FILES_PER_TRIGGER,
    prune_on: str | None = None,
) -> None:
    """Load every new Parquet file of a landing folder into a raw table, then stop.

    Other formats are landed first: a stream would read CSV and JSON without the rules that
    `land_folder` keeps (columns by name, refused cells).

    The checkpoint remembers the files by path. Each batch's rows lie in a folder named after the query and
    the batch, which comes into the table as a whole: a batch replayed after a failure is known by that
    name, without a look at the table's rows. A file rewritten under its old path is not seen again; the
    ledger load covers that case.
    """
    target, started = stored_schema(schema), Future()

    def insert(batch: DataFrame, batch_id: int) -> None:
        load = f"{started.result()}-{batch_id}"
        if not holds_load(batch.sparkSession, raw, load):
            append_new(to_stored(batch, target), raw, target, prune_on=prune_on, load=load)

    files = (
        configure(spark)
        .readStream.format("parquet")
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(landing)
    )
    query = (
        files.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.set_result(query.id)
    query.awaitTermination()
