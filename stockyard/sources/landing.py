"""Landing zone, raw tables and the ledger of processed files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from itertools import islice
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.operators.incremental import new_rows
from stockyard.session import configure
from stockyard.sources.files import (
    FILE,
    file_inventory,
    literal_path,
    lower_names,
    plain_path,
    read_files,
    refuse_unknown,
    skip_landed,
)
from stockyard.sources.schemas import stored_schema

LOAD_ZONE = "Africa/Lagos"
LEDGER = "path string, size bigint, modified timestamp, processed_at timestamp"
FILE_IDENTITY = ["path", "size", "modified"]
# Conditions of errors that a file's content causes.
UNREADABLE = (
    "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "CANNOT_MERGE_SCHEMAS", "UNABLE_TO_INFER_SCHEMA",
    "is not a Parquet file", "PARQUET_COLUMN_DATA_TYPE_MISMATCH", "MALFORMED_RECORD",
)
# Files whose names pass through the driver at once, and footers that are read at once.
FILES_PER_GROUP, AT_ONCE = 10_000, 16


def stamp_lineage(df: DataFrame, source: str, now: datetime | None = None) -> DataFrame:
    """Adds `<source>_extraction_date` (text, to the second) and `origin`."""
    moment = F.current_timestamp() if now is None else F.lit(now)
    return df.withColumns(
        {
            f"{source}_extraction_date": F.date_format(moment, "yyyy-MM-dd HH:mm:ss"),
            "origin": F.lit(source),
        }
    )


def write_landing(df: DataFrame, source: str, folder: str, now: datetime | None = None) -> None:
    """Append to a landing folder, stamped; part files get unique names."""
    stamp_lineage(df, source, now).write.mode("append").parquet(folder)


def load_stamp(now: Column | None = None) -> Column:
    """The raw table's `ingestion_date`: wall-clock time of the load zone, whatever the session's zone is."""
    moment = F.current_timestamp() if now is None else now.cast("timestamp")
    seconds = (F.unix_micros(moment) / F.lit(1_000_000).cast("decimal(18,0)")).cast("decimal(18,6)")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(LOAD_ZONE), utc)


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet folder, or no rows where it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _groups(rows: Iterator, size: int) -> Iterator[list]:
    rows = iter(rows)
    while group := list(islice(rows, size)):
        yield group


def landed_files(spark: SparkSession, landing: str, folder: str) -> DataFrame:
    """What a landing folder holds, from its listing: folder and name, the source's with its time stamp."""
    try:
        held = file_inventory(spark, f"{landing}/{folder}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "folder string, name string")
    # Partition folders have their values escaped once.
    value = F.regexp_extract("path", "/landed_as=([^/]*)/", 1)
    names = held.select(plain_path(value).alias("name")).filter("name <> ''").distinct()
    return names.select(F.lit(folder).alias("folder"), "name")


def land_folder(
    spark: SparkSession, root: str, landing: str, folder: str, extension: str,
    schema: T.StructType | None = None, source: str = "s3",
    now: datetime | None = None, files_per_group: int = FILES_PER_GROUP,
) -> int:
    """Copy the files of one folder and format that have not landed yet; the number of files.

    All files of a group are one distributed read and write; each keeps its path below the folder, with a
    time stamp, as the partition `landed_as` of the landing folder.
    """
    configure(spark)
    found = file_inventory(spark, root).filter(
        (F.col("folder") == folder) & (F.col("extension") == extension)
    )
    pending = skip_landed(found, landed_files(spark, landing, folder))
    landed = 0
    for group in _groups(pending.select("path", "name").toLocalIterator(), files_per_group):
        paths = [literal_path(row.path) for row in group]
        rows = read_files(spark, extension, paths, schema)
        if rows is None:
            return 0
        moment = F.current_timestamp() if now is None else F.lit(now)
        # The part of the file's path that follows the folder, whose place in it is the same for all.
        start = len(group[0].path) - len(group[0].name)
        path = plain_path(F.col(FILE))
        name = F.substring(path, F.lit(start + 1), F.length(path))
        stamp = F.date_format(moment, "'_'yyyyMMdd'T'HHmmss'Z'")
        named = rows.withColumn("landed_as", F.concat(name, stamp)).drop(FILE)
        stamp_lineage(named, source, now).write.mode("append").partitionBy("landed_as").parquet(
            f"{landing}/{folder}"
        )
        landed += len(group)
    return landed


def to_stored(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the raw table's columns; absent ones become NULL, unknown ones are refused."""
    named = lower_names(df)
    refuse_unknown(named.columns, schema)
    return named.select(
        *[
            (F.col(f.name) if f.name in named.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A raw table with its load stamp; empty before its first load."""
    stored = T.StructType([*schema.fields]).add("ingestion_date", T.TimestampNTZType())
    stored = stored.add("load_day", T.DateType()).add("load", T.StringType())
    return read_if_exists(spark, path, stored).drop("load_day", "load")


def holds_load(spark: SparkSession, path: str, load: str) -> bool:
    """Whether a raw table holds the rows of a load, by the folder they lie in."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/load_day=*/load={load}")
    return bool(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place))


def append_new(
    batch: DataFrame, path: str, schema: T.StructType, null_safe: bool = True,
    file_column: str | None = None, now: Column | None = None, prune_on: str | None = None,
    load: str | None = None,
) -> None:
    """Insert the batch rows the raw table lacks, under one load stamp, partitioned by load day and load.

    The table is read only where it could hold the batch's rows: between the batch's extremes of
    `prune_on`, by default the extraction time. The rows come into the table by one move of the load's
    folder, when all are written; loads at the same time have folders of their own.
    """
    extracted = [c for c in schema.names if c.endswith("_extraction_date")]
    prune_on = prune_on or (extracted[0] if extracted else None)
    configure(batch.sparkSession)
    held = read_raw(batch.sparkSession, path, schema).select(*schema.names)
    fresh = new_rows(held, batch, null_safe, file_column, prune_on)
    stamp = load_stamp(now)
    named = {"ingestion_date": stamp, "load_day": stamp.cast("date"), "load": F.lit(load or uuid.uuid4().hex)}
    writer = fresh.withColumns(named).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("load_day", "load").parquet(path)


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not in the ledger; a file whose size or time changed counts as new."""
    done = ledger.select(*FILE_IDENTITY).distinct()
    return files.join(done, FILE_IDENTITY, "left_anti").select(*files.columns)


def mark_processed(files: DataFrame, path: str) -> None:
    """Record files in the ledger."""
    files.select(*FILE_IDENTITY, F.current_timestamp().alias("processed_at")).write.mode(
        "append"
    ).parquet(path)


class Loaded(NamedTuple):
    """How many files were loaded, and the paths of those that could not be read."""

    files: int
    unreadable: list[str]


def _unreadable(error: Exception) -> bool:
    """Whether a file's content is at fault, and not the run: its bytes, its types or its columns."""
    told = str(error)
    return isinstance(error, (ValueError, TypeError)) or any(c in told for c in UNREADABLE)


def _can_be_opened(spark: SparkSession, path: str) -> None:
    """Raise what the store says if a file's first byte cannot be had: then it is the store that fails."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(place)
    try:
        stream.read()
    finally:
        stream.close()


def _readable(spark: SparkSession, path: str, schema: T.StructType | None) -> bool:
    """Whether a file's footer can be read and its columns go into the raw table."""
    try:
        found = spark.read.parquet(literal_path(path))
        to_stored(found, stored_schema(schema or found.schema))
    except (PySparkException, Py4JJavaError, ValueError, TypeError) as error:
        _can_be_opened(spark, path)
        if not _unreadable(error):
            raise
        return False
    return True


def load_folder(
    spark: SparkSession, landing: str, raw: str, ledger: str, schema: T.StructType | None = None,
    null_safe: bool = True, prune_on: str | None = None, files_per_group: int = FILES_PER_GROUP,
) -> Loaded:
    """Load all landed Parquet files that the ledger lacks into a raw table.

    Files go in groups of bounded size: read, insert new rows, then mark. A run that dies between
    two steps is made good by the next one, which finds the rows already held. File names pass
    through the driver one group at a time, rows never do. Where a group cannot be read, the footers and
    columns of its files are looked at, and those that are sound are loaded together; the others stay
    unmarked for the next run. Only a group whose footers are all sound, and its pages not, is halved until the
    file is alone. A store that does not answer ends the load.
    """
    configure(spark)
    files = file_inventory(spark, landing).filter("extension = 'parquet'")
    pending = unprocessed(files, read_if_exists(spark, ledger, LEDGER)).select(*FILE_IDENTITY)
    done, bad = 0, []

    def load(group: list) -> None:
        paths = [literal_path(row.path) for row in group]
        found = spark.read.option("mergeSchema", True).parquet(*paths)
        target = stored_schema(schema or found.schema)
        rows = found.withColumn("source_file", F.col("_metadata.file_path"))
        batch = to_stored(rows, T.StructType([*target.fields]).add("source_file", T.StringType()))
        append_new(batch, raw, target, null_safe, "source_file", prune_on=prune_on)

    for group in _groups(pending.toLocalIterator(), files_per_group):
        left = [group]
        while left:
            some = left.pop()
            try:
                load(some)
            except (PySparkException, Py4JJavaError, ValueError, TypeError) as error:
                if not _unreadable(error):
                    raise
                with ThreadPoolExecutor(AT_ONCE) as pool:
                    sound = list(pool.map(lambda f: _readable(spark, f.path, schema), some))
                good = [f for f, ok in zip(some, sound, strict=True) if ok]
                if len(good) < len(some):
                    bad += [f.path for f, ok in zip(some, sound, strict=True) if not ok]
                    left += [good] if good else []
                elif len(some) == 1:
                    bad.append(some[0].path)
                else:
                    half = len(some) // 2
                    left += [some[half:], some[:half]]
                continue
            mark_processed(spark.createDataFrame(some, pending.schema), ledger)
            done += len(some)
    return Loaded(done, sorted(bad))
