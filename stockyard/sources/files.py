"""File scans, folder inventory and the skip-if-landed rule."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.operators.joins import sized

# CSV cell texts that mean "no value".
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Column with the path of the file a row was read from.
FILE = "_file"

# Time stamp that a landed file's name ends with.
LANDED_STAMP = r"_\d{8}T\d{6}Z$"


def plain_path(path: Column) -> Column:
    """A file's path without percent-encoding; a plus sign stands for itself."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


# Bytes of a file in which its first line is looked for at first, and files looked at together.
HEADER_BYTES, AT_ONCE = 1 << 16, 16


def _header(spark: SparkSession, path: str) -> list[str] | None:
    """The names in a file's first line, from its first bytes; None for a file without any line."""
    jvm, size = spark._jvm, HEADER_BYTES
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    while True:
        stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(place)
        try:
            found = bytes(stream.readNBytes(size))
        finally:
            stream.close()
        whole = len(found) < size
        lines = found.decode("utf-8-sig", "replace").splitlines(keepends=True)
        for row in csv.reader(lines if whole else lines[:-1]):
            if row:
                return [n.strip().lower() for n in row]
        if whole:
            return None
        size *= 16


# What a file's address begins with; it may be written with one slash or three.
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


def _layouts(spark: SparkSession, paths: list[str], schema: T.StructType) -> dict[str, list[str]]:
    """The columns of each file, in its order. Unknown ones are refused, and those named twice."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        found = dict(zip(paths, pool.map(lambda p: _header(spark, p), paths), strict=True))
    for names in {tuple(n) for n in found.values() if n}:
        refuse_unknown(names, schema)
        if len(set(names)) < len(names):
            raise ValueError(f"a column is named twice: {list(names)}")
    return {re.sub(_SCHEME, r"\1:/", path): names for path, names in found.items() if names}


def _read_csv(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV files with a header. With a schema, columns are found by the header's names (in any order and
    case); absent ones are NULL, and files with unknown ones are refused. A cell that does not fit its type
    fails the query, and so does a cell beyond the header; cells that a row lacks are NULL.

    All files are one scan, however many layouts they have: cells are read by position, and a map from
    a file to the positions of its columns, made from the files' first bytes, says which is which. Cells
    are read as text and cast, so that the usual spellings of a missing value become NULL and anything else
    unreadable is not silently dropped. `multi_line` admits line breaks inside quotes, at the price of one
    task per file.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if schema is None:
        return reader.option("inferSchema", True).csv(paths)
    layouts = _layouts(spark, reader.schema("cell string").csv(paths).inputFiles(), schema)
    fields = _lower(schema)
    if not layouts:
        return spark.createDataFrame([], T.StructType([*fields, T.StructField(FILE, T.StringType())]))
    # One more than any file has, so that a cell too many is seen.
    width = max(map(len, layouts.values())) + 1
    scan = reader.schema(T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(width)])).csv(paths)
    address = F.col("_metadata.file_path")
    cells = scan.select(
        F.array(*scan.columns).alias("cells"), address.alias(FILE), F.regexp_replace(address, _SCHEME, "$1:/").alias("address")
    )
    places = [
        (path, [names.index(f.name) if f.name in names else None for f in fields], len(names))
        for path, names in layouts.items()
    ]
    known = spark.createDataFrame(places, "address string, places array<int>, width int")
    placed = cells.join(sized(known), "address")
    beyond = F.exists(F.slice("cells", F.col("width") + 1, width), lambda c: c.isNotNull())
    wrong = F.concat(F.lit("a cell beyond the header in "), F.col(FILE))
    held = F.when(beyond, F.raise_error(wrong).cast("array<string>")).otherwise(F.col("cells"))
    picked = placed.select(held.alias("cells"), "places", FILE)

    def cell(i: int, field: T.StructField) -> Column:
        text = F.get("cells", F.get("places", F.lit(i)))
        return F.when(~text.isin(*MISSING_CELLS), text).cast(field.dataType).alias(field.name)

    return picked.select(*[cell(i, f) for i, f in enumerate(fields)], FILE)


def _lower(schema: T.StructType) -> list[T.StructField]:
    return [T.StructField(f.name.lower(), f.dataType) for f in schema.fields]


def refuse_unknown(names: Iterable[str], schema: T.StructType) -> None:
    unknown = {n.lower() for n in names} - {n.lower() for n in schema.names}
    if unknown:
        raise ValueError(f"columns not in the raw table: {sorted(unknown)}")


def _typed(value: Column, kind: T.DataType) -> Column:
    """A JSON value (VARIANT) as a column; of an object, every field must be known, at any depth."""
    if not isinstance(kind, T.StructType):
        return value.cast(kind)
    # A variable of a lambda is computed once, an expression as often as it is named.
    objects = F.transform(F.array(_lower_names(value.cast("map<string,variant>"))), lambda o: _known(o, kind))
    records = F.transform(objects, lambda o: F.when(o.isNotNull(), F.struct(*_values(o, kind))))
    return F.get(records, F.lit(0))


def _lower_names(fields: Column) -> Column:
    """An object's fields (a map from names to values), named in lower case."""
    return F.transform_keys(fields, lambda name, _: F.lower(name))


def _known(fields: Column, schema: T.StructType) -> Column:
    """The fields, all of which must be in the schema."""
    unknown = F.array_except(F.map_keys(fields), F.array(*[F.lit(f.name.lower()) for f in schema.fields]))
    told = F.concat(F.lit("fields not in the raw table: "), F.array_join(F.array_sort(unknown), ", "))
    return F.when(F.size(unknown) > 0, F.raise_error(told).cast("map<string,variant>")).otherwise(fields)


def _values(fields: Column, schema: T.StructType) -> list[Column]:
    return [_typed(F.get(F.array(F.element_at(fields, f.name.lower())), F.lit(0)), f.dataType).alias(f.name) for f in schema.fields]


def _read_json(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """JSON files holding an array of records or one single record each; one task per file.

    With a schema, absent fields are NULL and unknown ones fail the query, nested ones too. That takes one
    scan: objects are read as maps, so that their names are data, and values as VARIANT, to be cast.
    """
    if schema is None:
        return spark.read.option("multiLine", True).option("mode", "FAILFAST").json(paths)
    # Names of folders are no columns.
    texts = spark.read.text(paths, wholetext=True, recursiveFileLookup=True)
    whole = texts.select("value", F.col("_metadata.file_path").alias(FILE)).filter("trim(value) <> ''")
    many = F.from_json("value", "array<map<string,variant>>")
    one = F.array_compact(F.array(F.from_json("value", "map<string,variant>")))
    records = F.coalesce(many, F.when(F.size(one) > 0, one))
    wrong = F.raise_error(F.concat(F.lit("no JSON record or array of records in "), F.col(FILE)))
    read = whole.select(F.explode(F.coalesce(records, wrong.cast("array<map<string,variant>>"))).alias("fields"), FILE)
    # Each step is a projection of its own: what all columns need is computed once per record, not once per column.
    named = read.select(_lower_names(F.col("fields")).alias("fields"), FILE)
    checked = named.select(_known(F.col("fields"), schema).alias("fields"), FILE)
    return checked.select(*_values(F.col("fields"), schema), FILE)


def read_csv(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV files with a header; see `_read_csv`."""
    return _read_csv(spark, paths, schema, multi_line).drop(FILE)


def read_json(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """JSON files; see `_read_json`."""
    return _read_json(spark, paths, schema).drop(FILE)


def read_parquet(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Parquet files, column names in lower case; files may lack columns that others have."""
    paths = [paths] if isinstance(paths, str) else paths
    return lower_names(spark.read.option("mergeSchema", True).parquet(*paths))


def read_sheet_export(spark: SparkSession, path: str) -> DataFrame:
    """A sheet's CSV export: the first row names the columns, every cell is text, blanks are ''."""
    cells = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return cells.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in cells.columns])


def literal_path(path: str) -> str:
    """The path with its wildcard characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files at any depth below `root`: path, folder (first level), name (the path below that folder),
    base, extension, size, time.

    Only file listings are read, never contents.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )
    where = urlsplit(root)
    top = (where.netloc + where.path).rstrip("/") + "/"
    below = F.substring(F.col("path"), F.instr("path", F.lit(top)) + len(top), F.length("path"))
    name = _file_name(F.col("path"))
    folder = F.when(F.contains(below, F.lit("/")), F.split_part(below, F.lit("/"), F.lit(1)))
    return files.select(
        "path",
        folder.alias("folder"),
        F.coalesce(F.substring(below, F.length(folder) + 2, F.length("path")), below).alias("name"),
        F.regexp_replace(name, r"\.[^.]*$", "").alias("base"),
        F.when(F.contains(name, F.lit(".")), F.element_at(F.split(name, r"\."), -1)).alias("extension"),
        "size",
        "modified",
    )


def folder_formats(inventory: DataFrame) -> DataFrame:
    """Each folder with the set of file extensions found in it."""
    return (
        inventory.filter(F.col("folder").isNotNull())
        .groupBy("folder")
        .agg(F.sort_array(F.collect_set("extension")).alias("extensions"))
    )


def skip_landed(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Source files of an inventory that have no counterpart among the landed ones (folder, name).

    A landed file is named after its source's path below the folder, plus a time stamp.
    """
    done = landed.select("folder", F.regexp_replace("name", LANDED_STAMP, "").alias("name")).distinct()
    return source.join(done, ["folder", "name"], "left_anti").select(*source.columns)


def read_files(
    spark: SparkSession, extension: str, paths: str | list[str], schema: T.StructType | None = None
) -> DataFrame | None:
    """Files of one format as one scan, each row with its file's path; formats other than csv and json
    are ignored."""
    readers = {"csv": _read_csv, "json": _read_json}
    if extension not in readers:
        return None
    found = readers[extension](spark, paths, schema)
    return found if schema is not None else found.withColumn(FILE, F.col("_metadata.file_path"))
