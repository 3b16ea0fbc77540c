"""File scans, landing, ledger, streaming load, relational options and catalog tables."""

from datetime import datetime
from itertools import permutations
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.plans.registry import _write_json_arrays
from stockyard.sources import files, jdbc, landing, schemas, tables
from stockyard.streaming.loader import load_stream

NOW = datetime(2023, 5, 10, 1, 2, 3)


def write(path, text):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv(spark, folder):
    write(f"{folder}/a.csv", "quantity,prices\n1,0\n2,1\n3,3\n")
    schema = T.StructType.fromDDL("quantity bigint, prices bigint")
    assert rows(files.read_csv(spark, folder, schema)) == [(1, 0), (2, 1), (3, 3)]
    assert rows(files.read_csv(spark, folder)) == [(1, 0), (2, 1), (3, 3)]


def test_csv_missing_and_unreadable_cells(spark, folder):
    write(f"{folder}/a.csv", 'n,s\nNA,nan\n,"say ""hi"", you"\n7, x \n')
    schema = T.StructType.fromDDL("n bigint, s string")
    assert rows(files.read_csv(spark, folder, schema)) == rows(
        spark.createDataFrame([(None, None), (None, 'say "hi", you'), (7, " x ")], schema)
    )
    write(f"{folder}/b.csv", "n,s\nseven,x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_csv(spark, folder, schema).collect()


def test_json_array_object_and_empty_object(spark, folder):
    schema = T.StructType.fromDDL("a bigint, b bigint")
    write(f"{folder}/1/a.json", '[{"a":1,"b":2},\n{"a":3,"b":4}]')
    write(f"{folder}/2/a.json", '{"a":5,\n"b":6}')
    write(f"{folder}/3/a.json", "{}")
    assert rows(files.read_json(spark, f"{folder}/1", schema)) == [(1, 2), (3, 4)]
    assert rows(files.read_json(spark, f"{folder}/2", schema)) == [(5, 6)]
    assert rows(files.read_json(spark, f"{folder}/3", schema)) == [(None, None)]
    assert rows(files.read_json(spark, f"{folder}/1")) == [(1, 2), (3, 4)]


def test_parquet_names_and_differing_columns(spark, folder):
    spark.createDataFrame([(1,)], "A bigint").write.parquet(f"{folder}/x")
    spark.createDataFrame([(2, "z")], "A bigint, B string").write.parquet(f"{folder}/y")
    df = files.read_parquet(spark, [f"{folder}/x", f"{folder}/y"])
    assert df.columns == ["a", "b"]
    assert rows(df) == rows(spark.createDataFrame([(1, None), (2, "z")], "a bigint, b string"))


def test_sheet_cells_stay_text(spark, folder):
    write(f"{folder}/stores.csv", "quantity,stock\n1,02\n25,\n")
    df = files.read_sheet_export(spark, folder)
    assert {k for _, k in df.dtypes} == {"string"}
    assert rows(df) == [("1", "02"), ("25", "")]


def listing(spark, folder):
    write(f"{folder}/raw/inventory/file1.csv", "a\n1\n")
    write(f"{folder}/raw/inventory/file10.csv", "a\n1\n")
    write(f"{folder}/raw/products/file2.json", "{}")
    write(f"{folder}/raw/products/deep/file.3.txt", "x")
    write(f"{folder}/raw/top.csv", "a\n")
    write(f"{folder}/raw/raw/again.csv", "a\n")
    return files.file_inventory(spark, f"{folder}/raw")


def test_inventory_and_formats(spark, folder):
    found = listing(spark, folder)
    assert rows(found.select("folder", "base", "extension")) == rows(
        spark.createDataFrame(
            [("inventory", "file1", "csv"), ("inventory", "file10", "csv"), ("products", "file2", "json"),
             ("products", "file.3", "txt"), (None, "top", "csv"), ("raw", "again", "csv")],
            "f string, b string, e string",
        )
    )
    assert rows(files.folder_formats(found)) == [("inventory", ["csv"]), ("products", ["json", "txt"]), ("raw", ["csv"])]
    assert files.read_files(spark, "txt", [folder]) is None


def test_skip_landed(spark, folder):
    write(f"{folder}/raw/inventory/2024-01-01/file1.csv", "a\n1\n")
    write(f"{folder}/raw/inventory/file1.json", "{}")
    source = listing(spark, folder).filter("folder = 'inventory'")
    assert source.count() == 4
    schema = "folder string, name string"
    landed = spark.createDataFrame([("inventory", "file10.csv_20230510T010203Z")], schema)
    left = {"file1.csv", "2024-01-01/file1.csv", "file1.json"}
    assert {r.name for r in files.skip_landed(source, landed).collect()} == left
    same = spark.createDataFrame([("inventory", "2024-01-01/file1.csv_20230510T010203Z")], schema)
    assert {r.name for r in files.skip_landed(source, same).collect()} == {"file1.csv", "file10.csv", "file1.json"}
    dated = spark.createDataFrame([("inventory", "file1.csv_2023_05_10"), ("products", "file10.csv")], schema)
    assert files.skip_landed(source, dated).count() == 4


def test_csv_columns_are_found_by_name(spark, folder):
    write(f"{folder}/in/a.csv", "city,warehouse_id,state\nLagos,WH-1,LA\n")
    write(f"{folder}/in/b.csv", "State,Warehouse_ID\nKN,WH-2\n")
    write(f"{folder}/in/c.csv", "")
    schema = T.StructType.fromDDL("warehouse_id string, city string, state string")
    assert rows(files.read_csv(spark, f"{folder}/in", schema)) == [("WH-1", "Lagos", "LA"), ("WH-2", None, "KN")]
    write(f"{folder}/in/d.csv", "warehouse_id,colour\nWH-3,red\n")
    with pytest.raises(ValueError, match="colour"):
        files.read_csv(spark, f"{folder}/in", schema)
    write(f"{folder}/none/a.csv", "")
    assert files.read_csv(spark, f"{folder}/none", schema).columns == schema.names


def test_unknown_json_fields_are_refused(spark, folder):
    schema = T.StructType.fromDDL("a bigint, b string")
    write(f"{folder}/a.json", '[{"a": 1}]')
    assert rows(files.read_json(spark, folder, schema)) == [(1, None)]
    write(f"{folder}/b.json", '[{"a": 1, "colour": "red"}]')
    with pytest.raises(Exception, match="fields not in the raw table: colour"):
        files.read_json(spark, folder, schema).collect()
    nested = T.StructType.fromDDL("a bigint, place struct<city string, code int>, tags array<string>")
    write(f"{folder}/n/a.json", '[{"a": 1, "place": {"City": "Lagos", "code": 7}, "tags": ["x", "y"]}, {"A": 2, "place": null}]')
    assert rows(files.read_json(spark, f"{folder}/n", nested)) == rows(
        spark.createDataFrame([(1, ("Lagos", 7), ["x", "y"]), (2, None, None)], nested)
    )
    write(f"{folder}/n/b.json", '{"place": {"city": "Kano", "mayor": "n"}}')
    with pytest.raises(Exception, match="fields not in the raw table: mayor"):
        files.read_json(spark, f"{folder}/n", nested).collect()
    write(f"{folder}/bad/a.json", '[{"a": 1}, {"a":')
    with pytest.raises(Exception, match="no JSON record"):
        files.read_json(spark, f"{folder}/bad", schema).collect()


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [")


def test_json_names_are_lowered_once_per_record(spark, folder):
    """Not once for every column, whichever depth the object has."""
    schema = T.StructType.fromDDL("a bigint, b string, c string, place struct<city: string, code: bigint>")
    write(f"{folder}/a.json", '[{"A": 1, "c": "x", "place": {"City": "Lagos"}}, null, {"b": "y", "place": null}]')
    found = files.read_json(spark, folder, schema)
    expected = [(1, None, "x", ("Lagos", None)), (None,) * 4, (None, "y", None, None)]
    assert rows(found) == rows(spark.createDataFrame(expected, schema))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("transform_keys") == 2


def test_json_records_without_an_id_lie_in_many_files(spark, folder):
    records = spark.range(2000).select(F.lit(None).cast("string").alias("id"), F.col("id").alias("n"))
    _write_json_arrays(records, f"{folder}/out", per_file=100)
    sizes = [r[1] for r in spark.read.text(f"{folder}/out", wholetext=True).select("file", F.length("value")).collect()]
    assert len(sizes) == 21 and max(sizes) < 3 * sum(sizes) / len(sizes)
    found = files.read_json(spark, f"{folder}/out", T.StructType.fromDDL("id string, n bigint"))
    assert rows(found) == rows(records)


def test_one_scan_whatever_the_layouts(spark, folder, monkeypatch):
    """Forty orders of columns, cells that rows lack or have too many, a quoted header, a byte-order mark."""
    schema = T.StructType.fromDDL("a bigint, b string, c string, d string, e string")
    expected = []
    for i, order in enumerate(list(permutations("abcde"))[:40]):
        names = order[: 2 + i % 4] if "a" in order[: 2 + i % 4] else (*order[:2], "a")
        cells = {n: str(i) if n == "a" else f"{n}{i}" for n in names}
        text = ",".join(f'"{n.upper()}"' for n in names) + "\n" + ",".join(cells[n] for n in names) + "\n"
        write(f"{folder}/many/f {i}%.csv", ("\ufeff" if i % 5 == 0 else "") + text)
        expected.append(tuple(int(cells[n]) if n == "a" and n in cells else cells.get(n) for n in "abcde"))
    found = files.read_csv(spark, f"{folder}/many", schema)
    assert rows(found) == sorted(expected, key=repr)
    assert scans(found) == 1
    write(f"{folder}/json/a.json", '[{"a": 1}]')
    assert scans(files.read_json(spark, f"{folder}/json", T.StructType.fromDDL("a bigint"))) == 1
    write(f"{folder}/short/a.csv", "a,b,c\n1,x\n")
    write(f"{folder}/short/b.csv", "b\ny\n")
    assert rows(files.read_csv(spark, f"{folder}/short", schema)) == rows(
        spark.createDataFrame([(1, "x", None, None, None), (None, "y", None, None, None)], schema)
    )
    write(f"{folder}/short/c.csv", "b,c\ny,z,w\n")
    with pytest.raises(Exception, match="a cell beyond the header"):
        files.read_csv(spark, f"{folder}/short", schema).collect()
    monkeypatch.setattr(files, "HEADER_BYTES", 8)
    write(f"{folder}/long/a.csv", "a,b,c,d,e" + " " * 300 + "\n1,2,3,4,5\n")
    assert rows(files.read_csv(spark, f"{folder}/long", schema)) == [(1, "2", "3", "4", "5")]


def test_files_of_equal_names_all_land(spark, folder):
    for day, n in (("2024-01-01", 1), ("2024-01-02", 2)):
        write(f"{folder}/raw/inventory/{day}/part-0.csv", f"quantity,stock\n{n},{n}\n")
        assert land(spark, folder) == 1
    assert land(spark, folder) == 0
    assert spark.read.parquet(f"{folder}/landing/inventory").count() == 2


def test_load_stamp_in_another_session_zone(spark):
    moment = F.timestamp_micros(F.lit(1704110400000000))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = spark.range(1).select(landing.load_stamp(moment)).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == datetime(2024, 1, 1, 13, 0)


def test_bad_files_are_found_by_their_footers(spark, folder, monkeypatch):
    """Two bad files of eleven cost one failed job; a store that fails is no bad file."""
    schema, calls, insert = T.StructType.fromDDL("a string, b bigint"), [], landing.append_new
    monkeypatch.setattr(landing, "append_new", lambda *a, **k: (calls.append(1), insert(*a, **k)))
    for i in range(9):
        spark.createDataFrame([(f"x{i}", i)], schema).coalesce(1).write.mode("append").parquet(f"{folder}/landing/in")
    write(f"{folder}/landing/in/no.parquet", "no parquet")
    spark.range(1).selectExpr("'y' AS a", "1L AS colour").coalesce(1).write.parquet(f"{folder}/landing/unknown")
    found = landing.load_folder(spark, f"{folder}/landing", f"{folder}/table", f"{folder}/ledger", schema)
    assert found.files == 9 and len(found.unreadable) == 2 and len(calls) <= 2
    assert len(held(spark, folder)) == 9
    spark.createDataFrame([("late", 1)], schema).coalesce(1).write.parquet(f"{folder}/landing/late")

    def lost(spark, path):
        raise ConnectionError("store lost")

    monkeypatch.setattr(landing, "_can_be_opened", lost)
    with pytest.raises(ConnectionError):
        landing.load_folder(spark, f"{folder}/landing", f"{folder}/table", f"{folder}/ledger", schema)
    assert len(held(spark, folder)) == 9


def test_a_bad_file_does_not_stop_a_load(spark, folder):
    for i in range(5):
        df = spark.createDataFrame([(f"x{i}", i)], "a string, b bigint").coalesce(1)
        df.write.parquet(f"{folder}/landing/f{i}")
    write(f"{folder}/landing/bad/part.parquet", "no parquet")
    found = load(spark, folder)
    assert found.files == 5 and [p.endswith("bad/part.parquet") for p in found.unreadable] == [True]
    assert held(spark, folder) == [(f"x{i}", i) for i in range(5)]
    again = load(spark, folder)
    assert again.files == 0 and len(again.unreadable) == 1


def test_lineage_stamp(spark):
    df = landing.stamp_lineage(spark.createDataFrame([(1,), (2,)], "quantity int"), "test", NOW)
    assert rows(df) == [(1, "2023-05-10 01:02:03", "test"), (2, "2023-05-10 01:02:03", "test")]
    fresh = landing.stamp_lineage(spark.range(1), "s3").first()
    assert len(fresh.s3_extraction_date) == 19


def test_write_landing(spark, folder):
    for _ in range(2):
        landing.write_landing(spark.range(2), "s3", f"{folder}/inventory", NOW)
    assert spark.read.parquet(f"{folder}/inventory").count() == 4


def test_load_stamp_is_lagos_time(spark):
    stamp = landing.load_stamp(F.lit("2024-01-01 23:30:00").cast("timestamp"))
    assert spark.range(1).select(stamp).first()[0] == datetime(2024, 1, 2, 0, 30)


def test_stored_types(spark):
    given = T.StructType.fromDDL("A int, b double, C string, d boolean, e decimal(10,2), f timestamp_ntz")
    stored = schemas.stored_schema(given)
    assert [(f.name, f.dataType.simpleString()) for f in stored] == [
        ("a", "bigint"), ("b", "double"), ("c", "string"), ("d", "boolean"), ("e", "decimal(10,2)"),
        ("f", "timestamp_ntz"),
    ]
    with pytest.raises(TypeError, match="binary"):
        schemas.stored_schema(T.StructType.fromDDL("a binary"))
    with pytest.raises(ValueError, match="extra"):
        landing.to_stored(spark.range(1).withColumn("extra", F.lit(1)), T.StructType.fromDDL("id bigint"))


STOCK = T.StructType().add("quantity", T.LongType()).add("stock", T.LongType())


def land(spark, folder, **options):
    return landing.land_folder(
        spark, f"{folder}/raw", f"{folder}/landing", "inventory", "csv", STOCK, now=NOW, **options
    )


def test_landing_takes_each_file_once(spark, folder):
    write(f"{folder}/raw/inventory/file1.csv", "quantity,stock\n1,1\n2,2\n")
    assert land(spark, folder) == 1
    assert land(spark, folder) == 0
    for i in (2, 3, 4):
        write(f"{folder}/raw/inventory/file{i}.csv", f"quantity,stock\n{i},{i}\n")
    write(f"{folder}/raw/inventory/file[5] a+b=c%.csv", "quantity,stock\n5,5\n")
    assert land(spark, folder, files_per_group=2) == 4
    assert land(spark, folder) == 0
    landed = spark.read.parquet(f"{folder}/landing/inventory")
    assert landed.count() == 6
    assert {r.landed_as for r in landed.select("landed_as").collect()} == {
        f"file{i}.csv_20230510T010203Z" for i in (1, 2, 3, 4, "[5] a+b=c%")
    }


def load(spark, folder, **options):
    return landing.load_folder(
        spark, f"{folder}/landing", f"{folder}/table", f"{folder}/ledger", **options
    )


def held(spark, folder):
    schema = T.StructType.fromDDL("a string, b bigint")
    return rows(landing.read_raw(spark, f"{folder}/table", schema).select("a", "b"))


def test_ledger_load(spark, folder):
    schema = "a string, b bigint"
    first = spark.createDataFrame([("x", 1), ("x", 1), ("y", None)], schema).coalesce(1)
    first.write.parquet(f"{folder}/landing/one")
    assert load(spark, folder, files_per_group=1).files == 1
    assert load(spark, folder).files == 0
    second = spark.createDataFrame([("y", None), ("z", 3)], schema).coalesce(1)
    second.write.parquet(f"{folder}/landing/two")
    assert load(spark, folder, prune_on="b").files == 1
    assert held(spark, folder) == [("x", 1), ("y", None), ("z", 3)]


def test_ledger_load_with_plain_equality(spark, folder):
    for part in ("one", "two"):
        df = spark.createDataFrame([("y", None), ("y", None), ("z", 3)], "a string, b bigint").coalesce(1)
        df.write.parquet(f"{folder}/landing/{part}")
    assert load(spark, folder, null_safe=False).files == 2
    assert held(spark, folder) == [("y", None), ("y", None), ("z", 3)]


def test_a_rewritten_file_is_loaded_again(spark):
    schema = "path string, size bigint, modified timestamp"
    seen = spark.createDataFrame([("a", 1, NOW), ("b", 1, NOW)], schema)
    now = spark.createDataFrame([("a", 1, NOW), ("b", 2, NOW), ("c", 1, NOW)], schema)
    assert [r.path for r in landing.unprocessed(now, seen).orderBy("path").collect()] == ["b", "c"]


def test_stream_load(spark, folder):
    schema = T.StructType.fromDDL("a string, b bigint")

    def run():
        load_stream(spark, f"{folder}/landing", schema, f"{folder}/table", f"{folder}/checkpoint")

    spark.createDataFrame([("x", 1), ("x", 1), ("y", None)], schema).write.parquet(f"{folder}/landing")
    run()
    run()
    assert held(spark, folder) == [("x", 1), ("y", None)]
    spark.createDataFrame([("x", 1), ("z", 2)], schema).write.mode("append").parquet(f"{folder}/landing")
    run()
    assert held(spark, folder) == [("x", 1), ("y", None), ("z", 2)]


def test_a_replayed_batch_is_known_by_its_name(spark, folder, monkeypatch):
    """Batches whose rows are in the table, but not in the checkpoint: neither rows nor a look at the table."""
    schema = T.StructType.fromDDL("a string, b bigint")

    def run():
        load_stream(spark, f"{folder}/landing", schema, f"{folder}/table", f"{folder}/checkpoint", files_per_trigger=1)

    for a in "xy":
        spark.createDataFrame([(a, 1)], schema).coalesce(1).write.mode("append").parquet(f"{folder}/landing")
    run()
    done = held(spark, folder)
    assert done == [("x", 1), ("y", 1)]
    monkeypatch.setattr(landing, "new_rows", lambda *args: pytest.fail("the table was compared"))
    for n in (0, 1):
        last = sorted(Path(f"{folder}/checkpoint/commits").glob("[0-9]*"))[-1]
        for path in (last, last.with_name(f".{last.name}.crc")):
            path.unlink()
        run()
        assert held(spark, folder) == done
    monkeypatch.undo()
    # Another stream with batches of the same numbers is no replay.
    spark.createDataFrame([("z", 2)], schema).coalesce(1).write.parquet(f"{folder}/more")
    load_stream(spark, f"{folder}/more", schema, f"{folder}/table", f"{folder}/other")
    assert held(spark, folder) == [*done, ("z", 2)]


def test_table_names_match_like_a_wildcard(spark):
    names = ["sales_2023", "SALESxx", "sale_1", "other", "sales_v"]
    catalog = spark.createDataFrame(
        [("public", "VIEW" if n == "sales_v" else "BASE TABLE", n) for n in names]
        + [("private", "BASE TABLE", "sales_x")],
        "table_schema string, table_type string, table_name string",
    )
    assert rows(jdbc.matching_tables(catalog, jdbc.SALES_TABLES, "public")) == [("SALESxx",), ("sales_2023",)]


class Reader:
    """Stands in for Spark's reader; no database is available here."""

    def __init__(self, spark, log, extremes):
        self.spark, self.log, self.extremes, self.settings = spark, log, extremes, {}

    @property
    def read(self):
        return Reader(self.spark, self.log, self.extremes)

    def format(self, name):
        self.settings["format"] = name
        return self

    def option(self, key, value):
        self.settings[key] = value
        return self

    def options(self, **settings):
        self.settings |= settings
        return self

    def load(self):
        self.log.append(self.settings)
        if "query" in self.settings:
            return self.spark.createDataFrame([self.extremes], "low bigint, high bigint")
        return self.spark.range(1)


def test_partitioned_table_scan_options(spark):
    log = []
    jdbc.read_table(Reader(spark, log, (3, 90)), "jdbc:x", "sales_1", "id", 8, properties={"user": "u"})
    assert log[0]["query"] == 'SELECT min("id") AS low, max("id") AS high FROM sales_1'
    assert log[1] == {
        "format": "jdbc", "url": "jdbc:x", "fetchsize": 10_000, "user": "u", "dbtable": "sales_1",
        "partitionColumn": '"id"', "lowerBound": "3", "upperBound": "90", "numPartitions": 8,
    }
    empty = []
    jdbc.read_table(Reader(spark, empty, (None, None)), "jdbc:x", "sales_1", "id", 8)
    assert "partitionColumn" not in empty[1]


def test_union_of_sales_tables(spark):
    one = spark.createDataFrame([(1, "a")], "id int, store string")
    two = spark.createDataFrame([("b", 2, 0.1)], "store string, id int, discount double")
    assert rows(jdbc.union_tables([one, two])) == rows(
        spark.createDataFrame([(1, "a", None), (2, "b", 0.1)], "id int, store string, discount double")
    )


def test_discovered_names_are_quoted_and_qualified(spark):
    assert jdbc.quoted("Other", 'Sales "x"') == '"Other"."Sales ""x"""'


def test_published_versions(spark):
    name = "shop.stock"
    assert tables.read_table(spark, name) is None
    tables.publish(spark.createDataFrame([(1, "a")], "k int, v string"), name, ["k"], 2)
    for n in (2, 3):
        grown = tables.read_table(spark, name).unionByName(spark.createDataFrame([(n, "b")], "k int, v string"))
        tables.publish(grown, name, ["k"], 2)
    assert rows(tables.read_table(spark, name)) == [(1, "a"), (2, "b"), (3, "b")]
    tables.publish(tables.read_table(spark, name), name, ["k"], 2, marked="k")
    assert tables.published_mark(spark, name) == "3"
    tables.publish(tables.read_table(spark, name).limit(0), name, ["k"], marked="k")
    assert tables.published_mark(spark, name) is None
    tables.write_table(spark.range(2), "shop.copy")
    tables.write_table(spark.range(3), "shop.copy")
    assert spark.table("shop.copy").count() == 3
    tables.write_view(spark.range(4), "passing")
    assert spark.table("passing").count() == 4


def test_scanned_json_lies_compressed(spark):
    """Its text would take most of the disk that the scan needs; every record is read from its file."""
    from stockyard.plans.registry import QUERIES
    from stockyard.session import scratch_folders

    before = set(scratch_folders())
    read = QUERIES["json_scan"](spark, "/root/testdata/sf0.001")
    (path,) = set(scratch_folders()) - before
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    size = sum(f.stat().st_size for f in Path(path.removeprefix("file:")).rglob("part-*"))
    assert size * 4 < texts.agg(F.sum(F.octet_length("value"))).first()[0]
    assert read.count() == texts.agg(F.sum(F.call_function("json_array_length", "value"))).first()[0] > 6000
