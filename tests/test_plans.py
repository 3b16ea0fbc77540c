"""What the physical plans look like: pruned scans, measured broadcasts, split hot keys."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from stockyard.operators import incremental, joins, marts, quality
from stockyard.operators.joins import measured_size, sized
from stockyard.plans.checks import LAYERS
from stockyard.plans.models import HANDED_ON, MODELS, NEEDED
from stockyard.plans.registry import QUERIES, views
from stockyard.session import configure

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def settings(spark):
    """Change settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_measured_size(spark):
    df = spark.createDataFrame([("abc", 1), (None, 22)], "s string, n int")
    assert measured_size(df) == (2, 3 + 8 + 1 + 8 + 0 + 8 + 2 + 8)
    assert measured_size(df.limit(0)) == (0, 0)


def test_lookups_are_broadcast_only_below_the_bound(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    fact, lookup = spark.range(100), spark.range(10).withColumn("v", F.lit("x"))
    assert "BroadcastHashJoin" in plan(fact.join(sized(lookup).select("id", "v"), "id"))
    assert "SortMergeJoin" in plan(fact.join(sized(lookup, max_rows=9), "id"))
    assert "SortMergeJoin" in plan(fact.join(sized(lookup, max_bytes=50), "id"))
    assert "SortMergeJoin" in plan(fact.join(sized(lookup, fact, max_rows=50), "id"))


def test_a_lookup_that_has_grown_is_measured_again(spark, folder, monkeypatch):
    """The same folder read again, or its one file overwritten by a larger one of the same name."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1000)
    path = f"{folder}/lookup"
    hinted = lambda: "ResolvedHint" in spark_plan(sized(spark.read.parquet(path)))
    spark_plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    spark.range(10).write.parquet(path)
    assert hinted() and hinted()
    spark.range(3000).write.mode("append").parquet(path)
    assert not hinted() and measured_size(spark.read.parquet(path))[0] == 3010
    single = f"{folder}/one.parquet"
    for rows in (10, 3000):
        spark.range(rows).toPandas().to_parquet(single)
        assert measured_size(spark.read.parquet(single))[0] == rows


def test_facts_join_dimensions_without_a_shuffle(spark):
    text = plan(QUERIES["lane_efficiency"](spark, FOLDER))
    assert "SortMergeJoin" not in text
    assert text.count("BroadcastHashJoin Inner") >= 3


def test_scans_read_only_needed_columns(spark):
    """Regional sales need no carrier, tax or status columns."""
    text = plan(QUERIES["fct_inventory"](spark, FOLDER))
    read = next(line for line in text.splitlines() if "ReadSchema" in line and "l_suppkey" in line)
    assert "l_extendedprice" not in read and "l_tax" not in read


def test_mark_reaches_the_scan(spark, folder):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "k int, t string")
    stored = df.select("k", F.col("t").cast("timestamp_ntz").alias("ingestion_date"))
    stored.write.parquet(f"{folder}/t")
    table = spark.read.parquet(f"{folder}/t")
    fresh = incremental.newer_than(table, incremental.high_water_mark(table))
    assert "GreaterThan(ingestion_date" in plan(fresh)
    assert fresh.count() == 0
    pruned = incremental.within_batch_range(table, table, "k")
    assert "LessThanOrEqual(k,1)" in plan(pruned)


def hot(spark, n=40_000):
    """Rows of which a third share one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("v"))


def executed(df) -> str:
    df.collect()
    return plan(df)


def test_hot_join_key_is_split(spark, settings):
    """Beyond the broadcast bound the hot key's partition is divided between tasks, also below an
    aggregate on the same key."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__advisoryPartitionSizeInBytes="10KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    lookup = spark.range(40_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    joined = hot(spark).join(sized(lookup, max_rows=10), "k")
    totals = joined.groupBy("k").agg(F.sum(F.col("w") + F.xxhash64("v") % 7).alias("s"), F.count("*").alias("n"))
    assert "skew=true" in executed(totals)
    assert totals.filter("k = 0").first().n == -(-40_000 // 3)
    assert totals.count() == 40_000 - 40_000 // 3


def test_hot_key_aggregates_reduce_before_the_shuffle(spark):
    """The latest row per key, the merge and the checks all begin with a partial aggregate."""
    df = hot(spark)
    for result in (
        incremental.latest_by_key(df, ["k"], ["v"]),
        incremental.new_rows(df, df),
        quality.unique(df, "k"),
    ):
        text = plan(result)
        above, below = text.split("Exchange", 1)
        assert "Aggregate" in below.split("(1)")[0]
        assert "Window" not in text


@pytest.mark.parametrize("query", ["lane_efficiency", "shipment_performance", "transactions_enriched", "inventory_health"])
def test_copies_go_in_the_shuffle_of_the_first_large_lookup(spark, settings, monkeypatch, query):
    """Beyond the broadcast bound facts are dealt once for both, a hot key to several places; the rows are the same."""
    expected = sorted(map(str, QUERIES[query](spark, FOLDER).collect()))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    found = QUERIES[query](spark, FOLDER)
    key = "store_id" if query == "lane_efficiency" else "product_id"
    dealt = [line for line in plan(found).splitlines() if f"hashpartitioning({key}#" in line]
    # The facts by the removal of copies, the lookup by the join; no other shuffle of the facts by that key.
    assert [joins.PLACE in line for line in dealt] == [True, True]
    assert sum("REPARTITION_BY_COL" in line for line in dealt) == 1
    assert sorted(map(str, found.collect())) == expected


def test_checks_of_intermediate_tables_shuffle_what_they_look_at(spark, settings, monkeypatch):
    """Beyond the broadcast bound both tables of shipments are dealt alike, without text that is only checked."""
    expected = sorted(map(tuple, QUERIES["dq_intermediate"](spark, FOLDER).collect()))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    found = QUERIES["dq_intermediate"](spark, FOLDER)
    dealt = [line for line in plan(found).splitlines() if "REPARTITION_BY_COL" in line]
    assert [sum(f"{joins.PLACE}_{key}" in line for line in dealt) for key in ("store_id", "product_id")] == [2, 2]
    assert sorted(map(tuple, found.collect())) == expected


def test_handed_on_text_has_only_checks_that_a_stand_in_passes_alike(spark):
    kinds = {(c.table, c.column): set() for c in LAYERS["intermediate"]}
    for c in LAYERS["intermediate"]:
        kinds[c.table, c.column].add(c.kind)
    for reader in (m for m in MODELS.values() if m.layer == "intermediate"):
        handed = {c for columns in HANDED_ON.get(reader.name, {}).values() for c in columns}
        handed |= set(NEEDED[reader.inputs[0]].handed_on) if reader.inputs[0] in NEEDED else set()
        assert all(kinds.get((reader.name, c), set()) <= {"not_null", "no_whitespace"} for c in handed)
    texts = spark.createDataFrame([(None,), ("",), (" a",), ("a ",), ("a b",), (" ",)], "t string")
    short = texts.withColumn("t", quality.stand_in("t"))
    for check in (quality.not_null, quality.no_whitespace):
        assert check(short, "t").count() == check(texts, "t").count() > 0


def test_narrowly_dealt_rows_are_told_apart_by_all_columns(spark):
    """Rows that differ only in a column that is not kept, or in where a NULL stands, are different rows."""
    rows = [("k", "a", None, 1), ("k", None, "a", 1), ("k", "a", None, 1), ("k", "a", "b", 1), ("k", "a", "b", 2), (None, None, None, None)]
    df = spark.createDataFrame(rows, "k string, x string, y string, n int")
    found = joins.dealt_narrow(df, "k", ("k",), {"x": quality.stand_in("x")})
    told = sorted(map(str, found.select("k", "x", "y", "n").collect()))
    expected = df.distinct().withColumn("x", quality.stand_in("x"))
    assert told == sorted(map(str, expected.collect())) and len(told) == 5


def test_only_rows_without_a_parent_are_compared_as_a_whole(spark, settings):
    """Copies are removed after the semi-join with the values that have no parent, however large the parent."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    child = spark.range(0, 4000, 1, 4).select((F.col("id") % 10).alias("k"), (F.col("id") % 400).alias("v"), F.lit(None).cast("long").alias("n"))
    child = child.unionByName(spark.range(3).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v"), F.lit(1).cast("long").alias("n")))
    found = quality.relationships(child.distinct(), "k", spark.range(2, 50).union(spark.range(3, 4)), "id")
    tree = found._jdf.queryExecution().executedPlan().toString()
    assert tree.index("LeftSemi") > tree.index("Exchange hashpartitioning(k#", tree.index("v#"))
    assert {tuple(r) for r in found.collect()} == {(0, 40), (1, 40)}


def test_regional_sales_sum_before_joining(spark):
    schema = "store_id string, region string"
    stores = spark.createDataFrame([("s", "N")], schema)
    tx = spark.range(0, 1000, 1, 4).select(
        F.lit("s").alias("store_id"), F.lit(1).alias("quantity_sold"), F.lit(2).alias("net_revenue")
    )
    result = marts.fct_regional_sales(tx, stores)
    tree = plan(result)
    assert tree.index("Join") < tree.index("HashAggregate", tree.index("Join"))
    assert tuple(result.first()) == ("N", 1000, 2000)


def test_views_build_each_table_once(spark):
    tables = views(spark, FOLDER)
    assert tables["stg_products"] is tables["stg_products"]
    assert tables.lookup("stg_products") is tables.lookup("stg_products")


def test_tasks_are_bounded_whatever_the_cluster_sets(spark, settings):
    """Large settings are lowered, smaller ones stay, and a shuffle is dealt finely however few partitions are set."""
    scanned, read = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    settings(files__maxPartitionBytes="128MB", adaptive__advisoryPartitionSizeInBytes="4m", shuffle__partitions="2")
    configure(spark)
    assert (spark.conf.get(scanned), spark.conf.get(read)) == (f"{16 << 20}b", "4m")
    settings(adaptive__advisoryPartitionSizeInBytes="8k", adaptive__coalescePartitions__minPartitionSize="1k")
    keys = spark.range(10_000).select(F.concat(F.lit("k"), "id").alias("k")).distinct()
    assert keys.select(F.spark_partition_id()).distinct().count() > 2


def test_the_given_tables_make_every_case(spark):
    """What the queries are compared on differs: counts to rank by, events without an id, each status."""
    tables = views(spark, FOLDER)
    out = tables["int_inventory_health"].filter("stock_status = 'Stock-Out'")
    counts = out.groupBy("product_id", "warehouse_id").count().select("count").distinct()
    assert counts.count() >= 3
    for name, key in (("stg_transactions", "transaction_id"), ("stg_shipments", "shipment_id")):
        assert tables[name].filter(F.col(key) == "UNKNOWN").count() > 10
    found = {r[0] for r in tables["int_transactions_enriched"].select("financial_status").distinct().collect()}
    assert {"Breakeven", "Loss"} <= found and len(found) >= 3
    assert tables["raw_transactions"].select("rds_extraction_date").distinct().count() > 100


def scans(df, table: str) -> int:
    text = plan(df)
    return sum(line.startswith("Location") and f"/{table}.parquet" in line for line in text.splitlines())


def test_suites_read_each_table_once(spark, settings):
    settings(exchange__reuse="false")
    assert scans(QUERIES["dq_staging"](spark, FOLDER), "lineitem") == 3
    assert scans(QUERIES["dq_marts"](spark, FOLDER), "lineitem") == 4


def test_lookups_are_measured_once(spark):
    lookup = spark.range(100).select(F.col("id").alias("k"))
    first = measured_size(lookup)
    assert measured_size(spark.range(100).select(F.col("id").alias("k"))) == first == (100, first[1])


def test_a_fact_that_counts_different_values_is_shuffled_once(spark, monkeypatch):
    """Unless one group would fill a task."""
    enriched = views(spark, FOLDER)["int_transactions_enriched"].localCheckpoint()
    keys = MODELS["fct_transactions"].grouped
    plain, dealt = marts.fct_transactions(enriched), marts.fct_transactions(joins.grouped(enriched, keys))
    assert plan(dealt).count(") Exchange") < plan(plain).count(") Exchange")
    as_rows = lambda df: sorted(map(str, df.collect()))
    assert as_rows(dealt) == as_rows(plain)
    monkeypatch.setattr(joins, "FEW_ROWS", 1)
    one = enriched.withColumns({k: F.lit("x") for k in keys})
    assert joins.grouped(one, keys) is one
    assert joins.grouped(enriched.limit(0), keys).count() == 0


@pytest.mark.parametrize("layer", ["staging", "marts"])
def test_large_tables_are_checked_one_after_another(spark, layer, monkeypatch, shuffle_files):
    """Beyond the broadcast bound no more than one table's shuffles are there at once; the results are the same."""
    expected = sorted(map(tuple, QUERIES[f"dq_{layer}"](spark, FOLDER).collect()))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    kept, left, run = shuffle_files(), [], quality.once
    monkeypatch.setattr(quality, "once", lambda df, purpose: (left.append(shuffle_files(gone=kept) - kept), run(df, purpose))[1])
    found = QUERIES[f"dq_{layer}"](spark, FOLDER)
    assert sorted(map(tuple, found.collect())) == expected
    assert left == [set()] * len({c.table for c in LAYERS[layer]})
