"""A whole run over catalog tables: first load, increment, late dimension, full refresh, gates."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stockyard.operators.quality import ChecksFailed
from stockyard.plans.adapter import Source
from stockyard.plans.layers import Run
from stockyard.operators import enrich, incremental, joins, quality
from stockyard.operators.incremental import without_key
from stockyard.plans import layers
from stockyard.plans.checks import LAYERS
from stockyard.plans.models import MODELS, Views
from stockyard.session import scratch_folders
from stockyard.sources import tables
from stockyard.sources.schemas import INCOMING

FOLDER, AS_OF = "/root/testdata/sf0.001", "2024-01-01"
CUT = "1999-01-01 00:00:00"
FACTS = ("transactions", "shipments", "inventory")


@pytest.fixture(scope="module")
def source(spark):
    return Source(spark, FOLDER)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def up_to(source, cut):
    def raw(name):
        df = source.raw(name)
        return df.filter(F.col("ingestion_date") <= F.lit(cut).cast("timestamp_ntz")) if name in FACTS else df

    return raw


def run(spark, raw, month, **options):
    job = Run(spark, raw, AS_OF, datetime(2024, month, 1), enforce=False, buckets=4, **options)
    return job, job.run()


def test_runs(spark, source, monkeypatch):
    names = ("fct_transactions", "fct_regional_sales", "fct_warehouse_efficiency", "fct_inventory",
             "dim_products", "dim_stores")
    job, tables = run(spark, up_to(source, CUT), 1)
    lazy = Views(up_to(source, CUT), AS_OF)
    for name in names[:3]:
        assert rows(tables[name]) == rows(lazy[name]), name
    assert {layer: r.count() for layer, r in job.results.items()} == {
        "staging": 120, "intermediate": 107, "marts": 88,
    }
    assert tables["history_products"].filter("valid_to IS NOT NULL").count() == 0

    monkeypatch.setattr(Run, "check", lambda self, layer: None)
    # The rest of the facts, and a product whose brand changed.
    def later(name):
        df = source.raw(name)
        if name == "products":
            first = F.lower(F.trim("product_id")) == "prod-000000000007"
            df = df.withColumn("brand", F.when(first, "New").otherwise(F.col("brand")))
        return df

    job, tables = run(spark, later, 2)
    full = Views(later, AS_OF)
    assert rows(tables["stg_shipments"]) == rows(full["stg_shipments"])
    for name in ("fct_regional_sales", "fct_warehouse_efficiency", "dim_products", "dim_stores"):
        assert rows(tables[name]) == rows(full[name]), name
    changed = tables["history_products"].filter("product_id = 'PROD-000000000007'")
    assert sorted((r.brand == "New", r.valid_to) for r in changed.collect()) == [
        (False, datetime(2024, 2, 1)), (True, None),
    ]
    # Sales enriched before the change keep the old brand until a full refresh.
    brands = tables["int_transactions_enriched"].filter("product_id = 'PROD-000000000007'")
    assert {r.brand == "New" for r in brands.collect()} == {True, False}

    before = rows(job.tables["int_transactions_enriched"])
    job.build("intermediate")
    assert rows(job.tables["int_transactions_enriched"]) == before
    job.full_refresh = True
    job.build("intermediate")
    assert rows(job.tables["int_transactions_enriched"]) == rows(full["int_transactions_enriched"])


def test_failed_checks_stop_the_run(spark, source):
    job = Run(spark, source.raw, AS_OF, datetime(2024, 5, 1), buckets=4)
    with pytest.raises(ChecksFailed) as failed:
        job.run()
    assert "dim_products" not in job.tables
    assert any(kind == "relationships" for _, _, kind, _ in failed.value.failures)


def test_scratch_and_shuffles_are_gone_with_the_step_that_needs_them(spark, source, shuffle_files):
    """First load, upsert, full refresh and mart; of the tables' files none are larger than they need be."""
    kept, scratch = shuffle_files(), set(scratch_folders())
    for cut in (CUT, "2100-01-01"):
        job = Run(spark, up_to(source, cut), AS_OF, datetime(2024, 1, 1), buckets=4, prefix="brief_", enforce=False)
        job.make("stg_products", "stg_transactions", "int_transactions_enriched")
    job.full_refresh = True
    table = job.make("int_transactions_enriched", "fct_transactions")
    assert set(scratch_folders()) == scratch
    assert not shuffle_files(gone=kept) - kept
    assert all(f.endswith(".zstd.parquet") for f in [*table.inputFiles(), *job.tables["stg_transactions"].inputFiles()])


@pytest.mark.parametrize("few", [10_000, 1])
def test_published_rows_are_reduced_in_the_shuffle_that_deals_them(spark, few, monkeypatch):
    """Copies, older rows of a key and rows without one; also where a key fills too much of the batch."""
    name, seen, put = f"parts.reduced_{few}", [], tables._create
    monkeypatch.setattr(joins, "FEW_ROWS", few)
    monkeypatch.setattr(tables, "_create", lambda rows, *args, **named: (seen.append(rows), put(rows, *args, **named))[1])
    batch = sales(spark, [(f"k{i % 50}", i, i % 7 + 1) for i in range(300)] + [("hot", 1, d % 3 + 1) for d in range(300)]
                  + [(None, i % 20, 1) for i in range(60)] + [("?", i % 30, 1) for i in range(60)])
    keyless = without_key(batch, ["k"], {"k": "?"})
    tables.publish(batch, name, ["k"], 8, "ingestion_date", keyless, order=["ingestion_date"])
    assert rows(tables.read_table(spark, name)) == rows(incremental.reduced(batch, ["k"], ["ingestion_date"], keyless))
    assert spark.table(name).groupBy("k").agg(F.countDistinct("_part").alias("n")).filter("k LIKE 'k%' AND n > 1").isEmpty()
    plan = seen[0]._jdf.queryExecution().toString()
    assert ("REBALANCE" in plan) == (few == 1)
    assert tables.published_mark(spark, name) == rows(batch.agg(F.max(F.col("ingestion_date").cast("string"))))[0][0]


def test_written_tables_are_judged_while_they_are_written(spark, source, monkeypatch):
    """The row checks of a mart's tables need no pass; the counts are those of one."""
    job = Run(spark, source.raw, AS_OF, datetime(2024, 1, 1), buckets=2, prefix="judged_", enforce=False)
    job.make("stg_products", "stg_stores", "dim_products", "dim_stores")
    names = ("dim_products", "dim_stores")
    checks = [c for c in LAYERS["marts"] if c.table in names]
    by_row = [c for c in checks if c.kind not in quality.BY_VALUE]
    assert set(job._judged) == set(by_row) and len(by_row) >= 8
    passes = quality.run_suite({n: job.tables[n] for n in names}, by_row)
    assert rows(passes) == rows(quality.known_results(spark, job._judged))
    monkeypatch.setitem(layers.LAYERS, "marts", checks)
    asked, run_all = [], layers.run_suite
    monkeypatch.setattr(layers, "run_suite", lambda t, c, p: (asked.extend(c), run_all(t, c, p))[1])
    job.check("marts")
    assert all(c.kind in quality.BY_VALUE for c in asked) and job.results["marts"].count() == len(checks)
    parents = {n: job.tables[f"raw_{n}"] for n in INCOMING}
    assert rows(job.results["marts"]) == rows(quality.run_suite(job.tables, checks, parents))


KEYED = "k string, v int, ingestion_date timestamp_ntz"


def sales(spark, values):
    return spark.createDataFrame([(k, v, datetime(2024, 1, d)) for k, v, d in values], KEYED)


def part_files(spark, name):
    read = spark.table(name).select(tables.PART, F.col("_metadata.file_path").alias("f")).distinct()
    return {(r[tables.PART], r.f) for r in read.collect()}


def held(spark, name):
    return {r.k: r.v for r in tables.read_table(spark, name).collect()}


def test_an_upsert_rewrites_only_parts_that_hold_its_keys(spark):
    """New keys in a range that the table covers rewrite nothing, by the filters; replaced ones their parts."""
    name, n = "parts.upserted", 6000
    tables.publish(sales(spark, [(f"k{2 * i:06}", i, 1) for i in range(n)]), name, ["k"], 300, "ingestion_date")
    before = part_files(spark, name)
    assert len(before) == 300
    new = sales(spark, [(f"k{2 * i + 1:06}", -i, 2) for i in range(0, n, 100)])
    tables.upsert_into(new, name, ["k"], ["ingestion_date"])
    after = part_files(spark, name)
    assert before < after and len({p for p, _ in after - before}) == 1
    assert tables.published_mark(spark, name).startswith("2024-01-02")
    some = sales(spark, [("k000002", 900, 3), ("k000002", 901, 4), ("k000201", 902, 3), ("k000103", 903, 3), ("zz", 904, 3)])
    tables.upsert_into(some, name, ["k"], ["ingestion_date"])
    last = part_files(spark, name)
    assert len({p for p, _ in before - last}) == 1 and len(last - after) == 3 and len(after - last) == 2
    found = held(spark, name)
    assert (found["k000002"], found["k000201"], found["k000103"], found["zz"]) == (901, 902, 903, 904)
    assert tables.read_table(spark, name).count() == len(found) == n + n // 100 + 2
    assert tables.published_mark(spark, name).startswith("2024-01-04")


def test_filters_lose_no_key(spark):
    rows = sales(spark, [(f"k{i}", i, 1) for i in range(3000)])
    tables.publish(rows, "parts.filtered", ["k"], 16, "ingestion_date")
    parts, found = tables.parts_with(spark, "parts.filtered", rows.filter("v % 7 = 0"), ["k"])
    assert len(parts) == 16 and found.count() == 429
    nobody = sales(spark, [(f"k{i}x", i, 1) for i in range(2000)])
    words = int(spark.sql("SHOW TBLPROPERTIES parts.filtered ('words')").first().value)
    asked = nobody.select(joins.filter_word(["k"], words), joins.filter_mask(["k"]))
    sketch = spark.table("parts.filtered__sketch").filter("word >= 0")
    assert sketch.join(asked, "word").filter("bits & mask = mask").count() < 60


def test_partitions_without_a_sketch_are_sketched_first(spark):
    """A writer that died between its rows and their sketch: the mark and the keys are found all the same."""
    name = "parts.unsketched"
    tables.publish(sales(spark, [("a", 1, 1)]), name, ["k"], 4, "ingestion_date")
    tables._put(sales(spark, [("b", 2, 5)]).withColumn(tables.PART, F.lit("n-dead")), name)
    assert tables.published_mark(spark, name).startswith("2024-01-05")
    tables.upsert_into(sales(spark, [("b", 3, 6)]), name, ["k"], ["ingestion_date"])
    assert held(spark, name) == {"a": 1, "b": 3}


def test_two_writers(spark):
    """Additions at the same time are all kept; a second writer that replaces rows fails and changes nothing."""
    name = "parts.contended"
    tables.publish(sales(spark, [(f"k{i}", i, 1) for i in range(100)]), name, ["k"], 4, "ingestion_date")
    batches = [sales(spark, [(f"{w}{i}", i, 2) for i in range(20)]) for w in "abc"]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda b: tables.append(b, name), batches))
    assert len(held(spark, name)) == 160
    change = sales(spark, [("k1", 1000, 3)])
    with tables.alone(spark, name):
        tables.append(sales(spark, [("d", 1, 3)]), name)
        for write in (
            lambda: tables.upsert_into(change, name, ["k"], ["ingestion_date"]),
            lambda: tables.publish(change, name, ["k"]),
            lambda: tables.replace_keys(change, name, ["k"], change),
        ):
            with pytest.raises(tables.TableInUse):
                write()
    assert len(held(spark, name)) == 161 and held(spark, name)["k1"] == 1
    tables.upsert_into(change, name, ["k"], ["ingestion_date"])
    assert held(spark, name)["k1"] == 1000
    # The lock of a writer that died is removed by hand.
    path, files = tables._lock(spark, name)
    files.create(path, False).close()
    with pytest.raises(tables.TableInUse):
        tables.write_table(change, name)
    tables.release(spark, name)
    tables.compact(spark, name)
    assert len(held(spark, name)) == 161 and all(p[0] != tables.ADDED for p in tables.parts_of(spark, name))


def test_writing_goes_on_after_a_job_died(spark):
    """A failed write leaves the table as it was and nothing in the way of the next one."""
    name = "parts.crashed"
    tables.publish(sales(spark, [("a", 1, 1)]), name, ["k"], 4, "ingestion_date")
    broken = sales(spark, [("a", 2, 2)]).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    for write in (
        lambda: tables.publish(broken, name, ["k"], 4), lambda: tables.write_table(broken, name),
        lambda: tables.append(broken, name), lambda: tables.upsert_into(broken, name, ["k"], ["ingestion_date"]),
    ):
        with pytest.raises(Exception, match="broken"):
            write()
        assert held(spark, name) == {"a": 1}
    tables.publish(sales(spark, [("b", 2, 2)]), name, ["k"], 4, "ingestion_date")
    assert held(spark, name) == {"b": 2}
    tables.write_table(sales(spark, []), "parts.empty")
    assert held(spark, "parts.empty") == {} and spark.table("parts.empty").columns == ["k", "v", "ingestion_date"]


def test_new_columns_are_taken_in(spark):
    name = "parts.widened"
    tables.publish(sales(spark, [("a", 1, 1), ("b", 2, 1)]), name, ["k"], 4, "ingestion_date")
    tables.append(sales(spark, [("c", 3, 2)]).withColumn("brand", F.lit("x")), name)
    tables.upsert_into(sales(spark, [("a", 5, 3)]).withColumn("brand", F.lit("y")), name, ["k"], ["ingestion_date"])
    tables.append(sales(spark, [("d", 4, 4)]), name)
    found = {r.k: (r.v, r.brand) for r in tables.read_table(spark, name).collect()}
    assert found == {"a": (5, "y"), "b": (2, None), "c": (3, "x"), "d": (4, None)}


def test_rows_of_stale_keys_are_replaced(spark):
    """Keys may be NULL or repeated; a partition that loses all its rows goes."""
    name = "parts.stale"
    tables.publish(sales(spark, [("a", 1, 1), ("b", 2, 1), (None, 3, 1), (None, 4, 1)]), name, ["k"], 1, "ingestion_date")
    tables.append(sales(spark, [("c", 5, 2)]), name)
    stale = spark.createDataFrame([("a",), (None,), ("c",)], "k string")
    tables.replace_keys(sales(spark, [("a", 9, 1), (None, 8, 1)]), name, ["k"], stale)
    assert sorted((r.k or "", r.v) for r in tables.read_table(spark, name).collect()) == [("", 8), ("a", 9), ("b", 2)]
    assert len(tables.parts_of(spark, name)) == 2
    unknown = spark.createDataFrame([(None,)], "k string")
    tables.replace_keys(sales(spark, [(None, 7, 1)]), name, ["k"], unknown)
    tables.replace_keys(sales(spark, []), name, ["k"], unknown.filter("k = 'x'"))
    tables.publish(sales(spark, [("x", 1, 1), ("y", 1, 1)]), "parts.gone", ["k"], 1, "ingestion_date")
    tables.replace_keys(sales(spark, []), "parts.gone", ["k"], spark.createDataFrame([("x",), ("y",)], "k string"))
    assert tables.read_table(spark, "parts.gone").count() == 0 and tables.parts_of(spark, "parts.gone") == []
    tables.upsert_into(sales(spark, [("z", 1, 2)]), "parts.gone", ["k"], ["ingestion_date"])
    assert held(spark, "parts.gone") == {"z": 1}
    assert sorted((r.k or "", r.v) for r in tables.read_table(spark, name).collect()) == [("", 7), ("a", 9), ("b", 2)]


def test_closed_versions_stay_where_they_are(spark):
    name, closed = "parts.history", F.col("v") > 0
    tables.publish_history(sales(spark, [("a", 0, 1), ("b", 5, 1)]), name, closed)
    before = {f for p, f in part_files(spark, name) if p != tables.OPEN}
    assert [r.k for r in tables.open_rows(spark, name).collect()] == ["a"]
    tables.publish_history(sales(spark, [("a", 7, 2), ("a", 0, 2)]), name, closed)
    after = {f for p, f in part_files(spark, name) if p != tables.OPEN}
    assert before < after
    assert sorted(r.v for r in spark.table(name).collect()) == [0, 5, 7]
    tables.publish_history(sales(spark, [("a", 9, 3)]), name, closed)
    assert tables.open_rows(spark, name).count() == 0 and spark.table(name).count() == 3
    tables.publish_history(sales(spark, []), name, closed)
    assert spark.table(name).count() == 3
    seen, checks = Observation(), [quality.Check("t", "k", "not_null")]
    tables.write_table(quality.observed(sales(spark, []).filter("v > rand()"), checks, seen), "parts.none")
    assert quality.observed_failures(checks, seen) == {checks[0]: 0}


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_facts_and_large_lookups_join_where_they_lie(spark, source, monkeypatch):
    """Beyond the broadcast bound, no exchange on either side; the rows are those of any other run."""
    monkeypatch.setattr(Run, "check", lambda self, layer: None)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for cut in (CUT, "2100-01-01"):
            job = Run(spark, up_to(source, cut), AS_OF, datetime(2024, 1, 1), buckets=2, prefix="dealt_", clusters=4)
            job.make("stg_products", "stg_transactions")
            facts, products = job.tables["stg_transactions"], job._lookup("stg_products")
            assert exchanges(enrich.transactions_enriched(facts, products)) == 0
            assert exchanges(incremental.latest_by_key(facts, ["product_id", "store_id"], ["ingestion_date"])) == 0
            assert exchanges(enrich.transactions_enriched(facts, job.tables["stg_products"])) > 0
            found = job.make("int_transactions_enriched")
        full = Views(source.raw, AS_OF)
        assert rows(found) == rows(full["int_transactions_enriched"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_key_is_not_clustered(spark):
    hot = sales(spark, [("hot" if i % 3 else f"k{i}", i, 1) for i in range(300)])
    assert not tables.even(hot, ("k", 16)) and tables.even(hot, ("v", 16))
    assert not tables.write_clustered(hot, "parts.hot", ("k", 16))
    assert tables.read_table(spark, "parts.hot") is None
    tables.publish(hot, "parts.hot", ["v"], 2, "ingestion_date", cluster=("k", 16))
    assert tables._cluster_of(spark, "parts.hot") is None and spark.table("parts.hot").count() == 300


def test_late_dimensions_change_what_a_full_refresh_changes(spark, source, monkeypatch):
    """A product and a store that come late, one that changes, one that goes: no rebuild, same rows."""
    monkeypatch.setattr(Run, "check", lambda self, layer: None)
    rewritten = []

    def raw(late):
        def table(name):
            df = up_to(source, CUT)(name)
            if name == "products":
                key = F.upper(F.trim("product_id"))
                df = df.filter(key != ("PROD-000000000009" if late else "PROD-000000000011"))
                changed = (key == "PROD-000000000007") & F.lit(late)
                df = df.withColumn("product_name", F.when(changed, "New name").otherwise(F.col("product_name")))
            if name == "stores" and not late:
                df = df.filter(F.upper("store_id") != "STORE-000000000004")
            return df

        return table

    names = [m.name for m in MODELS.values() if m.layer == "intermediate" and m.kept == "incremental"]
    staging = [m.name for m in MODELS.values() if m.layer == "staging"]
    for late in (False, True):
        job = Run(spark, raw(late), AS_OF, datetime(2024, 1, 1), buckets=4, prefix="late_", late_dimensions=True)
        if late:
            replace = layers.replace_keys
            monkeypatch.setattr(layers, "replace_keys", lambda r, n, k, s: (rewritten.append((n, s.count())), replace(r, n, k, s)))
        job.make(*staging, *names)
    facts = job.tables["stg_transactions"].count()
    assert {n.split(".")[1] for n, _ in rewritten} == set(names)
    assert all(0 < n < facts / 5 for name, n in rewritten if "transactions" in name)
    found = {name: rows(job.tables[name]) for name in names}
    rewritten.clear()
    job.make(names[1])
    assert not rewritten
    job.full_refresh = True
    job.make(*names)
    for name in names:
        assert found[name] == rows(job.tables[name]), name


def test_rows_with_an_unknown_id_all_stay(spark, source, monkeypatch):
    """Sales without an id are different sales: none replaces another, in the first load or later."""
    def raw(cut):
        def table(name):
            df = up_to(source, cut)(name)
            unknown = F.col("transaction_id").like("1%")
            return df.withColumn("transaction_id", F.when(~unknown, F.col("transaction_id"))) if name == "transactions" else df

        return table

    full = Views(raw("2100-01-01"), AS_OF)["stg_transactions"]
    lost = full.filter("transaction_id = 'UNKNOWN'").count()
    assert lost > 100
    for cut in (CUT, "2100-01-01"):
        job = Run(spark, raw(cut), AS_OF, datetime(2024, 1, 1), enforce=False, buckets=4, prefix="unknown_")
        staged = job.make("stg_transactions")
    assert staged.filter("transaction_id = 'UNKNOWN'").count() == lost
    assert rows(staged) == rows(full)
    keyless = without_key(full, ["transaction_id"], {"transaction_id": "UNKNOWN"})
    assert full.filter(keyless).count() == lost
