"""History over many loads, as-of merge, heavy-hitter sketch, runtime bloom
filter, bucketed staging, seeds by name, freshness from footers, bitmaps,
filled series, checks on stored marts, scratch folders."""

import datetime as dt
import os
import random
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from closebook import session
from closebook.config import MartConfig
from closebook.functions.columns import ntz
from closebook.operators import bitmaps, skew, snapshot
from closebook.plans import catalog, checks, refresh, sales, staging
from closebook.plans.models import Marts
from closebook.sources import files, sinks
from closebook.sources.tpch import RawFeeds
from fixture_feeds import feeds

KEY, CHECK = "customer_id", ("segment", "city")
EXTRACT = "load_no int, load_ts timestamp_ntz, customer_id string, segment string, city string, email string"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan: str, column: str) -> int:
    return sum(column in s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan))


@pytest.fixture
def conf(spark):
    """Sets Spark settings for one test."""
    before = {}

    def put(**settings):
        for k, v in settings.items():
            k = k.replace("__", ".")
            before.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ------------------------------------------------------------------- history
def loads_of(n, customers=12, seed=1, empty=()):
    """(loads, rows): customers come, change, vanish and return over n loads."""
    rng = random.Random(seed)
    now, rows, loads = {}, [], []
    for i in range(n):
        ts = dt.datetime(2020, 1, 1) + dt.timedelta(days=3 * i)
        loads.append((i + 1, ts))
        for c in range(customers):
            if rng.random() < 0.05 or c not in now:
                now[c] = [rng.choice("abc"), rng.choice(["x", "y", None]), f"{c}-{i}"]
            if rng.random() < 0.1:
                now[c][2] = f"{c}-{i}"  # not a checked column
        there = [c for c in range(customers) if rng.random() > 0.08]
        rows += [(i + 1, ts, f"C{c}", *now[c]) for c in there if i not in empty]
    return loads, rows


def plainly(loads, rows, hard):
    """The fold in plain Python: (key, valid_from, valid_to, data) of each version."""
    current, done = {}, []
    for no, ts in loads:
        extract = {r[2]: r[2:] for r in rows if r[0] == no}
        for key in list(current):
            if key in extract and extract[key][1:3] != current[key][1][1:3] \
                    or key not in extract and hard:
                start, data = current.pop(key)
                done.append((key, start, ts, *data[1:]))
        for key, data in extract.items():
            current.setdefault(key, (ts, data))
    return sorted(map(repr, done + [(k, s, None, *d[1:]) for k, (s, d) in current.items()]))


def folded(spark, loads, rows, hard):
    """The stored-version fold: each load applied to the version read back."""
    snap, schema = None, EXTRACT.split(", ", 2)[2]
    for no, ts in loads:
        extract = spark.createDataFrame([r[2:] for r in rows if r[0] == no], schema).coalesce(1)
        snap = snapshot.snapshot_apply(snap, extract, KEY, CHECK, ts, hard)
        # Stored: the next step reads rows, not the plan that made them.
        snap = spark.createDataFrame(snap.collect(), snap.schema).coalesce(1)
    return sorted(map(repr, snap.collect()))


@pytest.mark.parametrize("n,hard,empty,stored", [
    (200, True, (17, 18), False), (200, False, (3,), False), (1, True, (), True),
    (9, True, (4, 5), True), (9, False, (4,), True)])
def test_history_in_one_pass_equals_the_fold(spark, conf, n, hard, empty, stored):
    conf(spark__sql__shuffle__partitions="1")
    loads, rows = loads_of(n, customers=40, empty=empty)
    got = snapshot.history_of(spark.createDataFrame(rows, EXTRACT).drop("load_ts"),
                              spark.createDataFrame(loads, "load_no int, load_ts timestamp_ntz"),
                              KEY, CHECK, hard)
    plan = plan_of(got)  # as long for 200 loads as for one
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id", plan)) <= 1
    assert plan.count("Window [") <= 6
    out = got.collect()
    if stored:
        assert sorted(map(repr, out)) == folded(spark, loads, rows, hard)
    assert sorted(repr((r[KEY], r["valid_from"], r["valid_to"], r["segment"], r["city"], r["email"]))
                  for r in out) == plainly(loads, rows, hard)


def test_history_reads_customers_once(spark, small_sf):
    plan = plan_of(catalog.QUERIES["customer_history"](spark, small_sf))
    assert scans(plan, "c_custkey") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id", plan)) == 1
    as_of = plan_of(catalog.QUERIES["segment_at_purchase"](spark, small_sf))
    assert scans(as_of, "c_custkey") == 1 and "Nested" not in as_of


# ---------------------------------------------------------------- as-of merge
def purchases(spark, n):
    """Orders of which one customer has a third, half of those on one day."""
    day = F.when(F.col("id") % 6 == 0, F.lit(700)).otherwise((F.col("id") * 7919) % 1500).cast("int")
    return spark.range(n).select(
        F.concat(F.lit("O"), "id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, "BIG").when(F.col("id") % 97 == 1, None).otherwise(
            F.concat(F.lit("C"), F.col("id") % 50)).alias("customer_id"),
        F.when(F.col("id") % 89 != 1, F.date_add(F.lit(dt.date(2020, 1, 1)), day)).alias("d"))


def versions(spark):
    loads, rows = loads_of(60, customers=45, seed=4)
    rows += [(n, ts, "BIG", "abc"[n // 7 % 3], "x", "") for n, ts in loads if n % 11]
    return snapshot.history_of(spark.createDataFrame(rows, EXTRACT).drop("load_ts"),
                               spark.createDataFrame(loads, "load_no int, load_ts timestamp_ntz"),
                               KEY, CHECK).cache()


@pytest.mark.parametrize("per_task", [10 ** 9, 500, 60])
def test_as_of_merge_equals_the_range_join(spark, per_task):
    facts, history = purchases(spark, 6000), versions(spark)
    want = snapshot.as_of_join(facts, history, KEY, F.col("d"), ["segment", "city"])
    hot = skew.hot_keys(skew.sketch(facts, KEY), per_task)
    assert per_task > 6000 or hot[0][0] == "BIG"
    cuts = snapshot.time_cuts(facts, KEY, F.col("d"), "order_id", hot)
    got = snapshot.as_of_merge(facts, history, KEY, F.col("d"), ["segment", "city"], cuts, "order_id")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.where("segment IS NOT NULL").count() > 3000


def test_a_hot_customer_is_divided_by_time(spark, conf):
    """A third of the orders belong to one customer, half of those to one day."""
    conf(spark__sql__shuffle__partitions="8", spark__sql__adaptive__enabled="false")
    facts, history = purchases(spark, 60_000), versions(spark)
    cuts = snapshot.time_cuts(facts, KEY, F.col("d"), "order_id", [("BIG", 64)])
    row, = cuts.collect()
    assert row["_cut_key"] == "BIG" and len(row["_cuts"]) == 63
    assert row["_cuts"] == sorted(row["_cuts"]) and len(set(row["_cuts"])) == 63
    got = snapshot.as_of_merge(facts, history, KEY, F.col("d"), ["segment"], cuts, "order_id")

    def rows_by_task(df):
        per = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max("segment"))
        return [r["n"] for r in per.collect()]

    sizes = rows_by_task(got)
    assert len(sizes) == 8 and sum(sizes) == 60_000 and max(sizes) <= 2 * 60_000 / 8
    lone = rows_by_task(snapshot.as_of_merge(facts, history, KEY, F.col("d"), ["segment"]))
    assert max(lone) > 2 * 60_000 / 8  # what the cuts are for


# --------------------------------------------------------------------- sketch
def test_sketch_lists_every_hot_key(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") < 20_000, "hot").when(F.col("id") < 24_000, "warm")
        .when(F.col("id") < 24_500, None).otherwise(F.col("id").cast("string")).alias("k"))
    sketches = skew.sketch(rows, "k")
    assert skew.hot_keys(sketches, 3) == [("hot", 6667), ("warm", 1334)]  # no cap on the parts
    assert skew.hot_keys(sketches, 5000) == [("hot", 4)]
    assert skew.hot_keys(sketches, 10 ** 6) == []
    # Sketches of two loads merge: a key may be hot in their sum only.
    assert skew.hot_keys(sketches.unionAll(sketches), 30_000) == [("hot", 2)]
    few = skew.hot_keys(skew.sketch(rows, "k", tracked=16, parts=2), 5000, tracked=16)
    assert [k for k, _ in few] == ["hot"]  # also from sketches far too small to hold all keys
    assert skew.hot_keys(skew.sketch(rows.limit(0), "k"), 1) == []


def test_salted_joins_keep_their_meaning(spark):
    big = spark.createDataFrame([("a", f"r{i}") for i in range(30)] + [("b", "s"), ("x", "t"),
                                (None, "u"), (None, "v")], "k string, id string")
    small = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, n int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(repr, big.join(small, "k", how).collect()))
        for hot in ([], [("a", 7)], [("a", 3), ("x", 2), ("nowhere", 5)]):
            got = skew.salted_join(big, small, "k", hot, "id", how)
            assert sorted(map(repr, got.collect())) == want, (how, hot)


def test_stored_feeds_bring_their_sketch(spark, tmp_path):
    base = files.write_feeds(feeds(spark), str(tmp_path / "feeds"),
                             ("orders", "order_items", "customers", "products", "gl_entries",
                              "chart_of_accounts", "budgets"))
    stored = files.StoredFeeds(spark, base)
    assert stored.order_line_sketch.count() > 0
    assert getattr(stored, "customer_extracts", None) is None
    m = Marts(stored, MartConfig(rows_per_join_task=1))
    lazy = Marts(feeds(spark), MartConfig(rows_per_join_task=1))
    # Stored sketches count the raw lines, staged or not: a few more keys at most.
    assert set(m.hot_orders) >= set(lazy.hot_orders) != set()
    assert sorted(map(repr, m.completed_order_items.collect())) == sorted(
        map(repr, lazy.completed_order_items.collect()))


# ------------------------------------------------- bloom filter, buckets, store
def stages(node, kind):
    """Nodes of a final plan whose name starts with ``kind``."""
    found = [node] if node.nodeName().startswith(kind) else []
    children = node.children()
    nested = [children.apply(i) for i in range(children.size())]
    if "QueryStage" in node.nodeName():
        nested.append(node.plan())
    if node.nodeName().startswith("AdaptiveSparkPlan"):
        nested.append(node.executedPlan())
    return found + [x for n in nested for x in stages(n, kind)]


def test_bloom_filter_stands_before_the_line_shuffle(spark, conf, tmp_path):
    """Two thirds of the orders are open: their lines do not reach the shuffle."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="1KB")
    raw = RawFeeds(spark, "/root/testdata/sf0.01")
    m = Marts(raw)
    m.use("stg_products", sinks.stored(m.stg_products, str(tmp_path / "p")))
    open_orders = m.stg_orders.withColumn("order_status", F.when(
        F.xxhash64("order_id") % 3 != 0, "pending").otherwise(F.col("order_status")))
    m.use("stg_order_items", sinks.stored(m.stg_order_items, str(tmp_path / "i")))
    m.use("stg_orders", open_orders)
    refresh.store_staging(m, str(tmp_path))
    fact = m.completed_order_items
    rows = fact.count()
    conf(spark__sql__optimizer__runtime__bloomFilter__enabled="false")
    plain = Marts(raw)
    plain.use("stg_orders", open_orders)
    assert sorted(map(repr, fact.select("order_item_id", "order_total_revenue").collect())) == sorted(
        map(repr, plain.completed_order_items.select("order_item_id", "order_total_revenue").collect()))
    conf(spark__sql__optimizer__runtime__bloomFilter__enabled="true")
    run = fact.groupBy().agg(F.count("order_item_sk"), F.sum("revenue"), F.max("sku"))
    assert "might_contain" in run._jdf.queryExecution().optimizedPlan().toString()
    query = run._jdf.queryExecution()
    query.executedPlan().executeCollect()
    # Of the filtered exchanges (lines and their sums) that of the lines has most rows.
    shuffled = [n.metrics().apply("shuffleRecordsWritten").value()
                for n in stages(query.executedPlan(), "Exchange") if "might_contain" in n.toString()]
    assert rows < m.stg_order_items.count() / 2
    assert len(shuffled) > 1 and rows <= max(shuffled) <= 1.02 * rows


def test_bucketed_staging_joins_lines_without_a_shuffle(spark, conf, tmp_path):
    conf(spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__autoBroadcastJoinThreshold="100KB")
    raw = RawFeeds(spark, "/root/testdata/sf0.001")
    m, out = Marts(raw), str(tmp_path / "m")
    refresh.store_staging(m, out, buckets=4)
    plan = plan_of(m.completed_order_items)
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" in plan
    assert "Bucketed: true" in plan and plan.count("SelectedBucketsCount") >= 3
    paths = refresh.refresh(spark, raw, out, ["completed_order_items"], buckets=4)
    got = spark.read.parquet(paths["completed_order_items"])
    want = Marts(raw).completed_order_items
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    # Very large orders would each fill a bucket: then the tables are plain.
    hot = Marts(raw, MartConfig(rows_per_join_task=5))
    refresh.store_staging(hot, str(tmp_path / "h"), buckets=4)
    assert hot.hot_orders and "Bucketed: true" not in plan_of(hot.completed_order_items)


def test_checks_make_the_fact_once(spark, small_sf):
    # What is left are the checks of the raw lines and of the ledger derived from them.
    for name, most in (("dq_relationships", 2), ("dq_summary", 3)):
        plan = plan_of(catalog.QUERIES[name](spark, small_sf))
        assert scans(plan, "l_partkey") <= most, name


def test_fact_plan_budget(spark, small_sf):
    for name, scanned, shuffles in (("completed_order_items", 2, 4), ("order_line_economics", 1, 4),
                                    ("unrecognised_revenue_check", 2, 5)):
        plan = plan_of(catalog.QUERIES[name](spark, small_sf))
        assert scans(plan, "l_orderkey") <= scanned, name
        assert len(re.findall("Exchange hashpartitioning", plan)) <= shuffles, name


# ------------------------------------------------------------------- seeds, S8
HEAD = "budget_id,account_code,fiscal_year,month_number,budgeted_amount,currency,_loaded_at"
ROWS = ["B1,REV_TOTAL,2024,1,100.50,usd,2024-01-01 00:00:00",
        "B2,REV_TOTAL,2024,2,,usd,2024-01-01 00:00:00"]


def seed(tmp_path, lines, name="raw_budgets.csv"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_seed_columns_are_bound_by_name(spark, tmp_path):
    plain = files.read_csv_seed(spark, "budgets", seed(tmp_path, [HEAD, *ROWS]))
    turned = [",".join([r.split(",")[1], "more", *r.split(",")[::-1][:5], r.split(",")[0]])
              for r in [HEAD, *ROWS]]
    other = files.read_csv_seed(spark, "budgets", seed(tmp_path, turned, "turned.csv"))
    assert other.schema == plain.schema == files.RAW_SCHEMAS["budgets"]
    assert sorted(map(repr, other.collect())) == sorted(map(repr, plain.collect()))
    assert other.select("budget_id").where("budget_id = 'B1'").count() == 1


@pytest.mark.parametrize("head", [HEAD.replace("currency", "money"),
                                  HEAD.replace("currency", "budget_id"), "budget_id"])
def test_seed_header_must_have_the_declared_columns(spark, tmp_path, head):
    with pytest.raises(ValueError, match="header"):
        files.read_csv_seed(spark, "budgets", seed(tmp_path, [head, *ROWS]))


def test_files_of_a_seed_share_their_header(spark, tmp_path):
    (tmp_path / "s").mkdir()
    seed(tmp_path / "s", [HEAD, ROWS[0]], "1.csv")
    swapped = HEAD.replace("budget_id,account_code", "account_code,budget_id")
    seed(tmp_path / "s", [swapped, "REV_TOTAL" + ROWS[1][2:]], "2.csv")
    with pytest.raises(Exception):
        files.read_csv_seed(spark, "budgets", str(tmp_path / "s")).collect()


def test_bad_rows_fail_by_any_column_or_are_kept_aside(spark, tmp_path):
    bad = ["B3,REV_TOTAL,2024,three,1.00,usd,2024-01-01 00:00:00",
           "B4,REV_TOTAL,2024,4,1.00,usd,yesterday", "B5,REV_TOTAL"]
    path = seed(tmp_path, [HEAD, *ROWS, *bad])
    with pytest.raises(Exception):  # by a column that is not asked for
        files.read_csv_seed(spark, "budgets", path).select("budget_id").collect()
    rejects = str(tmp_path / "rejects")
    good = files.read_csv_seed(spark, "budgets", path, rejects)
    assert sorted(r["budget_id"] for r in good.select("budget_id").collect()) == ["B1", "B2"]
    assert good.schema == files.RAW_SCHEMAS["budgets"]
    kept = sinks.read_table(spark, rejects)
    assert kept.count() == 3 and {r["line"] for r in kept.collect()} == set(bad)
    assert kept.first()["seed"] == "budgets" and "raw_budgets.csv" in kept.first()["file"]
    source = files.SourceCatalog({"raw_finance": str(tmp_path)}, "csv", str(tmp_path / "bad"))
    assert source.read(spark, "budgets").count() == 2
    assert sinks.read_table(spark, str(tmp_path / "bad" / "raw_budgets")).count() == 3


# ------------------------------------------------------------------- freshness
def test_freshness_of_stored_feeds_reads_footers_only(spark, tmp_path):
    base = files.write_feeds(feeds(spark), str(tmp_path / "f"), ("orders", "gl_entries"), files=3)
    stored, cfg = files.StoredFeeds(spark, base), MartConfig()
    v1 = spark.conf.get(files.V1_SOURCES)
    got = checks.freshness(stored, ntz(cfg.as_of), cfg)
    assert spark.conf.get(files.V1_SOURCES) == v1
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in text and text.count("max(_loaded_at)") >= 2
    want = checks.freshness(feeds(spark), ntz(cfg.as_of), cfg)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")
    try:
        assert stored.newest("orders").first()[0] == feeds(spark).orders.agg(
            F.max("_loaded_at")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# --------------------------------------------------------------------- bitmaps
def test_bitmap_counts_add_up(spark):
    rows = spark.range(200_000).select((F.col("id") % 40_000).cast("string").alias("who"),
                                       (F.col("id") % 7).alias("g"), (F.col("id") % 3).alias("h"))
    numbers = bitmaps.numbered(rows, "who").cache()
    assert numbers.select("number").distinct().count() == 40_000
    maps = bitmaps.key_bitmaps(rows.join(numbers, "who"), ["g", "h"])
    for keys in (["g", "h"], ["g"], ["h"], []):
        got = {tuple(r) for r in bitmaps.distinct_counts(maps, keys, "n").collect()}
        want = {tuple(r) for r in rows.groupBy(*keys).agg(F.count_distinct("who")).collect()}
        assert got == want


def test_customer_reach_agrees_with_the_monthly_mart(spark, small_sf):
    m = Marts(RawFeeds(spark, small_sf))
    reach = sales.customer_reach(m.customer_bitmaps)
    grain = ["order_month", "sales_channel", "region", "category"]
    cells = reach.where("level = 'cell'").withColumnRenamed("period", "order_month")
    mart = m.revenue_performance_monthly.select(*grain, F.col("total_customers").alias("customers"))
    assert cells.select(*grain, "customers").exceptAll(mart).count() == 0
    assert mart.exceptAll(cells.select(*grain, "customers")).count() == 0


# --------------------------------------------------------------- filled series
def test_a_gap_month_is_a_row_of_zeros(spark):
    m = Marts(feeds(spark))
    rows = sales.revenue_performance_filled(m.order_categories).orderBy("order_month").collect()
    series = {}
    for r in rows:
        series.setdefault((r["sales_channel"], r["region"], r["category"]), []).append(r)
    for months in series.values():
        first = months[0]["order_month"]
        assert [r["order_month"] for r in months] == [
            dt.date(first.year + (first.month - 1 + i) // 12, (first.month - 1 + i) % 12 + 1, 1)
            for i in range(len(months))]
        assert months[-1]["order_month"] == dt.date(2025, 4, 1) and not months[0]["is_filled"]
        for prev, r in zip(months, months[1:]):
            assert r["is_filled"] == (r["total_orders"] == 0)
            if prev["net_revenue"] and not r["net_revenue"]:
                assert r["mom_revenue_growth_pct"] == -1.0
            if not prev["net_revenue"]:
                assert r["mom_revenue_growth_pct"] is None
    assert any(r["is_filled"] for r in rows)
    base = m.revenue_performance_monthly.collect()
    assert {(r["order_month"], r["category"], r["net_revenue"]) for r in rows if not r["is_filled"]} \
        == {(r["order_month"], r["category"], r["net_revenue"]) for r in base}


# --------------------------------------------------- refunds, ledger warnings
def test_refunds_are_negative_lines_and_unbooked_ones_are_told(spark):
    m = Marts(feeds(spark))
    rows = {r["order_item_id"]: r for r in m.refund_items.collect()}
    assert rows and {r["order_id"] for r in rows.values()} == {"A4"}
    assert all(r["revenue"] < 0 and r["quantity"] < 0 and r["is_booked"] is not None
               for r in rows.values())
    quiet = Marts(SimpleNamespace(**{**vars(feeds(spark)), "gl_entries": feeds(spark).gl_entries.where(
        "reference_id IS NULL OR reference_id <> 'A4'")}))
    assert not any(r["is_booked"] for r in quiet.refund_items.collect())
    from closebook.plans import finance
    for marts, told in ((m, any(not r["is_booked"] for r in rows.values())), (quiet, True)):
        months = finance.net_revenue_monthly(marts.order_facts, marts.refund_items).collect()
        assert all(r["net_revenue"] == r["sales_revenue"] + r["refunded_revenue"] for r in months)
        assert any(r["unbooked_refunds"] for r in months) == told
        may = next(r for r in months if r["order_month"] == dt.date(2024, 5, 1))
        assert may["sales_revenue"] == 0 and may["net_revenue"] < 0


def test_anomalies_and_open_months(spark):
    from closebook.plans import finance
    activity = spark.createDataFrame(
        [("A", dt.date(2024, m, 1), c, float(v)) for m, c, v in (
            (1, "usd", 100), (2, "usd", -301), (3, "usd", 900), (5, "usd", 9000), (6, "usd", 0),
            (7, "usd", 5), (1, "eur", 1), (2, "eur", 3), (3, "eur", 10))],
        "account_code string, entry_month date, currency string, net_amount double")
    got = {(r["entry_month"].month, r["currency"]) for r in finance.gl_anomalies(activity).collect()}
    assert got == {(2, "usd"), (3, "eur")}  # not after a gap, nor after a month of zero
    gl = spark.createDataFrame(
        [(dt.date(2024, 1, 1), dt.datetime(2024, 2, 7, 23)), (dt.date(2024, 1, 1), dt.datetime(2024, 2, 8)),
         (dt.date(2024, 2, 1), dt.datetime(2024, 3, 1))],
        "entry_month date, _loaded_at timestamp_ntz")
    out = {r["entry_month"].month: r for r in finance.ledger_completeness(
        gl, MartConfig(as_of=dt.date(2024, 3, 7))).collect()}
    assert (out[1]["closes_on"], out[1]["is_open"], out[1]["entries_after_close"]) == (
        dt.date(2024, 2, 7), False, 1)
    assert (out[2]["closes_on"], out[2]["is_open"]) == (dt.date(2024, 3, 7), True)


# ----------------------------------------------------------------- incremental
def grown(spark, days):
    """Feeds as they stand after some days: statuses change, lines come late, an
    order moves to another month, one loses its date, one is cancelled."""
    from decimal import Decimal as D
    t, d = dt.datetime, dt.date
    base = feeds(spark)
    step = dt.timedelta(days=1)
    order = lambda k, day, status, date, at: (
        f"N{k}", f"C{k % 3 + 1}", date, None, None, status, "online", "east", *([D("1")] * 5),
        t(2025, 6, 1) + at * step)
    orders = [order(k, k, "shipped", d(2025, 5, 1 + k), 0) for k in range(8)]
    late = [(2, order(1, 1, "cancelled", d(2025, 5, 2), 2)), (3, order(2, 2, "delivered", d(2025, 6, 9), 3)),
            (3, order(3, 3, "shipped", None, 3)), (4, order(8, 8, "delivered", d(2025, 7, 1), 4)),
            (5, order(9, 9, "pending", d(2025, 7, 2), 5)), (6, order(9, 9, "shipped", d(2025, 7, 2), 6)),
            *[(7, order(k, k, "refunded", d(2025, 5, 1 + k), 7)) for k in (0, 4, 5, 6, 7)]]
    orders += [o for day, o in late if day <= days]
    item = lambda k, n, at: (f"N{k}-{n}", f"N{k}", "P1", n + 1, D("3"), D("0"), t(2025, 6, 1) + at * step)
    items = [item(k, 0, 0) for k in range(9)]
    items += [x for day, x in ((4, item(2, 1, 1)), (5, item(9, 0, 5)), (6, item(0, 1, 6))) if day <= days]
    mk = lambda rows, like: like.unionByName(spark.createDataFrame(rows, like.schema))
    return SimpleNamespace(**{**vars(base), "orders": mk(orders, base.orders),
                              "order_items": mk(items, base.order_items)})


def test_incremental_fact_equals_the_full_one(spark, tmp_path, monkeypatch):
    """Day by day; the line that arrived three days late (day 4, loaded on day 1)
    is found by the lookback, and months left empty are gone."""
    from closebook.plans import incremental
    out, sizes = str(tmp_path), []
    monkeypatch.setattr(sinks, "overwrite_partitions",
                        lambda rows, folder, col, months, *a, f=sinks.overwrite_partitions:
                        (sizes.append(len(months)), f(rows, folder, col, months, *a)))
    for days in (0, 2, 3, 4, 6, 7, 7):
        raw = grown(spark, days)
        path = incremental.refresh_fact(spark, raw, out)
        want = Marts(raw).completed_order_items
        got = spark.read.parquet(path).select(want.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), days
    assert len(sizes) == 6 and all(0 < n < 8 for n in sizes)
    months = {r[0] for r in Marts(grown(spark, 0)).completed_order_items.select("order_month").collect()}
    assert dt.date(2025, 5, 1) in months and not [f for f in os.listdir(path.removeprefix("file:"))
                                                 if f == "order_month=2025-05-01"]
    # A run that fails leaves the mark where it was.
    before = sinks.read_table(spark, f"{out}/_loaded_until").first()
    with pytest.raises(Exception):
        incremental.refresh_fact(spark, SimpleNamespace(**{
            **vars(grown(spark, 7)), "products": raw.products.drop("sku")}), out)
    assert sinks.read_table(spark, f"{out}/_loaded_until").first() == before


# --------------------------------------------------------------------- scratch
def test_scratch_scope_deletes_what_was_made_in_it(spark):
    with session.scratch_scope(spark) as folders:
        with session.scratch_scope(spark) as inner:
            assert session.settle(spark.range(5), "inner").count() == 5
        assert session.settle(spark.range(5), "outer").count() == 5
        paths = [p.removeprefix("file:") for p in (*folders, *inner)]
        assert len(paths) == 2 and os.path.isdir(paths[0]) and not os.path.exists(paths[1])
    assert not os.path.exists(paths[0])
    kept = session.scratch_folder(spark, "free")
    assert kept not in folders


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    local = "file:" + str(spark.conf.get("spark.sql.warehouse.dir")).removeprefix("file:")
    jvm = SimpleNamespace(_jvm=spark._jvm, _jsc=spark._jsc)
    fake = SimpleNamespace(
        sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None,
                                     setCheckpointDir=lambda p: pytest.fail("set " + p)),
        conf=SimpleNamespace(get=lambda k, d=None: local if "warehouse" in k else d),
        **vars(jvm))
    monkeypatch.delenv("CLOSEBOOK_SCRATCH", raising=False)
    with pytest.raises(RuntimeError, match="shares"):
        session.ensure_checkpoint_dir(fake)


def test_staged_customers_keep_named_columns(spark):
    raw = feeds(spark).customers.withColumn("load_no", F.lit(3))
    assert staging.stg_customers(raw, "load_no").columns == [
        *staging.stg_customers(raw).columns, "load_no"]
