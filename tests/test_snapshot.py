"""SCD2: insert, change, unchanged, non-check change, delete, return, null-safe change."""

import datetime as dt

from pyspark.sql import functions as F

from closebook.operators.snapshot import as_of_join, snapshot_apply

T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
SCHEMA = "customer_id string, customer_segment string, city string, email string"


def _run(spark):
    b1 = spark.createDataFrame([("K1", "a", "x", "k1@a"), ("K2", "b", "x", "k2@a"),
                                ("K3", "c", "x", "k3@a")], SCHEMA)
    b2 = spark.createDataFrame([("K1", "a", "x", "NEW@a"), ("K2", "b2", "x", "k2@a"),
                                ("K4", "d", "x", "k4@a")], SCHEMA)
    b3 = spark.createDataFrame([("K1", "a", "x", "NEW@a"), ("K2", "b2", "x", "k2@a"),
                                ("K3", "c", "x", "k3@a"), ("K4", "d", None, "k4@a")], SCHEMA)
    snap = None
    for batch, ts in ((b1, T1), (b2, T2), (b3, T3)):
        snap = snapshot_apply(snap, batch, "customer_id", ("customer_segment", "city"), ts)
    return snap


def test_versions(spark):
    rows = _run(spark).collect()
    got = sorted((r["customer_id"], r["valid_from"], r["valid_to"]) for r in rows)
    assert got == sorted([
        ("K1", T1, None),
        ("K2", T1, T2), ("K2", T2, None),
        ("K3", T1, T2), ("K3", T3, None),
        ("K4", T2, T3), ("K4", T3, None),
    ])
    k1 = [r for r in rows if r["customer_id"] == "K1"][0]
    assert k1["email"] == "k1@a"                 # non-check change makes no version
    assert len({r["scd_id"] for r in rows}) == len(rows)


def test_one_open_row_per_key(spark):
    snap = _run(spark)
    assert snap.where(F.col("valid_to").isNull()).groupBy("customer_id").count() \
               .where("count > 1").count() == 0
    assert snap.where(F.col("valid_to") <= F.col("valid_from")).count() == 0


def test_as_of_join(spark):
    facts = spark.createDataFrame(
        [("K2", dt.date(2024, 1, 15)), ("K2", dt.date(2024, 2, 15)), ("K3", dt.date(2024, 2, 15)),
         ("K9", dt.date(2024, 2, 15))], "customer_id string, order_date date")
    out = as_of_join(facts, _run(spark), "customer_id", F.col("order_date"), ["customer_segment"])
    got = sorted((r["customer_id"], r["order_date"], r["customer_segment"]) for r in out.collect())
    assert got == [("K2", dt.date(2024, 1, 15), "b"), ("K2", dt.date(2024, 2, 15), "b2"),
                   ("K3", dt.date(2024, 2, 15), None), ("K9", dt.date(2024, 2, 15), None)]
