"""The line fact is made in pieces and clustered by parts: what it holds on disk at once."""

import os
from types import SimpleNamespace

import pytest

from closebook.plans import incremental, refresh, sales
from closebook.plans.catalog import QUERIES, edge, marts
from closebook.plans.models import Marts
from closebook.sources import sinks
from test_round_four import plan_of, rows_of
from test_round_three import grown, stages


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def shuffled(df) -> int:
    """Bytes that one execution of ``df`` shuffles, all of which it holds to its end."""
    query = df._jdf.queryExecution()
    query.executedPlan().executeCollect()
    return sum(n.metrics().apply("shuffleBytesWritten").value()
               for n in stages(query.executedPlan(), "Exchange"))


def test_a_piece_shuffles_its_own_lines(spark, small_sf, no_broadcast):
    m = marts(spark, small_sf)
    whole = shuffled(sales.early_columns(m.completed_order_items))
    pieces = [sales.early_columns(p) for p in m.completed_pieces(4)]
    assert max(shuffled(p) for p in pieces) < whole / 2
    assert sum(p.count() for p in pieces) == m.completed_order_items.count()


def test_month_cuts_divide_the_orders(spark):
    import datetime as dt
    orders = spark.createDataFrame(
        [(dt.date(2024, 1 + k % 8, 3),) for k in range(80)] + [(None,)] * 9, "order_date date")
    assert refresh.month_cuts(orders, 1) == []
    assert refresh.month_cuts(orders, 4) == [dt.date(2024, k, 1) for k in (3, 5, 7)]
    one = spark.createDataFrame([(dt.date(2024, 1, 3),)] * 5, "order_date date")
    assert refresh.month_cuts(one, 3) == [] and refresh.month_cuts(one.limit(0), 3) == []
    assert [sinks.part_of(v, [3, 5]) for v in (None, 2, 3, 4, 5, 9)] == [0, 0, 1, 1, 2, 2]


def test_the_fact_in_parts_equals_the_whole(spark, small_sf, no_broadcast, monkeypatch):
    """Two runs of the registered query, in several pieces and parts each."""
    want, parts = edge(marts(spark, small_sf).completed_order_items), []
    monkeypatch.setattr(refresh, "ORDERS_PER_PIECE", 300)
    monkeypatch.setattr(sinks, "overwrite_partitions", lambda rows, folder, col, months, *a,
                        f=sinks.overwrite_partitions:
                        (parts.append((rows.count(), set(months))), f(rows, folder, col, months, *a)))
    got = QUERIES["completed_order_items_incremental"](spark, small_sf)
    assert got.dtypes == want.dtypes and rows_of(got) == rows_of(want)
    months = [m for _, own in parts for m in own]
    assert len(parts) > 2 and len(months) == len(set(months))
    assert max(n for n, _ in parts) < sum(n for n, _ in parts) / 2


def test_incremental_fact_in_parts_equals_the_full_one(spark, tmp_path, no_broadcast, monkeypatch):
    """Day by day with months left empty, an order without a date, and late lines; the
    stored months hold what follows from other columns too."""
    monkeypatch.setattr(refresh, "ORDERS_PER_PIECE", 2)
    out = str(tmp_path)
    for days in (0, 3, 4, 7):
        raw = grown(spark, days)
        path = incremental.refresh_fact(spark, raw, out)
        want = Marts(raw).completed_order_items
        assert rows_of(spark.read.parquet(path).select(want.columns)) == rows_of(want), days
        assert not os.path.exists(f"{out}/completed_order_items/_staged")


def test_a_run_that_fails_between_two_parts_is_repeated(spark, tmp_path, no_broadcast, monkeypatch):
    monkeypatch.setattr(refresh, "ORDERS_PER_PIECE", 2)
    out, done, real = str(tmp_path), [], sinks.overwrite_partitions
    incremental.refresh_fact(spark, grown(spark, 0), out)

    def lost(*a):
        if done:
            raise RuntimeError("lost")
        done.append(real(*a))
    raw = grown(spark, 7)
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(sinks, "overwrite_partitions", lost)
        incremental.refresh_fact(spark, raw, out)
    assert done
    path, want = incremental.refresh_fact(spark, raw, out), Marts(raw).completed_order_items
    assert rows_of(spark.read.parquet(path).select(want.columns)) == rows_of(want)


def test_lines_are_not_shuffled_for_many_changed_orders(spark, tmp_path, no_broadcast, monkeypatch):
    """They meet the ids of changed orders before their orders only where those are few."""
    out, plans = str(tmp_path), []
    first, raw = grown(spark, 0), grown(spark, 7)
    incremental.refresh_fact(spark, first, out)

    class Spied(Marts):
        def __init__(self, feeds, cfg):
            super().__init__(feeds, cfg)
            if not plans:
                plans.append(plan_of(feeds.order_items))
    monkeypatch.setattr(incremental, "Marts", Spied)
    incremental.refresh_fact(spark, raw, out)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    many = plans.pop()
    incremental.refresh_fact(spark, SimpleNamespace(**vars(raw)), out)
    assert "LeftSemi" not in many and "BroadcastHashJoin" in plans[0] and "LeftSemi" in plans[0]


def test_a_version_counts_when_all_its_parts_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    part = lambda k: sinks.stored(
        spark.range(20).selectExpr(f"{k} AS m", "id AS k"), str(tmp_path / f"p{k}"))

    def parts(fails):
        yield part(1)
        if fails:
            raise RuntimeError("lost")
        yield part(2)
    with pytest.raises(RuntimeError):
        sinks.write_parts(parts(True), path, "m", (), "k")
    assert sinks.current(spark, path) is None
    sinks.write_parts(parts(False), path, "m", (), "k")
    assert sinks.read_table(spark, path).count() == 40
