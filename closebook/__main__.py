"""Command line: stage, run, test, snapshot and freshness over raw feeds.

    python -m closebook stage     --sf-dir DRIVER_DIR --out FEEDS_DIR
    python -m closebook run       --sources FEEDS_DIR --out MARTS_DIR [--select fact ...]
    python -m closebook test      --sources FEEDS_DIR [--kind not_null] [--marts MARTS_DIR]
    python -m closebook snapshot  --sources FEEDS_DIR --base SNAP_DIR --version V
                                  [--previous SNAP_DIR/version=U]
    python -m closebook freshness --sources FEEDS_DIR

``--sources`` is a directory of raw tables under their physical names
(``raw_orders``, ``raw_order_items``...), as parquet (default), as CSV seeds
(``--format csv``: ``raw_orders.csv``...) or a ``catalog.schema`` of tables
(``--format table``); ``--finance-sources`` names another one for the ledger
feeds. ``--as-of`` sets the clock of the run (the present, if left out). With
``test --marts`` the checks read the stored marts written by ``run`` (as tests
of stored tables do) instead of recomputing them; without ``--kind`` the
assertions over several models run as well.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from closebook.config import MartConfig
from closebook.functions.columns import ntz
from closebook.operators import quality
from closebook.plans import checks, incremental, refresh
from closebook.plans.models import Marts
from closebook.session import plan_session
from closebook.sources import sinks
from closebook.sources.files import SourceCatalog, StoredFeeds, write_feeds
from closebook.sources.schemas import SOURCE_IDENTIFIERS
from closebook.sources.tpch import RawFeeds


class CatalogFeeds:
    """Raw feeds resolved through a ``SourceCatalog``."""

    def __init__(self, spark: SparkSession, catalog: SourceCatalog):
        self._spark, self._catalog = spark, catalog
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SOURCE_IDENTIFIERS:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self._catalog.read(self._spark, name)
        return self._cache[name]


def feeds_from(spark: SparkSession, path: str, fmt: str, finance: str | None = None,
               rejects: str | None = None):
    if fmt == "parquet" and finance is None:
        return StoredFeeds(spark, path)
    return CatalogFeeds(spark, SourceCatalog(
        {"raw_sales": path, "raw_finance": finance or path}, fmt=fmt, rejects=rejects))


def _resolver(spark: SparkSession, m: Marts, marts_dir: str | None):
    def get(name: str) -> DataFrame:
        if name.startswith("raw_"):
            return getattr(m.raw, name[len("raw_"):])
        if marts_dir and name in refresh.ALL_MARTS:
            return sinks.read_table(spark, f"{marts_dir.rstrip('/')}/{name}")
        return m.model(name)
    return get


def _run_tests(m: Marts, kind: str | None, get) -> int:
    chosen = checks.checks_of_kind(kind, m.cfg) if kind else checks.all_checks(m.cfg)
    found = {r["check_id"]: r["failures"] for r in quality.run_checks(chosen, get).collect()}
    for a in () if kind else checks.ASSERTIONS:
        found[f"assertion__{a.name}"] = a.rows(get, m.cfg).count()
    for check_id, failures in sorted(found.items()):
        print(f"{'FAIL' if failures else 'PASS'}\t{failures}\t{check_id}")
    failed = sum(1 for n in found.values() if n)
    print(f"{len(found) - failed} pass, {failed} fail")
    return 1 if failed else 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="closebook")
    sub = ap.add_subparsers(dest="cmd", required=True)
    st = sub.add_parser("stage")
    st.add_argument("--sf-dir", required=True)
    st.add_argument("--out", required=True)
    for name in ("run", "test", "snapshot", "freshness"):
        p = sub.add_parser(name)
        p.add_argument("--sources", required=True)
        p.add_argument("--finance-sources", help="where the ledger feeds are, if elsewhere")
        p.add_argument("--format", choices=("parquet", "csv", "table"), default="parquet")
        p.add_argument("--rejects", help="folder for the bad rows of CSV seeds, which else fail")
        p.add_argument("--as-of", type=dt.datetime.fromisoformat,
                       help="clock of the run, e.g. 2024-07-01T00:00:00; the present, if left out")
    sub.choices["run"].add_argument("--out", required=True)
    sub.choices["run"].add_argument("--select", nargs="*", default=list(refresh.ALL_MARTS))
    sub.choices["run"].add_argument(
        "--incremental", action="store_true",
        help="bring the stored fact up to date from the rows loaded since the last such run")
    sub.choices["run"].add_argument(
        "--buckets", type=int, help="store staged lines and orders in that many buckets by order_id")
    sub.choices["test"].add_argument("--kind")
    sub.choices["test"].add_argument("--marts")
    sn = sub.choices["snapshot"]
    sn.add_argument("--base", required=True)
    sn.add_argument("--version", required=True)
    sn.add_argument("--previous")
    args = ap.parse_args(argv)

    spark = spark or plan_session("closebook")
    if args.cmd == "stage":
        print(write_feeds(RawFeeds(spark, args.sf_dir), args.out))
        return 0
    feeds = feeds_from(spark, args.sources, args.format, args.finance_sources, args.rejects)
    now = args.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    cfg = MartConfig(as_of=now.date())
    if args.cmd == "run" and args.incremental:
        print(f"{incremental.FACT}\t{incremental.refresh_fact(spark, feeds, args.out, cfg)}")
        args.select = [n for n in args.select if n != incremental.FACT]
    if args.cmd == "run":
        for name, path in refresh.refresh(spark, feeds, args.out, args.select, cfg,
                                          args.buckets).items():
            print(f"{name}\t{path}")
        return 0
    if args.cmd == "snapshot":
        print(refresh.snapshot_customers(spark, feeds, args.base, args.version, now,
                                         args.previous, cfg))
        return 0
    if args.cmd == "freshness":
        rows = checks.freshness(feeds, ntz(now), cfg).collect()
        for r in rows:
            print(f"{r['source']}\t{r['status']}\t{r['age_hours']:.1f}h")
        return 1 if any(r["status"] == "error" for r in rows) else 0
    m = Marts(feeds, cfg)
    return _run_tests(m, args.kind, _resolver(spark, m, args.marts))


if __name__ == "__main__":
    raise SystemExit(main())
