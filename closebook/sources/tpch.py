"""Raw ERP and ledger feeds derived from the TPC-H-like driver tables.

The marts read seven raw feeds (orders, order_items, customers, products,
gl_entries, chart_of_accounts, budgets). The test tables do not contain
them, so this module derives them, deterministically and from whole tables
(no subsets): every order, line, part, customer and supplier becomes a feed row.

Edge cases the marts must handle are produced by value rules, never by
dropping rows:

* every order is emitted twice (placement row, then current row four days
  later) like an append-only status feed; one key in 500 gets both rows on
  the same timestamp, which exercises the dedupe tiebreak;
* statuses: F -> delivered, O -> ' Shipped' (case and blanks), P -> pending,
  processing, cancelled or refunded by order key;
* one order key in 997 puts its lines under a missing order id (orphans);
  one part in 50 is archived with no cost; one order in 101 has no total;
* suppliers become prospects (customers without orders);
* the ledger posts one revenue credit per shipped order (sum of its line
  revenue, in the month of shipment, so month-end orders cross months),
  refund debits, monthly expense postings, an accrual without reference, a
  balance-sheet row, an unknown account, an unknown entry type and a zero row;
* the revenue budget of a month is last year's order book of that month
  times a fixed factor, so the first year has no budget.

Dates move forward by 300 months so the data lands in 2020-2026.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.functions.columns import MONEY, RATE, ntz
from closebook.operators.dedupe import keyed
from closebook.sources.schemas import RAW_SCHEMAS

# Fixed values of the derivation.
SHIFT_MONTHS = 300
PROSPECT_BASE_DATE = dt.date(2019, 1, 1)
FEED_LOADED_AT = dt.datetime(2020, 1, 1)
LIST_PRICE_FACTOR = Decimal("0.02")
COST_FACTOR = Decimal("0.60")
TAX_RATE = Decimal("0.08")
BUDGET_FACTOR = Decimal("0.0060")
SNAPSHOT_LOADS = (dt.datetime(2021, 1, 1), dt.datetime(2023, 1, 1), dt.datetime(2025, 1, 1))

# The chart of accounts, in source order.
# (account_code, account_name, account_type, account_subtype, normal_balance, is_income_statement)
CHART_OF_ACCOUNTS = (
    ("REV-1000", "Operating Revenue", "revenue", "operating_revenue", "credit", True),
    ("REV-REFUND", "Refund Contra-Revenue", "revenue", "refund", "debit", True),
    ("COGS-2000", "Cost of Goods Sold", "expense", "cogs", "debit", True),
    ("OPEX-3000", "Operating Expenses", "expense", "opex", "debit", True),
    ("DEPR-4000", "Depreciation & Amortization", "expense", "depreciation", "debit", True),
    ("INT-5000", "Interest Expense", "expense", "interest_expense", "debit", True),
    ("TAX-6000", "Income Tax Expense", "expense", "income_tax", "debit", True),
    ("CASH-7000", "Cash & Equivalents", "asset", "current_asset", "debit", False),
    ("AR-8000", "Accounts Receivable", "asset", "current_asset", "debit", False),
)
CHART_LOADED_AT = dt.datetime(2024, 1, 1)

# Monthly ledger postings derived from the month's order revenue R:
# (kind, account_code, entry_type, factor of R or None, fixed amount or None,
#  reference_id, description)
MONTHLY_POSTINGS = (
    ("COGS", "COGS-2000", "debit", Decimal("0.5500"), None, None, "COGS shipments"),
    ("OPEX", "OPEX-3000", "debit", Decimal("0.2000"), None, None, "Operating expenses"),
    ("DEPR", "DEPR-4000", "debit", Decimal("0.0500"), None, None, "Depreciation"),
    ("INT", "INT-5000", "debit", Decimal("0.0100"), None, None, "Interest"),
    ("TAX", "TAX-6000", "debit", Decimal("0.0200"), None, None, "Income tax provision"),
    ("ACCR", "REV-1000", "credit", Decimal("0.0040"), None, None, "Revenue accrual"),
    ("CASH", "CASH-7000", "debit", Decimal("1.0000"), None, None, "Cash receipts"),
    ("SUSP", "SUSP-9999", "debit", Decimal("0.0010"), None, None, "Suspense posting"),
    ("ADJ", "OPEX-3000", " Adjustment", None, Decimal("25.00"), "JE-ADJ", "Manual adjustment"),
    ("ZERO", "OPEX-3000", "debit", None, Decimal("0.00"), "JE-ZERO", "Zero amount entry"),
)


def _lit_dec(v: Decimal, precision: int, scale: int) -> Column:
    return F.lit(v).cast(f"decimal({precision},{scale})")


def shifted_date(c: str) -> Column:
    """Driver timestamp -> DATE moved forward by SHIFT_MONTHS."""
    return F.add_months(F.to_date(F.col(c)), SHIFT_MONTHS)


def at_midnight(d: Column) -> Column:
    return d.cast("timestamp_ntz")


def plus_days(ts: Column, days: int) -> Column:
    return ts + F.expr(f"INTERVAL {days} DAYS")


def product_id_of(key: str) -> Column:
    return F.concat(F.lit("PROD-"), F.col(key).cast("string"))


def part_key_of(product_id: str) -> Column:
    """The key's digits of a product id."""
    return F.expr(f"substring({product_id}, 6)")


def line_order_id() -> Column:
    prefix = F.when(F.col("l_orderkey") % 997 == 0, "ORD-MISSING-").otherwise("ORD-")
    return F.concat(prefix, F.col("l_orderkey").cast("string"))


def list_price_of(retailprice: Column) -> Column:
    return F.round(retailprice.cast(MONEY) * _lit_dec(LIST_PRICE_FACTOR, 4, 2), 2).cast(MONEY)


def line_net_amount(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """round(quantity * unit_price * (1 - coalesce(discount_pct, 0)), 2)."""
    return F.round(quantity * unit_price * (F.lit(1) - F.coalesce(discount_pct, F.lit(0))), 2)


# Declared schemas of the driver tables this module reads (no footer-based
# schema inference per read).
DRIVER_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


@dataclass
class DriverTables:
    """Lazy readers for the driver's parquet tables in one directory (each
    table is listed once per instance and read with its declared schema)."""

    spark: SparkSession
    sf_dir: str

    def __post_init__(self):
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read
            if name in DRIVER_SCHEMAS:
                reader = reader.schema(DRIVER_SCHEMAS[name])
            self._tables[name] = reader.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        return self._tables[name]


class RawFeeds:
    """The seven raw feeds (plus SCD2 customer extracts) for one driver directory."""

    #: ``gl_entries`` aggregates all lines each time it is read.
    ledger_is_derived = True

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.driver = DriverTables(spark, sf_dir)

    # ---------------------------------------------------------------- orders
    @cached_property
    def orders(self) -> DataFrame:
        o = self.driver.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
            "o_orderpriority")
        r = self.driver.table("region").select("r_regionkey", "r_name")
        o = o.join(r, (o.o_custkey % 5) == r.r_regionkey, "left")

        key, st = F.col("o_orderkey"), F.col("o_orderstatus")
        d = shifted_date("o_orderdate")
        final_status = (
            F.when(st == "F", "delivered").when(st == "O", " Shipped")
            .when(key % 4 == 0, "pending").when(key % 4 == 1, "processing")
            .when(key % 4 == 2, "cancelled").otherwise("refunded")
        )
        refunded = (st == "P") & (key % 4 == 3)
        shipped = F.when(st.isin("F", "O") | refunded, F.date_add(d, 1))
        delivered = F.when((st == "F") | refunded, F.date_add(d, 3))
        channel = (
            F.when(F.col("o_orderpriority") == "1-URGENT", "online")
            .when(F.col("o_orderpriority") == "2-HIGH", "Retail")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "wholesale")
            .otherwise(" Online ")
        )
        subtotal = F.col("o_totalprice").cast(MONEY)
        tax = F.round(subtotal * _lit_dec(TAX_RATE, 4, 2), 2).cast(MONEY)
        current_ts = plus_days(at_midnight(d), 4)
        placed_ts = F.when(key % 500 == 0, current_ts).otherwise(at_midnight(d))

        emission = F.col("emission")
        is_current = emission == 1
        feed = o.select(
            "*", F.explode(F.array(F.lit(0), F.lit(1))).alias("emission"))
        return feed.select(
            F.concat(F.lit("ORD-"), key.cast("string")).alias("order_id"),
            F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("customer_id"),
            d.alias("order_date"),
            F.when(is_current, shipped).alias("shipped_date"),
            F.when(is_current, delivered).alias("delivered_date"),
            F.when(is_current, final_status).otherwise("pending").alias("status"),
            channel.alias("channel"),
            F.col("r_name").alias("region"),
            subtotal.alias("subtotal_amount"),
            _lit_dec(Decimal("0.00"), 18, 2).alias("discount_amount"),
            tax.alias("tax_amount"),
            _lit_dec(Decimal("0.00"), 18, 2).alias("shipping_amount"),
            F.when(key % 101 != 0, (subtotal + tax).cast(MONEY)).alias("total_amount"),
            F.when(is_current, current_ts).otherwise(placed_ts).alias("_loaded_at"),
        )

    # ----------------------------------------------------------- order items
    @cached_property
    def order_items(self) -> DataFrame:
        # Lines and parts meet on the product's id: where parts are too many to be
        # broadcast, the models join products to the lines as they lie.
        return self._items(self._lines(), self._prices(), F.col("product_id") == F.col("part_id"))

    @cached_property
    def unpriced_items(self) -> DataFrame:
        """``order_items`` for readers of no price: lines do not meet parts for them,
        unless the key of a part repeats and so its lines do (``keyed``)."""
        return self._items(self._lines(), keyed(self._prices(), "part_id"),
                           F.col("product_id") == F.col("part_id"))

    def _lines(self) -> DataFrame:
        return self.driver.table("lineitem").select(
            product_id_of("l_partkey").alias("product_id"), "l_partkey",
            "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_shipdate")

    def _prices(self) -> DataFrame:
        # List price is a per-part value: compute it on the part side (one row
        # per part) before the join, not once per line.
        return self.driver.table("part").select(
            "p_partkey", product_id_of("p_partkey").alias("part_id"),
            list_price_of(F.col("p_retailprice")).alias("list_price"))

    @staticmethod
    def _items(li: DataFrame, p: DataFrame, on: Column) -> DataFrame:
        j = li.join(p, on, "left")
        tier = (F.lit(100) - F.lit(5) * (F.col("l_linenumber") % 4)).cast("decimal(9,0)")
        unit_price = F.round(
            F.col("list_price") * tier * _lit_dec(Decimal("0.01"), 4, 2), 2
        ).cast(MONEY)
        price_cents = F.floor(F.col("l_extendedprice") * F.lit(100.0) + F.lit(0.5))
        item_id = F.concat_ws(
            "-", F.lit("ITEM"), F.col("l_orderkey").cast("string"),
            F.col("l_linenumber").cast("string"), part_key_of("product_id"),
            F.col("l_suppkey").cast("string"), price_cents.cast("bigint").cast("string"))
        return j.select(
            item_id.alias("order_item_id"),
            line_order_id().alias("order_id"),
            "product_id",
            F.col("l_quantity").cast("int").alias("quantity"),
            unit_price.alias("unit_price"),
            F.col("l_discount").cast(RATE).alias("discount_pct"),
            at_midnight(shifted_date("l_shipdate")).alias("_loaded_at"),
        )

    @cached_property
    def order_line_ids(self) -> DataFrame:
        """The order id of every line alone, for counts that need no price."""
        return self.driver.table("lineitem").select(line_order_id().alias("order_id"))

    # -------------------------------------------------------------- products
    @cached_property
    def products(self) -> DataFrame:
        p = self.driver.table("part")
        key = F.col("p_partkey")
        lp = list_price_of(F.col("p_retailprice"))
        active = key % 50 != 0
        return p.select(
            product_id_of("p_partkey").alias("product_id"),
            F.concat(F.lit("SKU-"), key.cast("string")).alias("sku"),
            F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("product_name"),
            F.col("p_type").alias("category"),
            F.concat(F.lit("Size-"), F.col("p_size").cast("string")).alias("subcategory"),
            F.col("p_brand").alias("brand"),
            F.when(active, F.round(lp * _lit_dec(COST_FACTOR, 4, 2), 2).cast(MONEY)).alias("cost_price"),
            lp.alias("list_price"),
            active.alias("is_active"),
            ntz(FEED_LOADED_AT).alias("_loaded_at"),
        )

    # ------------------------------------------------------------- customers
    def _parties(self) -> DataFrame:
        """Customers plus suppliers (as prospects), with nation and balance."""
        n = self.driver.table("nation").select("n_nationkey", "n_name")
        c = self.driver.table("customer").select(
            F.lit("CUST-").alias("prefix"), F.lit(" customer").alias("first_name"),
            F.col("c_custkey").alias("pkey"), F.col("c_name").alias("pname"),
            F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("acctbal"))
        s = self.driver.table("supplier").select(
            F.lit("PROS-").alias("prefix"), F.lit(" supplier").alias("first_name"),
            F.col("s_suppkey").alias("pkey"), F.col("s_name").alias("pname"),
            F.col("s_nationkey").alias("nationkey"), F.lit("Prospect").alias("segment"),
            F.col("s_acctbal").alias("acctbal"))
        parties = c.unionByName(s)
        return parties.join(n, parties.nationkey == n.n_nationkey, "left")

    @staticmethod
    def _registration() -> Column:
        return F.date_add(F.lit(PROSPECT_BASE_DATE), (F.col("pkey") % 2000).cast("int"))

    @classmethod
    def _customer_columns(cls, segment: Column, city: Column) -> list[Column]:
        reg = cls._registration()
        return [
            F.concat(F.col("prefix"), F.col("pkey").cast("string")).alias("customer_id"),
            F.col("first_name"),
            F.concat(F.lit("nr-"), F.col("pkey").cast("string")).alias("last_name"),
            F.concat(F.lit(" "), F.col("pname"), F.lit("@Example.com")).alias("email"),
            segment.alias("segment"),
            F.col("n_name").alias("country"),
            city.alias("city"),
            reg.alias("registration_date"),
            plus_days(at_midnight(reg), 1).alias("_loaded_at"),
        ]

    @staticmethod
    def _home_city() -> Column:
        return F.concat(F.lit("City "), F.col("nationkey").cast("string"))

    @cached_property
    def customers(self) -> DataFrame:
        return self._parties().select(
            *self._customer_columns(F.col("segment"), self._home_city()))

    @cached_property
    def customer_extracts(self) -> DataFrame:
        """Three dated full extracts of the customer feed, for the SCD2 history.

        Extract 3 equals the current feed. Earlier extracts differ by data
        rules: customers registered later are absent; high-balance accounts
        were in segment 'SMB' before extract 3; low-balance accounts lived in
        another city in extract 1; negative-balance accounts were suspended
        (missing) in extract 2 and came back in extract 3.
        """
        loads = F.array(*[F.struct(F.lit(i + 1).alias("load_no"),
                                   ntz(ts).alias("load_ts"))
                          for i, ts in enumerate(SNAPSHOT_LOADS)])
        x = self._parties().select("*", F.inline(loads))
        n = F.col("load_no")
        segment = F.when((n < 3) & (F.col("acctbal") > 9000), "SMB").otherwise(F.col("segment"))
        moved = F.concat(F.lit("City "), ((F.col("nationkey") + 1) % 25).cast("string"))
        city = F.when((n == 1) & (F.col("acctbal") < 1000), moved).otherwise(self._home_city())
        cols = self._customer_columns(segment, city)
        registered_before = self._registration() < F.col("load_ts").cast("date")
        suspended = (n == 2) & (F.col("acctbal") < 0)
        return x.where(registered_before & ~suspended).select("load_no", "load_ts", *cols)

    @cached_property
    def customer_loads(self) -> DataFrame:
        """Number and time of each customer extract."""
        loads = F.array(*[F.struct(F.lit(i).alias("load_no"), ntz(ts).alias("load_ts"))
                          for i, ts in enumerate(SNAPSHOT_LOADS, start=1)])
        return self.spark.range(1).select(F.inline(loads))

    # ------------------------------------------------------- chart, budgets
    @cached_property
    def chart_of_accounts(self) -> DataFrame:
        """The fixed chart as a generated local relation. Unlike a DataFrame
        made from a Python list (an RDD of unknown size), its size estimate is
        tiny, so the planner broadcasts it instead of shuffling the ledger."""
        schema = RAW_SCHEMAS["chart_of_accounts"]
        structs = [
            F.struct(*[(ntz(v) if f.name == "_loaded_at" else F.lit(v).cast(f.dataType)).alias(f.name)
                       for v, f in zip(r + (CHART_LOADED_AT,), schema.fields)])
            for r in CHART_OF_ACCOUNTS]
        return self.spark.range(1).select(F.inline(F.array(*structs)))

    @cached_property
    def budgets(self) -> DataFrame:
        o = self.driver.table("orders").select("o_orderdate", "o_totalprice")
        book = (o.groupBy(F.trunc(shifted_date("o_orderdate"), "month").alias("m"))
                .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("book")))
        month = F.add_months(F.col("m"), 12)
        return book.select(
            F.concat(F.lit("BUD-"), F.date_format(month, "yyyyMM")).alias("budget_id"),
            F.lit("REV_TOTAL").alias("account_code"),
            F.year(month).alias("fiscal_year"),
            F.month(month).alias("month_number"),
            F.round(F.col("book").cast(MONEY) * _lit_dec(BUDGET_FACTOR, 6, 4), 2)
            .cast(MONEY).alias("budgeted_amount"),
            F.lit("usd").alias("currency"),
            at_midnight(F.add_months(F.col("m"), 11)).alias("_loaded_at"),
        )

    # ------------------------------------------------------------ gl entries
    @cached_property
    def gl_entries(self) -> DataFrame:
        return self.ledger_of(self.order_postings)

    @cached_property
    def order_postings(self) -> DataFrame:
        """One row per order that the ledger posts: its key, kind, date and revenue."""
        # No product joins these lines: they meet parts on the shorter key.
        items = self._items(self._lines(), self._prices(), F.col("l_partkey") == F.col("p_partkey"))
        revenue = (items.groupBy("order_id")
                   .agg(F.sum(line_net_amount(F.col("quantity"), F.col("unit_price"),
                                              F.col("discount_pct"))).alias("rev")))
        o = self.driver.table("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
        key, st = F.col("o_orderkey"), F.col("o_orderstatus")
        d = shifted_date("o_orderdate")
        refunded = (st == "P") & (key % 4 == 3)
        posting = (
            o.select(
                F.concat(F.lit("ORD-"), key.cast("string")).alias("order_id"),
                key.alias("okey"),
                F.when(st.isin("F", "O"), F.lit("REV"))
                .when(refunded, F.lit("RFD")).alias("kind"),
                F.when(st.isin("F", "O"), F.last_day(F.date_add(d, 1)))
                .otherwise(F.last_day(F.date_add(d, 3))).alias("entry_date"))
            .where(F.col("kind").isNotNull())
        )
        return posting.join(revenue, "order_id", "inner")

    def ledger_of(self, per_order: DataFrame) -> DataFrame:
        """The ledger from ``order_postings``, which it reads twice: for the entries
        of orders and for the monthly ones."""
        is_rev = F.col("kind") == "REV"
        order_rows = per_order.select(
            F.concat(F.lit("GL-"), F.col("kind"), F.lit("-"), F.col("okey").cast("string")).alias("entry_id"),
            F.when(is_rev, "REV-1000").otherwise("REV-REFUND").alias("account_code"),
            F.col("entry_date"),
            F.when(is_rev, "credit").otherwise("Debit ").alias("entry_type"),
            F.col("rev").cast(MONEY).alias("amount"),
            F.when(is_rev, "Revenue recognition").otherwise("Refund contra-revenue").alias("description"),
            F.col("order_id").alias("reference_id"),
            F.lit("usd").alias("currency"),
            plus_days(at_midnight(F.col("entry_date")), 2).alias("_loaded_at"),
        )

        monthly = (per_order.where(is_rev).groupBy("entry_date")
                   .agg(F.sum("rev").cast(MONEY).alias("r")))
        postings = F.array(*[
            F.struct(F.lit(kind).alias("kind"), F.lit(code).alias("code"),
                     F.lit(etype).alias("etype"),
                     (F.lit(factor) if factor is not None else F.lit(None)).cast("decimal(6,4)").alias("factor"),
                     (F.lit(fixed) if fixed is not None else F.lit(None)).cast(MONEY).alias("fixed"),
                     F.lit(ref).cast("string").alias("ref"), F.lit(desc).alias("descr"))
            for kind, code, etype, factor, fixed, ref, desc in MONTHLY_POSTINGS])
        m = monthly.select("entry_date", "r", F.inline(postings))
        month_rows = m.select(
            F.concat(F.lit("GL-"), F.col("kind"), F.lit("-"),
                     F.date_format("entry_date", "yyyyMM")).alias("entry_id"),
            F.col("code").alias("account_code"),
            F.col("entry_date"),
            F.col("etype").alias("entry_type"),
            F.coalesce(F.col("fixed"), F.round(F.col("r") * F.col("factor"), 2)).cast(MONEY).alias("amount"),
            F.col("descr").alias("description"),
            F.col("ref").alias("reference_id"),
            F.lit(" USD").alias("currency"),
            plus_days(at_midnight(F.col("entry_date")), 5).alias("_loaded_at"),
        )
        return order_rows.unionByName(month_rows)
