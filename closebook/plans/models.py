"""The model graph: raw feeds -> staging -> intermediate -> marts.

``Marts`` builds each model once per instance (as a lazy DataFrame) and hands
the same object to every downstream model, so a mart that reads the fact
twice shares one plan subtree and Spark can reuse its exchanges.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.config import DEFAULT_CONFIG, MartConfig
from closebook.operators.bitmaps import numbered
from closebook.operators.dedupe import keyed
from closebook.operators.skew import HotKeys, crowded, hot_keys, sketch
from closebook.plans import finance, sales, staging
from closebook.session import settle


def model(fn):
    """A model property, built once per ``Marts`` instance."""
    name = fn.__name__

    @functools.wraps(fn)
    def get(self):
        cache = self.__dict__.setdefault("_models", {})
        if name not in cache:
            cache[name] = fn(self)
        return cache[name]
    return property(get)


class Marts:
    def __init__(self, raw, cfg: MartConfig = DEFAULT_CONFIG):
        """``raw`` exposes the seven raw feeds as attributes (``orders``,
        ``order_items``, ``customers``, ``products``, ``gl_entries``,
        ``chart_of_accounts``, ``budgets``)."""
        self.raw = raw
        self.cfg = cfg

    def use(self, name: str, table: DataFrame) -> None:
        """Read a stored table in place of a model that is not built yet."""
        self.__dict__.setdefault("_models", {})[name] = table

    # staging
    @model
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders)

    @model
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw.order_items)

    @model
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers)

    @model
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.products)

    @model
    def stg_gl_entries(self) -> DataFrame:
        return staging.stg_gl_entries(self.raw.gl_entries)

    @model
    def stg_chart_of_accounts(self) -> DataFrame:
        return staging.stg_chart_of_accounts(self.raw.chart_of_accounts, self.cfg)

    @model
    def stg_budgets(self) -> DataFrame:
        return staging.stg_budgets(self.raw.budgets)

    # intermediate
    @model
    def line_inputs(self) -> DataFrame:
        return sales.line_inputs(self.stg_order_items, self.stg_products)

    @model
    def line_values(self) -> DataFrame:
        return sales.line_economics(self.line_inputs)

    @model
    def hot_orders(self) -> HotKeys:
        """Runs a small job once per graph, over the stored sketches of the feed
        where it has them, else over the order ids of the lines."""
        sketches = getattr(self.raw, "order_line_sketch", None)
        if sketches is None:
            ids = getattr(self.raw, "order_line_ids", None)
            busy = crowded(self.stg_order_items if ids is None else ids, "order_id",
                           self.cfg.rows_per_join_task)
            if busy is None:
                return []
            sketches = sales.order_sketch(busy)
        return sales.hot_orders(sketches, self.cfg)

    @model
    def hot_customers(self) -> HotKeys:
        return hot_keys(sketch(self.raw.orders.select("customer_id"), "customer_id"),
                        self.cfg.rows_per_join_task)

    @model
    def order_line_economics(self) -> DataFrame:
        return sales.order_line_economics(self.line_inputs, self.stg_orders, self.hot_orders,
                                          self.cfg)

    @model
    def gl_classified(self) -> DataFrame:
        return finance.gl_classified(self.stg_gl_entries, self.stg_chart_of_accounts, self.cfg)

    # sales marts
    @model
    def order_facts(self) -> DataFrame:
        return sales.order_facts(self.line_values, self.stg_orders, self.cfg)

    @model
    def order_categories(self) -> DataFrame:
        return sales.order_categories(self.line_values, self.stg_orders, self.cfg, self.hot_orders)

    @model
    def stored_order_categories(self) -> DataFrame:
        """The same in a scratch table, for the models that read it twice."""
        return settle(self.order_categories, "order-categories")

    @model
    def customer_bitmaps(self) -> DataFrame:
        """Both tables are stored: the numbers before anything is made of them."""
        numbers = settle(numbered(self.stored_order_categories, "customer_id"), "customer-numbers")
        return settle(sales.customer_bitmaps(self.stored_order_categories, numbers),
                      "customer-bitmaps")

    @model
    def completed_order_items(self) -> DataFrame:
        return sales.completed_order_items(self.line_inputs, self.order_facts,
                                           self.hot_orders, self.cfg)

    def completed_pieces(self, pieces: int) -> Iterator[DataFrame]:
        """The rows of ``completed_order_items`` in so many pieces, by a hash of their
        order: each holds whole orders, and its shuffles move its own lines alone."""
        if pieces < 2:
            yield self.completed_order_items
            return
        for k in range(pieces):
            mine = F.pmod(F.xxhash64("order_id"), F.lit(pieces)) == k
            facts = sales.order_facts(self.line_values.where(mine), self.stg_orders.where(mine),
                                      self.cfg)
            yield sales.completed_order_items(self.line_inputs.where(mine), facts,
                                              self.hot_orders, self.cfg)

    @model
    def completed_lines(self) -> DataFrame:
        return sales.completed_lines(self.line_inputs, self.stg_orders, self.hot_orders, self.cfg)

    @model
    def unpriced_lines(self) -> DataFrame:
        """``completed_lines`` for readers of no price and no product's column: lines
        meet neither parts nor products there, if those have unique keys."""
        items = getattr(self.raw, "unpriced_items", None)
        items = self.stg_order_items if items is None else staging.stg_order_items(items)
        lines = sales.line_inputs(items, keyed(self.stg_products, "product_id"))
        return sales.completed_lines(lines, self.stg_orders, self.hot_orders, self.cfg)

    @model
    def customer_360(self) -> DataFrame:
        return sales.customer_360(self.stg_customers, self.order_facts, self.cfg)

    @model
    def revenue_performance_monthly(self) -> DataFrame:
        cats = self.stored_order_categories
        return sales.revenue_performance_monthly(
            cats, sales.first_order_months(cats, self.stg_customers))

    @model
    def refund_items(self) -> DataFrame:
        return sales.refund_items(self.line_inputs, self.stg_orders,
                                  finance.booked_refunds(self.gl_classified, self.cfg),
                                  self.hot_orders, self.cfg)

    # finance marts
    @model
    def gl_activity_monthly(self) -> DataFrame:
        return finance.gl_activity_monthly(self.gl_classified)

    @model
    def income_statement_monthly(self) -> DataFrame:
        return finance.income_statement_monthly(self.gl_activity_monthly, self.stg_budgets,
                                                self.cfg)

    @model
    def revenue_reconciliation(self) -> DataFrame:
        return finance.revenue_reconciliation(self.order_facts, self.gl_classified, self.cfg)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)
