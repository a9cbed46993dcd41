"""A small hand-made set of raw feeds with known answers (invented values).

Orders: A1 placed then shipped (two rows, mixed-case status), A2 delivered
with no total, A3 two rows on one timestamp (processing vs cancelled: the
later status wins), A4 refunded, A5 delivered in upper case a year later, and
one row without an id. Lines include an orphan, a zero quantity and a product
archived without cost. The ledger has order revenue, an accrual without
reference, expenses, a refund, a balance-sheet row, an unknown entry type, a
zero amount and an unknown account.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D
from types import SimpleNamespace

from closebook.sources.schemas import RAW_SCHEMAS
from closebook.sources.tpch import CHART_OF_ACCOUNTS

T = dt.datetime
d = dt.date


def feeds(spark) -> SimpleNamespace:
    orders = [
        ("A1", "C1", d(2024, 4, 2), None, None, "pending", "Online", "East ",
         D("100.00"), D("0.00"), D("20.00"), D("0.00"), D("120.00"), T(2024, 4, 2, 8)),
        ("A1", "C1", d(2024, 4, 2), d(2024, 4, 3), None, "Shipped ", "Online", "East ",
         D("100.00"), D("0.00"), D("20.00"), D("0.00"), D("120.00"), T(2024, 4, 3, 9)),
        ("A2", "C2", d(2024, 4, 10), d(2024, 4, 11), d(2024, 4, 12), "delivered", "retail", "west",
         D("30.00"), None, None, None, None, T(2024, 4, 12)),
        ("A3", "C1", d(2024, 5, 5), None, None, "processing", "online", "east",
         D("50.00"), D("0.00"), D("0.00"), D("0.00"), D("50.00"), T(2024, 5, 6)),
        ("A3", "C1", d(2024, 5, 5), None, None, "cancelled", "online", "east",
         D("50.00"), D("0.00"), D("0.00"), D("0.00"), D("50.00"), T(2024, 5, 6)),
        ("A4", "C3", d(2024, 5, 20), d(2024, 5, 21), d(2024, 5, 23), "refunded", "online", "west",
         D("20.00"), D("0.00"), D("0.00"), D("0.00"), D("20.00"), T(2024, 5, 30)),
        ("A5", "C2", d(2025, 4, 15), d(2025, 4, 16), d(2025, 4, 18), "DELIVERED", "retail", "west",
         D("76.00"), D("0.00"), D("0.00"), D("0.00"), D("76.00"), T(2025, 4, 18)),
        (None, "C9", d(2024, 4, 1), None, None, "pending", "online", "east",
         None, None, None, None, None, T(2024, 4, 1)),
    ]
    items = [
        ("I1", "A1", "P1", 2, D("10.00"), D("0.1000"), T(2024, 4, 2)),
        ("I2", "A1", "P2", 1, D("50.00"), None, T(2024, 4, 2)),
        ("I3", "A2", "P1", 3, D("10.00"), D("0.0000"), T(2024, 4, 10)),
        ("I4", "A3", "P2", 1, D("50.00"), D("0.0000"), T(2024, 5, 5)),
        ("I5", "A4", "P3", 1, D("20.00"), D("0.0000"), T(2024, 5, 20)),
        ("I6", "A5", "P3", 4, D("20.00"), D("0.0500"), T(2025, 4, 15)),
        ("I7", "ORPH", "P1", 1, D("10.00"), D("0.0000"), T(2024, 4, 20)),
        ("I8", "A2", "P1", 0, D("10.00"), D("0.0000"), T(2024, 4, 10)),
    ]
    products = [
        ("P1", "SKU-1", " Desk Lamp ", "Gadgets ", "Lamps", "Lumo", D("6.00"), D("12.00"), True, T(2024, 1, 1)),
        ("P2", "SKU-2", "Drill", "Tools", "Power", "Bolt", D("20.00"), D("50.00"), True, T(2024, 1, 1)),
        ("P3", "SKU-3", "Saw", "tools", "Hand", "Bolt", None, D("25.00"), False, T(2024, 1, 1)),
    ]
    customers = [
        ("C1", " ana maria", "lopez ", "Ana@Mail.com ", "Consumer", "Spain", "Madrid", d(2023, 1, 5), T(2024, 1, 1)),
        ("C2", "bo", "li", "bo@mail.com", "corporate", "China", "Xian", d(2022, 6, 1), T(2024, 1, 1)),
        ("C3", "cy", None, "cy@mail.com", "consumer", "Peru", "Lima", d(2024, 2, 1), T(2024, 2, 1)),
        ("C4", "di", "ng", "di@mail.com", "home_office", "Chile", "Arica", d(2024, 3, 1), T(2024, 3, 1)),
    ]
    gl = [
        ("G1", "REV-1000", d(2024, 4, 30), "credit", D("68.00"), "rev A1", "A1", "usd", T(2024, 5, 2)),
        ("G2", "REV-1000", d(2024, 4, 30), "credit", D("31.00"), "rev A2", "A2", "usd", T(2024, 5, 2)),
        ("G3", "COGS-2000", d(2024, 4, 30), "debit", D("50.00"), "cogs", None, "usd", T(2024, 5, 2)),
        ("G4", "OPEX-3000", d(2024, 4, 30), "Debit", D("10.00"), "opex", None, "usd", T(2024, 5, 3)),
        ("G5", "REV-1000", d(2024, 4, 30), "credit", D("5.00"), "accrual", None, "usd", T(2024, 5, 3)),
        ("G6", "REV-1000", d(2025, 4, 30), "credit", D("76.00"), "rev A5", "A5", "usd", T(2025, 5, 2)),
        ("G7", "REV-REFUND", d(2024, 5, 31), "debit", D("20.00"), "refund A4", "A4", "usd", T(2024, 6, 2)),
        ("G8", "CASH-7000", d(2024, 4, 30), "debit", D("100.00"), "cash", None, "usd", T(2024, 5, 2)),
        ("G9", "OPEX-3000", d(2024, 4, 30), "reversal", D("3.00"), "odd type", None, "usd", T(2024, 5, 2)),
        ("G10", "OPEX-3000", d(2024, 4, 30), "debit", D("0.00"), "zero", None, "usd", T(2024, 5, 2)),
        ("G11", "SUSP-1", d(2024, 4, 30), "debit", D("1.00"), "unknown account", None, "usd", T(2024, 5, 2)),
    ]
    budgets = [("B1", "REV_TOTAL", 2024, 4, D("100.00"), "USD", T(2024, 1, 1))]
    chart = [r + (T(2024, 1, 1),) for r in CHART_OF_ACCOUNTS]
    mk = lambda rows, name: spark.createDataFrame(rows, RAW_SCHEMAS[name])
    return SimpleNamespace(
        orders=mk(orders, "orders"), order_items=mk(items, "order_items"),
        customers=mk(customers, "customers"), products=mk(products, "products"),
        gl_entries=mk(gl, "gl_entries"), chart_of_accounts=mk(chart, "chart_of_accounts"),
        budgets=mk(budgets, "budgets"),
    )
