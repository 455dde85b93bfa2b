"""Contracts on literal tables: each injected defect is reported exactly once."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tradecast.operators import contracts as CT
from tradecast.sources.io import RAW_SCHEMAS

D0 = dt.date(2024, 1, 1)


def _tables(spark):
    rows = {
        "product": [(1, "Rose", "SMALL", "red"), (2, None, "SMALL", "white")],          # NULL name
        "site": [(1, "B01", Decimal("2.50"), 1, 0), (2, "B02", Decimal("1.00"), 2, 0)],
        "store_room": [(0, "R0", None, 100), (1, "R1", Decimal("1.00"), 200)],
        "customer": [(1, "A", "USA", "Broker"), (2, "B", "USA", "Importador de flores frescas")],  # kind > 20
        "carrier": [(0, "Air", "C0"), (1, "Sky", "C1")],
        "forwarder": [(0, "F0", "0"), (1, "F1", "1")],
        "production": [(10, D0, 1, 100, "A", 50), (11, D0, 2, 80, "B", 60)],
        "movement": [(1, 1, 1, D0, 0, 10, "in", 5), (2, 1, 2, D0, 1, None, "lost", 5),   # bad domain
                     (3, 1, 3, D0, 1, 11, "waste", -5)],                                  # negative quantity
        "sale": [(8, 1, 1, D0, 1, 1, "FB", 3, Decimal("0.250")),
                 (9, 1, 2, D0, 999, 2, "HB", 4, None)],                                    # orphan customer
        "shipment": [(1, D0, 1, 0, None, "AWB1", Decimal("1.00")),
                     (2, D0, 2, 1, 1, "AWB1", Decimal("2.00"))],                           # duplicate waybill
    }
    return {t: spark.createDataFrame(r, RAW_SCHEMAS[t]) for t, r in rows.items()}


def _nonzero(df, *cols):
    return {tuple(r[c] for c in cols): r[-1] for r in df.collect() if r[-1]}


def test_each_defect_reported_once(spark):
    t = _tables(spark)
    assert _nonzero(CT.not_null(t), "table_name", "column_name") == {("product", "name"): 1}
    assert _nonzero(CT.domain(t), "table_name", "column_name") == {("movement", "move_type"): 1}
    assert _nonzero(CT.positive(t), "table_name", "column_name") == {("movement", "quantity"): 1}
    assert _nonzero(CT.width(t), "table_name", "column_name") == {("customer", "kind"): 1}
    u = {(r.table_name, r.key_columns): (r.duplicate_keys, r.surplus_rows)
         for r in CT.unique(t).collect() if r.duplicate_keys}
    assert u == {("shipment", "awb"): (1, 1)}
    fk = {(r.table_name, r.column_name): (r.orphan_rows, r.orphan_keys)
          for r in CT.foreign_keys(t).collect() if r.orphan_rows}
    assert fk == {("sale", "customer_id"): (1, 1), ("shipment", "order_id"): (1, 1)}  # NULL foreign keys pass
