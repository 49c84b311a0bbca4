"""Measure layer: outer filters, replace-filter semantics, unreachable attributes."""
from pyspark.sql import functions as F

from vigil.operators import metrics as M


def test_where_is_replaced_by_measure_filter(cat):
    star = cat.star()
    ft = star["fact_transaction"]
    r = M.evaluate(star, ["transactions", "high_risk_txns"], where={"fact_transaction.risk_band": "LOW"}).collect()[0]
    assert r["transactions"] == ft.filter(F.col("risk_band") == "LOW").count()
    # the measure's own band filter replaces the outer one
    assert r["high_risk_txns"] == ft.filter(F.col("risk_band") == "HIGH").count()


def test_transaction_measure_not_split_by_rule(cat):
    star = cat.star()
    rows = M.evaluate(star, ["rule_firings", "transactions"], by=["dim_risk_rule.rule_id"]).collect()
    total = star["fact_transaction"].count()
    assert rows and all(r["transactions"] == total for r in rows)
    assert sum(r["rule_firings"] for r in rows) == star["fact_alert"].count()
