"""Change lines derived from the driver's ``orders`` table (CDC fixture).

One scan of ``orders`` emits, per key class (``o_orderkey % 10``):

    0 update (status X, price x2, priority gains a quoted word; custkey NULL when key % 20 = 0)
    1 delete (key only)
    2 insert of a new key (-2 * key - 1, status N)
    3 insert of a new key then its delete (collapses to absent)
    4 two updates, the later one wins (price x3 then x4)
    5 a change to another table (filtered out)
    6 a line that is not a change (quarantined)
    7 BEGIN / COMMIT around an update of status only
    8 a change of key (to -2 * key - 1) with the old key first; the new priority holds a line end
    9 an update that leaves the price unchanged, then a change without a tuple and one without a usable key

``seq`` orders the lines (key * 10 + position). The expected final state is
computed independently by the oracle SQL from ``orders`` itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys of new rows: odd and even numbers below zero, which orders do not have.
NEW_KEY, NEW_THEN_DELETED_KEY = "(-2 * o_orderkey - 1)", "(-2 * o_orderkey - 2)"


def _q(c: Column) -> Column:
    """Single-quoted text value with inner quotes doubled."""
    return F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))


def _num(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def _row_payload(key, cust, status, price, date, prio) -> Column:
    return F.concat_ws(" ",
                       F.concat(F.lit("o_orderkey[bigint]:"), _num(key)),
                       F.concat(F.lit("o_custkey[bigint]:"), _num(cust)),
                       F.concat(F.lit("o_orderstatus[character varying]:"), _q(status)),
                       F.concat(F.lit("o_totalprice[double precision]:"), _num(price)),
                       F.concat(F.lit("o_orderdate[timestamp without time zone]:"),
                                _q(F.date_format(date, "yyyy-MM-dd HH:mm:ss"))),
                       F.concat(F.lit("\"o_orderpriority\"[character varying]:"), _q(prio)))


def _line(op: str, payload: Column, table: str = "public.orders") -> Column:
    return F.concat(F.lit(f"table {table}: {op}: "), payload)


def change_lines(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    cls = k % 10
    cust, status, price = F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_totalprice")
    date, prio = F.col("o_orderdate"), F.col("o_orderpriority")
    upd_cust = F.when(k % 20 == 0, F.lit(None).cast("long")).otherwise(cust)
    quoted_prio = F.concat(prio, F.lit(" 'x'"))

    def item(pos: int, cond: Column, line: Column) -> Column:
        return F.struct(F.lit(pos).alias("pos"), F.when(cond, line).alias("value"))

    items = F.array(
        item(0, cls == 0, _line("UPDATE", _row_payload(k, upd_cust, F.lit("X"), price * 2, date, quoted_prio))),
        item(0, cls == 1, _line("DELETE", F.concat(F.lit("o_orderkey[bigint]:"), k.cast("string")))),
        item(0, cls == 2, _line("INSERT", _row_payload(F.expr(NEW_KEY), cust, F.lit("N"), price, date, prio))),
        item(0, cls == 3, _line("INSERT", _row_payload(F.expr(NEW_THEN_DELETED_KEY), cust, F.lit("N"), price,
                                                       date, prio))),
        item(1, cls == 3, _line("DELETE", F.concat(F.lit("o_orderkey[bigint]:"),
                                                  F.expr(NEW_THEN_DELETED_KEY).cast("string")))),
        item(0, cls == 4, _line("UPDATE", _row_payload(k, cust, F.lit("X"), price * 3, date, prio))),
        item(1, cls == 4, _line("UPDATE", _row_payload(k, cust, F.lit("X"), price * 4, date, prio))),
        item(0, cls == 5, _line("INSERT", F.concat(F.lit("l_orderkey[bigint]:"), k.cast("string")),
                                "public.lineitem")),
        item(0, cls == 6, F.concat(F.lit("garbage line "), k.cast("string"))),
        item(0, cls == 7, F.concat(F.lit("BEGIN "), k.cast("string"))),
        item(1, cls == 7, _line("UPDATE", _row_payload(k, cust, F.lit("Y"), price, date, prio))),
        item(2, cls == 7, F.concat(F.lit("COMMIT "), k.cast("string"))),
        item(0, cls == 8, _line("UPDATE", F.concat(F.lit("old-key: o_orderkey[bigint]:"), k.cast("string"), F.lit(" new-tuple: "),
                                                   _row_payload(F.expr(NEW_KEY), cust, F.lit("K"), price, date, F.concat(prio, F.lit("\nsecond line")))))),
        item(0, cls == 9, _line("UPDATE", F.concat_ws(" ", F.concat(F.lit("o_orderkey[bigint]:"), k.cast("string")), F.concat(F.lit("o_custkey[bigint]:"), _num(cust)),
                                                      F.lit("o_orderstatus[character varying]:'T' o_totalprice[double precision]:unchanged-toast-datum"),
                                                      F.concat(F.lit("o_orderdate[timestamp without time zone]:"), _q(F.date_format(date, "yyyy-MM-dd HH:mm:ss"))),
                                                      F.concat(F.lit("o_orderpriority[character varying]:"), _q(prio))))),
        item(1, cls == 9, _line("DELETE", F.lit("(no-tuple-data)"))),
        item(2, cls == 9, _line("UPDATE", F.lit("o_orderkey[bigint]:none o_orderstatus[character varying]:'B'"))),
    )
    x = orders.select(k, F.explode(items).alias("it")).filter(F.col("it.value").isNotNull())
    return x.select((k * 10 + F.col("it.pos")).cast("long").alias("seq"), F.col("it.value").alias("value"))


ORDERS_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                 "o_orderdate timestamp_ntz, o_orderpriority string")
