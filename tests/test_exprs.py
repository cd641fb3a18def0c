"""Column expressions on hand-made values (edge cases the bulk data hides)."""

from decimal import Decimal

from pyspark.sql import functions as F

from quotalens.functions import exprs as X


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_decorated_number(spark):
    data = [("1,05.5%",), ("92.25USD",), ("100%",), (None,), ("abc",), ("",), ("iUSDnteger",),
            (" 7 quantity",)]
    got = one(spark, X.decorated_number("t"), data, "t string")
    assert got == [105.5, 92.25, 100.0, None, None, None, None, 7.0]
    # nested replaces in order: 'iUSDnteger' -> 'integer' -> ''
    assert one(spark, X.strip_decorations("t"), [("iUSDnteger",)], "t string") == [""]


def test_fx_factor_null_and_zero_give_zero(spark):
    got = one(spark, X.fx_factor("t"), [("0%",), (None,), ("abc",), ("105.5%",)], "t string")
    assert got == [Decimal(0), Decimal(0), Decimal(0), Decimal("1.0550000000")]


def test_accrual_rate_keeps_null(spark):
    assert one(spark, X.fx_rate("t"), [(None,), ("92.25USD",)], "t string") == [
        None, Decimal("92.2500000000")]


def test_credit_type_label(spark):
    data = [("Invoice Revenue", "ICO-1"), ("Invoice Revenue", "CO-1"),
            ("Invoice Revenue", "X-1"), ("Invoice Revenue Adj", "CO-2"),
            ("Invoice Revenue Adj", "ICO-2"), (None, "CO-3")]
    got = one(spark, X.credit_type_label("t", "n"), data, "t string, n string")
    assert got == ["Roll up", "Direct Receiver", "Invoice Revenue", "Direct Receiver",
                   "Invoice Revenue Adj", None]


def test_event_type_label(spark):
    got = one(spark, X.event_type_label("e", "INV"), [("Invoice",), ("Debit Memo",), ("Return",),
                                                     (None,)], "e string")
    assert got == ["INV", "INV", "Return", None]


def test_fiscal_month_order(spark):
    got = one(spark, X.fiscal_month_order("m"), [("July 1998",), ("June 1999",), ("MONTH",),
                                                 ("october 1998",)], "m string")
    assert got == [1, 12, None, None]


def test_zero_fallback_is_not_coalesce(spark):
    got = one(spark, X.zero_fallback("x", "y"), [(0, 5), (None, 5), (3, 5)], "x int, y int")
    assert got == [5, None, 3]


def test_ti_usd_rounds_before_zero_test(spark):
    # 0 < number6 < 0.005 -> LOC keeps the number, USD falls back to target compensation
    data = [(Decimal("0.004"), Decimal("1000"), "100%")]
    sch = "n decimal(25,10), tc decimal(25,10), fx string"
    assert one(spark, X.ti_loc("n", "tc"), data, sch) == [Decimal("0.0040000000")]
    assert one(spark, X.ti_usd("n", "tc", "fx"), data, sch) == [Decimal("1000.00")]


def test_tier_rate(spark):
    data = [(0.5, 10.0, 2.0), (0.5, 10.0, 0.0), (0.5, 10.0, None), (0.25, 10.0, -1.0)]
    got = one(spark, X.tier_rate("r", "q", "t"), data, "r double, q double, t double")
    assert got == [3.0, 0.0, 0.0, -3.0]  # 2.5 -> 3, -2.5 -> -3 (half away from zero)


def test_money_and_percent_text(spark):
    data = [(Decimal("1234.56789"),), (None,)]
    sch = "x decimal(25,10)"
    assert one(spark, X.money_text("x", dollar=True), data, sch) == ["$1234.5679", None]
    assert one(spark, X.percent_text("x"), [(Decimal("0.125"),)], sch) == ["12.5000%"]


def test_mask_keeps_null_type(spark):
    got = one(spark, X.mask_by_credit_type("t", F.col("v")),
              [("Roll up", 1), (None, 2), ("Invoice Revenue", 3)], "t string, v int")
    assert got == [None, 2, 3]


def test_full_name_null_propagates(spark):
    got = one(spark, X.full_name("l", "f"), [("A", "B"), (None, "B")], "l string, f string")
    assert got == ["A B", None]
