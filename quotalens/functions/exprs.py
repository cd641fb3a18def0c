"""Pure Column expressions used by the reports. All JVM-side built-ins (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotalens.schemas import MONEY_2, TEXT_DEC

# The decorations stripped from numbers held as text, in this order.
DECORATIONS = [",", "%", "USD", "quantity", "integer"]

# Fiscal month order by month-name prefix (fiscal year starts in July).
FISCAL_MONTHS = ["July", "August", "September", "October", "November", "December",
                 "January", "February", "March", "April", "May", "June"]

# Credit-type labels and the credit types whose money columns are masked (FY26).
DIRECT_RECEIVER = "Direct Receiver"
ROLL_UP = "Roll up"
MASKED_CREDIT_TYPES = ["Direct Receiver", "Revenue Adjustment", "Roll up"]
INVOICE_EVENT_TYPES = ["Invoice", "Credit Memo", "Debit Memo"]
PERCENT_PLAN_ELEMENTS = ["MBO", "YOY Growth"]
DEFAULT_INVOICE_LABEL = "Invoice (all)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_decorations(c) -> Column:
    """Remove the five decorations with nested replaces (order matters on overlaps)."""
    out = _c(c)
    for token in DECORATIONS:
        out = F.replace(out, F.lit(token), F.lit(""))
    return out


def decorated_number(c, strict: bool = False) -> Column:
    """Number inside decorated text ('1,05.5%' -> 105.5) as double.

    Bad text gives NULL (``try_cast``); ``strict=True`` raises like the reference's TO_DOUBLE.
    """
    s = strip_decorations(c)
    return s.cast("double") if strict else s.try_cast("double")


def bad_number(c) -> Column:
    """True where text is there but holds no number (null text is no failed parse)."""
    return _c(c).isNotNull() & decorated_number(c).isNull()


FX_DEC = "decimal(20,10)"


def fx_factor(c, strict: bool = False) -> Column:
    """Attainment FX factor: rate/100 when the rate is non-zero, else 0 (NULL text -> 0).

    The text is parsed as a double (TO_DOUBLE) and the factor fixed to decimal(20,10), so money
    products are exact decimal arithmetic: the same on every engine and in every row order.
    """
    r = decorated_number(c, strict)
    return F.when(r != 0, (r / 100).cast(FX_DEC)).otherwise(F.lit(0).cast(FX_DEC))


def exact_product(a, b) -> Column:
    """Product of a decimal(25,10) and a decimal(20,10), rounded half up once to ten digits.

    The full product has 45 digits, and Spark cuts the scale of one that passes 38. ``a`` is
    therefore split into its whole part and its fraction, which have its sign: the product with the
    whole part is exact at ten digits, the one with the fraction exact at twenty and then rounded.
    Their sum is the rounded product, because adding a multiple of the last digit with the same
    sign moves no rounding. The whole range of both types is covered.
    """
    a, b = _c(a).cast("decimal(25,10)"), _c(b).cast(FX_DEC)
    fraction = (a % F.lit(1).cast("decimal(1,0)")).cast("decimal(10,10)")
    whole = (a - fraction).cast("decimal(15,0)")
    return whole * b + (fraction * b).cast("decimal(21,10)")


def checked_number(c, what: str) -> Column:
    """``decorated_number`` that raises on text that is no number (null text stays null).

    For numbers that decide whether a row is kept: a bad one must not remove the row unseen.
    """
    return F.when(bad_number(c), F.raise_error(F.concat(F.lit(f"not a number in {what}: "), _c(c)))
                  .cast("double")).otherwise(decorated_number(c))


def fx_rate(c, strict: bool = False, per_cent: bool = False) -> Column:
    """Accrual FX: the parsed rate (NULL stays NULL), optionally /100, as decimal(20,10)."""
    r = decorated_number(c, strict)
    return (r / 100 if per_cent else r).cast(FX_DEC)


def credit_type_label(type_id, name) -> Column:
    """Searched CASE over credit type id and credit name (prefix tests are case-sensitive)."""
    t, n = _c(type_id), _c(name)
    return (F.when(t.like("Invoice Revenue%") & n.like("CO%"), F.lit(DIRECT_RECEIVER))
            .when((t == "Invoice Revenue") & n.like("ICO%"), F.lit(ROLL_UP))
            .otherwise(t))


def event_type_label(event_id, invoice_label: str = DEFAULT_INVOICE_LABEL) -> Column:
    """Invoice / Credit Memo / Debit Memo collapse to one label; others pass through."""
    e = _c(event_id)
    return F.when(e.isin(*INVOICE_EVENT_TYPES), F.lit(invoice_label)).otherwise(e)


def fiscal_month_order(month_name) -> Column:
    """1 for a name starting 'July' ... 12 for 'June'; NULL otherwise."""
    m = _c(month_name)
    out = None
    for i, name in enumerate(FISCAL_MONTHS, start=1):
        cond = m.like(f"{name}%")
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out


def zero_fallback(x, y) -> Column:
    """``case when x = 0 then y else x``: NULL x stays NULL (not a coalesce)."""
    x = _c(x)
    return F.when(x == 0, _c(y)).otherwise(x)


def ti_loc(number6, target_comp) -> Column:
    return zero_fallback(number6, target_comp)


def ti_usd(number6, target_comp, fx_text) -> Column:
    """TI in USD: zero test after rounding to 2 decimals, times the FX factor, as decimal(18,2)."""
    n2 = _c(number6).cast(MONEY_2)
    return (zero_fallback(n2, target_comp) * fx_factor(fx_text)).cast(MONEY_2)


def flag_set(c) -> Column:
    """``coalesce(flag, 0) = 1``."""
    return F.coalesce(_c(c), F.lit(0)) == 1


def dept_code(cc_dept) -> Column:
    return F.substring(_c(cc_dept), 1, 4)


def substr_from(c, pos: int = 100) -> Column:
    """``substr(s, pos)``: the text from position ``pos`` on."""
    return F.substring(_c(c), pos, 2147483647)


def full_name(last, first) -> Column:
    """last || ' ' || first; NULL if either side is NULL."""
    return F.concat(_c(last), F.lit(" "), _c(first))


def tier_rate(rate, quota, ti) -> Column:
    """FY25 tier rate: 0 when TI is NULL/0, else round(rate * quota / ti) (half away from zero)."""
    r, q, t = _c(rate).cast("double"), _c(quota).cast("double"), _c(ti).cast("double")
    return F.when(F.coalesce(t, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(
        F.round(F.try_divide(r * q, t), 0))


def money_text(c, dollar: bool = False) -> Column:
    """decimal(20,4) printed as text, optionally with a leading '$' (NULL stays NULL)."""
    txt = _c(c).cast(TEXT_DEC).cast("string")
    return F.concat(F.lit("$"), txt) if dollar else txt


def percent_text(c) -> Column:
    """round(x * 100, 4) || '%'."""
    return F.concat(F.round(_c(c) * 100, 4).cast("string"), F.lit("%"))


def round4_text(c, prefix: str = "", suffix: str = "") -> Column:
    txt = F.round(_c(c), 4).cast("string")
    parts = ([F.lit(prefix)] if prefix else []) + [txt] + ([F.lit(suffix)] if suffix else [])
    return F.concat(*parts) if len(parts) > 1 else txt


def mask_by_credit_type(credit_type, value) -> Column:
    """NULL for the masked credit types; a NULL credit type is not masked."""
    return F.when(_c(credit_type).isin(*MASKED_CREDIT_TYPES), F.lit(None)).otherwise(_c(value))


def format_by_plan_element(plan_element, value, else_prefix: str = "") -> Column:
    """MBO / YOY Growth print as percent text, others plain (or with a prefix)."""
    pe = _c(plan_element)
    return F.when(pe.isin(*PERCENT_PLAN_ELEMENTS), round4_text(value, suffix="%")).otherwise(
        round4_text(value, prefix=else_prefix))
