"""Money as whole cents.

Amounts travel between operators as BIGINT cents: sums stay exact, order
independent and inside whole-stage codegen, while DECIMAL sums widen past 18
digits and leave the fast path.  ``amount`` turns cents into DECIMAL(18,2) at
the edge of a job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Interest rates in basis points.
DETAIL_RATE_BP = 500      # interest on carried debt when a statement is issued, basis points
LATE_FIRST_RATE_BP = 200  # first payment after the first due date
LATE_SECOND_RATE_BP = 500  # first payment after the second due date


def cents(value: Column) -> Column:
    """Whole cents of an amount given as DOUBLE or DECIMAL, halves away from zero."""
    return F.round(value * 100).cast("bigint")


def amount(value: Column) -> Column:
    """DECIMAL(18,2) amount of BIGINT cents."""
    return (value.cast("decimal(20,0)") / 100).cast("decimal(18,2)")


def amount_text(value: Column) -> Column:
    """Cents as text with thousands separators and two decimals, ``1,234.50``."""
    return F.format_number(amount(value), 2)


def plain_text(value: Column) -> Column:
    """Non-negative cents as plain text with two decimals, ``1234.50``."""
    return F.concat(
        int_div(value, F.lit(100)).cast("string"),
        F.lit("."),
        F.lpad((value % 100).cast("string"), 2, "0"),
    )


def int_div(num: Column, den: Column) -> Column:
    """Integer quotient truncated toward zero."""
    return F.call_function("div", num, den)


def div_round(num: Column, den: Column) -> Column:
    """Integer quotient of ``num`` by a positive ``den``, halves away from zero."""
    num, den = num.cast("bigint"), den.cast("bigint")
    half_up = int_div(F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -half_up).otherwise(half_up)


def share_of(total: Column, basis_points: Column) -> Column:
    """``total`` times a share in basis points (1/100 of a percent), rounded to the unit."""
    return div_round(total.cast("bigint") * basis_points, F.lit(10000))


def exact_part(total: Column, num: Column, den: Column, product: Column | None = None) -> tuple[Column, Column]:
    """``total * num / den`` as (whole, rest): whole part rounded down and what is left over ``den``, 0 <= rest < den.

    Whole and rest of ``total / den`` are scaled apart, so that only ``den * num`` has to fit in BIGINT.  Where
    ``product`` is at hand, ``try_multiply(total, num)``, it does if it fits and is not negative.
    """
    left = F.pmod(total, den)
    whole = int_div(total - left, den) * num + int_div(left * num, den)
    rest = (left * num) % den
    if product is None:
        return whole, rest
    plain = product >= 0
    return F.when(plain, int_div(product, den)).otherwise(whole), F.when(plain, product % den).otherwise(rest)


def rounded_sum(whole: Column, rest: Column, den: Column) -> Column:
    """``whole + rest / den`` rounded to the unit, halves away from zero, for 0 <= rest."""
    floor, rest = whole + int_div(rest, den), rest % den
    up = F.when(floor >= 0, rest * 2 >= den).otherwise(rest * 2 > den)
    return floor + up.cast("bigint")


def fraction_of(total: Column, num: Column, den: Column) -> Column:
    """``total`` times the exact share ``num / den``, rounded once to the unit, halves away from zero."""
    return rounded_sum(*exact_part(total.cast("bigint"), num, den), den)


def weighted_part(value: Column, weight: Column, weight_sum: Column) -> Column:
    """``value`` cents times ``weight / weight_sum`` in millionths of the currency unit, as BIGINT.

    Quotient and remainder are scaled apart; the product is DECIMAL(38), which any two amounts fit in.  0 when the weights
    do not add up to more than 0.
    """
    amount_, part, whole = (c.cast("decimal(19,0)") for c in (value, weight, weight_sum))
    product = F.abs(amount_ * part)
    size = int_div(product, whole) * 10000 + int_div((product % whole) * 20000 + whole, whole * 2)
    signed = F.when((value < 0) != (weight < 0), -size).otherwise(size)
    return F.when(weight_sum > 0, signed).otherwise(F.lit(0))
