"""Cleaning of the text columns found in the monthly files."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .money import amount

# The seven services of the monthly cost file, in file order.
SERVICES = (
    "BANCARIOS",
    "LIMPIEZA",
    "ADMINISTRACION",
    "SEGUROS",
    "GASTOS GENERALES",
    "SERVICIOS PUBLICOS-Agua",
    "SERVICIOS PUBLICOS-Luz",
)

# Prefix of a supplier's expense type -> service category.
CATEGORY_PREFIXES = (
    ("GASTOS BANCARIOS", "BANCARIOS"),
    ("GASTOS DE ADMINISTRACION", "ADMINISTRACION"),
    ("GASTOS DE LIMPIEZA", "LIMPIEZA"),
    ("SEGUROS", "SEGUROS"),
    ("SERVICIOS PUBLICOS", "SERVICIOS PUBLICOS"),
)

# Companies that always belong to public services.
UTILITY_COMPANIES = ("AYSA", "EDENOR")
UTILITY_CATEGORY = "SERVICIOS PUBLICOS"


def key_text(value: Column) -> Column:
    """Comparison form of a text key: outer blanks and case do not count."""
    return F.upper(F.trim(value))


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def no_blanks(value: Column) -> Column:
    return F.replace(F.trim(value), F.lit(" "), F.lit(""))


def clean_cents(value: Column) -> Column:
    """Cents of a number in local or English notation; null when it is not a number.

    A last separator followed by one or two digits is the decimal mark, every
    other ``.`` or ``,`` groups thousands: ``1.234,50``, ``1,234.50`` and
    ``1,234,50`` are all 123450 cents.
    """
    text = F.trim(value)
    digits = F.regexp_replace(text, "[.,]", "")
    scale = (
        F.when(text.rlike(r"[.,][0-9]{2}$"), F.lit(1))
        .when(text.rlike(r"[.,][0-9]$"), F.lit(10))
        .otherwise(F.lit(100))
    )
    return F.when(text.rlike(r"^-?[0-9][0-9.,]*$"), digits.try_cast("bigint") * scale)


def clean_number(value: Column, comma_decimals_only: bool = False) -> Column:
    """DECIMAL(18,2) of an amount text, null when it is not a number.

    ``comma_decimals_only`` applies the plain local rule instead: dots are
    dropped and commas become the decimal point, whatever follows them.
    """
    if comma_decimals_only:
        plain = F.replace(F.replace(value, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
        return plain.try_cast("decimal(18,2)")
    return amount(clean_cents(value))


def decimal_comma(value: Column, to: str) -> Column:
    return F.replace(F.trim(value), F.lit(","), F.lit(".")).try_cast(to)


def money_sign_cents(value: Column) -> Column:
    """Cents of a ``$ 1234.50`` text; null when the rest is not a number."""
    plain = F.trim(F.replace(value, F.lit("$"), F.lit(""))).try_cast("decimal(18,2)")
    return (plain * 100).cast("bigint")


def normalize_category(expense_type: Column) -> Column:
    upper = F.upper(expense_type)
    result = None
    for prefix, category in CATEGORY_PREFIXES:
        hit = upper.startswith(prefix)
        result = F.when(hit, category) if result is None else result.when(hit, category)
    return result.otherwise(upper)


def utility_category(company_cell: Column) -> Column:
    """Public-services category for the utility companies, null for others."""
    return F.when(key_text(company_cell).isin(*UTILITY_COMPANIES), UTILITY_CATEGORY)


def company_name(company_cell: Column) -> Column:
    """Part of ``company - detail`` before the first dash."""
    return F.trim(F.substring_index(company_cell, "-", 1))


def cost_detail(company_cell: Column, extra: Column) -> Column:
    """The extra detail if any, else what follows the first dash, else the whole cell."""
    tail = F.substr(company_cell, F.instr(company_cell, "-") + 1)
    return F.coalesce(blank_to_null(extra), blank_to_null(tail))


def zero_pad(value: Column, width: int) -> Column:
    """``value`` with leading zeros up to ``width``; a longer one stays whole."""
    digits = value.cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def invoice_number(building_id: Column, issued: Column, sequence: Column) -> Column:
    """Ten digits: last 3 of the building, yyMM, last 3 of the sequence."""
    return F.concat(
        zero_pad(building_id % 1000, 3),
        F.date_format(issued, "yyMM"),
        zero_pad(F.abs(sequence) % 1000, 3),
    )


def bucket_of(key: Column, buckets: int) -> Column:
    """Repeatable 0-based bucket of a key, spread by the first 32 bits of its MD5."""
    head = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10)
    return (head.cast("bigint") % buckets).cast("int")


def choose_by_hash(key: Column, options: tuple[str, ...]) -> Column:
    """Repeatable pseudo-random pick: the same key always gets the same option."""
    return F.get(F.array(*[F.lit(o) for o in options]), bucket_of(key, len(options)))
