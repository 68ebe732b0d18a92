"""Imports of the monthly files.

Each job takes parsed file rows and the tables they touch and returns frames:
rows to add, rows to replace, rows refused.  Nothing is imported twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..functions import dates, text
from ..operators import maintenance as m
from ..operators.numbering import continue_ids, dense_numbers
from ..operators.spread import spread_join
from ..sources.files import CORRUPT

# Why a cost document or one of its amounts is refused.
REFUSED_UNREADABLE = "documento ilegible"
REFUSED_NO_BUILDING = "sin consorcio"
REFUSED_MONTH = "mes desconocido"
REFUSED_BUILDING = "consorcio desconocido"
REFUSED_EMPTY = "sin importes"
REFUSED_AMOUNT = "importe ilegible"
REFUSED_NOT_POSITIVE = "importe no positivo"
REFUSED_REPEATED = "documento del mes ya importado"


def parse_payments(lines: DataFrame) -> DataFrame:
    """Typed payments of payment-file rows; unreadable dates or amounts become null."""
    return m.drop_blank_rows(lines).select(
        F.col("id_pago").cast("bigint").alias("id_pago"),
        F.lit(schemas.DEFAULT_PAYMENT_METHOD).alias("forma_pago_id"),
        F.trim("cvu").alias("cvu"),
        F.try_to_date("fecha", "dd/MM/yyyy").alias("fecha"),
        text.money_sign_cents(F.col("valor")).alias("importe_cents"),
    )


def import_payments(lines: DataFrame, payments: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new payments, refused rows): rows without id are skipped, repeated lines and known ids too.

    An id whose rows differ names no single payment: all its rows are refused.  The least and the greatest row of an id
    tell that after map-side aggregation, and the anti-join goes on with the same partitioning.
    """
    parsed = parse_payments(lines).filter(F.col("id_pago").isNotNull())
    complete = F.col("fecha").isNotNull() & F.col("importe_cents").isNotNull() & (F.col("cvu") != "")
    usable = F.coalesce(complete, F.lit(False))
    good = parsed.filter(usable)
    values = F.struct(*(c for c in good.columns if c != "id_pago"))
    by_id = good.groupBy("id_pago").agg(F.min(values).alias("_low"), F.max(values).alias("_high"))
    new = by_id.filter("_low = _high").select("id_pago", "_low.*").select(*good.columns)
    unclear = good.join(by_id.filter("_low <> _high").select("id_pago"), "id_pago", "left_semi")
    if payments is not None:
        new = m.absent_rows(new, payments.select("id_pago"), ["id_pago"])
    return new, parsed.filter(~usable).unionByName(unclear.select(*parsed.columns))


def cost_entries(docs: DataFrame, buildings: DataFrame, year) -> DataFrame:
    """Every amount of the monthly documents with ``motivo``, why it is no cost; null for a cost.

    (consorcio_id, fecha, tipo_servicio, importe_cents, motivo, detalle); costs are dated the first of their month.  ``year`` is
    the year of the drop, a number or the name of a document column.  A document that is no cost as a whole is one
    row, and so is one without amounts, so every document is found again.  ``detalle`` is the document of a refused row.
    """
    services = [s for s in text.SERVICES if s in docs.columns]
    corrupt = F.col(CORRUPT) if CORRUPT in docs.columns else F.lit(None).cast("string")
    given = docs.select(
        F.struct(*[c for c in docs.columns if c != CORRUPT]).alias("_doc"), corrupt.alias("_corrupt"),
        (F.col(year) if isinstance(year, str) else F.lit(year)).alias("_year"),
        dates.spanish_month_number(F.col("Mes")).alias("_mes"),
        text.blank_to_null(F.col("`Nombre del consorcio`")).alias("_consorcio"),
    )
    names = buildings.select(F.col("id").alias("consorcio_id"), text.key_text(F.col("nombre")).alias("_name"))
    found = given.withColumn("_name", text.key_text(F.col("_consorcio"))).join(names, "_name", "left")
    whole = (
        F.when(F.col("_corrupt").isNotNull(), REFUSED_UNREADABLE)
        .when(F.col("_consorcio").isNull(), REFUSED_NO_BUILDING)
        .when(F.col("_mes").isNull(), REFUSED_MONTH)
        .when(F.col("consorcio_id").isNull(), REFUSED_BUILDING)
    )
    amounts = F.array(*[F.struct(F.lit(s).alias("tipo_servicio"), F.col(f"_doc.`{s}`").alias("_text")) for s in services])
    given_amounts = F.filter(amounts, lambda a: F.trim(a["_text"]) != "")
    entries = (
        found.withColumn("_whole", whole)
        .select("*", F.explode_outer(F.when(F.col("_whole").isNull(), given_amounts)).alias("_a"))
        .select(
            "consorcio_id", F.make_date(F.col("_year"), F.col("_mes"), F.lit(1)).alias("fecha"), "_a.tipo_servicio",
            text.clean_cents(F.col("_a._text")).alias("importe_cents"), "_whole", "_doc", "_corrupt",
        )
    )
    reason = F.coalesce(
        "_whole",
        F.when(F.col("tipo_servicio").isNull(), REFUSED_EMPTY)
        .when(F.col("importe_cents").isNull(), REFUSED_AMOUNT)
        .when(F.col("importe_cents") <= 0, REFUSED_NOT_POSITIVE),
    )
    return entries.withColumn("motivo", reason).select(
        "consorcio_id", "fecha", "tipo_servicio", "importe_cents", "motivo",
        F.when(F.col("motivo").isNotNull(), F.coalesce("_corrupt", F.to_json("_doc"))).alias("detalle"),
    )


def number_costs(entries: DataFrame, last_id: int = 0) -> DataFrame:
    """Ordinary costs of the entries without ``motivo``; invoice numbers go on from ``last_id`` in building, month, service order."""
    costs = entries.filter("motivo is null").select("consorcio_id", "fecha", "importe_cents", "tipo_servicio")
    numbered = dense_numbers(costs, ["consorcio_id", "fecha", "tipo_servicio"], name="_seq")
    return numbered.select(
        "consorcio_id",
        F.lit(None).cast("string").alias("empresa"),
        text.invoice_number(F.col("consorcio_id"), F.col("fecha"), F.col("_seq") + last_id).alias("nro_factura"),
        "fecha",
        "importe_cents",
        F.lit(None).cast("string").alias("detalle"),
        "tipo_servicio",
    )


def import_costs(docs: DataFrame, buildings: DataFrame, year, last_id: int = 0) -> DataFrame:
    """Ordinary costs of monthly documents."""
    return number_costs(cost_entries(docs, buildings, year), last_id)


DNI_DIGITS = 8


def long_dni(dni):
    """True for a document number that its column cannot hold; false for a missing one."""
    return F.coalesce(F.length(dni.cast("string")) > DNI_DIGITS, F.lit(False))


def import_persons(lines: DataFrame, persons: DataFrame) -> DataFrame:
    """New persons: shared account numbers out, known (dni, cvu) pairs out, document numbers with too many digits out."""
    lone = m.drop_all_duplicates(m.drop_blank_rows(lines), "cvu").filter(~long_dni(F.col("dni")))
    clean = lone.select(
        F.trim("nombre").alias("nombre"),
        F.trim("apellido").alias("apellido"),
        text.zero_pad(F.col("dni"), DNI_DIGITS).alias("dni"),
        text.no_blanks(F.col("email")).alias("email"),
        F.trim("cvu").alias("cvu"),
        F.col("telefono").cast("string").alias("telefono"),
        F.when(F.col("inquilino") == 1, 1).when(F.col("inquilino") == 0, 2).alias("rol_id"),
    )
    return m.absent_rows(clean, persons.select("dni", "cvu"), ["dni", "cvu"])


def rounded_account(cvu):
    """True for an account number a spreadsheet has rounded to scientific notation."""
    return F.upper(cvu).contains("E+") | ~F.trim(cvu).rlike("^[0-9]{1,22}$")


def import_buildings(lines: DataFrame, buildings: DataFrame) -> DataFrame:
    """The building table after the upsert; new buildings get the next ids."""
    merged = m.upsert(buildings, lines, "nombre", ["direccion", "m2_total"])
    new = continue_ids(merged.filter(F.col("id").isNull()), buildings, "id", ["nombre"])
    return merged.filter(F.col("id").isNotNull()).unionByName(new)


def supplier_rows(lines: DataFrame, *keep: str) -> DataFrame:
    """Suppliers with normalised category, company and detail split apart."""
    company_cell = F.col("empresa_detalle")
    return lines.select(
        *keep,
        F.trim("consorcio").alias("consorcio"),
        text.normalize_category(F.trim("tipo_gasto")).alias("categoria"),
        text.utility_category(company_cell).alias("categoria_nueva"),
        text.company_name(company_cell).alias("empresa"),
        text.cost_detail(company_cell, F.col("detalle_adicional")).alias("detalle"),
    )


def match_suppliers(services: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Suppliers of a building for each of its services that starts with their category.

    The prefix condition becomes an equality by listing the prefixes of a service,
    so no service meets suppliers it does not match.
    """
    name = text.key_text(F.col("tipo_servicio"))
    prefixes = F.transform(F.sequence(F.lit(1), F.length(name)), lambda n: F.substring(name, F.lit(1), n))
    offers = suppliers.filter("categoria != ''")
    return (
        services.filter(F.trim("tipo_servicio") != "")
        .withColumn("categoria", F.explode(prefixes))
        .join(offers, ["consorcio_id", "categoria"])
    )


def enrich_with_suppliers(costs: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Fill company, detail and category of costs without a detail.

    Suppliers are chosen once per (building, service), not per cost; of several
    that match, the one that sorts first counts.  General costs are left alone.
    """
    open_cost = text.blank_to_null(F.col("detalle")).isNull() & (F.col("tipo_servicio") != "GASTOS GENERALES")
    services = costs.filter(open_cost).select("consorcio_id", "tipo_servicio").distinct()
    choice = (
        match_suppliers(services, suppliers)
        .groupBy("consorcio_id", "tipo_servicio")
        .agg(F.min(F.struct("categoria", "empresa", "detalle", "categoria_nueva")).alias("_offer"))
    )
    hit = F.coalesce(open_cost, F.lit(False)) & F.col("_offer").isNotNull()
    return (
        spread_join(costs, choice, ["consorcio_id", "tipo_servicio"], costs.columns, "left")
        .withColumns({
            "_hit": hit,
            "_service": F.coalesce(F.col("_offer.categoria_nueva"), F.col("tipo_servicio")),
        })
        .withColumns({
            "empresa": F.when(F.col("_hit"), F.col("_offer.empresa")).otherwise(F.col("empresa")),
            "detalle": F.when(F.col("_hit"), F.col("_offer.detalle")).otherwise(F.col("detalle")),
            "tipo_servicio": F.when(F.col("_hit"), F.col("_service")).otherwise(F.col("tipo_servicio")),
        })
        .select(*costs.columns)
    )


def import_unit_holders(
    lines: DataFrame, units: DataFrame, buildings: DataFrame, persons: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(new units, refused rows).

    Units whose holder account already has one are skipped.  Refused are rows of
    an unknown building or holder and accounts given to several units at once,
    because payments find their unit by the account alone.
    """
    trimmed = lines.select(
        F.trim("cvu").alias("cvu"), "consorcio", "numero", F.trim("piso").alias("piso"),
        F.trim("departamento").alias("departamento"),
    )
    holders = persons.select("cvu").distinct().withColumn("_holder", F.lit(True))
    uses = trimmed.groupBy("cvu").agg(F.count(F.lit(1)).alias("_uses")).join(holders, "cvu", "left")
    by_account = spread_join(m.absent_rows(trimmed, units.select("cvu"), ["cvu"]), uses, ["cvu"], ["consorcio", "numero"], "left")
    names = buildings.select(F.col("id").alias("consorcio_id"), F.col("nombre").alias("consorcio"))
    checked = m.scalar_lookup(by_account, names, "consorcio", "consorcio_id")
    ok = F.coalesce(F.col("consorcio_id").isNotNull() & F.col("_holder") & (F.col("_uses") == 1), F.lit(False))
    columns = ["cvu", "consorcio", "consorcio_id", "numero", "piso", "departamento"]
    return checked.filter(ok).select(*columns), checked.filter(~ok).select(*columns)


def unit_sizes(lines: DataFrame, buildings: DataFrame) -> DataFrame:
    """(consorcio_id, numero, m2, pct_bp, tipo) of unit-size rows with a building and number."""
    names = buildings.select(F.col("id").alias("consorcio_id"), F.col("nombre").alias("consorcio"))
    return m.scalar_lookup(
        m.require_keys(lines, ["consorcio", "numero"]), names, "consorcio", "consorcio_id"
    ).select(
        "consorcio_id",
        F.trim("numero").try_cast("int").alias("numero"),
        text.decimal_comma(F.col("m2"), "decimal(10,2)").alias("m2"),
        (text.decimal_comma(F.col("coeficiente"), "decimal(5,2)") * 100).cast("bigint").alias("pct_bp"),
        text.choose_by_hash(
            F.concat_ws("|", text.key_text(F.col("consorcio")), F.trim("numero")), schemas.UNIT_TYPES
        ).alias("tipo"),
    )


def import_unit_sizes(lines: DataFrame, units: DataFrame, buildings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(units with their null size, coefficient and type filled, buildings to create)."""
    new_buildings = m.discover_parents(
        m.require_keys(lines, ["consorcio", "numero"]).select(F.col("consorcio").alias("nombre")),
        buildings, "nombre", schemas.UNKNOWN_ADDRESS,
    )
    filled = m.fill_nulls_from(
        units, unit_sizes(lines, buildings), ["consorcio_id", "numero"], ["m2", "pct_bp", "tipo"]
    )
    return filled, new_buildings


def fill_general_costs(costs: DataFrame, key: list[str]) -> DataFrame:
    """Give general costs without vendor or detail a repeatable pick from the fixed lists."""
    salt = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    general = F.upper("tipo_servicio") == "GASTOS GENERALES"
    vendor = text.choose_by_hash(F.concat(F.lit("v|"), salt), schemas.GENERAL_VENDORS)
    detail = text.choose_by_hash(F.concat(F.lit("d|"), salt), schemas.GENERAL_DETAILS)
    return costs.withColumns({
        "empresa": F.when(general, F.coalesce(text.blank_to_null(F.col("empresa")), vendor)).otherwise(F.col("empresa")),
        "detalle": F.when(general, F.coalesce(text.blank_to_null(F.col("detalle")), detail)).otherwise(F.col("detalle")),
    })
