"""The monthly chain: import all files, issue statements, apply payments, publish once.

Tables are written as they become final and read back by the later steps; the run counts only after its last table is there.
A run reads and writes what is new and what that touches, not history.  Of the facts it writes new payments, the costs it
charges, its own statements and lines, and again only the lines of periods that new payments settle.  It reads the months
next to its range, the lines it changes, and of older payments the ids, by the range of the new ones.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators import maintenance as m
from ..operators.numbering import continue_ids, dense_numbers
from ..sources import files as src
from ..sources.versions import OPEN, NewVersion, month_name
from . import annexes, ingest, statements as st


@dataclass(frozen=True)
class MonthlyFiles:
    """Paths of the monthly drop."""

    buildings: str
    persons: str
    unit_holders: str
    unit_sizes: str
    suppliers: str
    costs: str
    payments: str
    person_separator: str = ";"
    costs_as_array: bool = True
    cost_record_key: str | None = None  # first key of the documents, to read a large array in many tasks


def with_accounts(buildings: DataFrame, accounts: DataFrame | None) -> DataFrame:
    """Give buildings without a bank account the free accounts in order."""
    if accounts is None:
        return buildings
    free = accounts.join(buildings.select("cvu"), "cvu", "left_anti")
    pairs = (
        dense_numbers(buildings.filter(F.col("cvu").isNull()).select("id"), ["id"], name="posicion")
        .join(dense_numbers(free.select("cvu", "saldo_cents"), ["cvu"], name="posicion"), "posicion")
        .select("id", F.col("cvu").alias("_cvu"), F.col("saldo_cents").alias("_saldo"))
    )
    return buildings.join(pairs, "id", "left").select(
        "id", "nombre", F.coalesce("cvu", "_cvu").alias("cvu"), "direccion", "m2_total",
        F.coalesce("saldo_cents", "_saldo").alias("saldo_cents"),
    )


UNREADABLE = "fila ilegible"


class _Drop:
    """The parsed files of a drop; keeps what was refused on the way, for the reject table."""

    def __init__(self, spark: SparkSession, files: MonthlyFiles):
        self.spark, self.files = spark, files
        self.refused: list[DataFrame] = []

    def read(self, name: str, *options) -> DataFrame:
        loaded = getattr(src, f"read_{name}")(self.spark, getattr(self.files, name), *options)
        self.refuse(name, loaded.rejected)
        return loaded.good

    def refuse(self, name: str, rows: DataFrame, reason: str = UNREADABLE) -> None:
        self.refused.append(rows.select(F.lit(name).alias("origen"), F.lit(reason).alias("motivo"), F.to_json(F.struct("*")).alias("detalle")))

    def refuse_documents(self, entries: DataFrame) -> None:
        """Entries of cost documents that carry their reason."""
        self.refused.append(entries.select(F.lit("costs").alias("origen"), "motivo", "detalle"))

    def rejects(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.refused).distinct()


def _buildings(listed: DataFrame, old: DataFrame, sizes: DataFrame) -> DataFrame:
    merged = ingest.import_buildings(listed, old)
    found = m.discover_parents(
        m.require_keys(sizes, ["consorcio", "numero"]).select(F.col("consorcio").alias("nombre")),
        merged, "nombre", schemas.UNKNOWN_ADDRESS,
    ).withColumn("id", F.lit(None).cast("bigint"))
    return merged.unionByName(continue_ids(found, merged, "id", ["nombre"]), allowMissingColumns=True)


def _months(period_range: st.Range, shift: int = 0) -> set[str]:
    """Partitions of the months of a range moved by ``shift``."""
    return {month_name(period_range.after(i + shift)) for i in range(period_range.months)}


def _moved(partitions: set[str], months: int) -> set[str]:
    """Partitions so many months later."""
    index = (int(p[:4]) * 12 + int(p[5:]) - 1 + months for p in partitions if p != OPEN)
    return {month_name(dt.date(i // 12, i % 12 + 1, 1)) for i in index}


def run_month(
    spark: SparkSession,
    root: str,
    files: MonthlyFiles,
    period_range: st.Range,
    year: int,
    accounts: DataFrame | None = None,
    extraordinary: DataFrame | None = None,
) -> str:
    """Run the chain for a drop and return the new version.

    ``year`` dates the cost documents, which name only their month.
    ``extraordinary`` holds new extraordinary costs in table layout.  Statements
    of the range must not exist yet; running the imports again adds nothing.
    """
    out, drop = NewVersion(spark, root), _Drop(spark, files)
    old = out.base
    if old.partitions("expensa") & _months(period_range):
        raise ValueError("the range holds periods with statements already issued")

    sizes = drop.read("unit_sizes")
    buildings = out.stage(with_accounts(_buildings(drop.read("buildings"), old.read("consorcio"), sizes), accounts))

    person_lines = drop.read("persons", files.person_separator)
    unusable = F.coalesce(ingest.rounded_account(F.col("cvu")), F.lit(True)) | ingest.long_dni(F.col("dni"))
    drop.refuse("persons", person_lines.filter(unusable), "cuenta o documento ilegible")
    known_persons = old.read("persona")
    new_persons = ingest.import_persons(person_lines.filter(~unusable), known_persons).withColumn("id", F.lit(None).cast("bigint"))
    out.write("persona", continue_ids(new_persons, known_persons, "id", ["dni", "cvu"]))

    holders, strangers = ingest.import_unit_holders(drop.read("unit_holders"), old.read("unidad"), buildings, out.read("persona"))
    drop.refuse("unit_holders", strangers, "consorcio, titular o cuenta desconocidos")
    new_units = continue_ids(
        holders.drop("consorcio").withColumn("uf_id", F.lit(None).cast("bigint")), old.read("unidad"), "uf_id",
        ["consorcio_id", "numero", "cvu"],
    )
    filled, _ = ingest.import_unit_sizes(sizes, old.read("unidad").unionByName(new_units, allowMissingColumns=True), buildings)
    units = out.replace("unidad", filled)

    new_payments = _payments(out, drop)
    costs = _costs(out, drop, buildings, period_range, year, extraordinary)

    # New payments settle lines of any statement issued, older ones only those of the statements issued now.
    issuing = st.statements_of(buildings, period_range)
    settling = _moved({f.partition for f in out.written["pago"]}, -1)
    issued = old.read("expensa", settling).select("consorcio_id", "periodo").unionByName(issuing)
    early = old.read("pago", _months(period_range, 1))
    out.write(
        "pago_aplicado",
        st.apply_payments(new_payments, units, issued).unionByName(st.apply_payments(early, units, issuing)),
    )
    settled = {f.partition for f in out.written["pago_aplicado"]}
    touched = (settled | _moved(settled, 1)) & old.partitions("detalle_expensa")
    if touched:
        applied = out.read("pago_aplicado", touched | _moved(touched, -1))
        out.write("detalle_expensa", _refresh(old.read("detalle_expensa", touched), applied), replacing=touched)

    last = {month_name(period_range.after(-1))}
    opening_debt = out.read("detalle_expensa", last).select(
        "uf_id", (F.col("total_cents") - F.col("pagado_cents")).alias("deuda_cents")
    )
    payments = out.read("pago", _months(period_range, -1) | _months(period_range) | _months(period_range, 1))
    new_lines = st.statement_detail(units, costs, payments, period_range, opening_debt)
    out.write("detalle_expensa", _refresh(new_lines, out.read("pago_aplicado", _months(period_range) | last)))

    headers = out.write("expensa", st.statement_header(buildings, units, costs, payments, period_range))
    closing = headers.groupBy("consorcio_id").agg(F.max_by("saldo_cierre_cents", "periodo").alias("_closing"))
    closed = out.replace(
        "consorcio",
        buildings.join(closing, buildings.id == closing.consorcio_id, "left").withColumn(
            "saldo_cents", F.coalesce("_closing", "saldo_cents", F.lit(0))
        ),
    )

    for table, weight in (("cochera", annexes.PARKING_WEIGHT), ("baulera", annexes.STORAGE_WEIGHT)):
        sized = units.withColumn("m2", F.coalesce("m2", F.lit(0)))
        out.write(table, annexes.new_annexes(sized, old.read(table).select("uf_id", "numero"), weight))

    _write_fixed_tables(out, closed, accounts)
    out.write("rechazo", m.absent_rows(drop.rejects(), old.read("rechazo"), ["origen", "motivo", "detalle"]))
    return out.commit()


def _payments(out: NewVersion, drop: _Drop) -> DataFrame:
    """Write the payments of the drop that are new; of the old ones only ids between its least and greatest are read."""
    lines = drop.read("payments")
    low, high = lines.agg(F.min("id_pago"), F.max("id_pago")).first()
    known = out.base.read("pago").filter(F.col("id_pago").between(low, high)) if low is not None else None
    new, refused = ingest.import_payments(lines, known)
    drop.refuse("payments", refused, "pago incompleto o contradictorio")
    return out.write("pago", new)


def _costs(
    out: NewVersion, drop: _Drop, buildings: DataFrame, period_range: st.Range, year: int, extraordinary: DataFrame | None
) -> DataFrame:
    """Write the costs of the drop, each with the statement that charges it, and return those that this range charges.

    Costs that no statement has charged are in the open partition; what the range charges goes to its partitions, the rest
    stays there.
    """
    old, files = out.base, drop.files
    documents = src.read_costs(drop.spark, files.costs, files.costs_as_array, files.cost_record_key)
    entries = out.stage(ingest.cost_entries(documents, buildings, year))
    # A building has one document per month: another one is refused, also when it is the same one again.  The costs
    # of a month are charged by its own statement or a later one, or are still open.
    first = entries.agg(F.min("fecha")).first()[0]
    later = {p for p in old.partitions("gasto_ordinario") if p == OPEN or first is not None and p >= month_name(first)}
    known = old.read("gasto_ordinario", later).select("consorcio_id", "fecha").distinct()
    costs = entries.filter("motivo is null")
    repeated = costs.join(known, ["consorcio_id", "fecha"], "left_semi").select(
        F.lit(ingest.REFUSED_REPEATED).alias("motivo"), F.to_json(F.struct("consorcio_id", "fecha", "tipo_servicio", "importe_cents")).alias("detalle")
    )
    drop.refuse_documents(entries.filter("motivo is not null"))
    drop.refuse_documents(repeated)

    names = buildings.select(F.col("id").alias("consorcio_id"), F.col("nombre").alias("consorcio"))
    suppliers = m.scalar_lookup(ingest.supplier_rows(drop.read("suppliers")), names, "consorcio", "consorcio_id").drop("consorcio")
    fresh = ingest.number_costs(m.absent_rows(costs, known, ["consorcio_id", "fecha"]), last_id=old.rows("gasto_ordinario"))
    ordinary = ingest.fill_general_costs(ingest.enrich_with_suppliers(fresh, suppliers), ["nro_factura"])

    charged = []
    for table, new in (("gasto_ordinario", ordinary), ("gasto_extraordinario", extraordinary)):
        waiting = old.read(table, {OPEN})
        every = waiting if new is None else waiting.unionByName(new, allowMissingColumns=True)
        written = out.write(table, st.link_costs(every, period_range), replacing={OPEN})
        charged.append(st.charged_costs(written))
    return st.union_costs(*charged)


def _refresh(lines: DataFrame, applied: DataFrame) -> DataFrame:
    """Lines with payments received, payments of the period before and late interest brought up to date."""
    received = st.payments_received(applied)
    before = received.select(
        "uf_id", F.add_months("periodo", 1).alias("periodo"), F.col("pagado_cents").alias("pagado_anterior_cents")
    )
    columns = lines.columns
    fresh = (
        lines.drop("pagado_cents", "primera_fecha", "pagado_anterior_cents", "mora_cents")
        .join(received, ["uf_id", "periodo"], "left")
        .join(before, ["uf_id", "periodo"], "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("pagado_cents", "pagado_anterior_cents")})
    )
    return st.late_interest(fresh).select(*columns)


def _write_fixed_tables(out: NewVersion, buildings: DataFrame, accounts: DataFrame | None) -> None:
    """Roles and payment methods with their seeds, and bank accounts with the balance their building closed with."""
    seeds = {
        "tipo_rol": (schemas.ROLE_SEEDS, "nombre", "descripcion"),
        "forma_de_pago": (schemas.PAYMENT_METHOD_SEEDS, "descripcion", "confirmacion"),
    }
    for table, (rows, key, other) in seeds.items():
        seed = out.spark.createDataFrame(
            [(i, *row) for i, row in enumerate(rows, 1)], f"id int, {key} string, {other} string"
        )
        out.replace(table, m.seed_if_absent(out.base.read(table), seed, key))
    known = out.base.read("cuenta_bancaria")
    if accounts is not None:
        known = known.unionByName(m.absent_rows(accounts, known.select("cvu"), ["cvu"]), allowMissingColumns=True)
    balances = buildings.select("cvu", F.col("saldo_cents").alias("_balance"))
    out.replace("cuenta_bancaria", known.join(balances, "cvu", "left").withColumn("saldo_cents", F.coalesce("_balance", "saldo_cents")))
