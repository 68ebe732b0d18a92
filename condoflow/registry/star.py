"""The domain tables as derived from a star schema.

nation -> buildings, customer -> holders and their units, orders -> payments,
lineitem with supplier -> costs.  Everything is a projection or aggregation of
the given tables, so the work grows with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import money, text
from ..plans import statements as st
from ..plans.annexes import share_of_total
from ..session import configure

AS_OF = dt.date(2002, 12, 31)  # the day of the reports, so that they do not change with the calendar
RANGE = st.Range(dt.date(1995, 1, 1), dt.date(2001, 12, 1))
EXTRAORDINARY_FLAG = "R"


class Star:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.dir = sf_dir.rstrip("/")
        self._schemas = {}

    def read(self, table: str) -> DataFrame:
        """A fresh scan of the table; its footer is read for the schema only once."""
        path = f"{self.dir}/{table}.parquet"
        if table not in self._schemas:
            self._schemas[table] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[table]).parquet(path)

    def buildings(self) -> DataFrame:
        """id, nombre, direccion and the opening balance: what its suppliers hold."""
        balances = self.read("supplier").groupBy("s_nationkey").agg(
            F.sum(money.cents(F.col("s_acctbal"))).alias("saldo_cents")
        )
        nation = self.read("nation")
        return nation.join(balances, nation.n_nationkey == balances.s_nationkey, "left").select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.col("n_name").alias("nombre"),
            F.concat(F.lit("Calle "), F.col("n_name")).alias("direccion"),
            F.coalesce("saldo_cents", F.lit(0)).alias("saldo_cents"),
        )

    def building_names(self) -> DataFrame:
        return self.read("nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("nombre")
        )

    def persons(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.read("customer").select(
            key.alias("id"),
            F.col("c_name").alias("nombre"),
            F.col("c_mktsegment").alias("apellido"),
            text.zero_pad(key, 8).alias("dni"),
            F.concat(F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")), F.lit("@example.org")).alias("email"),
            text.zero_pad(key, 22).alias("cvu"),
            F.concat(F.lit("11"), text.zero_pad(key, 8)).alias("telefono"),
            (key % 2 + 1).cast("int").alias("rol_id"),
        )

    def bare_units(self) -> DataFrame:
        """Units without their share."""
        key = F.col("c_custkey")
        return self.read("customer").select(
            key.alias("uf_id"),
            text.zero_pad(key, 22).alias("cvu"),
            F.col("c_nationkey").cast("bigint").alias("consorcio_id"),
            F.chr(key % 5 + 65).alias("departamento"),
            F.when(key % 10 == 0, "PB").otherwise((key % 10).cast("string")).alias("piso"),
            key.cast("int").alias("numero"),
            (key % 70 + 30).alias("m2"),
        )

    def units(self) -> DataFrame:
        return share_of_total(self.bare_units())

    def payments(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("id_pago"),
            text.zero_pad(F.col("o_custkey"), 22).alias("cvu"),
            F.to_date("o_orderdate").alias("fecha"),
            money.cents(F.col("o_totalprice")).alias("importe_cents"),
        )

    def cost_items(self) -> DataFrame:
        """Every cost with its building, service and kind."""
        service = F.get(F.array(*[F.lit(s) for s in text.SERVICES]), F.col("l_linenumber") - 1)
        supplier = self.read("supplier").select("s_suppkey", "s_nationkey")
        item = self.read("lineitem")
        return item.join(supplier, item.l_suppkey == supplier.s_suppkey).select(
            F.col("s_nationkey").cast("bigint").alias("consorcio_id"),
            F.to_date("l_shipdate").alias("fecha"),
            money.cents(F.col("l_extendedprice")).alias("importe_cents"),
            service.alias("tipo_servicio"),
            (F.col("l_returnflag") == EXTRAORDINARY_FLAG).alias("extraordinario"),
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        )

    def ordinary_costs(self) -> DataFrame:
        return self.cost_items().filter(~F.col("extraordinario"))

    def extraordinary_costs(self) -> DataFrame:
        return self.cost_items().filter("extraordinario")

    def costs(self) -> DataFrame:
        """Same rows as the union of both kinds, from one scan."""
        value, extra = F.col("importe_cents"), F.col("extraordinario")
        return self.cost_items().select(
            "consorcio_id", "fecha",
            F.when(~extra, value).otherwise(F.lit(0)).alias("ord_cents"),
            F.when(extra, value).otherwise(F.lit(0)).alias("ext_cents"),
        )

    # ---- computed tables over the whole range ----

    def statements(self) -> DataFrame:
        return st.statements_of(self.building_names(), RANGE)

    def applied(self) -> DataFrame:
        return st.apply_payments(self.payments(), self.bare_units(), self.statements())

    def applied_with_shares(self) -> DataFrame:
        applied = st.apply_payments(self.payments(), self.units(), self.statements(), carry=st.SHARE)
        return st.with_shares(applied, self.costs())

    def ledgers(self) -> DataFrame:
        return st.unit_ledgers(self.units(), self.costs(), self.payments(), RANGE)

    def lines(self) -> DataFrame:
        return st.ledger_lines(self.ledgers(), RANGE)

    def paid_lines(self) -> DataFrame:
        """The lines a payment can meet; no row is made of the others."""
        return st.ledger_lines(self.ledgers(), RANGE, paid_only=True)

    def headers(self) -> DataFrame:
        return st.statement_header(self.buildings(), self.bare_units(), self.costs(), self.payments(), RANGE)
