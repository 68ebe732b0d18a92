"""Plans that have to hold when one key owns a third of the rows or the data grows a thousandfold."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from condoflow import registry
from condoflow.plans import ingest, statements as st
from condoflow.plans.annexes import share_of_total
from condoflow.registry.star import RANGE
from condoflow.sources.buckets import add_to_buckets, write_buckets

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def small_limits(spark):
    """No broadcasts and tiny skew limits, so that small data behaves like big data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "50KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k in settings:
        spark.conf.unset(k)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_account_is_split_when_payments_are_applied(small_limits):
    spark = small_limits
    n = 200_000
    account = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000 + 2)
    payments = spark.range(0, n, 1, 8).select(
        F.col("id").alias("id_pago"), F.lpad(account.cast("string"), 22, "0").alias("cvu"),
        F.date_add(F.lit(dt.date(1999, 1, 1)), (F.col("id") % 700).cast("int")).alias("fecha"),
        F.lit(100).cast("bigint").alias("importe_cents"),
    )
    units = spark.range(1, 5003).select(
        F.col("id").alias("uf_id"), F.lpad(F.col("id").cast("string"), 22, "0").alias("cvu"), (F.col("id") % 3).alias("consorcio_id")
    )
    buildings = spark.range(3)
    applied = st.apply_payments(payments, units, st.statements_of(buildings, RANGE))
    assert "SortMergeJoin(skew=true)" in final_plan(applied)
    assert applied.count() == n


@pytest.fixture
def buckets(small_limits):
    """Payments and units in buckets by account; the tables go after the test."""
    spark = small_limits
    payments = spark.range(0, 20_000, 1, 8).select(
        F.col("id").alias("id_pago"), F.lpad((F.col("id") % 500).cast("string"), 22, "0").alias("cvu"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") % 400).cast("int")).alias("fecha"), F.lit(100).cast("bigint").alias("importe_cents"),
    )
    units = spark.range(500).select(
        F.col("id").alias("uf_id"), F.lpad(F.col("id").cast("string"), 22, "0").alias("cvu"), (F.col("id") % 3).alias("consorcio_id"))
    tables = [f"{name}_{uuid.uuid4().hex}" for name in ("pago", "unidad")]
    yield payments, units, *(write_buckets(df, table, "cvu", 4) for df, table in zip((payments, units), tables)), tables[0]
    for table in tables:
        spark.sql(f"DROP TABLE {table}")


def test_bucketed_payments_are_not_shuffled_when_applied(buckets, rows):
    payments, units, stored, stored_units, table = buckets
    statements = st.statements_of(payments.sparkSession.range(3), st.Range(dt.date(2000, 1, 1), dt.date(2000, 6, 1)))
    applied = st.apply_payments(stored, stored_units, statements)
    plan = final_plan(applied)
    plan = plan[:plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    scan = next(i for i, line in enumerate(plan.splitlines()) if table in line)
    above, depth = [], 10**9
    for line in reversed(plan.splitlines()[: scan + 1]):  # the operators between the scan and the root
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            above, depth = [*above, line], at
    assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above)
    assert rows(applied) == rows(st.apply_payments(payments, units, statements)) and applied.count() > 5000
    more = add_to_buckets(payments.limit(10).withColumn("id_pago", F.col("id_pago") + 10**6), table, "cvu", 4)
    assert more.count() == 20_010


def hot_building_units(spark, n):
    """Units of which two thirds belong to one building."""
    building = F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 997 + 2)
    return spark.range(0, n, 1, 8).select(
        F.col("id").alias("uf_id"), F.lpad(F.col("id").cast("string"), 22, "0").alias("cvu"),
        building.cast("bigint").alias("consorcio_id"), F.lit(7).cast("bigint").alias("pct_bp"), (F.col("id") % 70 + 30).alias("m2"),
    )


def test_a_hot_building_is_split_when_lines_are_made(small_limits):
    spark = small_limits
    units = hot_building_units(spark, 60_000)
    costs = spark.range(2, 2000).select(
        F.floor(F.col("id") / 2).alias("consorcio_id"),
        F.date_add(F.lit(dt.date(2000, 1, 5)), (F.col("id") % 2).cast("int")).alias("fecha"),
        F.lit(5_000).cast("bigint").alias("ord_cents"), F.lit(0).cast("bigint").alias("ext_cents"),
    )
    payments = units.select(
        F.col("uf_id").alias("id_pago"), "cvu", F.lit(dt.date(2000, 2, 5)).alias("fecha"), F.lit(7).cast("bigint").alias("importe_cents")
    )
    lines = st.statement_detail(units, costs, payments, st.Range(dt.date(2000, 1, 1), dt.date(2000, 2, 1)))
    assert "SortMergeJoin(skew=true)" in final_plan(lines)
    assert lines.agg(F.sum("total_cents"), F.sum("pagado_cents")).first() == (60_000 * 7, 60_000 * 7)


def test_a_hot_building_is_split_when_shares_are_taken(small_limits):
    units = hot_building_units(small_limits, 200_000).drop("pct_bp")
    shares = share_of_total(units)
    assert "SortMergeJoin(skew=true)" in final_plan(shares)
    assert shares.count() == 200_000


def test_a_hot_service_is_split_when_suppliers_are_filled_in(small_limits):
    spark = small_limits
    n = 200_000
    service = F.when(F.col("id") % 3 > 0, "BANCARIOS").otherwise(F.concat(F.lit("SEGUROS "), F.col("id") % 499))
    nothing = F.lit(None).cast("string")
    costs = spark.range(0, n, 1, 8).select(
        "id", F.lit(1).cast("bigint").alias("consorcio_id"), service.alias("tipo_servicio"),
        nothing.alias("empresa"), nothing.alias("detalle"),
    )
    suppliers = spark.createDataFrame(
        [(1, "BANCARIOS", None, "UNO", "x"), (1, "SEGUROS", None, "DOS", "y")],
        "consorcio_id long, categoria string, categoria_nueva string, empresa string, detalle string",
    )
    filled = ingest.enrich_with_suppliers(costs, suppliers)
    assert "SortMergeJoin(skew=true)" in final_plan(filled)
    assert filled.filter("empresa = 'UNO'").count() == n - len(range(0, n, 3))
    assert filled.filter("empresa is null").isEmpty()


def test_monthly_sums_meet_before_the_shuffle(spark):
    plan = registry.queries()["income_buckets"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scan = plan.rindex("orders.parquet")
    above = plan[:scan]
    assert "partial_sum" in above[above.rindex("Exchange hashpartitioning(cvu"):]


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_product_joins_and_no_global_windows(small_limits, name):
    """No cartesian or nested-loop join, and no window that pulls a whole table into one task."""
    df = registry.queries()[name](small_limits, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "PythonUDF"):
        assert operator not in plan
    single = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    allowed = {"audit_counts", "r5_top_debtors_xml", "join_by_position", "assign_surrogate_id", "ingest_gastos", "upsert_consorcio"}
    assert not single or name in allowed, single


@pytest.mark.parametrize("name", ["filter_period", "filter_date_range"])
def test_date_filters_reach_the_scan(spark, name):
    plan = registry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(" in plan[plan.index("PushedFilters"):]
