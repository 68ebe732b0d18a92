"""Parking and storage places: one per unit, numbered per building, weighted by size."""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, functions as F

from ..functions.money import div_round
from ..operators.numbering import number_after
from ..operators.spread import spread_join

PARKING_WEIGHT = 100  # percent of the size share a place carries
STORAGE_WEIGHT = 50


def share_of_total(units: DataFrame, weight: int = 100) -> DataFrame:
    """Add the exact share ``share_num`` / ``share_den``, size over the building's total size (0 / 1 if it has no size),
    and ``pct_bp``, the same in basis points for display: rounded, it would vanish in a very large building.

    ``m2`` may have two decimals.  The total is a separate aggregation, so a
    building with very many units is summed map-side.
    """
    hundredths = (F.col("m2") * 100).cast("bigint")
    totals = units.groupBy("consorcio_id").agg(F.coalesce(F.sum(hundredths), F.lit(0)).alias("_total"))
    sized, common = F.col("_total") > 0, gcd(weight, 100)
    share = div_round(hundredths * (100 * weight), F.col("_total"))
    return (
        spread_join(units, totals, ["consorcio_id"], ["uf_id"])
        .withColumns({
            "pct_bp": F.when(sized, share).otherwise(F.lit(0)),
            "share_num": F.when(sized, hundredths * (weight // common)).otherwise(F.lit(0)).cast("bigint"),
            "share_den": F.when(sized, F.col("_total") * (100 // common)).otherwise(F.lit(1)).cast("bigint"),
        })
        .drop("_total")
    )


def new_annexes(units: DataFrame, annexes: DataFrame, weight: int) -> DataFrame:
    """(uf_id, consorcio_id, numero, pct_bp, share_num, share_den) of one new place per unit that has none.

    ``annexes`` are the existing places with uf_id and numero.  Shares are taken
    over all units, numbers go on after the building's largest.
    """
    shares = share_of_total(units, weight).select("uf_id", "consorcio_id", "pct_bp", "share_num", "share_den")
    lacking = shares.join(annexes.select("uf_id"), "uf_id", "left_anti")
    taken = annexes.join(units.select("uf_id", "consorcio_id"), "uf_id").select("consorcio_id", "numero")
    return number_after(lacking, taken, "consorcio_id", "numero", ["uf_id"])
