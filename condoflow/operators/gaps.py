"""Days between consecutive payments of a unit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SALTS = 4


def payment_gaps(payments: DataFrame) -> DataFrame:
    """Add ``dias``: days since the unit's previous payment by (fecha, id_pago), null for its first.

    ``primero``/``ultimo`` mark the unit's first and last payment in that order.

    The payments are read once.  A unit's payments fall into slices of one date each, and a date into a few more by
    hash of the id; inside a slice every payment but the first follows one of its own date.  The first and the last payment of each
    slice are carried on to a second window, where they meet those of the unit's other slices: as many as the calendar
    has dates, not as there are payments.  The other payments stay in their slices, so a unit that owns a third of all
    payments is spread over as many groups.
    """
    salted = payments.withColumn("_salt", F.pmod(F.xxhash64("id_pago"), F.lit(SALTS)))
    inside = Window.partitionBy("uf_id", "fecha", "_salt").orderBy("id_pago")
    ends = salted.withColumn("_end", F.lag("id_pago").over(inside).isNull() | F.lead("id_pago").over(inside).isNull())
    slice_of = F.when(~F.col("_end"), F.unix_date("fecha") * SALTS + F.col("_salt"))
    carried = Window.partitionBy("uf_id", "_slice").orderBy("fecha", "id_pago")
    before, after = F.lag("fecha").over(carried), F.lead("fecha").over(carried)
    return ends.withColumn("_slice", slice_of).select(
        *payments.columns,
        F.when(F.col("_end"), F.datediff("fecha", before)).otherwise(F.lit(0)).alias("dias"),
        (F.col("_end") & before.isNull()).alias("primero"),
        (F.col("_end") & after.isNull()).alias("ultimo"),
    )
