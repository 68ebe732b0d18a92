"""XML output of the two reports that leave as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import money
from ..operators.ranking import largest

# Element names of the two documents.
DEBTORS_ROOT, DEBTOR_TAG = "mayoresMorosos", "propietario"
GAPS_ROOT, UNIT_TAG, PAYMENT_TAG = "pagosOrdinarios", "unidadFuncional", "pago"


def debtors_document(debtor_rows: DataFrame, n: int = 3) -> DataFrame:
    """One row, one document: the n largest debtors.  Only those n rows are collected."""
    element = F.to_xml(
        F.struct(
            F.col("dni").alias("_dni"), "nombre", "apellido", "email", "telefono",
            money.amount(F.col("morosidad_cents")).cast("string").alias("morosidad"),
        ),
        {"rowTag": DEBTOR_TAG},
    )
    ranked = F.struct((-F.col("morosidad_cents")).alias("_rank"), "dni", element.alias("_xml"))
    listed = F.array_sort(F.collect_list("_row"))
    return (
        largest(debtor_rows, n, "morosidad_cents", ["dni"])
        .select(ranked.alias("_row"))
        .agg(F.transform(listed, lambda r: r["_xml"]).alias("_elements"))
        .select(
            F.concat(
                F.lit(f"<{DEBTORS_ROOT}>\n"), F.array_join("_elements", "\n"), F.lit(f"\n</{DEBTORS_ROOT}>")
            ).alias("XML_Reporte5")
        )
    )


def gap_fragments(gaps: DataFrame) -> DataFrame:
    """One fragment per payment; in (uf_id, fecha, id_pago) order they make up the document body.

    A unit's first payment opens its element and the last one closes it, so the
    nesting needs no task that holds all payments of a unit.
    """
    payment = F.to_xml(
        F.struct(F.col("fecha").cast("string").alias("_fecha"), F.col("dias").alias("_diasDesdeAnterior")),
        {"rowTag": PAYMENT_TAG},
    )
    opening = F.concat(F.lit(f'<{UNIT_TAG} id="'), F.col("uf_id").cast("string"), F.lit('">'))
    fragment = F.concat(
        F.when(F.col("primero"), opening).otherwise(F.lit("")),
        payment,
        F.when(F.col("ultimo"), F.lit(f"</{UNIT_TAG}>")).otherwise(F.lit("")),
    )
    return gaps.select("uf_id", "fecha", "id_pago", fragment.alias("fragmento"))


def write_gaps(gaps: DataFrame, path: str) -> None:
    """Body of the document as text files; their concatenation in name order, inside the root, is the document."""
    (
        gap_fragments(gaps)
        .repartitionByRange("uf_id", "fecha", "id_pago")
        .sortWithinPartitions("uf_id", "fecha", "id_pago")
        .select("fragmento")
        .write.text(path)
    )
