"""Wide monthly cost rows to one row per service."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import SERVICES


def unpivot_services(docs: DataFrame, ids: list[str]) -> DataFrame:
    """One row per document and service with the amount text, nulls included."""
    return docs.unpivot(ids, [F.col(f"`{s}`") for s in SERVICES], "tipo_servicio", "importe_texto")
