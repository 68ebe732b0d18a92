"""Monthly cost documents as a column of JSON text instead of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import schemas
from ..functions import money, text


def parse_documents(arrays: DataFrame, array: str = "documentos") -> DataFrame:
    """One row per document of a JSON array text."""
    others = [c for c in arrays.columns if c != array]
    documents = F.from_json(F.col(array), T.ArrayType(schemas.COST_DOCUMENT))
    return arrays.select(*others, F.explode(documents).alias("_d")).select(*others, "_d.*")


def amount_shapes(value: Column, shape: Column) -> Column:
    """Cents as text in one of the notations found in cost files: 0 local, 1 English, 2 commas only."""
    english = F.format_number(money.amount(value), 2)
    return (
        F.when(shape == 0, F.translate(english, ",.", ".,"))
        .when(shape == 1, english)
        .otherwise(F.translate(english, ".", ","))
    )


def document_array(documents: DataFrame, group: list[str], order: str, name: Column, month: Column) -> DataFrame:
    """One JSON array text per group; ``documents`` has a text column per service.

    Groups hold one document per month of a year.
    """
    document = F.struct(
        name.alias("Nombre del consorcio"), month.alias("Mes"), *[F.col(f"`{s}`") for s in text.SERVICES]
    )
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), document.alias("_d"))))
    return documents.groupBy(*group).agg(
        F.to_json(F.transform(ordered, lambda x: x["_d"])).alias("documentos")
    )
