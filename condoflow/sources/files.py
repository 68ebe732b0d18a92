"""Readers of the monthly files and writers of the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas

CORRUPT = "_corrupt_record"
ANSI_CODE_PAGE = "windows-1252"
_NO_SEPARATOR = "\u0001"  # a control character; lines that hold it are refused


@dataclass(frozen=True)
class Loaded:
    """A file split into rows that fit its layout and raw lines that do not."""

    good: DataFrame
    rejected: DataFrame


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Raw lines of a text file in column ``linea``, without the header line of each file."""
    lines = (
        spark.read.schema(f"linea string, {CORRUPT} string")
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", _NO_SEPARATOR)
        .option("quote", "")
        .option("encoding", encoding)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    return lines.select(F.coalesce(CORRUPT, "linea").alias("linea"))  # a line that holds the separator comes whole


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str, line: str = "linea") -> DataFrame:
    """Replace the line column by the columns of the layout plus the corrupt-record column.

    Lines are parsed by position and as a whole whatever columns are used later,
    so a bad line is a bad line for every reader of the result.  Parsing goes
    through a generator: later filters stay above it instead of being pushed
    below, where each would parse the line again.
    """
    layout = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_csv(
        F.col(line), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout),
        {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    others = [c for c in lines.columns if c != line]
    return lines.select(*others, F.inline(F.array(parsed)))


def split_rejects(parsed: DataFrame) -> Loaded:
    bad = F.col(CORRUPT).isNotNull()
    return Loaded(parsed.filter(~bad).drop(CORRUPT), parsed.filter(bad).select(CORRUPT))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame itself; raises when it is empty."""
    if df.isEmpty():
        raise ValueError(f"no rows loaded from {what}")
    return df


def load_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str, encoding: str = "UTF-8"
) -> Loaded:
    lines = require_rows(read_lines(spark, path, encoding), path)
    odd = F.coalesce(F.col("linea").contains(_NO_SEPARATOR), F.lit(False))
    loaded = split_rejects(parse_lines(lines.filter(~odd), schema, sep))
    return Loaded(loaded.good, loaded.rejected.unionByName(lines.filter(odd).select(F.col("linea").alias(CORRUPT))))


def read_buildings(spark: SparkSession, path: str) -> Loaded:
    return load_delimited(spark, path, schemas.BUILDING_FILE, ",")


def read_suppliers(spark: SparkSession, path: str) -> Loaded:
    return load_delimited(spark, path, schemas.SUPPLIER_FILE, ";")


def read_unit_holders(spark: SparkSession, path: str) -> Loaded:
    return load_delimited(spark, path, schemas.UNIT_HOLDER_FILE, "|")


def read_unit_sizes(spark: SparkSession, path: str) -> Loaded:
    return load_delimited(spark, path, schemas.UNIT_SIZE_FILE, "\t")


def read_payments(spark: SparkSession, path: str, encoding: str = ANSI_CODE_PAGE) -> Loaded:
    return load_delimited(spark, path, schemas.PAYMENT_FILE, ",", encoding)


def read_persons(
    spark: SparkSession, path: str, sep: str = ";", encoding: str = ANSI_CODE_PAGE
) -> Loaded:
    return load_delimited(spark, path, schemas.PERSON_FILE, sep, encoding)


RECORD_KEY = "_id"  # first key of every cost document


def read_costs(spark: SparkSession, path: str, multi_line: bool = True, record_key: str | None = None) -> DataFrame:
    """Monthly cost documents: one JSON array per file, or one document per line; what cannot be read is in ``CORRUPT``.

    A JSON array read as such cannot be split: one file is one task.  With ``record_key``, the first key of every document, arrays of
    any size are read by many tasks, see ``read_array``.
    """
    layout = T.StructType([*schemas.COST_DOCUMENT.fields, T.StructField(CORRUPT, T.StringType())])
    if record_key is not None:
        return require_rows(read_array(spark, path, schemas.COST_DOCUMENT, record_key), path)
    reader = spark.read.schema(layout).option("multiLine", multi_line).option("columnNameOfCorruptRecord", CORRUPT)
    return require_rows(reader.json(path), path)


def read_array(spark: SparkSession, path: str, schema: T.StructType, record_key: str) -> DataFrame:
    """Elements of JSON arrays of objects, each file cut between the objects and read by as many tasks as its size asks for.

    The quoted key is the separator of the text, so a piece begins inside an object, behind its first key, and ends before the
    first key of the next one; quotes inside a JSON string are escaped, so no string holds the separator unless it is
    nothing but the key.  A piece becomes an array again and is parsed as one: objects without the key stay with the object before
    them.  Pieces that are not balanced, cut inside an object, come out whole in ``CORRUPT``.
    """
    quoted = f'"{record_key}"'
    piece = spark.read.option("lineSep", quoted).text(path)
    # Before the first key of a file stands the bracket that opens the array; after the last object the one that closes it.
    head = F.col("value").rlike(r"^[\s\uFEFF]*\[")
    body = F.regexp_replace("value", r"(,\s*\{\s*|\]\s*)$", "")
    text = F.when(head, F.regexp_replace("value", r"^[\s\uFEFF]*\[|,?\s*(\{\s*|\]\s*)$", "")).otherwise(F.concat(F.lit("{" + quoted), body))
    given = piece.withColumn("_text", text).filter(F.trim("_text") != "")
    array = F.concat(F.lit("["), F.col("_text"), F.lit("]"))
    parsed = F.struct(F.from_json(array, T.ArrayType(schema)).alias("_rows"), F.json_array_length(array).alias("_n"))
    once = given.select("_text", F.inline(F.array(parsed)))  # parsed once, whatever reads it
    bad = F.coalesce(F.col("_n"), F.lit(0)) == 0  # null where brackets, braces and quotes do not close
    nothing = F.array(F.lit(None).cast(schema))
    rows = once.select(F.when(bad, F.col("_text")).alias(CORRUPT), F.explode(F.when(bad, nothing).otherwise(F.col("_rows"))).alias("_r"))
    return rows.select("_r.*", CORRUPT)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)
