"""Column encryption of personal data: AES-GCM, with the row id as authenticated data.

The key comes from the session setting ``condoflow.pii.key`` (16, 24 or 32 bytes).  Plans hold it as a scalar subquery over a
one-row frame, of which they name the column only, so neither ``explain`` nor the event log shows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

KEY_SETTING = "condoflow.pii.key"
IV_BYTES, TAG_BYTES = 12, 16  # what AES-GCM adds to the clear bytes


def session_key(spark: SparkSession) -> str:
    key = spark.conf.get(KEY_SETTING, None)
    if not key or len(key.encode()) not in (16, 24, 32):
        raise ValueError(f"set {KEY_SETTING} to a key of 16, 24 or 32 bytes")
    return key


def hidden(spark: SparkSession, key: str) -> Column:
    """The key as a column that does not show it."""
    return spark.createDataFrame([(bytearray(key.encode()),)], "clave binary").scalar()


def encrypt(value: Column, row_id: Column, key: Column) -> Column:
    return F.aes_encrypt(
        value.cast("binary"), key, F.lit("GCM"), F.lit("DEFAULT"), F.lit(b""), row_id.cast("string").cast("binary"),
    )


def decrypt(value: Column, row_id: Column, key: Column) -> Column:
    """Clear text; fails when the value was not encrypted for this row id."""
    return F.aes_decrypt(
        value, key, F.lit("GCM"), F.lit("DEFAULT"), row_id.cast("string").cast("binary"),
    ).cast("string")


def encrypt_columns(df: DataFrame, columns: tuple[str, ...], row_id: str, key: str) -> DataFrame:
    """Replace each column by ``<column>_encriptado``."""
    secret = {f"{c}_encriptado": encrypt(F.col(c), F.col(row_id), hidden(df.sparkSession, key)) for c in columns}
    return df.withColumns(secret).drop(*columns)


def decrypt_columns(df: DataFrame, columns: tuple[str, ...], row_id: str, key: str) -> DataFrame:
    """The reading view: clear columns for whoever holds the key."""
    clear = {c: decrypt(F.col(f"{c}_encriptado"), F.col(row_id), hidden(df.sparkSession, key)) for c in columns}
    return df.withColumns(clear).drop(*[f"{c}_encriptado" for c in columns])


def encryption_facts(df: DataFrame, columns: tuple[str, ...], row_id: str, key: str) -> DataFrame:
    """What does not vary of each encrypted column, though its bytes do on every run.

    ``<column>_bytes``: length, the clear bytes and what the method adds; ``<column>_oculto``: that the clear bytes are not in it;
    ``<column>_vuelve``: that it decrypts to the clear text.  All null where the value is null.
    """
    spark = df.sparkSession
    # Encrypted once: out of a generator, so that the facts do not encrypt anew for each use.
    secret = F.struct(*[encrypt(F.col(c), F.col(row_id), hidden(spark, key)).alias(f"_{c}") for c in columns])
    both = df.select(row_id, *columns, F.inline(F.array(secret)))
    facts = []
    for c in columns:
        hex_of = lambda value: F.hex(value.cast("binary"))
        facts += [
            F.octet_length(f"_{c}").alias(f"{c}_bytes"),
            (~F.contains(hex_of(F.col(f"_{c}")), hex_of(F.col(c)))).alias(f"{c}_oculto"),
            (decrypt(F.col(f"_{c}"), F.col(row_id), hidden(spark, key)) == F.col(c)).alias(f"{c}_vuelve"),
        ]
    return both.select(row_id, *facts)
