"""Keyed message signatures over table rows."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions.scalar import ColumnLike, as_col, row_json

_BLOCK = 64  # bytes, block size of the digest


def hmac_sha256(payload: ColumnLike, key: str | bytes) -> Column:
    """HMAC-SHA256 of a text column as lower-case hexadecimal digits.

    Only the two padded forms of the key are prepared on the driver; both
    digests over the payload are built-in expressions.
    """
    secret = key.encode() if isinstance(key, str) else key
    if len(secret) > _BLOCK:
        secret = hashlib.sha256(secret).digest()
    secret = secret.ljust(_BLOCK, b"\0")
    inner_pad = F.lit(bytes(b ^ 0x36 for b in secret))
    outer_pad = F.lit(bytes(b ^ 0x5C for b in secret))
    inner = F.unhex(F.sha2(F.concat(inner_pad, as_col(payload).cast("binary")), 256))
    return F.sha2(F.concat(outer_pad, inner), 256)


def sign_rows(df: DataFrame, key: str | bytes, columns: list[str] | None = None) -> DataFrame:
    """Add the JSON payload of each row and its signature."""
    return df.withColumn("payload", row_json(df, columns)).withColumn(
        "signature", hmac_sha256("payload", key)
    )


def verify_rows(df: DataFrame, key: str | bytes) -> DataFrame:
    """Add ``signature_ok``: whether the payload still matches its signature."""
    return df.withColumn("signature_ok", F.col("signature").eqNullSafe(hmac_sha256("payload", key)))
