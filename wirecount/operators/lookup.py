"""Joins against a smaller side whose size is checked, not assumed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

MAX_BROADCAST_BYTES = 64 << 20
SALTS = 16


def measured_bytes(df: DataFrame) -> int:
    """Payload of a frame in bytes, from one small aggregate."""
    def width(field):
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)).cast("long") + 16
        return F.lit(16).cast("long")

    per_row = sum((width(f) for f in df.schema.fields), F.lit(16).cast("long"))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def lookup_join(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "inner",
                spread_by: list[str] | None = None, small: bool | None = None,
                max_bytes: int = MAX_BROADCAST_BYTES, salts: int = SALTS) -> DataFrame:
    """Join ``facts`` to ``dim`` on equal names, whatever the size and skew.

    A ``dim`` measured below ``max_bytes`` is broadcast (``small`` passes on a check the
    caller has made). Beyond it both sides shuffle; with ``spread_by`` the rows of a hot
    key are spread over ``salts`` partitions by those columns and ``dim`` is repeated
    once per salt. Rows equal in ``spread_by`` too are left to the run-time skew split.
    """
    if fits_broadcast(dim, max_bytes) if small is None else small:
        return facts.join(F.broadcast(dim), on, how)
    # The check has spoken: the engine's own estimate of the size does not overrule it.
    dim = dim.hint("merge")
    if not spread_by:
        return facts.join(dim, on, how)
    salted = facts.withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated.hint("merge"), [*on, "_salt"], how).drop("_salt")
