"""Expensive expressions, computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` added as values instead of expressions.

    The optimizer moves filters towards the scan and repeats there whatever expression
    the filtered column stands for; a date parser or a tokenizer is then run several
    times per row. It does not look through a generator, so a one-element one holds
    the values.
    """
    values = F.struct(*(expr.alias(name) for name, expr in columns.items()))
    return (
        df.withColumn("_pinned", F.explode_outer(F.array(values)))
        .select(*df.columns, *(F.col(f"_pinned.{name}").alias(name) for name in columns))
    )
