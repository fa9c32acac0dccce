"""Partitions of catalog tables: listed, replaced and dropped by name."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

#: Partitions named in one catalog command.
DROPPED_AT_ONCE = 200


def listed(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """Partitions of a table, from the catalog alone."""
    return [{k: unquote(v) for k, v in (part.split("=", 1) for part in r[0].split("/"))}
            for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def drop(spark: SparkSession, table: str, parts: Sequence[dict[str, str]]) -> None:
    def spec(part):
        return ", ".join("{} = '{}'".format(k, v.replace("'", "''")) for k, v in part.items())

    specs = [f"PARTITION ({spec(p)})" for p in parts]
    for at in range(0, len(specs), DROPPED_AT_ONCE):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS "
                  + ", ".join(specs[at:at + DROPPED_AT_ONCE]))


def replace(rows: DataFrame, table: str) -> None:
    """Replace the partitions that ``rows`` has, in a session set up for that alone."""
    mode = rows.sparkSession.conf.get("spark.sql.sources.partitionOverwriteMode")
    if mode.lower() != "dynamic":
        raise RuntimeError("spark.sql.sources.partitionOverwriteMode must be dynamic: "
                           f"a {mode} overwrite would empty {table}")
    rows.write.mode("overwrite").insertInto(table)
