"""Keyed upserts on plain tables: union, and the last row of each key wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_wins(rows: DataFrame, keys: list[str], seq: list[str], keep: list[str] | None = None, sticky: list[str] | None = None) -> DataFrame:
    """One row per key, by ascending ``seq`` columns.

    ``keep`` columns come from the last row. ``sticky`` columns come from the last row
    that has a value that is neither null nor empty, so that an empty value doesn't erase
    an earlier one. Rows with equal ``seq`` are ordered by their values, so that the result
    is the same however the rows are dealt. Each is the greatest of one struct, which is
    aggregated before the shuffle as well, so a key with very many rows moves once per task.
    """
    sticky = sticky or []
    keep = [c for c in rows.columns if c not in {*keys, *seq, *sticky}] if keep is None else keep
    order = [F.col(c) for c in seq]
    held = [F.max(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.struct(*order, F.col(c)))).alias(c) for c in sticky]
    out = rows.groupBy(*keys).agg(F.max(F.struct(*order, *[F.col(c) for c in keep])).alias("_last"), *held)
    return out.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in keep], *[F.col(f"{c}.{c}").alias(c) for c in sticky], *[F.col(f"_last.{c}").alias(c) for c in seq])


def upsert(existing: DataFrame | None, incoming: DataFrame, keys: list[str], seq: list[str], sticky: list[str] | None = None) -> DataFrame:
    """What a table holds after ``incoming``; rows of the table come before all incoming ones."""
    new = incoming.withColumn("_new", F.lit(True))
    if existing is not None:
        new = existing.withColumn("_new", F.lit(False)).unionByName(new, allowMissingColumns=True)
    return last_wins(new, keys, ["_new", *seq], sticky=sticky).drop("_new")
