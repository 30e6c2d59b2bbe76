"""Callers' columns under neutral names, so that no name, and no case of one, clashes with an operator's own."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of this very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def kept_columns(df: DataFrame, carry: list[str] | None, made: list[str]) -> list[str]:
    """Columns to carry, all by default, without those that a result replaces (names differ by more than case)."""
    taken = {m.lower() for m in made}
    return [c for c in (df.columns if carry is None else carry) if c.lower() not in taken]


def neutral(df: DataFrame, own: list[str], **more: Column | str) -> DataFrame:
    """Columns ``own`` as c0, c1, ..., then those of ``more``, each a column or the name of one, under its keyword."""
    place = [df.columns.index(c) if c in df.columns else [x.lower() for x in df.columns].index(c.lower()) for c in own]
    wide = df.select("*", *(named(x).alias(f"x{k}") if isinstance(x, str) else x.alias(f"x{k}") for k, x in enumerate(more.values())))
    wide = wide.toDF(*(f"k{k}" for k in range(len(df.columns))), *more)
    return wide.select(*(F.col(f"k{p}").alias(f"c{i}") for i, p in enumerate(place)), *more)


def least_hashed(df: DataFrame, n: int, seed: int, *columns: str) -> DataFrame:
    """The ``n`` rows whose columns have the least hash, in that order; all rows if there are no more.

    A count comes first, so that no task sends many more rows to be ordered than are wanted.
    """
    place = F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(1 << 40))
    share = (n + 6 * math.sqrt(n) + 64) / max(1, df.count())
    near = df.where(place < int(share * (1 << 40))) if share < 1 else df
    return near.orderBy(place, *columns).limit(n)
