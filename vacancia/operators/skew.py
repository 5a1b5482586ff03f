"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000  # rows of one key that are worth splitting
HOT_KEYS = 1_000  # most keys ever listed as hot
SALTS = 64

# The sketch is kept per hash group, so that its partial results merge in parallel.
_GROUPS, _PER_GROUP, _TRACKED = 64, 32, 512
_SALT, _HASH = "__salt", "__key_hash"


def _key_hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in on])


def count_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(
    df: DataFrame, on: Sequence[str], min_rows: int = HOT_ROWS, top: int = HOT_KEYS
) -> list[int]:
    """Hashes of the heaviest keys, from a frequent-items sketch. Runs a job.

    For a caller whose table is written and who wants to hand :func:`salted_join` a list. Each task
    keeps a sketch of fixed size and passes on only that, so millions of rare keys cost no shuffle.
    At most ``top`` numbers reach the driver whatever the data.
    """
    sketched = (
        df.select(_key_hash(on).alias(_HASH))
        .groupBy(F.pmod(F.col(_HASH), F.lit(_GROUPS)).alias("part"))
        .agg(F.expr(f"approx_top_k({_HASH}, {_PER_GROUP}, {_TRACKED})").alias("found"))
        .select(F.inline("found").alias(_HASH, "n"))
    )
    heaviest = sketched.where(F.col("n") >= min_rows).orderBy(F.desc("n"), _HASH).limit(top)
    return [row[_HASH] for row in heaviest.collect()]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: Sequence[int] = (),
    spread: Sequence[str] = ("seq",),
    salts: int = SALTS,
) -> DataFrame:
    """Equi join of a large ``left`` with a ``right`` that has few rows per key.

    Without ``hot`` it is Spark's own join, whose skewed partitions adaptive execution splits; nothing
    runs while the plan is built, so streams can use it. ``hot`` lists hashes of keys (see
    :func:`hot_keys`) to be split whatever the settings: their rows of ``left`` go to ``salts`` parts
    that follow from the ``spread`` columns, and only their rows of ``right`` are copied. A key that is
    missing there or listed in vain changes how rows are spread, never the result.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    on = list(on)
    left_types, right_types = dict(left.dtypes), dict(right.dtypes)
    for name in on:
        # Both sides must hash a key alike; floats compare equal with different bits.
        if left_types[name] != right_types[name] or left_types[name] in ("float", "double"):
            raise ValueError(f"join key {name}: {left_types[name]} and {right_types[name]}")
    if not hot:
        return left.join(right, on, how)
    is_hot = _key_hash(on).isin(*hot)
    no_key = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in on])
    picked = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(salts)).cast("int")
    big = left.withColumn(_SALT, F.when(is_hot | no_key, picked).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0))))
    return big.join(right.withColumn(_SALT, copies), on + [_SALT], how).drop(_SALT)


def keep_groups(df: DataFrame, groups: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``groups`` (one row per key). Null is a key like any other."""
    theirs = groups.select(*[F.col(c).alias(f"__g_{c}") for c in on])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in on])
    return df.join(theirs, same, "left_semi")
