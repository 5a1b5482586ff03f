"""First rows, limits and offsets per group, in arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ARRIVAL = ("seq", "pos")
# Parts into which a group is cut before its rows are numbered.
SLOTS = 16

_RANK, _SLOT = "__rank", "__slot"


def _numbered(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window))


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence = ARRIVAL
) -> DataFrame:
    """First row of every key. Each map task passes on at most one row per key."""
    return _numbered(df, keys, order).where(F.col(_RANK) == 1).drop(_RANK)


def rows_per_group(
    df: DataFrame,
    wanted: int,
    offset: int = 0,
    keys: Sequence[str] = ("site",),
    order: Sequence[str] = ARRIVAL,
    slots: int = SLOTS,
) -> DataFrame:
    """Rows ``offset+1 .. offset+wanted`` of every group; rows without arrival number come first.

    A row that is wanted is among the first ``offset+wanted`` of its slot, a part of its group that
    follows from the arrival number. So every slot is cut to that many rows in a task of its own, and
    what one task numbers in the end is bounded by the request, not by the size of a group. Small
    requests are cut before each shuffle (Spark's window group limit); the input is read once.
    """
    last, keys = offset + wanted, list(keys)
    slot = F.pmod(F.xxhash64(*order), F.lit(slots))
    early = _numbered(df.withColumn(_SLOT, slot), [*keys, _SLOT], order).where(F.col(_RANK) <= last)
    ranked = _numbered(early.drop(_SLOT, _RANK), keys, order).where(F.col(_RANK) <= last)
    return ranked.where(F.col(_RANK) > offset).drop(_RANK)


def results_wanted(df: DataFrame, wanted: int) -> DataFrame:
    """At most ``wanted`` rows per site."""
    return rows_per_group(df, wanted)


def offset_slice(df: DataFrame, offset: int, wanted: int) -> DataFrame:
    """``wanted`` rows per site after skipping ``offset``."""
    return rows_per_group(df, wanted, offset)


def final_sort(df: DataFrame) -> DataFrame:
    """Site, newest first, undated last; the id breaks ties."""
    return df.orderBy(F.asc("site"), F.desc_nulls_last("date_posted"), F.asc("id"))
