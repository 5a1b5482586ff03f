"""Array helpers that keep page-local work inside its row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions.text import let


def distinct_by(items: Column, key: Callable[[Column], Column]) -> Column:
    """First item per key, order kept. Sorts instead of comparing all pairs."""
    keyed = F.sort_array(
        F.transform(items, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x")))
    )

    def firsts(entries: Column) -> Column:
        kept = F.filter(
            entries, lambda e, i: (i == 0) | ~F.get(entries, i - 1)["k"].eqNullSafe(e["k"])
        )
        ordered = F.sort_array(F.transform(kept, lambda e: F.struct(e["i"], e["x"])))
        return F.transform(ordered, lambda e: e["x"])

    return let(keyed, firsts)


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions run once per row.

    A filter on a plain column is pushed below the projection and evaluates the expression a second
    time; it cannot be pushed below a generator.
    """
    packed = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(packed)))
