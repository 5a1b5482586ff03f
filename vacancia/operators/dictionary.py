"""Names of a dictionary table found in texts, whatever the dictionary's size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions.text import let, rx

RUNS = rx(r"\w+|\W+")
WORD = rx(r"^\w")


def _runs(text: Column) -> Column:
    """The text cut at its word boundaries: words, and what stands between them."""
    return F.regexp_extract_all(text, F.lit(RUNS), F.lit(0))


#: Bits of the sketch through which texts are sifted before the join; 512 KB, whatever the dictionary's size.
SKETCH_BITS = 1 << 22


def _starts(runs: Column) -> Column:
    """``array<struct<place, word>>``: where a name can begin."""
    words = F.transform(runs, lambda r, i: F.struct(i.alias("place"), r.alias("word")))
    return F.filter(words, lambda w: w["word"].rlike(WORD))


def _stretches(runs: Column, place: Column, longest: int) -> Column:
    """``array<struct<n, name>>``: stretches of up to ``longest`` runs from a place where a word begins.

    A stretch ends where a word ends or begins, so it is what ``\\bname\\b`` can match.
    """
    left = F.size(runs) - place

    def can_end(n: Column) -> Column:
        # Words and what is between them take turns. Behind the last run no word begins, and no name
        # ends with white space.
        last = F.get(runs, place + n - 1)
        return (n % 2 == 1) | (n < left) & ~F.right(last, F.lit(1)).rlike(rx(r"\s"))

    ends = F.filter(F.sequence(F.lit(1), F.least(F.lit(longest), left)), can_end)
    return F.transform(
        ends, lambda n: F.struct(n.alias("n"), F.array_join(F.slice(runs, place + 1, n), "").alias("name"))
    )


def _bit(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))


def _slot(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(SKETCH_BITS).cast("long"))


def _sketch(names: DataFrame) -> Column:
    """A bit table of the names and of their first words, as a one-row result that runs with the query."""
    marks = names.select(F.explode(F.array("name", F.get(_runs(F.col("name")), F.lit(0)))).alias("mark"))
    slots = marks.select(_slot(F.col("mark")).alias("slot"))
    bits = slots.groupBy(F.shiftright("slot", 6).alias("id")).agg(F.bit_or(_bit(F.col("slot"))).alias("bits"))
    every = names.sparkSession.range(SKETCH_BITS // 64).join(bits, "id", "left")
    pairs = F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return every.agg(F.transform(pairs, lambda p: p["bits"])).scalar()


def _may_hold(sketch: Column, text: Column) -> Column:
    slot = _slot(text)
    return F.get(sketch, F.shiftright(slot, 6).cast("int")).bitwiseAND(_bit(slot)) != 0


def first_names(
    df: DataFrame, names: DataFrame, keys: Sequence[str], column: str = "text", words: int = 4
) -> DataFrame:
    """``keys, name, value`` of the leftmost name in each text, the longest of those that begin there.

    ``names`` has ``name, value``; letter case doesn't count, and a name stands as whole words with just the
    characters between them that it has itself. Of a name's several values the smallest stays. Names
    that don't begin with a word are never found, one of more than ``words`` words is an error. ``keys``
    tell the rows of ``df`` apart; rows whose text is null or names nothing are not in the result.

    Stretches of the texts meet the dictionary in an equality join, which is broadcast or shuffled as the
    dictionary's size has it. Before, a bit table of the dictionary sifts them, so that of texts that name
    little, little is moved. Each map task passes on at most one find of a row.
    """
    longest = 2 * words
    name = F.lower("name")
    wide = F.size(F.regexp_extract_all(name, F.lit(rx(r"\w+")), F.lit(0))) > words
    checked = F.when(wide, F.raise_error(F.concat(F.lit(f"a name of more than {words} words: "), name))).otherwise(name)
    table = names.select(checked.alias("name"), "value").groupBy("name").agg(F.min("value").alias("value"))
    sketch = _sketch(table)
    starts = df.select(*keys, _runs(F.lower(F.col(column))).alias("__runs")).select(
        "*", F.inline(_starts(F.col("__runs")))
    ).where(_may_hold(sketch, F.col("word")))
    stretches = starts.select(*keys, "place", F.inline(_stretches(F.col("__runs"), F.col("place"), longest)))
    found = stretches.where(_may_hold(sketch, F.col("name"))).join(table, "name")
    first = F.min(F.struct("place", (-F.col("n")).alias("n"), "name", "value")).alias("first")
    return found.groupBy(*keys).agg(first).select(*keys, "first.name", "first.value")
