"""Places of regular-expression matches in code points, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A private-use character that marks matches, and the one that takes its place in texts. No pattern
#: has a class that either belongs to without the other.
MARK, STAND_IN = "", ""
_BLOCK = 64


def clean(text: Column) -> Column:
    """A text without the mark, each code point in its place; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), MARK, STAND_IN)


def parts(text: Column, pattern: str, needs: str | None = None) -> Column:
    """A clean text cut at its leftmost non-overlapping matches, which are the odd elements.

    A text without the string ``needs``, which every match has, isn't searched.
    """
    cut = F.split(F.regexp_replace(text, f"(?:{pattern})", f"{MARK}$0{MARK}"), MARK, -1)
    return cut if needs is None else F.when(F.contains(text, F.lit(needs)), cut).otherwise(F.array(text))


def matches(parts: Column, context: int = 0) -> Column:
    """(start, end, value) of each match, and with ``context`` so many characters ``left`` and ``right`` of it.

    ``parts`` should be a column, as it is used often. Lengths are added up in blocks and contexts are
    put together from the neighbouring parts, so that a text with very many matches takes time in
    proportion. A context reaches three matches back at most.
    """
    def total(some):
        return F.aggregate(some, F.lit(0).cast("long"), lambda a, p: a + F.length(p))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _BLOCK).cast("int")),
                         lambda b: total(F.slice(parts, b * _BLOCK + 1, _BLOCK)))
    starts = F.aggregate(
        blocks, F.array(F.lit(0).cast("long")), lambda a, n: F.array_append(a, F.element_at(a, -1) + n)
    )

    def match(k, starts):
        at = 2 * k + 1
        block = F.floor(at / _BLOCK).cast("int")
        start = F.get(starts, block) + total(F.slice(parts, block * _BLOCK + 1, F.pmod(at, F.lit(_BLOCK))))
        value = F.get(parts, at)
        fields = [start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value")]
        if context:
            size, first = F.lit(context), F.greatest(at - 7, F.lit(0))
            before = F.transform(F.slice(parts, first + 1, at - first), lambda p: F.right(p, size))
            after = F.transform(F.slice(parts, at + 2, 2), lambda p: F.left(p, size))
            fields += [F.right(F.array_join(before, ""), size).alias("left"), F.left(F.array_join(after, ""), size).alias("right")]
        return F.struct(*fields)

    numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 3) / 2).cast("int"))
    # The block starts are bound once, as the element of an array of one.
    found = F.flatten(F.transform(F.array(starts), lambda s: F.transform(numbers, lambda k: match(k, s))))
    return F.when(F.size(parts) > 1, found).otherwise(none(context))


def none(context: int = 0) -> Column:
    more = ",left:string,right:string" if context else ""
    return F.array().cast(f"array<struct<start:bigint,end:bigint,value:string{more}>>")


def apart(spans: Column, others: Column, width: int = 4096) -> Column:
    """Those ``spans`` that overlap none of ``others``, both of one text.

    They are compared window by window of the text, so that many of both don't meet in all pairs.
    """
    def free(mine, near):
        return F.filter(mine, lambda s: ~F.exists(near, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))

    def window(w):
        mine = F.filter(spans, lambda s: F.floor(s["start"] / width) == w)

        def within(own):
            reach = F.coalesce(F.array_max(F.transform(own, lambda s: s["end"])), F.lit(0))
            near = F.transform(F.array(reach), lambda r: F.filter(others, lambda o: (o["end"] > w * width) & (o["start"] < r)))
            return F.get(F.transform(near, lambda n: free(own, n)), 0)

        return F.get(F.transform(F.array(mine), within), 0)

    last = F.coalesce(F.array_max(F.transform(spans, lambda s: s["start"])), F.lit(0))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.floor(last / width).cast("int")), window))


def text_of(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
