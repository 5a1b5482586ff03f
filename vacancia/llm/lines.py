"""Boilerplate lines by their frequency relative to a site, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import hidden, keep, pick, shown, small_side

#: Share of a site's pages above which a line is boilerplate. Measured: notices that sites repeat are on
#: 1 to 15 % of their pages, and other lines of more than a few words on less than 0.3 %.
RATIO = 0.01
#: A line on one page isn't repeated at all.
LEAST_PAGES = 2
#: Share of a page's lines above which the page is a copy of others, not one with boilerplate around it.
COPY = 0.5


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\f\r"))


def _mark(bare: Column) -> Column:
    """128 bits that stand for a line without the space around it; null for a blank line."""
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("h"), F.xxhash64(F.lit(1), bare).alias("g")))


def _written(mark: Column) -> Column:
    """A mark as text, which Spark's array functions look up by hash."""
    return F.concat_ws(":", mark["h"].cast("string"), mark["g"].cast("string"))


def boilerplate(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, marks): the marks of each host's lines on more than ``ratio`` of its pages.

    A page counts once for a line, however often the line is on it. Only hashes are shuffled, and
    counted on the map side first, so neither a host with a third of all pages nor a line of a third
    of all pages gathers anywhere. A host has at most (lines of its average page / ratio) such lines,
    which bounds its list.
    """
    pages = pick(docs, host=host, text=text)
    different = F.filter(F.array_distinct(F.transform(_lines(F.col("text")), _bare)), lambda x: x != "")
    marks = F.transform(different, _mark)
    seen = pages.select("host", F.explode(marks).alias("m")).groupBy("host", "m.h", "m.g").agg(F.count("*").alias("n"))
    totals = pages.groupBy(F.col("host").alias("site")).agg(F.count("*").alias("pages"))
    common = seen.where(F.col("n") >= least_pages).join(totals, F.col("host").eqNullSafe(F.col("site"))).where(F.col("n") > ratio * F.col("pages"))
    return common.groupBy("host").agg(F.array_sort(F.collect_list(_written(F.struct("h", "g")))).alias("marks"))


def _stripped(df: DataFrame, text: Column, host: Column, marks: DataFrame, copy: float) -> DataFrame:
    """``df`` with ``lines`` and, where lines of the page are boilerplate, ``left``: the lines that stay."""
    few = df.sparkSession.sparkContext.defaultParallelism  # a row per host that has any
    marks = keep(marks.repartition(few), "boilerplate").withColumnRenamed("host", "marks_host")
    entries = marks.agg(F.coalesce(F.sum(F.size("marks")), F.lit(0))).first()[0]
    # Whole texts stay where they are as long as the lists are few enough to be sent to them.
    joined = df.join(small_side(marks, entries), host.eqNullSafe(F.col("marks_host")), "left").withColumn("lines", _lines(text))
    own = F.when(F.col("marks").isNotNull(), F.transform("lines", lambda x: _written(_mark(_bare(x)))))
    joined = joined.withColumn("own", own).withColumn("hits", F.array_intersect("own", "marks"))
    gone = F.filter("own", lambda m: F.array_contains(F.col("hits"), m))
    filled = F.filter("own", lambda m: m != "")
    clean = F.filter("lines", lambda x, i: ~F.array_contains(F.col("hits"), F.get("own", i)))
    some = (F.size("hits") > 0) & (F.size(gone) <= copy * F.size(filled))
    return joined.withColumn("left", F.when(some, clean))


def _text_left(text: Column) -> Column:
    return F.when(F.size("left") < F.size("lines"), F.array_join("left", "\n")).otherwise(text)


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
                ratio: float = RATIO, least_pages: int = LEAST_PAGES, copy: float = COPY) -> DataFrame:
    """(key, n_lines, n_dropped, text) for every page, its text without boilerplate lines.

    Lines end at ``\\n`` and are compared without the space around them; blank lines stay. A page of
    whose lines more than the share ``copy`` are boilerplate is a copy of other pages, not one with
    boilerplate around it, and stays whole: which copies to keep is for the near-duplicate operators.

    Pages without a host are a site of their own. A null text has no lines and stays null; repeated rows
    are pages of their own; an empty table gives an empty result.
    """
    picked = pick(docs, key=key, text=text, host=host)
    found = _stripped(picked, F.col("text"), F.col("host"), boilerplate(docs, text, host, ratio, least_pages), copy)
    n_lines = F.coalesce(F.size("lines"), F.lit(0))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(n_lines).cast("long")
    dropped = F.when(F.col("left").isNull(), 0).otherwise(F.size("lines") - F.size("left")).cast("long")
    return found.select(F.col("key").alias(key), n_lines.alias("n_lines"), dropped.alias("n_dropped"),
                        _text_left(F.col("text")).alias(text))


def drop_boilerplate(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                     least_pages: int = LEAST_PAGES, copy: float = COPY) -> DataFrame:
    """All documents with all columns, their texts without the boilerplate lines of their host."""
    names = docs.columns
    own, at = f"in_{names.index(text)}", f"in_{names.index(host)}"
    found = _stripped(hidden(docs), F.col(own), F.col(at), boilerplate(docs, text, host, ratio, least_pages), copy)
    return shown(found.withColumn(own, _text_left(F.col(own))), names)
