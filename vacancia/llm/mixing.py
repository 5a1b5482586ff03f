"""Mixing sources to target weights by Pareto order sampling of whole documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancia.llm.common import hidden, keep, pick, shown, small_side

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a source that are gone through one by one to find where its sample ends, about.
BUCKET_ROWS = 100
SEED = 1


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(seed: int, key: Column, text: Column) -> Column:
    """A number between 0 and 1 that follows from a document's key and text alone."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), text).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def cyclic_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """(source, weight) for distinct sources: the weights in turn, by code point, null last.

    Its one window holds a row per source, not per document.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(float(w)) for w in weights])
    return sources.select("source", values[place % len(weights)].alias("weight"))


def source_targets(totals: DataFrame, weights: DataFrame, share: float, most_copies: float) -> DataFrame:
    """(source, n, source_size, target) from (source, n, source_size) and (source, weight).

    ``share`` of all sizes is dealt by weight. A target stops at ``most_copies`` times its source's
    size, and the excess is dealt again by weight, until none is above: with m such that targets are
    the smaller of that limit and m times the weight, m only grows while sources reach their limit.
    Each turn reads three sums. A source without a weight, or of none, has target zero.
    """
    known = keep(
        totals.join(weights.withColumnRenamed("source", "ws"), F.col("source").eqNullSafe(F.col("ws")), "left")
        .select("source", "n", "source_size", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight"),
                (F.lit(float(most_copies)) * F.col("source_size")).alias("limit")),
        "targets", totals.count(),
    )
    whole = share * float(known.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level, full = 0.0, -1
    while True:
        at = F.col("limit") <= F.lit(level) * F.col("weight") if full >= 0 else F.lit(False)
        row = known.where("weight > 0").agg(
            F.sum(at.cast("int")), F.sum(F.when(at, F.col("limit"))), F.sum(F.when(~at, F.col("weight")))
        ).first()
        if (row[0] or 0) == full or not row[2]:
            if not row[2]:
                level = float("inf")
            break
        full = row[0] or 0
        level = (whole - (row[1] or 0.0)) / row[2]
    dealt = F.when(F.col("weight") > 0, F.least(F.col("limit"), F.lit(level) * F.col("weight"))).otherwise(0.0)
    return known.select("source", "n", "source_size", dealt.alias("target"))


def with_levels(sized: DataFrame, targets: DataFrame, most_copies: float, equal: bool) -> DataFrame:
    """``targets`` with each source's ``level``: a document's expected copies are level times ``worth``.

    Levels are such that expected copies times sizes add up to the target. Copies stop at
    ``most_copies``, and what documents above it leave over is dealt again by worth, until no further
    document is above; each turn is a sum by source. If all worths are ``equal`` (to 1), there is
    nothing to deal again, as no target is above that limit.
    """
    if equal:
        level = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        return targets.withColumn("level", level)
    sources, full, levels = targets.count(), -1, None
    while True:
        if levels is None:
            at, joined = F.lit(False), sized
        else:
            known = small_side(levels.select(F.col("source").alias("ls"), "level"), sources)
            joined = sized.join(known, F.col("source").eqNullSafe(F.col("ls")))
            at = F.col("level") * F.col("worth") >= most_copies
        sums = keep(joined.groupBy("source").agg(
            F.sum(F.when(at, F.col("size")).otherwise(0)).alias("above"), F.count_if(at).alias("n_above"),
            F.sum(F.when(~at, F.col("worth") * F.col("size")).otherwise(0.0)).alias("below"),
        ), "levels", sources)
        now = sums.agg(F.coalesce(F.sum("n_above"), F.lit(0))).first()[0]
        if now == full:
            return levels
        full = now
        left = F.greatest(F.col("target") - most_copies * F.col("above"), F.lit(0.0))
        level = F.when(F.col("below") > 0, left / F.col("below")).otherwise(F.lit(float("inf")))
        levels = keep(targets.join(sums.withColumnRenamed("source", "ss"), F.col("source").eqNullSafe(F.col("ss"))).select(
            *targets.columns, level.alias("level")), "levels", sources)


def expected_copies(most_copies: float) -> Column:
    """Of a document, from its ``worth`` and its source's ``level``; none without worth."""
    return F.when(F.col("worth") > 0, F.least(F.lit(float(most_copies)), F.col("level") * F.col("worth"))).otherwise(0.0)


def _shared(most_copies: float) -> tuple[Column, Column]:
    """A document's certain copies, and the chance of one more."""
    expected = expected_copies(most_copies)
    return F.floor(expected).cast("long"), expected - F.floor(expected)


def plan(sized: DataFrame, targets: DataFrame, most_copies: float, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per source that says which of its documents the mix takes.

    ``sized`` has (source, size, worth, u); ``targets`` is from ``with_levels``. A document gets the
    whole part of its expected copies for certain; the fraction left is its inclusion probability.
    Documents are ranked by the odds of ``u`` divided by the odds of inclusion, and taken in that order
    as long as their words fit what is left of the target; the bucket in which it is used up is gone
    through to its end for what still fits. A last place goes to the document whose size is nearest to
    the words still missing, if that brings the source nearer to its target. The sample's size is thus
    fixed in words. Documents with equal ``u`` and chance (repeated rows) are taken together.

    No source is ordered in one task: ranks fall into buckets, of about ``bucket_rows`` documents where
    samples end (at odds near one), and as many neighbouring buckets form a group as there are groups.
    Sums of the groups show in which group the sample ends, sums of its buckets in which bucket, and
    only that bucket is ordered. No window holds more than the square root of a source's number of
    buckets.
    """
    sources = targets.count()
    shares = targets.withColumn("side", F.greatest(F.ceil(F.sqrt(F.col("n") / bucket_rows)), F.lit(1)).cast("long"))
    shares = shares.withColumn("buckets", F.col("side") * F.col("side"))
    copies, chance = _shared(most_copies)
    known = small_side(shares.select(F.col("source").alias("s"), "level", "side", "buckets"), sources)
    units = sized.join(known, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "u", "size", "side", "buckets", copies.alias("copies"), chance.alias("chance")
    )
    units = units.groupBy("source", "u", "chance", "copies", "side", "buckets").agg(F.sum("size").alias("size"))
    units = units.withColumn("rank", F.when(F.col("chance") > 0, rank("u", "chance"))).withColumn("bucket", bucket("rank", "buckets"))
    units = units.withColumn("part", F.floor(F.col("bucket") / F.col("side")).cast("long"))
    units = keep(units.select("source", "u", "size", "copies", "rank", "part", "bucket"), "units", sized.count())
    sure = units.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("sure"))
    rests = keep(shares.join(sure.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        "source", (F.col("target") - F.col("sure")).alias("rest")), "rests", sources)
    units = units.where("rank is not null").join(
        small_side(rests.withColumnRenamed("source", "s"), sources), F.col("source").eqNullSafe(F.col("s"))
    ).drop("s", "copies")

    parts = keep(_ends(units.withColumn("start", F.lit(0.0)), "part"), "parts", sources)
    ends = keep(_ends(_within(units, parts, sources, "part"), "bucket"), "ends", sources)
    last = _within(units, ends, sources, "bucket")
    place = F.struct("rank", "u", F.col("size").cast("double").alias("size"))
    inside = last.groupBy("source", F.col("bucket").alias("end"), "start", "rest").agg(
        F.array_sort(F.collect_list(place)).alias("places")
    )
    cuts = keep(inside.select("source", "end", _filled(F.col("places"), F.col("rest") - F.col("start")).alias("f"))
                .select("source", "end", "f.cut", "f.extras", F.col("f.left").alias("gap")), "cuts", sources)
    open_places = units.select("source", "u", "size", "rank", "bucket").join(
        small_side(cuts.withColumnRenamed("source", "s"), sources), F.col("source").eqNullSafe(F.col("s"))
    ).where("bucket > end or (bucket = end and rank > cut and not array_contains(extras, u))")
    off = F.abs(F.col("size") - F.col("gap"))
    nearest = open_places.where(off < F.col("gap")).groupBy("source").agg(
        F.min(F.struct(off.alias("off"), "rank", "u")).alias("x")
    ).select(F.col("source").alias("ns"), F.col("x.u").alias("nearest"))
    cuts = cuts.join(nearest, F.col("source").eqNullSafe(F.col("ns")), "left").select(
        F.col("source").alias("cs"), "end", "cut",
        F.when(F.col("nearest").isNull(), F.col("extras")).otherwise(F.array_append("extras", F.col("nearest"))).alias("extras"),
    )
    return shares.join(cuts, F.col("source").eqNullSafe(F.col("cs")), "left").select(
        "source", "source_size", "target", "level", "buckets", "end", "cut", "extras"
    )


def _ends(units: DataFrame, by: str) -> DataFrame:
    """(source, <by>, start): the last value of ``by`` that begins within the rest, and where it begins."""
    sums = units.groupBy("source", by, "rest", "start").agg(F.sum("size").alias("size"))
    before = F.col("start") + F.sum("size").over(Window.partitionBy("source").orderBy(by)) - F.col("size")
    return sums.withColumn("before", before).where("before <= rest").groupBy("source").agg(
        F.max(F.struct(by, "before")).alias("e")
    ).select("source", f"e.{by}", F.col("e.before").alias("start"))


def _within(units: DataFrame, ends: DataFrame, rows: int, by: str) -> DataFrame:
    ends = ends.withColumnsRenamed({"source": "s", by: "end"})
    return units.join(small_side(ends, rows), F.col("source").eqNullSafe(F.col("s")) & (F.col(by) == F.col("end"))).drop("s", "end")


def _filled(places: Column, room: Column) -> Column:
    """Go through ranked places and take what still fits: the rank up to which all did, and the rest.

    ``extras`` holds only what was taken after the first document that didn't fit, so its words are
    fewer than that document's.
    """
    state = "struct<left:double,full:boolean,cut:double,extras:array<double>>"

    def step(acc, x):
        fits = x["size"] <= acc["left"]
        return F.when(fits, F.struct(
            (acc["left"] - x["size"]).alias("left"), acc["full"].alias("full"),
            F.when(acc["full"], acc["cut"]).otherwise(x["rank"]).alias("cut"),
            F.when(acc["full"], F.array_append(acc["extras"], x["u"])).otherwise(acc["extras"]).alias("extras"),
        )).otherwise(F.struct(
            acc["left"].alias("left"), F.lit(True).alias("full"), acc["cut"].alias("cut"), acc["extras"].alias("extras")
        )).cast(state)

    start = F.struct(room.alias("left"), F.lit(False).alias("full"), F.lit(-1.0).alias("cut"),
                     F.array().cast("array<double>").alias("extras")).cast(state)
    return F.aggregate(places, start, step)


def rank(u: str, chance: str) -> Column:
    """Random odds divided by inclusion odds; a smaller one is drawn earlier."""
    u, chance = F.col(u), F.col(chance)
    return (u / (1 - u)) / (chance / (1 - chance))


def bucket(rank: str, buckets: str) -> Column:
    """Ranks go from none to any number; odds r lie at r / (1 + r) of the way."""
    return F.floor(F.col(rank) / (1 + F.col(rank)) * F.col(buckets)).cast("long")


def copies_taken(df: DataFrame, most_copies: float) -> DataFrame:
    """``df`` with ``copies``: how often a document is taken, from its ``u``, ``worth`` and source's ``plan``."""
    copies, chance = _shared(most_copies)
    df = df.withColumn("sure", copies).withColumn("chance", chance)
    df = df.withColumn("rank", F.when(F.col("chance") > 0, rank("u", "chance"))).withColumn("place", bucket("rank", "buckets"))
    early = (F.col("place") < F.col("end")) | ((F.col("place") == F.col("end")) & (F.col("rank") <= F.col("cut")))
    drawn = F.coalesce(early, F.lit(False)) | F.coalesce(F.array_contains("extras", F.col("u")), F.lit(False))
    return df.withColumn("copies", F.col("sure") + (F.col("rank").isNotNull() & drawn).cast("long"))


def _worth(worth: Column | None) -> Column:
    return F.lit(1.0) if worth is None else F.greatest(F.coalesce(worth.cast("double"), F.lit(0.0)), F.lit(0.0))


def _with_plan(sized: DataFrame, weights: DataFrame | Sequence[float], share: float, most_copies: float, equal: bool) -> DataFrame:
    totals = keep(sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")), "totals", sized.count())
    if not isinstance(weights, DataFrame):
        weights = cyclic_weights(totals.select("source"), weights)
    targets = keep(with_levels(sized, source_targets(totals, weights, share, most_copies), most_copies, equal), "levels", totals.count())
    return keep(plan(sized, targets, most_copies), "plan", totals.count())


def mix_sizes(
    docs: DataFrame, weights: DataFrame | Sequence[float], key: str = "doc_id", text: str = "text",
    source: str = "source", share: float = 1.5, most_copies: float = 2.0, seed: int = SEED, worth: str | None = None,
) -> DataFrame:
    """(key, source, size, source_size, target, copies, taken) for every document.

    ``weights`` is a frame (source, weight), or numbers dealt to the sources in turn. Within a source,
    expected copies are proportional to the column ``worth`` (none: all alike; null or negative: zero).
    Sizes are words; a null or empty text has none and is taken as often as its neighbours in the
    order. A null source is a source. Ties and repeated rows are taken together. Reruns agree, as the
    draw follows from seed, key and text. An empty table gives an empty result.
    """
    given = {"worth": worth} if worth else {}
    picked = pick(docs, key=key, source=source, text=text, **given)
    sized = keep(picked.select(
        "key", "source", _size(F.col("text")).alias("size"), _uniform(seed, F.col("key"), F.col("text")).alias("u"),
        _worth(F.col("worth") if worth else None).alias("worth"),
    ), "sized")
    plans = _with_plan(sized, weights, share, most_copies, worth is None).withColumnRenamed("source", "s")
    joined = sized.join(small_side(plans, plans.count()), F.col("source").eqNullSafe(F.col("s")))
    return copies_taken(joined, most_copies).select(
        F.col("key").alias(key), F.col("source").alias("source"), "size", "source_size", "target",
        "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )


def mix(
    docs: DataFrame, weights: DataFrame | Sequence[float], key: str = "doc_id", text: str = "text",
    source: str = "source", share: float = 1.5, most_copies: float = 2.0, seed: int = SEED, worth: str | None = None,
) -> DataFrame:
    """The mixed documents with their columns, each row as often as the mix takes it."""
    names = docs.columns
    df = hidden(docs)
    own = [F.col(f"in_{names.index(c)}") for c in (key, source, text)]
    value = _worth(F.col(f"in_{names.index(worth)}") if worth else None)
    u = _uniform(seed, own[0], own[2])
    sized = keep(df.select(own[1].alias("source"), _size(own[2]).alias("size"), u.alias("u"), value.alias("worth")), "sized")
    plans = _with_plan(sized, weights, share, most_copies, worth is None).withColumnRenamed("source", "s")
    joined = df.withColumn("u", u).withColumn("worth", value).join(
        small_side(plans, plans.count()), own[1].eqNullSafe(F.col("s"))
    )
    taken = copies_taken(joined, most_copies).where("copies > 0")
    return shown(taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), names)
