"""Secrets in texts, told apart by how many owners and repositories hold the same one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import keep, packed, pick
from vacancia.llm.spans import apart, clean, matches, parts

ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
#: A long run of one word's characters: a credential of no known form, if it mixes all three kinds.
LOOSE = r"[A-Za-z0-9+/_-]{24,}+"
KINDS = ("assign", "access", "hex", "loose")
#: Distinct owners from which on a value counts as an example that was copied.
COPIED_OWNERS = 3


def _mark(value: Column) -> Column:
    """128 bits that stand for a secret, which itself is not shuffled."""
    return F.struct(F.xxhash64(value).alias("h"), F.xxhash64(F.lit(1), value).alias("g"))


def _spans(spans: Column, kind: str, value=lambda s: s["value"]) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"),
        _mark(value(s)).alias("mark"),
    ))


def candidates(docs: DataFrame, key: str, text: str, owner: str, repository: str) -> DataFrame:
    """(row, key, owner, repository, base, loose): spans of each text, with a mark of their secrets."""
    df = pick(docs, key=key, owner=owner, repository=repository, text=text).withColumn("text", clean(F.col("text")))
    patterns = {"assign": (ASSIGN, None), "access": (ACCESS, "AKIA"), "hex": (HEX, None), "loose": (LOOSE, None)}
    df = df.select("key", "owner", "repository", *[parts(F.col("text"), *p).alias(k) for k, p in patterns.items()])
    df = df.select("key", "owner", "repository", *[matches(F.col(k)).alias(k) for k in patterns])
    secret = lambda s: F.regexp_extract(s["value"], ASSIGN, 2)
    df = df.withColumn("assign", F.filter("assign", lambda s: F.length(secret(s)) >= 12))
    mixed = F.filter("loose", lambda s: s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[0-9]"))
    df = df.select("key", "owner", "repository", F.array_sort(F.concat(
        _spans(F.col("assign"), "assign", secret), _spans(F.col("access"), "access"), _spans(F.col("hex"), "hex"),
    )).alias("base"), _spans(mixed, "loose").alias("loose"))
    df = df.withColumn("loose", F.when(F.size("loose") > 0, apart(F.col("loose"), F.col("base"))).otherwise(F.col("loose")))
    return df.withColumn("row", F.monotonically_increasing_id())


def ownership(found: DataFrame) -> DataFrame:
    """(h, g, owners, repositories): how many of each hold a secret.

    ``found`` has (owner, repository, h, g). Repeats within a repository go first, on the map side;
    then repositories are counted by owner and owners by secret, so that a secret in a third of all
    documents is summed up in pieces. A null owner or repository is one of its own.
    """
    once = found.select("h", "g", "owner", "repository").distinct()
    by_owner = once.groupBy("h", "g", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("h", "g").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id",
    copied_owners: int = COPIED_OWNERS,
) -> DataFrame:
    """(key, base, spans) for every document; a span has start, kind, end, owners, repositories, copied.

    ``base`` are the matches of the three known forms, by start. ``spans`` adds runs of 24 or more
    characters that mix small and capital letters with digits, overlap no base span, and are held by
    fewer than ``copied_owners`` owners; what more owners hold is a copied example. Base spans stay
    whoever holds them, with ``copied`` saying what they are.

    A null or empty text has no spans; repeated rows come repeated, and are one repository; an empty
    table gives an empty result.
    """
    rows = keep(candidates(docs, key, text, owner, repository), "secrets")
    every = rows.select("row", "owner", "repository", F.explode(F.concat("base", "loose")).alias("s"))
    every = every.select("row", "owner", "repository", "s.*", "s.mark.h", "s.mark.g")
    held = ownership(every)
    judged = every.join(held, ["h", "g"]).withColumn("copied", F.col("owners") >= copied_owners)
    span = F.struct("start", "rank", "kind", "end", "owners", "repositories", "copied")
    spans = judged.where("kind != 'loose' or not copied").groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    found = rows.select("row", "key", "base").join(spans, "row", "left").select(
        F.col("key").alias(key), "base", F.coalesce("spans", empty).alias("spans")
    )
    return packed(found, rows.count())
