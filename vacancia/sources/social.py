"""Social posts. The lines of a rendered post are told apart by a helper; the rest is column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions import dates, job_types, remote, social
from vacancia.functions.arrays import with_once
from vacancia.functions.country import detect_country
from vacancia.functions.post_lines import split_post_lines
from vacancia.functions.text import non_empty
from vacancia.functions.urls import url_hash
from vacancia.schema import location, posting_columns
from vacancia.sources.payloads import ParseOptions, rejects


def split_social_post_lines(raw: DataFrame) -> DataFrame:
    """``seq, author, subtitle, time, text, url`` of landed inner texts (``seq, url, payload``)."""
    posts = F.filter(F.array(split_post_lines(F.col("payload"))), lambda p: p.isNotNull())
    return raw.select("seq", "url", F.inline(posts))


def _place(city: Column, country: Column) -> Column:
    return F.when(city.isNotNull() | country.isNotNull(), location(city, None, country, True))


TWEET_DDL = (
    "array<struct<id:string,handle:string,name:string,text:string,iso:string,permalink:string,"
    "links:array<struct<href:string,text:string>>>>"
)


def read_tweets(raw: DataFrame) -> DataFrame:
    """``seq, pos, id, handle, name, text, iso, permalink, links`` of landed posts (one, or a list)."""
    return raw.select("seq", F.posexplode(F.from_json("payload", TWEET_DDL)).alias("pos", "t")).select(
        "seq", "pos", "t.*"
    )


def parse_tweets(posts: DataFrame) -> DataFrame:
    """``seq, id, handle, name, text, iso, permalink, links`` to postings."""
    text = F.col("text")
    author = F.coalesce(non_empty(F.col("name")), F.col("handle"))
    own = F.coalesce(
        non_empty(F.col("permalink")),
        F.concat(F.lit("https://x.com/"), non_empty(F.col("handle")), F.lit("/status/"), F.col("id")),
        F.lit(""),
    )
    kept = with_once(
        posts.where(F.length("text") >= social.MIN_TWEET_LENGTH),
        title=social.tweet_title(text), code=detect_country(text), city=social.tweet_location(text),
    )
    return kept.where(F.length("title") > 0).select(
        *posting_columns(
            seq=F.col("seq"),
            pos=F.col("pos") if "pos" in posts.columns else F.lit(0),
            site=F.lit("twitter"),
            id=F.col("id"),
            title=F.col("title"),
            company_name=social.tweet_company(text, author),
            job_url=social.external_link(social.resolve_links(F.col("links")), own),
            location=_place(F.col("city"), F.col("code")),
            description=text,
            date_posted=dates.iso_date(F.col("iso")),
            is_remote=remote.remote_tweet(text),
            job_type=job_types.extract_job_type(text),
        )
    )


def parse_linkedin_posts(posts: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """``seq, author, subtitle, time, text, url`` to postings."""
    o = options or ParseOptions()
    text = F.col("text")
    kept = with_once(
        posts.where(F.length("text") >= social.MIN_POST_LENGTH),
        title=social.post_title(text), city=social.post_location(text),
        code=detect_country(text, F.col("subtitle")),
    )
    return kept.where(F.length("title") > 0).select(
        *posting_columns(
            seq=F.col("seq"),
            pos=F.lit(0),
            site=F.lit("linkedin_posts"),
            id=F.concat(F.lit("lp-"), url_hash(text)),  # posts have no number; their text tells them apart
            title=F.col("title"),
            company_name=social.post_company(text, F.col("author"), F.col("subtitle")),
            job_url=F.col("url"),
            location=_place(F.col("city"), F.col("code")),
            description=text,
            date_posted=dates.social_relative_date(F.col("time"), o.today),
            is_remote=remote.remote_post(text),
            job_type=job_types.extract_job_type(text),
        )
    )


def quarantine_tweets(raw: DataFrame) -> DataFrame:
    """Posts too short or without a title, and payloads that hold no list of posts."""

    def usable(tweet: Column) -> Column:
        return (F.length(tweet["text"]) >= social.MIN_TWEET_LENGTH) & (F.length(social.tweet_title(tweet["text"])) > 0)

    payload = F.col("payload")
    return raw.select("seq", F.inline(rejects(payload, F.from_json(payload, TWEET_DDL), usable)))


def quarantine_linkedin_posts(raw: DataFrame) -> DataFrame:
    """Posts too short or without a title, and texts that are no post."""

    def usable(post: Column) -> Column:
        return (F.length(post["text"]) >= social.MIN_POST_LENGTH) & (F.length(social.post_title(post["text"])) > 0)

    payload = F.col("payload")
    posts = F.filter(F.array(split_post_lines(payload)), lambda p: p.isNotNull())
    return raw.select("seq", F.inline(rejects(payload, posts, usable)))
