"""Remote flags. Each source has its own fields and word list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.functions.text import contains_any, rx

# Word lists.
BASIC_WORDS = ("remote", "work from home", "wfh")
HOME_WORDS = BASIC_WORDS + ("home based",)
SHORT_WORDS = ("remote", "wfh")
POST_WORDS = ("remote", "wfh", "work from home", "work-from-home")
TWEET_WORDS = POST_WORDS + ("anywhere",)


def _joined(*texts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *texts))


def remote_keywords3(*texts: Column) -> Column:
    return contains_any(_joined(*texts), BASIC_WORDS)


REED_CHARS = 500  # fixed value: beginning of a description in which this board's rule looks


def remote_reed(title: Column, place: Column, description: Column, cut: int = REED_CHARS) -> Column:
    """Only the beginning of the description counts; that is this board's rule."""
    return remote_keywords3(title, place, F.left(description, F.lit(cut)))


def remote_indeed(labels: Column, description: Column, place: Column) -> Column:
    return F.exists(labels, lambda a: contains_any(F.lower(a), BASIC_WORDS)) | remote_keywords3(
        description, place
    )


def remote_bdjobs(title: Column, place: Column, description: Column | None = None) -> Column:
    texts = (title, place) if description is None else (title, description, place)
    return contains_any(_joined(*texts), HOME_WORDS)


def remote_google(description: Column) -> Column:
    return contains_any(_joined(description), SHORT_WORDS)


def remote_irish(*texts: Column) -> Column:
    """Whole words only."""
    return F.concat_ws("\n", *texts).rlike(rx(r"\b(?:remote|wfh|work from home)\b", ignore_case=True))


def remote_tweet(text: Column) -> Column:
    """True or unknown, never false."""
    return F.when(contains_any(F.lower(text), TWEET_WORDS), True)


def remote_post(text: Column) -> Column:
    """True or unknown, never false."""
    return F.when(contains_any(F.lower(text), POST_WORDS), True)


def remote_ats(platform: Column, flag: Column, place: Column, workplace: Column) -> Column:
    """Per career platform: location wording, explicit flag, work-place wording."""
    says = F.contains(F.lower(F.coalesce(place, F.lit(""))), F.lit("remote"))
    works = F.lower(F.coalesce(workplace, F.lit("")))
    flagged = F.coalesce(flag, F.lit(False))
    return (
        F.when(platform == "greenhouse", says)
        .when(platform == "lever", says | F.contains(works, F.lit("remote")))
        .when(platform == "ashby", flagged | says)
        .when(platform == "workable", flagged | F.contains(works, F.lit("remote")))
        .when(platform.isin("smartrecruiters", "bamboohr"), flagged)
        .when(platform == "jazzhr", says)
        .when(platform == "jsonld", F.contains(works, F.lit("telecommute")))
    )


def work_from_home_type(place: Column, title: Column, description: Column) -> Column:
    """Hybrid beats remote beats office."""
    text = F.lower(F.concat_ws(" ", place, title, description))
    return (
        F.when(F.contains(text, F.lit("hybrid")), "Hybrid")
        .when(F.contains(text, F.lit("remote")), "Remote")
        .otherwise("Work from office")
    )
