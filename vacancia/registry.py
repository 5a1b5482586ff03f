"""Which sites there are: the built-in boards and platforms, and those that a user adds."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.lookups import SITES
from vacancia.schema import POSTING_FIELDS
from vacancia.sources.payloads import ParseOptions

#: Career platforms that can be named like boards; without names, a request is for the boards.
PLATFORMS = ("greenhouse", "lever", "ashby", "smartrecruiters", "workable", "bamboohr", "jazzhr")
#: What is appended to a site's name where its detail payloads have landed.
DETAIL = "_detail"


@dataclass(frozen=True)
class Details:
    """How a site's detail payloads complete its listings."""

    parse: Callable[[DataFrame, ParseOptions], DataFrame]
    override: tuple[str, ...] = ("description",)
    fill: tuple[str, ...] = ()
    on: tuple[str, ...] = ("id",)
    job_type: str = "keep"


@dataclass(frozen=True)
class Board:
    """A site of a user's own.

    ``parse`` makes posting records of payloads (columns of ``RAW_DDL``). ``quarantine``, if given, makes
    ``seq, pos, reason, payload`` of what can't be read; without it, payloads that gave no posting are
    listed. Frames that ``details`` parses are joined as for the built-in boards.
    """

    name: str
    parse: Callable[[DataFrame, ParseOptions], DataFrame]
    quarantine: Callable[[DataFrame], DataFrame] | None = None
    details: Details | None = None


_ADDED: dict[str, Board] = {}


def register(board: Board) -> None:
    """Make a board known to requests, quarantine and streams of this session's driver."""
    name = board.name
    if name != name.strip().lower() or not name or name.endswith(DETAIL):
        raise ValueError(f"not a site's name: {name!r}")
    if name in SITES or name in PLATFORMS:
        raise ValueError(f"a built-in site: {name}")
    _ADDED[name] = board


def unregister(name: str) -> None:
    """Forget a board that was added; one that wasn't is an error."""
    del _ADDED[name]


def added() -> dict[str, Board]:
    return dict(_ADDED)


def site_names(names: str | Sequence[str] | None) -> list[str]:
    """Known sites in the order given, in any letter case; all boards by default."""
    if names is None:
        return [*SITES, *_ADDED]
    wanted = [n.strip().lower() for n in ([names] if isinstance(names, str) else names)]
    unknown = sorted(set(wanted) - {*SITES, *PLATFORMS, *_ADDED})
    if unknown:
        raise ValueError(f"unknown sites: {unknown}")
    return list(dict.fromkeys(wanted))


def checked(board: Board, rows: DataFrame) -> DataFrame:
    """A board's posting records in the fixed layout; a missing or differently typed field is an error."""
    found = {f.name: f.dataType.simpleString() for f in rows.schema}
    missing = sorted(set(POSTING_FIELDS) - set(found))
    if missing:
        raise ValueError(f"{board.name}: its parser gives no {', '.join(missing)}")
    wrong = sorted(c for c, kind in POSTING_FIELDS.items() if found[c] != kind)
    if wrong:
        raise ValueError(f"{board.name}: other types than a posting's: {', '.join(f'{c} {found[c]}' for c in wrong)}")

    def field(name: str) -> Column:
        return F.lit(board.name).alias("site") if name == "site" else F.col(name)

    return rows.select(*[field(c) for c in POSTING_FIELDS])
