"""Scope selectors: which talks a command works on."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: titles of conference items that are no talks.
NOT_TALKS = (
    r"(?iu)^(the )?(solemn assembly( and)? )?sustaining (of|a new|the)|^statistical report|^(the )?(church )?audit(ing)? (committee |department )?report|^audit report|"
    r"^church (audit|auditing|finance)|^(the )?solemn assembly$|^presentation of|^revelation on priesthood accepted|^video:|\[video presentation\]|annual report of the church|"
    r"^statistical and financial report|^financial report"
)
FIRST_YEAR = 1971


@dataclass(frozen=True)
class Scope:
    """Years from first to last (None: from FIRST_YEAR to the present), one month or both conferences, one talk or all."""

    first: int | None = None
    last: int | None = None
    month: int | None = None
    slug: str | None = None

    def condition(self) -> Column:
        last = F.year(F.current_date()) if self.last is None else F.lit(self.last)
        out = F.col("year").between(FIRST_YEAR if self.first is None else self.first, last)
        out = out & (F.col("month") == self.month if self.month else F.col("month").isin(4, 10))
        return out & (F.col("slug") == self.slug) if self.slug else out


def parse_selector(selector: str) -> Scope:
    """all | YYYY | YYYY..YYYY | YYYY/M | YYYY/M/slug | a talk's address, with or without /study."""
    s = selector.strip().strip("/")
    if s in ("", "*", "all"):
        return Scope()
    for pattern in (r"(\d{4})\.\.(\d{4})", r"(\d{4})"):
        if m := re.fullmatch(pattern, s):
            years = [int(y) for y in m.groups()]
            return Scope(years[0], years[-1])
    m = re.fullmatch(r"(\d{4})/(\d{1,2})(?:/([^/]+))?", s) or re.fullmatch(r"(?:https?://[^/]+/)?(?:study/)?general-conference/(\d{4})/(\d{2})/([^/?]+).*", s)
    if not m:
        raise ValueError(f"unrecognized selector: {selector!r}")
    return Scope(int(m[1]), int(m[1]), int(m[2]), m[3])


def is_talk(title: str = "title", speaker: str = "speaker") -> Column:
    return (F.length(F.trim(F.col(speaker))) > 0) & ~F.trim(F.col(title)).rlike(NOT_TALKS)


def select(refs: DataFrame, selector: str = "all", session: str | None = None, speaker: str | None = None, include_non_talks: bool = False) -> DataFrame:
    """The references in scope; all conditions reach the scan. A talk that is named must be there."""
    scope = parse_selector(selector)
    out = refs.filter(scope.condition())
    if scope.slug and out.isEmpty():
        raise ValueError(f"talk {scope.slug!r} not found in {selector}")
    return narrowed(out, session, speaker, include_non_talks, is_talk())


def narrowed(rows: DataFrame, session: str | None, speaker: str | None, include_non_talks: bool, talk: Column) -> DataFrame:
    if session:
        rows = rows.filter(F.lower("session").contains(session.lower().replace("-", " ")))
    if speaker:
        rows = rows.filter(F.lower("speaker").contains(speaker.lower()))
    return rows if include_non_talks else rows.filter(talk)
