"""Text keys and small projections as built-in column expressions."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..lexicon import PARTICLES  # noqa: F401  (re-exported for callers that build their own filters)

#: Titles before a name that are no part of it.
TITLES = (
    "president|elder|sister|brother|bishop|dr|the rev|rev|reverend|sir|lord|lady|dame|pope|rabbi|professor|prof|general|gen|king|queen|"
    "prophet|the prophet|apostle|mr|mrs|ms|miss|captain|capt|colonel|col|judge|justice|chief justice|senator|governor|cardinal|archbishop|"
    "presiding bishop|patriarch|the apostle|the venerable|his holiness|the honorable|hon|lieutenant|lt|major|maj|admiral|commander|sergeant|"
    "sgt|private|pvt|coach|chancellor|secretary|ambassador|mayor|first lady|brigadier|marshal|commodore|corporal|a sister|a brother|the late|the great"
)


def replaced(c: Column, *steps: tuple[str, str]) -> Column:
    for pattern, to in steps:
        c = F.regexp_replace(c, pattern, to)
    return c


def decade(year: Column) -> Column:
    """1987 -> '1980s'."""
    return F.concat((F.floor(year / 10) * 10).cast("string"), F.lit("s"))


def non_blank(c: Column, other: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(F.when(c != "", c), other)


@F.pandas_udf(T.StringType())
def unescaped(s: pd.Series) -> pd.Series:
    """HTML entities of all names and numbers, as one vector call a batch."""
    return s.map(html.unescape, na_action="ignore")


def plain(fragment: Column, entities: bool = True) -> Column:
    """Markup out, entities decoded, runs of white space to one space, trimmed."""
    bare = F.regexp_replace(fragment, "<[^>]+>", "")
    bare = unescaped(bare) if entities else bare
    return F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))


def clean_name(name: Column) -> Column:
    """A name without punctuation around it, leading titles and trailing dates; initials spaced."""
    out = replaced(
        name,
        (r"(?U)^[\s,;:.(“”]+|[\s,;:.)“”]+$", ""), (r"(?iu)^(?:by|and|from|with)\s+", ""), (rf"(?iu)^(?:(?:{TITLES})\.?\s+)+", ""),
        (r"(?U)\s+", " "), (r"\s*[\[(](?:\d{4}|b\.|d\.|c\.|ca\.)[^)\]]*[\])]\s*$", ""),
        (r"\b([A-Z])\.([A-Z])\.", "$1. $2."), (r"\b([A-Z])\.(?=[A-Z][a-z])", "$1. "), (r"\s+(Jr|Sr)$", " $1."),
    )
    return F.when(F.trim(out) != "", F.trim(out))


def name_key(name: Column) -> Column:
    """What spellings of one person share."""
    sister = F.regexp_extract(F.trim(name), r"(?U)^(?:Sister|Sis\.)\s+([A-Z][\w’'-]+)\.?$", 1)
    plain_key = replaced(F.lower(F.coalesce(clean_name(name), name)), (r"[.,’'\"()\[\]]", ""), (r"\b(?:jr|sr|ii|iii|iv)\b", ""), (r"(?U)\s+", " "))
    return F.when(sister != "", F.concat(F.lit("sister "), F.lower(sister))).otherwise(F.trim(plain_key))


def title_key(title: Column) -> Column:
    """What spellings of one title share."""
    return F.trim(replaced(F.lower(title), (r"[“”\"‘’'.,:;!?()\[\]—–-]", " "), (r"\b(?:the|a|an)\b", " "), (r"(?U)\s+", " ")))


def humanized(slug: Column) -> Column:
    """'saints-and-the-sea-2018' -> 'Saints and the Sea'."""
    small = F.array(*[F.lit(w) for w in ("of", "the", "and", "in", "to", "for", "a")])
    word = lambda w: F.when(F.array_contains(small, w), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 10_000))))
    return F.trim(F.array_join(F.transform(F.split(F.regexp_replace(slug, r"-\d{4}$", ""), "-"), word), " "))


def passage(book: Column, chapter: Column, start: Column, end: Column) -> Column:
    """'Alma 32:21–22'; the range only where it is one."""
    tail = F.when(end.isNotNull() & (end != 0) & (end != start), F.concat(F.lit("–"), end.cast("string"))).otherwise(F.lit(""))
    return F.concat(book, F.lit(" "), chapter.cast("string"), F.lit(":"), start.cast("string"), tail)
