"""Links: scripture references and cross-references, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..lexicon import BOOKS, HISTORIES, STUDY_HELPS, volumes
from .text import humanized


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def path_parts(href: Column) -> Column:
    """The parts of a link's path, without a leading /study."""
    path = F.regexp_replace(F.coalesce(F.try_parse_url(href, F.lit("PATH")), F.regexp_extract(href, r"^[^?#]*", 0)), "^/study", "")
    return F.filter(F.split(path, "/"), lambda p: p != "")


def part(parts: Column, i: int) -> Column:
    return F.try_element_at(parts, F.lit(i + 1))


def scripture_href(href: Column) -> Column:
    """Struct of book, chapter, verse_start, verse_end; all null for links to anything else.

    Verses are the least and the largest paragraph number of the ``id`` parameter.
    """
    parts = path_parts(href)
    is_book = (F.size(parts) >= 3) & (part(parts, 0) == "scriptures") & ~part(parts, 1).isin("bd", "gs", "tg", "jst", "harmony")
    book = F.coalesce(lookup(BOOKS, part(parts, 2)), F.initcap(F.replace(part(parts, 2), F.lit("-"), F.lit(" "))))
    chapter = F.when(part(parts, 3).rlike(r"^[0-9]+$"), part(parts, 3).try_cast("int"))
    query = F.regexp_extract(href, r"[?&]id=([^&#]*)", 1)
    numbers = F.transform(F.regexp_extract_all(F.coalesce(F.try_url_decode(F.try_url_decode(query)), F.lit("")), F.lit(r"p(\d+)"), F.lit(1)), lambda n: n.try_cast("int"))
    when = lambda c: F.when(is_book, c)
    return F.struct(when(book).alias("book"), when(chapter).alias("chapter"), when(F.array_min(numbers)).alias("verse_start"), when(F.array_max(numbers)).alias("verse_end"))


def book_of_link(href: Column, text: Column) -> Column:
    """The book of a scripture link, else its text without a trailing reference."""
    return F.coalesce(scripture_href(href)["book"], F.nullif(F.trim(F.regexp_extract(F.trim(text), r"^(.*?)(?:\s+\d+(?::\d+.*)?)?$", 1)), F.lit("")))


def volume_of(book: Column) -> Column:
    return F.coalesce(lookup(volumes(), book), F.lit("Other"))


def crossref(href: Column) -> Column:
    """Struct of work_type, container_title, cited_talk_uri, work_title_hint for a link inside the library."""
    parts = path_parts(href)
    head, sub = part(parts, 0), F.coalesce(part(parts, 1), F.lit(""))
    full, null = F.size(parts) >= 4, F.lit(None).cast("string")
    talk, hymn = head == "general-conference", sub.startswith("hymns")
    magazine = head.isin("ensign", "liahona", "new-era", "friend", "tambuli", "ya-weekly", "yw-weekly")
    song = (head == "manual") & (hymn | (sub == "childrens-songbook"))
    helps = (head == "scriptures") & sub.isin(*STUDY_HELPS)
    kind = (
        F.when(talk, "talk").when(magazine, "article").when(song | (head == "music"), "hymn").when(head == "manual", "manual").when(helps, "study_help")
        .when(head == "scriptures", "scripture").when(head.isin("history", "books"), "book").when(head.isin("broadcasts", "devotionals", "video", "media"), "speech").otherwise("other")
    )
    magazine_name = F.when(head == "new-era", "New Era").otherwise(F.concat(F.upper(F.substring(head, 1, 1)), F.substring(head, 2, 100)))
    container = (
        F.when(talk, "General Conference").when(magazine, magazine_name).when((head == "music") | ((head == "manual") & hymn), "Hymns")
        .when(song, "Children's Songbook").when(helps, lookup(STUDY_HELPS, sub)).otherwise(null)
    )
    hint = (
        F.when((head == "manual") & ~song, humanized(sub)).when(head == "history", F.coalesce(lookup(HISTORIES, sub), humanized(sub)))
        .when((head == "books") & (sub != ""), humanized(sub)).otherwise(null)
    )
    uri = F.when(talk & full, F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, 4), "/")))
    return F.struct(kind.alias("work_type"), container.alias("container_title"), uri.alias("cited_talk_uri"), hint.alias("work_title_hint"))
