"""Entity resolution: spellings of people and works to canonical entities.

Everything is grouping and joining by keys that spellings share; ties go to the larger count, then
to the spelling that sorts first. Identifiers are the keys themselves, so a run is repeatable and
inputs are never rewritten.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import lexicon as L
from ..functions.hrefs import lookup
from ..functions.spread import at_hand, attached
from ..functions.text import name_key, title_key
from .grammar import clean_name

TITLED = r"(?iu)^(?:president|elder|sister|brother|bishop)\s+"
NO_AUTHOR_TYPES = ("scripture", "periodical", "hymn", "manual", "study_help")
TITLE_ONLY_TYPES = ("periodical", "hymn", "manual", "talk", "study_help", "web", "play", "poem")


def most_common(rows: DataFrame, by: list[str], *what: str) -> DataFrame:
    """Per group the values that occur most; ties to the values that sort first."""
    n = rows.groupBy(*by, *what).agg(F.count("*").alias("_n"))
    return n.groupBy(*by).agg(F.min(F.struct((-F.col("_n")).alias("_n"), *what)).alias("_m")).select(*by, *[F.col("_m")[w].alias(w) for w in what])


def told_apart(rows: DataFrame, *columns: str) -> DataFrame:
    """The distinct values with their number as _n, by hashes: the least of many texts is found by sorting, so equal ones go first.

    The condition keeps the optimizer from folding this into an aggregate over it.
    """
    return rows.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 0")


def names_in(rows: DataFrame, *columns: str) -> DataFrame:
    """(name): every name in the columns, once for each row; by unpivot, as that makes no array of every row."""
    return rows.select(*columns).unpivot([], list(columns), "_column", "name").filter("name is not null").select("name")


def name_counts(citations: DataFrame, speakers: DataFrame) -> DataFrame:
    """(name, n): how often persons and authors are named, whatever the tier; speakers count 0."""
    named = names_in(citations, "person_quoted", "author_name").withColumn("n", F.lit(1))
    every = named.unionByName(speakers.filter("speaker_name <> ''").select(F.col("speaker_name").alias("name"), F.lit(0).alias("n")))
    return every.groupBy("name").agg(F.sum("n").alias("n"))


def first_last_merges(keys: DataFrame) -> DataFrame:
    """(key, into): 'first last' keys that one fuller key, and only one, shares first and last with."""
    t = F.split("key", " ")
    middle = F.slice(t, F.lit(2), F.greatest(F.size(t) - 2, F.lit(0)))
    full = (F.size(t) > 2) & ~F.arrays_overlap(middle, F.array(*[F.lit(w) for w in ("the", "of", "and", "de", "von", "van", "la", "le")]))
    pair = F.concat(t[0], F.lit(" "), F.element_at(t, -1))
    rows = keys.select("key").distinct().filter(F.size(t) >= 2).select("key", pair.alias("pair"), full.alias("full"), (F.size(t) == 2).alias("short"))
    groups = rows.groupBy("pair").agg(F.count_if("full").alias("fulls"), F.min(F.when(F.col("full"), F.col("key"))).alias("into"), F.max(F.when(F.col("short"), F.col("key"))).alias("key"))
    return groups.filter((F.col("fulls") == 1) & F.col("key").isNotNull() & ~F.col("pair").isin(*L.AMBIGUOUS)).select("key", "into")


def entry_order(curated: DataFrame) -> Column:
    """The place of a curated entry in its list; entries without one are equal."""
    return F.col("ord") if "ord" in curated.columns else F.lit(0)


def alias_keys(authors: DataFrame) -> DataFrame:
    """(key, canonical) of curated authors and their aliases; the later entry of a key wins, and among equals the last in order."""
    rows = authors.select("canonical", entry_order(authors).alias("ord"), F.posexplode(F.concat(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("i", "alias"))
    return rows.select(name_key(F.col("alias")).alias("key"), F.struct("ord", "i", "canonical").alias("at")).groupBy("key").agg(F.max("at")["canonical"].alias("canonical"))


def listed_canonical(key: Column, titled: Column) -> Column:
    """The leader or the wife whom a lone surname or 'sister surname' means."""
    sister = F.when(key.startswith("sister "), lookup(L.SISTER_TO_NAME, F.substring(key, 8, 100)))
    lone = F.when(~key.contains(" ") & (titled | ~key.isin(*L.UNTITLED_SURNAMES)), lookup(L.SURNAME_TO_LEADER, key))
    return F.coalesce(sister, lone)


def key_of_counted(name: str, n: str) -> Column:
    """``name_key`` of names that were grouped and counted: it asks for the count, so that the optimizer cannot move it ahead of that, to every row."""
    return F.when(F.coalesce(n, F.lit(0)) >= 0, name_key(F.col(name)))


def keyed_names(names: DataFrame, curated: DataFrame) -> DataFrame:
    """(name, n, author): every spelling with the key of its person."""
    rows = names.withColumn("key0", key_of_counted("name", "n"))
    rows = rows.join(first_last_merges(rows.select(F.col("key0").alias("key"))).withColumnRenamed("key", "key0"), "key0", "left")
    rows = rows.withColumn("key", F.coalesce("into", "key0")).drop("into")
    titled = F.coalesce(F.bool_or(F.col("name").rlike(TITLED)).over(W.partitionBy("key")), F.lit(False))
    rows = rows.withColumn("listed", listed_canonical(F.col("key"), titled)).join(alias_keys(curated), "key", "left")
    canonical = F.coalesce("canonical", "listed")
    return rows.select("name", "n", F.coalesce(name_key(canonical), "key").alias("author"), canonical.alias("canonical"))


def kinds(key: Column, speaker_keys: Column) -> Column:
    """church_leader, scripture_figure or external, before curated kinds."""
    leaders, figures = ({key_of_name(n) for n in names} for names in (L.HISTORIC_LEADERS, L.SCRIPTURE_FIGURES))
    return F.when(speaker_keys | key.isin(*leaders), "church_leader").when(key.isin(*figures), "scripture_figure").otherwise("external")


def key_of_name(name: str) -> str:
    """``name_key`` of a constant, on the driver."""
    bare = re.sub(r"\b(?:jr|sr|ii|iii|iv)\b", "", re.sub(r"[.,’'\"()\[\]]", "", (clean_name(name) or name).lower()))
    return " ".join(bare.split())


def authors(citations: DataFrame, speakers: DataFrame, curated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(author, canonical_name, kind) and (alias, author)."""
    keyed = keyed_names(name_counts(citations, speakers), curated)
    spelled = keyed.groupBy("author").agg(F.min(F.struct((-F.col("n")).alias("n"), "name"))["name"].alias("common"), F.max("canonical").alias("canonical"))
    spoke = told_apart(speakers.filter("speaker_name <> ''"), "speaker_name").select(key_of_counted("speaker_name", "_n").alias("author")).distinct().withColumn("spoke", F.lit(True))
    given = curated.select(name_key(F.col("canonical")).alias("author"), F.struct(entry_order(curated).alias("ord"), "kind").alias("given")).groupBy("author").agg(F.max("given")["kind"].alias("given"))
    out = spelled.join(spoke, "author", "left").join(given, "author", "left")
    out = out.select("author", F.coalesce("canonical", "common").alias("canonical_name"), F.coalesce("given", kinds(F.col("author"), F.coalesce("spoke", F.lit(False)))).alias("kind"))
    extra = curated.select(F.explode("aliases").alias("alias"), name_key(F.col("canonical")).alias("author")).join(out.select("author"), "author", "left_semi").select("alias", "author", F.lit(1).alias("rank"))
    aliases = keyed.select(F.col("name").alias("alias"), "author", F.lit(0).alias("rank")).unionByName(extra)
    return out, aliases.groupBy("alias").agg(F.max_by("author", F.struct("rank", "author")).alias("author"))  # curated aliases win


def filled(citations: DataFrame, talks: DataFrame) -> DataFrame:
    """Cross-references to known talks: title where none or a bare number, person and author where none."""
    known = talks.select(F.col("uri").alias("cited_talk_uri"), F.col("title").alias("_title"), F.nullif("speaker_name", F.lit("")).alias("_speaker"))
    weak = F.col("work_title").isNull() | (F.col("work_title").rlike("[0-9]") & (F.length("work_title") < 6))
    rows = citations.join(known, "cited_talk_uri", "left")
    return rows.withColumns({
        "work_title": F.when(weak, F.coalesce("_title", "work_title")).otherwise(F.col("work_title")),
        "person_quoted": F.coalesce("person_quoted", "_speaker"), "author_name": F.coalesce("author_name", "_speaker"),
    }).select(*citations.columns)


def with_ids(rows: DataFrame, aliases: DataFrame, **ids: str) -> DataFrame:
    """Adds the ids (column of names=column of ids) of persons through the alias table.

    A few names stand in most rows, so rows are not moved by their names: they stay where they are if
    the aliases can be broadcast; else only those with rare names are, and the others are scattered.
    """
    few = at_hand(aliases)
    if few is None:
        n = names_in(rows, *ids).groupBy(F.col("name").alias("alias")).agg(F.count("*").alias("_n"))
        aliases = aliases.join(n, "alias", "left")
    for name, key in ids.items():
        if few is None:
            rows = attached(rows, aliases.select(F.col("alias").alias(name), F.col("author").alias(key), "_n"), name, "_n")
        else:
            rows = rows.join(F.broadcast(few.select(F.col("alias").alias(name), F.col("author").alias(key))), name, "left").select(*rows.columns, key)
    return rows


def with_author_ids(citations: DataFrame, aliases: DataFrame) -> DataFrame:
    """Adds author_id and person_id through the alias table."""
    return with_ids(citations, aliases, author_name="author_id", person_quoted="person_id")


def curated_titles(works: DataFrame) -> DataFrame:
    """(title_key, given, given_type, given_author) of curated works and their aliases; the later entry of a key wins."""
    rows = works.select("canonical", "type", "author", entry_order(works).alias("ord"), F.posexplode(F.concat(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("i", "alias"))
    rows = rows.withColumn("title_key", title_key(F.col("alias"))).groupBy("title_key").agg(F.max(F.struct("ord", "i", "canonical", "type", "author")).alias("g"))
    return rows.select("title_key", F.col("g.canonical").alias("given"), F.col("g.type").alias("given_type"), F.col("g.author").alias("given_author"))


def work_keys(citations: DataFrame, works: DataFrame) -> DataFrame:
    """Adds work_id: 's|book', 'u|uri', 'o|curated title', 't|title' or 'a|title|author' (null where there is no title)."""
    title = F.coalesce("work_title", "container_title")
    rows = citations.withColumns({"title": title, "title_key": title_key(title)}).join(F.broadcast(curated_titles(works)), "title_key", "left")
    by_title = F.col("work_title").isNull() | F.coalesce(F.col("work_type").isin(*TITLE_ONLY_TYPES), F.lit(False)) | (F.size(F.split("title_key", " ")) >= 3)
    own = F.coalesce("author_id", "person_id", F.lit(""))
    key = (
        F.when(F.col("cited_talk_uri").isNotNull(), F.concat(F.lit("u|"), "cited_talk_uri"))
        .when((F.col("tier") == "scripture") & F.col("scripture_book").isNotNull(), F.concat(F.lit("s|"), "scripture_book"))
        .when(~F.col("tier").isin("freetext", "crossref") | F.col("title").isNull() | (F.col("title") == ""), F.lit(None))
        .when(F.col("given").isNotNull(), F.concat(F.lit("o|"), "given"))
        .when(by_title, F.concat(F.lit("t|"), "title_key")).otherwise(F.concat(F.lit("a|"), "title_key", F.lit("|"), own))
    )
    rows = rows.withColumn("work_id", key)
    # A title without an author joins the one author under whom it is known, if there is only one.
    lone = F.col("work_id").startswith("a|") & (own == "")
    known = told_apart(rows.filter(F.col("work_id").startswith("a|")).withColumn("_lone", lone), "title_key", "work_id", "_lone")
    named = F.when(~F.col("_lone"), F.col("work_id"))
    known = known.groupBy(F.col("title_key").alias("_key")).agg(F.min(named).alias("_a"), F.max(named).alias("_b"), F.sum(F.when(F.col("_lone"), F.col("_n"))).alias("n")).filter("_a = _b and n > 0")
    columns = rows.columns
    rows = attached(rows.withColumn("_key", F.when(lone, F.col("title_key"))), known.select("_key", "_a", "n"), "_key", "n")
    return rows.withColumn("work_id", F.coalesce("_a", "work_id")).select(*columns)


def works(keyed: DataFrame, talks: DataFrame) -> DataFrame:
    """(work_id, title, work_type, author_id, cited_talk_uri) of keyed citations."""
    rows = keyed.filter("work_id is not null")
    spelled = most_common(rows.withColumn("t", F.coalesce("title", "scripture_book", "cited_talk_uri")), ["work_id"], "t")
    only = F.col("work_title").isNull()
    meta = most_common(rows.select("work_id", F.when(only, "periodical").otherwise(F.col("work_type")).alias("work_type"), F.when(~only, F.col("author_id")).alias("author_id")), ["work_id"], "work_type", "author_id")
    given = told_apart(rows.filter("work_id like 'o|%'"), "work_id", "given_type", "given_author").groupBy("work_id").agg(F.max("given_type").alias("given_type"), F.max(name_key(F.col("given_author"))).alias("given_author"))
    cited = rows.filter("work_id like 'u|%'").select("work_id", "cited_talk_uri").distinct()
    cited = cited.join(talks.select(F.col("uri").alias("cited_talk_uri"), F.col("title").alias("_title"), F.col("speaker_id").alias("_speaker")), "cited_talk_uri", "left")
    out = spelled.join(meta, "work_id").join(given, "work_id", "left").join(cited, "work_id", "left")
    kind = F.substring("work_id", 1, 1)
    out = out.select(
        "work_id", F.when(kind == "o", F.substring("work_id", 3, 10_000)).when(kind == "u", F.coalesce("_title", "t")).when(kind == "s", F.substring("work_id", 3, 10_000)).otherwise(F.col("t")).alias("title"),
        F.when(kind == "u", "talk").when(kind == "s", "scripture").otherwise(F.coalesce("given_type", "work_type")).alias("work_type"),
        F.when(kind == "u", F.col("_speaker")).when(kind == "s", F.lit(None)).otherwise(F.coalesce("given_author", "author_id")).alias("author_id"), "cited_talk_uri",
    )
    return back_filled(out, rows)


def back_filled(works: DataFrame, rows: DataFrame) -> DataFrame:
    """Works without an author get the person most quoted from them; a work without a type gets none."""
    persons = most_common(rows.filter("person_id is not null").select("work_id", "person_id"), ["work_id"], "person_id")
    open_ = F.col("author_id").isNull() & F.coalesce(~F.col("work_type").isin(*NO_AUTHOR_TYPES), F.lit(False))
    return works.join(persons, "work_id", "left").withColumn("author_id", F.when(open_, F.col("person_id")).otherwise(F.col("author_id"))).drop("person_id")


def containers(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(container_title, container_id) and the new works among them (work_id, title).

    A container that is spelled as a work's title is that work; others are one per title key.
    """
    spelled = told_apart(keyed.filter("work_id is not null and title is not null"), "title", "work_id").groupBy(F.col("title").alias("container_title")).agg(F.min("work_id").alias("as_work"))
    found = keyed.filter("container_title is not null and work_title is not null").groupBy("container_title").agg(F.count("*").alias("n")).join(spelled, "container_title", "left")
    found = found.withColumn("key", F.concat(F.lit("c|"), title_key(F.col("container_title"))))
    first = found.groupBy("key").agg(F.min(F.struct((-F.col("n")).alias("n"), "container_title"))["container_title"].alias("title"), F.min("as_work").alias("shared"))
    out = found.join(first, "key").select("container_title", F.coalesce("as_work", "shared", "key").alias("container_id"))
    return out, first.filter("shared is null").select(F.col("key").alias("work_id"), "title")


def resolve(citations: DataFrame, talks: DataFrame, curated_authors: DataFrame, curated_works: DataFrame) -> dict[str, DataFrame]:
    """All of it: authors, aliases, works, talks with speaker_id, citations with author, person, work and container ids."""
    people, aliases = authors(citations, talks.select("speaker_name"), curated_authors)
    aliases = at_hand(aliases) or aliases
    talks = with_ids(talks, aliases, speaker_name="speaker_id")
    keyed = work_keys(with_author_ids(filled(citations, talks), aliases), curated_works)
    inside, new = containers(keyed)
    found = works(keyed, talks).unionByName(new.withColumns({"work_type": F.lit("periodical"), "author_id": F.lit(None).cast("string"), "cited_talk_uri": F.lit(None).cast("string")}))
    has = keyed.join(inside, "container_title", "left").withColumn("container_id", F.when(F.col("work_title").isNotNull(), F.col("container_id")))
    return {"authors": people, "aliases": aliases, "works": found, "talks": talks, "citations": has.drop("title", "title_key", "given", "given_type", "given_author")}
