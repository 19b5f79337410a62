"""Registered queries of the page, segment, grammar and fold operators.

Texts are made from templates, the same way in Spark and in SQL, and the SQL states the parts that
they were made from.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import hrefs, text
from .functions.spread import widened
from .operators import entities, fold, pages
from .plans import pipeline, star
from .queries import query
from .queries_text import ARTICLES, BOOKS, CODES, HREF_FIELDS, HREFS, PEOPLE, PERIODICALS, orders, pick, sql_pick

#: Parts of a template, by key: in Spark and in SQL.
PARTS = {
    "p": (lambda k: pick(PEOPLE, k), sql_pick(PEOPLE, "k")),
    "b": (lambda k: pick(BOOKS, F.floor(k / 3)), sql_pick(BOOKS, "k // 3")),
    "a": (lambda k: pick(ARTICLES, F.floor(k / 5)), sql_pick(ARTICLES, "k // 5")),
    "h": (lambda k: pick(PERIODICALS, F.floor(k / 2)), sql_pick(PERIODICALS, "k // 2")),
    "g": (lambda k: (k % 300 + 1).cast("string"), "CAST(k % 300 + 1 AS VARCHAR)"),
    "y": (lambda k: (k % 60 + 1950).cast("string"), "CAST(k % 60 + 1950 AS VARCHAR)"),
    "s": (lambda k: F.element_at(F.split(pick(PEOPLE, k), " "), -1), f"list_extract(string_split({sql_pick(PEOPLE, 'k')}, ' '), -1)"),
    "v": (lambda k: (k % 20 + 1).cast("string"), "CAST(k % 20 + 1 AS VARCHAR)"),
}


def made(template: str, k: Column) -> Column:
    """'{p}, {b}' as a column."""
    pieces = re.split(r"\{(\w)\}", template)
    return F.concat(*[PARTS[x][0](k) if i % 2 else F.lit(x) for i, x in enumerate(pieces)])


def sql_made(template: str | None) -> str:
    """The same in SQL."""
    if template is None:
        return "NULL"
    pieces = re.split(r"\{(\w)\}", template)
    return "(" + " || ".join(PARTS[x][1] if i % 2 else "'" + x.replace("'", "''") + "'" for i, x in enumerate(pieces)) + ")"


def chosen(templates: list[str], k: Column) -> Column:
    """The template whose number is the key's remainder."""
    out = F.when(F.lit(False), "")
    for i, t in enumerate(templates):
        out = out.when(k % len(templates) == i, made(t, k))
    return out


def sql_chosen(templates: list[str | None], kind: str = "VARCHAR") -> str:
    return f"CASE k % {len(templates)} " + " ".join(f"WHEN {i} THEN CAST({sql_made(t)} AS {kind})" for i, t in enumerate(templates)) + " END"


KEYS = "(SELECT o_orderkey AS k FROM orders)"

# ---- grammar: (segment, author, person, title, type, container, year, locator, relation, is_citation, confidence)
SHAPES = [
    ("{p}, {b} ({y}), {g}.", "{p}", "{p}", "{b}", "book", None, "{y}", "{g}", "quoted", "true", "0.9"),
    ("See {p}, “{a},” {h}, May {y}, {g}.", "{p}", "{p}", "{a}", "article", "{h}", "{y}", "{g}", "see", "true", "1.0"),
    ("Mahatma Gandhi, in {p}, comp., {b} ({y}), {g}.", "{p}", "Mahatma Gandhi", "{b}", "book", None, "{y}", "{g}", "secondary", "true", "0.9"),
    ("“{a},” Hymns, no. {g}", None, None, "{a}", "hymn", "Hymns", None, "no. {g}", "quoted", "true", "0.6"),
    ("{p} quoting Orson Pratt, {b} ({y}), {g}", "Orson Pratt", "Orson Pratt", "{b}", "book", None, "{y}", "{g}", "secondary", "true", "0.9"),
    ("{p}, “{a}” (address given at Provo, {y})", "{p}", "{p}", "{a}", "speech", None, "{y}", None, "quoted", "true", "1.0"),
    ("{b}, ed. Jane Roe, New York: Knopf, {y}, p. {g}.", "Jane Roe", None, "{b}", "book", None, "{y}", "p. {g}", "quoted", "true", "0.9"),
    ("Teachings of Presidents of the Church: {p} ({y}), {g}.", None, "{p}", "Teachings of Presidents of the Church: {p}", "manual", None, "{y}", "{g}", "quoted", "true", "0.9"),
    ("Mere Christianity, {g}.", None, "C. S. Lewis", "Mere Christianity", "book", None, None, "{g}", "quoted", "true", "0.9"),
    ("Hamlet, act 3, scene 1, lines {g}", None, "William Shakespeare", "Hamlet", "play", None, None, "act 3, scene 1, lines {g}", "quoted", "true", "0.9"),
    ("Personal correspondence, {y}", None, None, "Personal correspondence", "other", None, "{y}", None, "quoted", "true", "0.5"),
    ("{p}, “{a},” in {b} ({y}), {g}", "{p}", "{p}", "{a}", "chapter", "{b}", "{y}", "{g}", "quoted", "true", "1.0"),
    ("{p}, {b}, and the Long Night ({y}), {g}", "{p}", "{p}", "{b}, and the Long Night", "book", None, "{y}", "{g}", "quoted", "true", "0.9"),
    ("{p}, in Conference Report, Oct. {y}, {g}", "{p}", "{p}", None, "talk", "Conference Report", "{y}", "{g}", "quoted", "true", "0.75"),
    ("{h}, Nov. 15, {y}, {g}", None, None, None, "periodical", "{h}", "{y}", "{g}", "quoted", "true", "0.35"),
    ("Approximately forty people came yesterday with {p}", None, None, None, None, None, None, None, "quoted", "false", "0.0"),
    ("{p}, “{a},” in The Complete Poems, lines {g}", "{p}", "{p}", "{a}", "poem", "The Complete Poems", None, "lines {g}", "quoted", "true", "1.0"),
    ("Cf. {p}, “{a},” general conference", "{p}", "{p}", "{a}", "talk", None, None, None, "see", "true", "0.85"),
    ("{p}, {b} (Salt Lake City: Bookcraft, {y}), chap. 4", "{p}", "{p}", "{b}", "book", None, "{y}", "chap. 4", "quoted", "true", "0.9"),
    ("{p}, {b}, trans. Ann Roe, collector's ed. [c. {y}], vol. 2, p. {g}", "{p}", "{p}", "{b}", "book", None, "{y}", "vol. 2, p. {g}", "quoted", "true", "0.9"),
]
FIELDS = ("author", "person_quoted", "work_title", "work_type", "container_title", "year", "locator", "relation", "is_citation", "confidence")
_KIND = {"year": "INT", "is_citation": "BOOLEAN", "confidence": "DOUBLE"}


@query("grammar_roundtrip", "SELECT k, " + ", ".join(f"{sql_chosen([s[i + 1] for s in SHAPES], _KIND.get(n, 'VARCHAR'))} AS {n}" for i, n in enumerate(FIELDS)) + f" FROM {KEYS}", over_star=False)
def grammar_roundtrip(spark, sf_dir):
    rows = widened(orders(spark, sf_dir)).select("k", fold.parse_udf()(chosen([s[0] for s in SHAPES], F.col("k")), F.lit("")).alias("p"))
    return rows.select("k", *[f"p.{c}" for c in FIELDS[:-1]], F.round("p.confidence", 2).alias("confidence"))


# ---- running text: (context, person)
CONTEXTS = [
    ("In those days Parley P. Pratt wrote a letter. Later, Elder {p}, who knew him well, once said:", "{p}"),
    ("In those days Parley P. Pratt wrote a letter. Later, Elder {p} taught:", "{p}"),
    ("I think of the words of {p}, and how the saints sang", "{p}"),
    ("It was cold that night, and {b} lay open", None),
    ("The testimony of {p} stands, and Orson Pratt penned these words:", "Orson Pratt"),
]


@query("context_attribution", f"SELECT k, {sql_chosen([p for _, p in CONTEXTS])} AS person FROM {KEYS}", over_star=False)
def context_attribution(spark, sf_dir):
    return widened(orders(spark, sf_dir)).select("k", fold.attribution_udf()(chosen([c for c, _ in CONTEXTS], F.col("k"))).alias("person"))


# ---- segments and sentences: (footnote, number of segments, first, last)
NOTES = [
    ("<p>{p}, {b}, {g}; {a}, 2; emphasis added.</p>", "2", "{p}, {b}, {g}", "{a}, 2"),
    ("{p}, {b}, {g}; {a}, 2; or Ensign, May 1980, 3", "2", "{p}, {b}, {g}", "{a}, 2"),
    ("<p>{p}, {b} [one; two], {g}.</p><p>{a}, 3; spelling added</p>", "4", "{p}, {b} [one", "spelling added"),
    ("<p>President {p} taught: “Be kind in all that you do, and gentle too.” (“{a},” {h}, May {y}, {g}; see {b}, 4)</p>", "2", "“{a},” {h}, May {y}, {g}", "see {b}, 4"),
    ("<p>See {p}, pp. {g}. {b} has more.</p>", "2", "See {p}, pp. {g}.", "{b} has more."),
    ("<p>{p}, <cite>{b}; {a},</cite> no. {g}. Ibid., 4.</p>", "2", "{p}, ⟪{b}; {a},⟫ no. {g}.", "Ibid., 4."),
]


@query("segments", "SELECT k, " + ", ".join(f"{sql_chosen([n[i + 1] for n in NOTES], t)} AS {c}" for i, (c, t) in enumerate((("n", "INT"), ("first", "VARCHAR"), ("last", "VARCHAR")))) + f" FROM {KEYS}", over_star=False)
def segments(spark, sf_dir):
    rows = widened(orders(spark, sf_dir)).select("k", fold.segments_udf()(chosen([n[0] for n in NOTES], F.col("k"))).alias("s"))
    return rows.select("k", F.size("s").alias("n"), F.element_at("s", 1)["segment"].alias("first"), F.element_at("s", -1)["segment"].alias("last"))


SENTENCES = [("{p} wrote {b}. See p. {g}. “One. Two.” Then {a} came. End", ("{p} wrote {b}.", "See p. {g}.", "“One. Two.” Then {a} came.", "End")), ("{b} by {p} Jr. Was read in Oct. {y}. (Not. Here.) No.", ("{b} by {p} Jr. Was read in Oct. {y}.", "(Not. Here.) No."))]


@query("sentence_split", f"SELECT k, unnest(CASE k % 2 " + " ".join(f"WHEN {i} THEN [{', '.join(map(sql_made, parts))}]" for i, (_, parts) in enumerate(SENTENCES)) + f" END) AS sentence FROM {KEYS}", over_star=False)
def sentence_split(spark, sf_dir):
    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(fold.sentences)

    return widened(orders(spark, sf_dir)).select("k", F.explode(cut(chosen([t for t, _ in SENTENCES], F.col("k")))).alias("sentence"))


# ---- the fold: a talk of seven footnotes, with what each must give
LINK = '<a class="{kind}" href="{href}">{text}</a>'
TALK = [
    ("<p>{p}, {b} of Old Rome (1952), {g}.</p>", {"tier": "freetext", "author_name": "{p}", "work_title": "{b} of Old Rome", "locator": "{g}", "relation": "quoted", "parser": "rules"}),
    ("<p>{s}, {b} of Old Rome, 9.</p>", {"tier": "freetext", "author_name": "{p}", "work_title": "{b} of Old Rome", "locator": "9", "relation": "quoted", "parser": "rules"}),
    ("<p>Ibid., 180.</p>", {"tier": "freetext", "author_name": "{p}", "work_title": "{b} of Old Rome", "locator": "180", "relation": "quoted", "parser": "ibid"}),
    ('<p>See <a class="scripture-ref" href="/study/scriptures/bofm/alma/32?lang=eng&amp;id=p{v}#p{v}">Alma 32:{v}</a>.</p>', {"tier": "scripture", "work_title": "Alma", "relation": "see", "verse_start": "{v}", "parser": "href"}),
    ('<p>{p}, “<a class="cross-ref" href="/study/general-conference/2002/10/rise?lang=eng">Rise to Your Call</a>,” Liahona, Nov. 2002, {g}</p>',
     {"tier": "crossref", "author_name": "{p}", "work_title": "Rise to Your Call", "locator": "{g}", "relation": "quoted", "parser": "href+rules"}),
    ("<p>My grandfather came with them, and he told us many things.</p>", {"tier": "note", "relation": "quoted", "parser": "rules"}),
    ("<p>{b}, 12.</p>", {"tier": "freetext", "author_name": "{p}", "work_title": "{b} of Old Rome", "locator": "12", "relation": "quoted", "parser": "rules+shortform"}),
]
TALK_FIELDS = ("tier", "author_name", "work_title", "locator", "relation", "verse_start", "parser")


def talk_notes(spark, sf_dir) -> DataFrame:
    """Per order a talk with the footnotes of TALK."""
    notes = F.array(*[made(t, F.col("k")) for t, _ in TALK])
    rows = orders(spark, sf_dir).select(F.col("k").alias("talk_id"), F.posexplode(notes).alias("ord", "raw_html"))
    return rows.select("talk_id", F.concat(F.lit("note"), (F.col("ord") + 1).cast("string")).alias("marker"), F.lit(False).alias("inline"), "ord", "raw_html", F.lit("").alias("context"))


@query(
    "talk_fold",
    "SELECT k AS talk_id, 'note' || n AS marker, "
    + ", ".join(f"CASE n " + " ".join(f"WHEN {i + 1} THEN CAST({sql_made(want.get(f))} AS {'INT' if f == 'verse_start' else 'VARCHAR'})" for i, (_, want) in enumerate(TALK)) + f" END AS {f}" for f in TALK_FIELDS)
    + f" FROM {KEYS}, (SELECT unnest(range(1, {len(TALK) + 1})) AS n)",
    over_star=False,
)
def talk_fold(spark, sf_dir):
    return fold.extract(talk_notes(spark, sf_dir)).select("talk_id", "marker", *TALK_FIELDS)


# ---- links as the fold reads them, against the SQL of their native twins


@query("crossref_in_fold", "SELECT k, " + ", ".join(f"{sql_pick([f[i] for f in HREF_FIELDS], 'k')} AS {n}" for i, n in enumerate(("work_type", "container_title", "cited_talk_uri", "work_title_hint"))) + f" FROM {KEYS}", over_star=False)
def crossref_in_fold(spark, sf_dir):
    @F.pandas_udf("work_type string, container_title string, cited_talk_uri string, work_title_hint string")
    def read(links: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fold.library_link(x) for x in links], columns=["work_type", "container_title", "cited_talk_uri", "work_title_hint"], dtype=object)

    return orders(spark, sf_dir).select("k", read(pick(HREFS, F.col("k"))).alias("r")).select("k", "r.*")


def scripture_address(k: Column) -> Column:
    verse = k % 20 + 1
    return F.concat(F.lit("/study/scriptures/x/"), pick([c for c, _ in CODES], k), F.lit("/"), (k % 50 + 1).cast("string"), F.lit("?lang=eng&id=p"), verse.cast("string"), F.lit("%2Cp"), (verse + k % 3).cast("string"), F.lit("#p1"))


@query("scripture_in_fold", f"SELECT k, {sql_pick([b for _, b in CODES], 'k')} AS book, CAST(k % 50 + 1 AS INT) AS chapter, CAST(k % 20 + 1 AS INT) AS verse_start, CAST(k % 20 + 1 + k % 3 AS INT) AS verse_end FROM {KEYS}", over_star=False)
def scripture_in_fold(spark, sf_dir):
    @F.pandas_udf("book string, chapter int, verse_start int, verse_end int")
    def read(links: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fold.scripture_link(fold.Link("S", x, "")) for x in links], columns=["book", "chapter", "verse_start", "verse_end"])

    return orders(spark, sf_dir).select("k", read(scripture_address(F.col("k"))).alias("r")).select("k", "r.*")


@query("book_of_link", f"SELECT k, CASE k % 3 WHEN 0 THEN {sql_pick([b for _, b in CODES], 'k')} WHEN 1 THEN {sql_pick(BOOKS, 'k')} ELSE NULL END AS book FROM {KEYS}", over_star=False)
def book_of_link(spark, sf_dir):
    k = F.col("k")
    href = F.when(k % 3 == 0, scripture_address(k)).otherwise("/study/scriptures/bd/aaron")
    shown = F.when(k % 3 == 1, F.concat(pick(BOOKS, k), F.lit(" "), (k % 9).cast("string"), F.lit(":4–6"))).otherwise(" ")
    return orders(spark, sf_dir).select("k", hrefs.book_of_link(href, shown).alias("book"))


# ---- pages made from known parts


@query("plain_text_entities", "SELECT p_partkey AS k, p_name || ' & é “' || p_brand || '” <' || p_type || '> — ½' AS plain FROM part", over_star=False)
def plain_text_entities(spark, sf_dir):
    html = F.concat(F.lit("<p>  "), "p_name", F.lit(" &amp; &eacute;&nbsp;&#8220;<b>"), "p_brand", F.lit("</b>&#x201D;\n&lt;"), "p_type", F.lit("&gt; &mdash; &frac12;</p>"))
    return widened(star.table(spark, sf_dir, "part")).select(F.col("p_partkey").alias("k"), text.plain(html).alias("plain"))


PAGE = (
    '<p class="title">{b}</p><p class="author-name">By Elder {p}</p><p class="author-role">Of {h}</p><h2 class="kicker title">{a}</h2><p data-aid="p1" id="first">We read {b}<a class="note-ref" href="#note1">1</a> &amp; more'
    '<p>(see <cite>{a}</cite>, {y})<ul><li><p id="q1">Then {p} spoke <a class="scripture-ref" href="/study/scriptures/nt/luke/4?id=p{v}">Luke 4:{v}</a></p></li></ul>'
    '<footer class="notes"><p>{g}</p></footer><p data-aid="p1">Again</p><footer><p>No {g}</p></footer>'
)
_PARAGRAPHS = [("x0", "0", "{a}"), ("p1", "1", "We read {b}1 & more"), ("x2", "2", "(see {a}, {y})"), ("q1", "3", "Then {p} spoke Luke 4:{v}")]


def made_pages(spark, sf_dir) -> DataFrame:
    notes = F.array(
        F.struct(F.lit("note1").alias("key"), F.struct(made("<p>{p}, {g}.</p>", F.col("k")).alias("text"), F.lit("p1").alias("pid"), F.lit("told").alias("context")).alias("value")),
        F.struct(F.lit("note2").alias("key"), F.struct(made("{b}", F.col("k")).alias("text"), F.lit("p9").alias("pid"), F.lit("told").alias("context")).alias("value")),
    )
    return widened(orders(spark, sf_dir).filter("k % 10 = 0")).select("k", pages.page_udf()(made(PAGE, F.col("k")), notes).alias("b"))


TENTHS = "(SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 10 = 0)"


@query("page_byline", f"SELECT k, {sql_made('Elder {p}')} AS speaker_name, {sql_made('Of {h}')} AS speaker_role FROM {TENTHS}", over_star=False)
def page_byline(spark, sf_dir):
    return made_pages(spark, sf_dir).select("k", "b.speaker_name", "b.speaker_role")


@query("page_paragraphs", " UNION ALL ".join(f"SELECT k, '{pid}' AS pid, {n} AS ord, {sql_made(t)} AS text FROM {TENTHS}" for pid, n, t in _PARAGRAPHS), over_star=False)
def page_paragraphs(spark, sf_dir):
    return made_pages(spark, sf_dir).select("k", F.inline("b.paragraphs"))


#: (marker, pid, ord, inline, raw_html, context)
_FOOTNOTES = [
    ("note1", "p1", "0", "false", "<p>{p}, {g}.</p>", "We read {b}"),
    ("note2", "p9", "1", "false", "{b}", "told"),
    ("ix2.0", "x2", "10001", "true", "see <cite>{a}</cite>, {y}", "We read {b}1 & more"),
    ("iq1.0", "q1", "10002", "true", '<a class="scripture-ref" href="/study/scriptures/nt/luke/4?id=p{v}">Luke 4:{v}</a>', "Then {p} spoke"),
]


@query("page_footnotes", " UNION ALL ".join(f"SELECT k, '{m}' AS marker, '{pid}' AS pid, {n} AS ord, {i} AS inline, {sql_made(raw)} AS raw_html, {sql_made(c)} AS context FROM {TENTHS}" for m, pid, n, i, raw, c in _FOOTNOTES), over_star=False)
def page_footnotes(spark, sf_dir):
    return made_pages(spark, sf_dir).select("k", F.inline("b.footnotes"))


@query("web_page_paragraphs")
def web_page_paragraphs(spark, sf_dir):
    """Paragraphs of real web pages, which SQL cannot read."""
    none = F.expr("array()").cast("array<struct<key:string,value:struct<text:string,pid:string,context:string>>>")
    rows = widened(star.table(spark, sf_dir, "pages")).select("page_id", pages.page_udf()("html", none).alias("b"))
    return rows.select("page_id", F.inline("b.paragraphs"))


# ---- works of scripture and talks, and alias lists


def cited(spark, sf_dir) -> DataFrame:
    """Scripture citations, and cross-references to talks under three addresses out of four."""
    null = F.lit(None).cast("string")
    uri = F.when(F.col("tier") == "crossref", F.concat(F.lit("/t/"), F.pmod("work_id", F.lit(40)).cast("string")))
    title = F.when((F.col("tier") == "crossref") & (F.col("work_id") % 3 == 0), pick(BOOKS, F.pmod("work_id", F.lit(40))))
    return star.citations(spark, sf_dir).filter("tier in ('scripture', 'crossref')").select(
        "tier", "scripture_book", uri.alias("cited_talk_uri"), title.alias("work_title"), F.when(F.col("tier") == "crossref", "talk").otherwise("scripture").alias("work_type"), null.alias("container_title"), null.alias("author_id"), null.alias("person_id"),
    )


_CITED = "(SELECT DISTINCT work_id % 40 AS t FROM citations WHERE tier = 'crossref')"
_TITLES = f"(SELECT t, title FROM (SELECT t, title, row_number() OVER (PARTITION BY t ORDER BY n DESC, title) AS r FROM (SELECT work_id % 40 AS t, CASE WHEN work_id % 3 = 0 THEN {sql_pick(BOOKS, 'work_id % 40')} ELSE '/t/' || work_id % 40 END AS title, count(*) AS n FROM citations WHERE tier = 'crossref' GROUP BY ALL)) WHERE r = 1)"


@query(
    "scripture_and_talk_works",
    f"""SELECT DISTINCT 's|' || scripture_book AS work_id, scripture_book AS title, 'scripture' AS work_type, NULL AS author_id, NULL AS cited_talk_uri FROM citations WHERE tier = 'scripture' AND scripture_book IS NOT NULL
UNION ALL SELECT 'u|/t/' || t, CASE WHEN t % 4 < 3 THEN 'Talk ' || t ELSE title END, 'talk', CASE WHEN t % 4 < 3 THEN 'p' || t END, '/t/' || t FROM {_CITED} JOIN {_TITLES} USING (t)""",
)
def scripture_and_talk_works(spark, sf_dir):
    n = F.col("id")
    talks = spark.range(40).filter("id % 4 < 3").select(F.concat(F.lit("/t/"), n.cast("string")).alias("uri"), F.concat(F.lit("Talk "), n.cast("string")).alias("title"), F.concat(F.lit("p"), n.cast("string")).alias("speaker_id"))
    none = spark.createDataFrame([], "canonical string, author string, type string, aliases array<string>")
    return entities.works(entities.work_keys(cited(spark, sf_dir), none), talks)


@query("alias_lists", "SELECT person_id, string_agg(DISTINCT alias, ';' ORDER BY alias) AS aliases FROM (SELECT person_id, alias, dense_rank() OVER (PARTITION BY person_id ORDER BY alias) AS r FROM (SELECT person_id, 'n' || work_id % 50 AS alias FROM citations)) WHERE r <= 8 GROUP BY 1")
def alias_lists(spark, sf_dir):
    from .operators import rollups

    names = star.citations(spark, sf_dir).select("person_id", F.concat(F.lit("n"), (F.col("work_id") % 50).cast("string")).alias("alias"))
    return rollups.aliases(names, "person_id", "alias").withColumn("aliases", F.array_join("aliases", ";"))


# ---- a rerun over a narrow scope


@query("rerun_scope", "SELECT talk_id, year, month, CASE WHEN talk_id % 7 = 0 THEN 2 ELSE 1 END AS run FROM talks WHERE talk_id % 7 > 0 OR talk_id % 2 = 0")
def rerun_scope(spark, sf_dir):
    """All talks are saved, then a seventh of them again; of these the odd ones have no rows the second time."""
    home = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/") + "/rerun_scope"
    from .sources import archive

    archive.delete(spark, home)
    rows = star.talks(spark, sf_dir).select("talk_id", F.lit(1).alias("run"), "year", "month")
    pipeline.save(rows, home, rows, "talk_id")
    some = rows.filter("talk_id % 7 = 0").withColumn("run", F.lit(2))
    return pipeline.save(some.filter("talk_id % 2 = 0"), home, some, "talk_id")


