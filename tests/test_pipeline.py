"""The stages end to end over a small archive, and its parts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from glossa import cli
from glossa.functions import text
from glossa.operators import entities, fold, pages, scope
from glossa.plans import pipeline
from glossa.sources import archive, crawl, http
from glossa.streaming import ingest


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    """Two conferences, three talks, one item that is no talk."""
    at = tmp_path_factory.mktemp("raw")

    def item(uri, title, speaker):
        return {"content": {"uri": f"/study{uri}", "title": title, "subtitle": speaker}}

    note = lambda t, p="p1": {"text": f"<p>{t}</p>", "pid": p, "context": ""}
    talks = {
        "1980-04/one": {"note1": note("C. S. Lewis, Mere Christianity (1952), 174."), "note2": note("Lewis, Mere Christianity, 9."), "note3": note('See <a class="scripture-ref" href="/study/scriptures/nt/luke/4?id=p18-p19#p18">Luke 4</a>.')},
        "1980-04/two": {"note1": note('Anne Doe, “<a class="cross-ref" href="/study/general-conference/1980/04/one?lang=eng">First Things Last</a>,” Ensign, May 1980, 3.')},
        "1990-10/three": {},
    }
    toc = {
        "1980-04": [{"content": {}}, {"section": {"title": "Saturday Morning", "uri": "/s", "entries": [item("/general-conference/1980/04/one", "First Things Last", "Anne Doe"), {}, item("/general-conference/1980/04/two", "Second", "")]}}],
        "1990-10": [{"section": {"title": "Sunday-Session", "entries": [item("/general-conference/1990/10/three", "Third", "Bo Lee"), item("/general-conference/1990/10/audit", "Church Audit Report", "Cy Fry")]}}],
    }
    for c, entries in toc.items():
        (at / c).mkdir()
        (at / c / "toc.json").write_text(json.dumps({"entries": entries}))
    for k, notes in talks.items():
        body = '<p class="author-name">By Elder Bo Lee</p><p data-aid="p1">Words said<a class="note-ref" href="#note1">1</a> here\t(see “A Poem,” Hymns, no. 2).</p>'
        page = {"meta": {"title": k, "structuredData": '{"datePublished": "1980-04-05T00:00:00Z"}'}, "content": {"body": body, "footnotes": notes}}
        (at / f"{k}.json").write_text(json.dumps(page).replace("\\t", "\t"))  # a raw control character
    return str(at)


def test_references(spark, root):
    refs = {r["slug"]: r for r in archive.references(archive.tables_of_contents(spark, root)).collect()}
    assert (refs["one"]["session_ord"], refs["one"]["ord"], refs["two"]["ord"]) == (1, 1, 3)
    assert refs["two"]["uri"] == "/general-conference/1980/04/two"


def test_scope(spark, root):
    refs = archive.references(archive.tables_of_contents(spark, root))
    slugs = lambda *a, **k: sorted(r["slug"] for r in scope.select(refs, *a, **k).collect())
    assert slugs() == ["one", "three"]
    assert slugs(include_non_talks=True) == ["audit", "one", "three", "two"]
    assert slugs("1990", session="sunday-session") == []
    assert slugs("1980..1985", speaker="anne") == ["one"]
    assert slugs("/study/general-conference/1980/04/one?lang=eng") == ["one"]
    with pytest.raises(ValueError, match="unrecognized"):
        scope.parse_selector("nope!")
    with pytest.raises(ValueError, match="not found"):
        scope.select(refs, "1980/4/none")


def test_run(spark, root, tmp_path):
    found = pipeline.run(spark, root, str(tmp_path), include_non_talks=True)
    persons = {r["name"]: r for r in found["persons"].collect()}
    assert persons["C. S. Lewis"]["total"] == 2
    assert persons["C. S. Lewis"]["by_decade"] == {"1980s": 2}
    assert [r["book"] for r in found["scripture"].collect()] == ["Luke"]
    works = {r["title"]: r["work_type"] for r in found["works"].collect()}
    assert works["Mere Christianity"] == "book"
    assert "1980-04/one" not in works  # cited only by an item without a listed speaker, which is no talk
    assert found["totals"].first()["talks"] == 2
    lines = spark.read.text(f"{tmp_path}/site/citations").collect()
    assert all("\"wn\":" in r["value"] for r in lines)  # nulls are written


def test_rerun_keeps_other_conferences(spark, root, tmp_path):
    pipeline.parse(spark, root, str(tmp_path))
    again = pipeline.parse(spark, root, str(tmp_path), "1980")
    assert again.count() == 2


@pytest.mark.parametrize(("selector", "filters"), [("1980/4/one", {}), ("1980", {"speaker": "anne"}), ("all", {"session": "saturday-morning"})])
def test_rerun_over_a_narrow_scope_keeps_the_other_talks(spark, root, tmp_path, selector, filters):
    """A talk, a speaker, a session: the other talks of the conference and their citations stay."""
    out = str(tmp_path)
    before = pipeline.parse(spark, root, out, include_non_talks=True).count()
    key = ["talk_id", "marker", "position"]
    whole = {tuple(r) for r in pipeline.extract(spark, out, include_non_talks=True).select(key).collect()}
    assert {t for t, *_ in whole} >= {"/general-conference/1980/04/one", "/general-conference/1980/04/two"}
    assert {tuple(r) for r in pipeline.extract(spark, out, selector, **filters).select(key).collect()} == whole
    assert pipeline.parse(spark, root, out, selector, **filters).count() == before
    left = {r["talk_id"] for r in spark.read.parquet(f"{out}/citations").select("talk_id").distinct().collect()}
    assert "/general-conference/1980/04/one" not in left  # parsed anew, not extracted yet
    assert "/general-conference/1980/04/two" in left
    assert {r["uri"] for r in pipeline.dated_talks(spark, out).filter("extracted_at is null").collect()} == {"/general-conference/1980/04/one"} | ({"/general-conference/1990/10/three"} if not filters and selector == "all" else set())
    assert {tuple(r) for r in pipeline.extract(spark, out, selector, **filters).select(key).collect()} == whole


def test_talks_that_the_archive_drops_take_their_rows_along(spark, root, tmp_path):
    import shutil

    copy, out = str(tmp_path / "raw"), str(tmp_path / "out")
    shutil.copytree(root, copy)
    pipeline.parse(spark, copy, out, include_non_talks=True)
    pipeline.extract(spark, out, include_non_talks=True)
    toc = json.loads(open(f"{copy}/1980-04/toc.json").read())
    toc["entries"][1]["section"]["entries"] = toc["entries"][1]["section"]["entries"][:1]
    open(f"{copy}/1980-04/toc.json", "w").write(json.dumps(toc))
    assert {r["slug"] for r in pipeline.parse(spark, copy, out, "1980", include_non_talks=True).collect()} == {"one", "three"}
    assert pipeline.extract(spark, out).filter("talk_id like '%/two'").count() == 0
    counted = {(r["year"], r["month"]): (r["talks_total"], r["talks_parsed"], r["talks_extracted"]) for r in pipeline.coverage(spark, copy, out).collect()}
    assert counted == {(1980, 4): (1, 1, 1), (1990, 10): (1, 1, 1)}


def test_a_conference_without_rows_leaves_no_old_ones(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1, 1980, 4), ("b", 2, 1980, 4), ("c", 3, 1981, 4)], "uri string, v int, year int, month int")
    scope_talks = rows.select("uri", "year", "month")
    pipeline.save(rows, table, scope_talks)
    assert {r["uri"] for r in pipeline.save(rows.limit(0), table, scope_talks.filter("year = 1981")).collect()} == {"a", "b"}
    assert {r["uri"] for r in pipeline.save(rows.limit(0), table, scope_talks.filter("uri = 'a'")).collect()} == {"b"}


def test_site_holds_all_fields(spark, root, tmp_path):
    pipeline.run(spark, root, str(tmp_path), include_non_talks=True)
    read = lambda name: [json.loads(r["value"]) for r in spark.read.text(f"{tmp_path}/site/index/{name}").collect()]
    assert set(read("talks")[0]) >= {"uri", "title", "speaker_name", "speaker_id", "speaker_role", "conference", "year", "session", "session_ord", "ord", "counted", "scriptures"}
    assert {r["name"] for r in read("speakers")} == {"Anne Doe", "Bo Lee"}
    (book,) = [w for w in read("works") if w["title"] == "Mere Christianity"]
    assert (book["author"], book["by_decade"], book["work_type"]) == ("C. S. Lewis", {"1980s": 2}, "book")
    assert read("scripture")[0]["by_decade"] == {"1980s": 1}
    (first, _) = sorted(read("conferences"), key=lambda r: r["conference"])
    assert (first["title"], first["talks_parsed"], first["talks_extracted"]) == ("April 1980 general conference", 1, 1)
    assert read("generated")[0]["generated_at"][:2] == "20"


def test_later_curated_entries_win(spark):
    curated = spark.createDataFrame([(0, "Zed Poe", "external", ["Z. Poe"]), (1, "Abe Poe", "church_leader", ["Z. Poe"])], "ord int, canonical string, kind string, aliases array<string>")
    assert {r["key"]: r["canonical"] for r in entities.alias_keys(curated).collect()}["z poe"] == "Abe Poe"
    works = spark.createDataFrame([(0, "Zeal", "A", "book", ["Poems"]), (1, "Ardor", "B", "poem", ["Poems"])], "ord int, canonical string, author string, type string, aliases array<string>")
    assert {r["title_key"]: (r["given"], r["given_type"]) for r in entities.curated_titles(works).collect()}["poems"] == ("Ardor", "poem")


def test_crawl_fills_the_archive(spark, tmp_path):
    """Contents and talks come from a service; what is cached is not fetched again; failures are told."""
    root = str(tmp_path / "raw")

    def service(pages):
        def open_(request, timeout):
            import json as j
            from urllib.error import HTTPError

            class Answer:
                def __enter__(self):
                    return self

                def __exit__(self, *_):
                    return False

                def read(self):
                    return j.dumps(pages[request.full_url]).encode()

            if request.full_url not in pages:
                raise HTTPError(request.full_url, 404, "none", None, None)
            if pages[request.full_url] == "down":
                raise OSError("down")
            return Answer()

        return open_

    item = lambda slug: {"content": {"uri": f"/study/general-conference/1980/04/{slug}", "title": slug, "subtitle": "Anne Doe"}}
    toc = {"entries": [{"section": {"title": "S", "entries": [item("one"), item("two"), item("three")]}}]}
    page = {"meta": {"title": "One"}, "content": {"body": "<p id='p1'>Said.</p>", "footnotes": {}}}
    at = "http://x/"
    pages_ = {f"{at}toc?lang=eng&uri=/general-conference/1980/04": toc, f"{at}content?lang=eng&uri=/general-conference/1980/04/one": page, f"{at}content?lang=eng&uri=/general-conference/1980/04/two": "down"}
    quiet = lambda s: None
    count, failed = crawl.crawl(spark, root, at, "1980", open_=service(pages_), sleep=quiet)
    assert count == 1
    assert sorted(f.split(": ")[0] for f in failed) == ["/general-conference/1980/04/three", "/general-conference/1980/04/two"]
    assert json.loads((tmp_path / "raw/1980-04/one.json").read_text()) == page
    assert not (tmp_path / "raw/1980-10").exists()
    pages_ |= {f"{at}content?lang=eng&uri=/general-conference/1980/04/two": page, f"{at}content?lang=eng&uri=/general-conference/1980/04/one": "down"}
    assert crawl.crawl(spark, root, at, "1980", open_=service(pages_), sleep=quiet, workers=2)[0] == 1  # one is cached
    assert {r["slug"] for r in pipeline.parse(spark, root, str(tmp_path / "out"), "1980").collect()} == {"one", "two"}


def test_registered_functions(spark):
    fold.register(spark)
    note = "<p>C. S. Lewis, <cite>Mere Christianity</cite> (1952), 174; Lewis, 9.</p>"
    rows = spark.createDataFrame([(1, note)], "id int, note string")
    rows.createOrReplaceTempView("notes")
    got = spark.sql("SELECT tokenize(note).text AS t, size(segments(note)) AS n, parse_citation('C. S. Lewis, Mere Christianity, 4', '').author AS a, attribution('Victor Hugo wrote:') AS w FROM notes").first()
    assert (got["t"], got["n"], got["a"], got["w"]) == ("C. S. Lewis, ⟪Mere Christianity⟫ (1952), 174; Lewis, 9. ¶", 2, "C. S. Lewis", "Victor Hugo")
    found = spark.sql("SELECT id, c.position, c.author_name, c.locator FROM notes, LATERAL explode_citations(note, '') c").collect()
    assert [(r["author_name"], r["locator"]) for r in found] == [("C. S. Lewis", "174"), ("C. S. Lewis", "9")]


def test_streaming_ingest(spark, root, tmp_path):
    """A page that changes replaces its citations."""
    import shutil

    raw, out, mark = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ck")
    shutil.copytree(root, raw)
    refs = archive.references(archive.tables_of_contents(spark, raw))
    ingest.extract_stream(spark, raw, refs, out, mark).awaitTermination()
    first = spark.read.parquet(out)
    assert first.filter("tier = 'freetext'").count() >= 2
    page = json.loads(open(f"{raw}/1980-04/one.json").read(), strict=False)
    page["content"]["footnotes"] = {}
    kept = first.filter("talk_id not like '%/one'").count()
    os.makedirs(f"{raw}/again/1980-04")
    open(f"{raw}/again/1980-04/one.json", "w").write(json.dumps(page))
    ingest.extract_stream(spark, raw, refs, out, mark).awaitTermination()
    again = spark.read.parquet(out)
    assert again.filter("talk_id like '%/one' and marker like 'note%'").count() == 0
    assert again.filter("talk_id not like '%/one'").count() == kept


def test_page():
    page = pages.read_page('<p class="title">T</p><ul><li><p id="a">One <i>two</i></p></li></ul><h2 class="kicker title">K</h2><footer class="notes"><p>n</p></footer><p>open<p>(see <cite>X</cite>, 1990)', [("note1", {})])
    assert [p["text"] for p in page["paragraphs"]] == ["One two", "K", "open", "(see X, 1990)"]
    assert [(f["marker"], f["inline"], f["context"]) for f in page["footnotes"]] == [("note1", False, ""), (page["footnotes"][1]["marker"], True, "open")]


def test_names(spark):
    cases = {"President Neal A. Maxwell": "neal a maxwell", "C.S. Lewis": "c s lewis", "Sister Hinckley": "sister hinckley", "Joseph Smith Sr.": "joseph smith", "Anne Lindbergh (1906–2001)": "anne lindbergh 1906–2001", "Pensées": "pensées"}
    df = spark.createDataFrame([(k,) for k in cases], "n string").select("n", text.name_key(F.col("n")).alias("k"))
    assert {r["n"]: r["k"] for r in df.collect()} == cases
    assert all(entities.key_of_name(n) == k for n, k in cases.items() if not n.startswith("Sister"))


def test_authorless_title_joins_its_only_author(spark):
    rows = spark.createDataFrame([("freetext", "Poems", "book", "a", None), ("freetext", "Poems", "book", None, None), ("freetext", "Odes", "book", "a", None), ("freetext", "Odes", "book", "b", None), ("freetext", "Odes", "book", None, None), ("note", "Odes", "book", None, None)], "tier string, work_title string, work_type string, author_id string, person_id string")
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("container_title", "cited_talk_uri", "scripture_book")})
    found = entities.work_keys(rows, spark.createDataFrame([], "canonical string, author string, type string, aliases array<string>"))
    assert sorted(r["work_id"] or "" for r in found.collect()) == ["", "a|odes|", "a|odes|a", "a|odes|b", "a|poems|a", "a|poems|a"]


def test_fetch_retries_and_missing():
    class Answer:
        def __init__(self, body):
            self.body = body

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def read(self):
            return self.body

    answers = [OSError("down"), Answer(b'{"a": "\x01"}')]

    def open_(*_, **__):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    waits = []
    assert http.fetch("http://u", open_, waits.append) == '{"a": "\x01"}'
    assert waits == [1.5]
    answers.append(Answer(b'{"statusCode": 404}'))
    with pytest.raises(http.Missing):
        http.fetch("http://u", open_, waits.append)


def test_commands(spark, root, tmp_path, capsys):
    """run, status, sample and list over a small archive, with a second reading by name."""
    out = str(tmp_path)
    common = ["--root", root, "--out", out]
    cli.main(["run", "all", "--include-non-talks", *common])
    cli.main(["status", *common])
    shown = capsys.readouterr().out
    assert "1980" in shown
    assert "freetext" in shown
    cli.main(["extract", "1980/4/one", *common])
    assert spark.read.parquet(f"{out}/citations").filter("talk_id like '%/two'").count() > 0
    cli.main(["sample", "-n", "2", *common])
    assert "raw_text" in capsys.readouterr().out
    cli.main(["list", "1980", *common])
    assert "First Things Last" in capsys.readouterr().out


def test_site_server(tmp_path):
    import threading
    from urllib.request import urlopen

    (tmp_path / "x.json").write_text("{}")
    with cli.site_server(str(tmp_path), 0) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        assert urlopen(f"http://127.0.0.1:{server.server_port}/x.json", timeout=5).read() == b"{}"
        server.shutdown()
