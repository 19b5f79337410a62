"""Commands: list, crawl, parse, extract, resolve, aggregate, run, status, sample, serve."""

from __future__ import annotations

import argparse
import importlib
from functools import partial
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import SparkSession

from .operators import rollups as R
from .operators import scope
from .plans import export, pipeline
from .sources import archive
from .sources import crawl as crawling


def _refs(spark: SparkSession, a: argparse.Namespace):
    refs = archive.references(archive.tables_of_contents(spark, a.root))
    return scope.select(refs, a.selector, a.session, a.speaker, a.include_non_talks)


def _filters(a: argparse.Namespace) -> dict:
    return {"session": a.session, "speaker": a.speaker, "include_non_talks": a.include_non_talks}


def list_(spark, a):
    _refs(spark, a).orderBy("year", "month", "session_ord", "ord").select("year", "month", "session", "speaker", "title", "uri").show(a.n, truncate=60)


def crawl(spark, a):
    """Fetches tables of contents and talks in scope that are not cached, into the archive."""
    count, failed = crawling.crawl(spark, a.root, a.base, a.selector, a.refresh, a.workers, **_filters(a))
    print(f"fetched {count} talks, {len(failed)} failed", *failed, sep="\n")


def parse(spark, a):
    pipeline.parse(spark, a.root, a.out, a.selector, **_filters(a))


def extract(spark, a):
    pipeline.extract(spark, a.out, a.selector, **_filters(a))


def _reader(a: argparse.Namespace):
    """The second reading that --llm MODULE:FUNCTION names."""
    if not a.llm:
        return None
    module, _, name = a.llm.partition(":")
    return getattr(importlib.import_module(module), name)


def _refined(spark, a):
    reader = _reader(a)
    return pipeline.refined(spark, a.out, reader) if reader else None


def resolve(spark, a):
    pipeline.resolved(spark, a.out, a.overrides, _refined(spark, a))


def aggregate(spark, a):
    found = {n: spark.read.parquet(f"{a.out}/resolved/{n}") for n in ("authors", "aliases", "works", "talks", "citations")}
    export.write_site(pipeline.summaries(found), found["citations"], f"{a.out}/site")


def run(spark, a):
    if a.base:
        crawl(spark, a)
    pipeline.run(spark, a.root, a.out, a.selector, a.overrides, _reader(a), **_filters(a))


def status(spark, a):
    citations = spark.read.parquet(f"{a.out}/citations").drop("year", "month")
    talks = pipeline.dated_talks(spark, a.out)
    R.status(archive.tables_of_contents(spark, a.root).select("year", "month"), talks, citations).show(1000)
    R.tiers(citations, talks).show()


def sample(spark, a):
    R.sample(spark.read.parquet(f"{a.out}/citations"), a.n, a.tier, a.low).show(a.n, truncate=80, vertical=True)


def site_server(folder: str, port: int) -> ThreadingHTTPServer:
    """Serves a local folder on this machine only."""
    return ThreadingHTTPServer(("127.0.0.1", port), partial(SimpleHTTPRequestHandler, directory=folder))


def serve(_, a):
    """Serves the site until interrupted."""
    with site_server(f"{a.out}/site", a.port) as server:
        print(f"serving {a.out}/site at http://127.0.0.1:{server.server_port}/")
        server.serve_forever()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="glossa", description=__doc__)
    sub = ap.add_subparsers(dest="command", required=True)
    for f in (list_, crawl, parse, extract, resolve, aggregate, run, status, sample, serve):
        p = sub.add_parser(f.__name__.rstrip("_"), help=f.__doc__)
        p.set_defaults(f=f)
        p.add_argument("selector", nargs="?", default="all", help="all | 2026 | 2019..2026 | 2026/04 | 2026/04/13kearon")
        p.add_argument("--session")
        p.add_argument("--speaker")
        p.add_argument("--include-non-talks", action="store_true")
        p.add_argument("--root", default="raw", help="the cached archive")
        p.add_argument("--out", default="out", help="stage tables and site")
        p.add_argument("--overrides", help="YAML file of curated names and titles")
        p.add_argument("--base", default="", help="address of the archive's service, up to the kind of page; run crawls only where it is given")
        p.add_argument("--llm", help="MODULE:FUNCTION that reads unsure citations a second time (resolve, run)")
        p.add_argument("--workers", type=int, default=4)
        p.add_argument("--refresh", action="store_true")
        p.add_argument("-n", type=int, default=30)
        p.add_argument("--tier", default="freetext", choices=["freetext", "crossref", "note", "all"])
        p.add_argument("--low", action="store_true")
        p.add_argument("--port", type=int, default=8765)
    a = ap.parse_args(argv)
    a.f(None if a.f is serve else SparkSession.builder.appName("glossa").getOrCreate(), a)
