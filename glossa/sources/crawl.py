"""The crawl: tables of contents and talks that the archive lacks, fetched and put into it."""

from __future__ import annotations

import time
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scope
from . import archive, http


def months(spark: SparkSession, selector: str) -> DataFrame:
    """(year, month) of the conferences in scope, whether they exist or not."""
    years = spark.range(1).select(F.explode(F.sequence(F.lit(scope.FIRST_YEAR), F.greatest(F.year(F.current_date()), F.lit(scope.parse_selector(selector).last or 0)))).alias("year"))
    every = years.select("year", F.explode(F.array(F.lit(4), F.lit(10))).alias("month"), F.lit(None).cast("string").alias("slug"))
    where = scope.parse_selector(selector)
    return every.filter(scope.Scope(where.first, where.last, where.month).condition()).select("year", "month")


def conference() -> F.Column:
    return F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0"))


def address(base: str, kind: str, uri: F.Column) -> F.Column:
    return F.concat(F.lit(f"{base}{kind}?lang=eng&uri="), uri)


def crawl_contents(spark: SparkSession, root: str, base: str, selector: str = "all", refresh: bool = False, workers: int = 4, open_=urlopen, sleep=time.sleep) -> int:
    """Fetches the tables of contents in scope that are not cached; conferences that do not exist (yet) are passed over."""
    todo = months(spark, selector)
    if archive.exists(spark, root) and not refresh:
        todo = todo.join(archive.tables_of_contents(spark, root).select("year", "month"), ["year", "month"], "left_anti")
    uri = F.concat(F.lit("/general-conference/"), F.replace(conference(), F.lit("-"), F.lit("/")))
    found = http.fetched(todo, address(base, "toc", uri), workers, open_, sleep).filter("status = 200")
    return archive.publish(found.select(conference().alias("conference"), F.lit("toc").alias("name"), "body"), root)


def crawl(spark: SparkSession, root: str, base: str, selector: str = "all", refresh: bool = False, workers: int = 4, open_=urlopen, sleep=time.sleep, **filters) -> tuple[int, list[str]]:
    """Fetches what is in scope and not cached. Gives how many talks there are new, and the errors of the others."""
    crawl_contents(spark, root, base, selector, refresh, workers, open_, sleep)
    refs = scope.select(archive.references(archive.tables_of_contents(spark, root)), selector, **filters)
    todo = refs if refresh else archive.missing(refs, archive.contents(spark, root))
    rows = todo.select("uri", conference().alias("conference"), F.col("slug").alias("name"))
    found = http.fetched(rows, address(base, "content", F.col("uri")), workers, open_, sleep).persist()
    try:
        count = archive.publish(found.filter("status = 200"), root)
        failed = [f"{r['uri']}: {r['body'] or r['status']}" for r in found.filter("status <> 200").select("uri", "status", "body").toLocalIterator()]
    finally:
        found.unpersist()
    return count, failed
