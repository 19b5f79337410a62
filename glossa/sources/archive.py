"""The cached archive: ``<root>/<year>-<month>/toc.json`` and ``<slug>.json``, read by Spark from any store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema

#: Pages hold raw control characters inside strings.
JSON = {"allowUnquotedControlChars": "true"}


def documents(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(path, value) of whole files."""
    return spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob).select(F.col("_metadata.file_path").alias("path"), "value")


def tables_of_contents(spark: SparkSession, root: str) -> DataFrame:
    """(year, month, entries)."""
    when = lambda i: F.regexp_extract("path", r"/(\d{4})-(\d{2})/[^/]*$", i).try_cast("int")
    rows = documents(spark, root, "toc.json")
    return rows.select(when(1).alias("year"), when(2).alias("month"), F.from_json("value", schema.TOC, JSON)["entries"].alias("entries"))


def references(tocs: DataFrame) -> DataFrame:
    """One row per item: sessions count over entries that are sections, items by their place in the session."""
    sections = tocs.select("year", "month", F.posexplode(F.filter("entries", lambda e: e["section"].isNotNull())).alias("_s", "entry"))
    items = sections.select("year", "month", (F.col("_s") + 1).alias("session_ord"), "entry.section", F.posexplode("entry.section.entries").alias("_i", "item")).filter("item.content is not null")
    uri = F.regexp_replace("item.content.uri", "^(.*?)/study", "$1")
    return items.select(
        "year", "month", uri.alias("uri"), F.substring_index(uri, "/", -1).alias("slug"), F.coalesce("item.content.title", F.lit("")).alias("title"),
        F.coalesce("item.content.subtitle", F.lit("")).alias("speaker"), F.coalesce("section.title", F.lit("")).alias("session"), F.coalesce("section.uri", F.lit("")).alias("session_uri"),
        "session_ord", (F.col("_i") + 1).alias("ord"),
    )


def contents(spark: SparkSession, root: str) -> DataFrame:
    """(uri, meta, content) of the cached talks."""
    rows = documents(spark, root, "*.json").filter(~F.col("path").endswith("/toc.json"))
    at = F.regexp_extract("path", r"/(\d{4}-\d{2})/([^/]*)\.json$", 1)
    uri = F.concat(F.lit("/general-conference/"), F.replace(at, F.lit("-"), F.lit("/")), F.lit("/"), F.regexp_extract("path", r"/([^/]*)\.json$", 1))
    return rows.select(uri.alias("uri"), F.from_json("value", schema.CONTENT, JSON).alias("j")).select("uri", "j.meta", "j.content")


def missing(refs: DataFrame, cached: DataFrame) -> DataFrame:
    """References that are not cached yet."""
    return refs.join(cached.select("uri"), "uri", "left_anti")


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def publish(bodies: DataFrame, root: str) -> int:
    """Files of (conference, name, body) at ``<root>/<conference>/<name>.json``, replacing those that are there.

    Executors write the bodies beside the archive; then each file is renamed to its place, so a reader
    never meets half a file. Returns how many there are.
    """
    spark, aside = bodies.sparkSession, f"{root.rstrip('/')}/.incoming"
    delete(spark, aside)
    bodies.select("conference", "name", F.col("body").alias("value")).write.partitionBy("conference", "name").text(aside)
    system, where = _at(spark, aside)
    unquoted = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    count, Path = 0, spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for part in system.globStatus(Path(f"{aside}/conference=*/name=*/part-*")) or []:
        at = part.getPath()
        name, conference = (unquoted(x.getName().partition("=")[2]) for x in (at.getParent(), at.getParent().getParent()))
        to = Path(f"{root.rstrip('/')}/{conference}/{name}.json")
        system.mkdirs(to.getParent())
        system.delete(to, False)
        system.rename(at, to)
        count += 1
    system.delete(where, True)
    return count


def overrides(spark: SparkSession, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Curated authors and works from a YAML file; none where no path is given."""
    data: dict = {}
    if path:
        import yaml

        text = spark.read.text(path, wholetext=True).first()
        data = (yaml.safe_load(text[0]) if text else None) or {}
    row = lambda x, *names: tuple(x.get(n) for n in names)
    authors = [(i, *row(a, "canonical", "kind"), list(a.get("aliases") or [])) for i, a in enumerate(data.get("authors") or [])]
    works = [(i, *row(w, "canonical", "author", "type"), list(w.get("aliases") or [])) for i, w in enumerate(data.get("works") or [])]
    return spark.createDataFrame(authors, schema.OVERRIDE_AUTHORS), spark.createDataFrame(works, schema.OVERRIDE_WORKS)
