"""Streaming ingest: pages that arrive in the archive are parsed and extracted as they come.

Each micro-batch is saved as a rerun over its talks would be: their citations are replaced, those of other
talks stay. So a page that arrives again, as a new file, replaces itself, and so does a batch that is
repeated. A file that is rewritten in place is not read again: that is how file streams tell files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema
from ..operators import fold, pages
from ..plans import pipeline
from ..sources.archive import JSON


def pages_stream(spark: SparkSession, root: str) -> DataFrame:
    """(uri, meta, content) of talk files as they appear."""
    files = spark.readStream.schema("value string").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").format("text").load(root)
    path = F.col("_metadata.file_path")
    uri = F.concat(F.lit("/general-conference/"), F.replace(F.regexp_extract(path, r"/(\d{4}-\d{2})/[^/]*$", 1), F.lit("-"), F.lit("/")), F.lit("/"), F.regexp_extract(path, r"/([^/]*)\.json$", 1))
    rows = files.select(uri.alias("uri"), path.alias("path"), F.from_json("value", schema.CONTENT, JSON).alias("j")).filter(~F.col("path").endswith("/toc.json"))
    return rows.select("uri", "j.meta", "j.content")


def extract_stream(spark: SparkSession, root: str, refs: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Keeps ``out`` (a stage table of citations) in step with arriving pages. A talk is one file, so its fold sees all its footnotes."""

    def write(batch: DataFrame, number: int) -> None:
        parsed = pages.parse_pages(refs, batch)
        at = parsed.select(F.col("uri").alias("talk_id"), *pipeline.PARTS)
        found = fold.extract(pages.footnotes(parsed)).withColumnRenamed("year", "cited_year").join(at, "talk_id")
        pipeline.save(found, out, at, "talk_id")

    writer = pages_stream(spark, root).writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()
