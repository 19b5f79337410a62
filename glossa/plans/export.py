"""The two JSON files of a site, and the status and sample reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import non_blank
from ..operators.rollups import counted
from ..sources import archive

NULLS = {"ignoreNullFields": "false"}


def compact(citations: DataFrame) -> DataFrame:
    """Counted citations under short keys: texts cut to 600 and contexts to their last 240 characters."""
    c = F.col
    work = F.coalesce(F.nullif("work_title", F.lit("")), "container_title")
    keys: dict[str, Column] = {
        "t": c("talk_id"), "p": c("person_id"), "a": c("author_id"), "w": c("work_id"), "c": c("container_id"), "r": c("relation"), "k": c("tier"), "y": c("year"), "l": c("locator"),
        "wt": c("work_type"), "x": F.left(F.coalesce("raw_text", F.lit("")), F.lit(600)), "cx": F.right(F.coalesce("context", F.lit("")), F.lit(240)),
        "cf": F.bround(F.coalesce("confidence", F.lit(0.0)), 2), "u": c("cited_talk_uri"), "pn": F.when(c("person_id").isNull(), c("person_quoted")), "wn": F.when(c("work_id").isNull(), work),
    }
    return citations.filter(counted()).select(*[v.alias(k) for k, v in keys.items()])


def json_lines(rows: DataFrame) -> DataFrame:
    """One JSON text per row; nulls are written."""
    return rows.select(F.to_json(F.struct(*rows.columns), NULLS).alias("value"))


def write_json(rows: DataFrame, path: str) -> None:
    """JSON lines, replacing what is there; as many files as partitions, none of them gathered in one task."""
    json_lines(rows).write.mode("overwrite").text(path)


def write_site(summaries: dict[str, DataFrame], citations: DataFrame, path: str) -> None:
    """``citations``, one folder per summary, and ``generated``; what a site held before goes."""
    spark = citations.sparkSession
    archive.delete(spark, path)
    write_json(compact(citations), f"{path}/citations")
    for name, rows in summaries.items():
        write_json(rows, f"{path}/index/{name}")
    write_json(spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at")), f"{path}/index/generated")


def labelled(rows: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """Rows with the name of their key; those without one keep the key."""
    return rows.join(names.select(key, name), key, "left").withColumn(name, non_blank(F.col(name), F.col(key)))
