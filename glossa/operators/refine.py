"""A second reading of unsure citations by a pluggable function, cached by input.

``reader`` maps (text, context) to a dict of fields with ``is_citation``. It is off unless given.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("person_quoted", "author", "work_title", "work_type", "container_title", "locator", "relation")
ANSWER = "is_citation boolean, year int, " + ", ".join(f"{f} string" for f in FIELDS)
UNSURE = 0.6
TARGETS = {"person_quoted": "person_quoted", "author_name": "author", "work_title": "work_title", "work_type": "work_type", "container_title": "container_title", "year": "year", "locator": "locator"}


def cache_key(raw_text: Column, context: Column) -> Column:
    return F.sha2(F.concat(raw_text, F.lit("\n"), F.right(F.coalesce(context, F.lit("")), F.lit(500))), 256)


def unsure(citations: DataFrame, threshold: float = UNSURE) -> DataFrame:
    return citations.filter(F.col("tier").isin("freetext", "note") & (F.col("confidence") < threshold))


def answers(citations: DataFrame, reader: Callable[[str, str], dict], cache: DataFrame | None = None, threshold: float = UNSURE) -> DataFrame:
    """(input_hash, answer): for each distinct unsure input, from the cache or the reader. What the reader fails on is left out."""

    @F.pandas_udf(ANSWER)
    def read(text: pd.Series, context: pd.Series) -> pd.DataFrame:
        rows = []
        for t, c in zip(text, context, strict=True):
            try:
                rows.append(reader(t or "", (c or "")[-500:]))
            except Exception:  # one failed reading leaves its citation as it is
                rows.append({})
        return pd.DataFrame(rows, columns=["is_citation", "year", *FIELDS]).astype(object).where(lambda d: d.notna(), None)

    todo = unsure(citations, threshold).select(cache_key(F.col("raw_text"), F.col("context")).alias("input_hash"), "raw_text", "context").dropDuplicates(["input_hash"])
    if cache is not None:
        new = todo.join(cache, "input_hash", "left_anti").select("input_hash", read("raw_text", "context").alias("answer"))
        return cache.select("input_hash", "answer").unionByName(new.filter("answer.is_citation is not null"))
    return todo.select("input_hash", read("raw_text", "context").alias("answer")).filter("answer.is_citation is not null")


def merged(citations: DataFrame, found: DataFrame, threshold: float = UNSURE) -> DataFrame:
    """Unsure citations with an answer take it: no citation -> a note without fields, else its fields over the old ones."""
    weak = F.col("tier").isin("freetext", "note") & (F.col("confidence") < threshold)
    rows = citations.withColumn("input_hash", F.when(weak, cache_key(F.col("raw_text"), F.col("context")))).join(found, "input_hash", "left")
    has, yes = F.col("answer").isNotNull(), F.col("answer.is_citation")
    new = {old: F.when(has & yes, F.coalesce(F.col("answer")[name], F.col(old))).when(has & (F.lit(old) != "year"), F.lit(None)).otherwise(F.col(old)) for old, name in TARGETS.items()}
    new |= {
        "tier": F.when(has & yes, "freetext").when(has, "note").otherwise(F.col("tier")), "parser": F.when(has, "llm").otherwise(F.col("parser")),
        "confidence": F.when(has & yes, 0.85).when(has, 0.9).otherwise(F.col("confidence")), "relation": F.when(has & yes, F.col("answer.relation")).otherwise(F.col("relation")),
    }
    return rows.withColumns(new).select(*citations.columns)
