"""Fetching into the archive: addresses are rows, dealt to workers.

Missing items are not retried; other failures back off.
"""

from __future__ import annotations

import json
import time
from urllib.error import HTTPError
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import Column, DataFrame

ATTEMPTS, TIMEOUT, PAUSE = 3, 30, 1.5


class Missing(Exception):
    """The item does not exist."""


def fetch(url: str, open_=urlopen, sleep=time.sleep) -> str:
    """The body; a 404, as status or as statusCode in the body, is Missing."""
    last: Exception | None = None
    for attempt in range(ATTEMPTS):
        try:
            with open_(Request(url, headers={"User-Agent": "glossa/1.0"}), timeout=TIMEOUT) as r:
                body = r.read().decode("utf-8")
            found = json.loads(body, strict=False)
            if isinstance(found, dict) and found.get("statusCode") == 404:
                raise Missing(url)
            return body
        except HTTPError as e:
            if e.code == 404:
                raise Missing(url) from e
            last = e
        except (OSError, ValueError) as e:
            last = e
        sleep(PAUSE * (attempt + 1))
    raise RuntimeError(f"failed to fetch {url}: {last}")


def fetched(addresses: DataFrame, url: Column, workers: int = 4, open_=urlopen, sleep=time.sleep) -> DataFrame:
    """The rows with status and body: 200 with the body, 404, or 0 with the last error; one partition a worker."""

    def run(batches):
        for batch in batches:
            for i, address in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                try:
                    status, body = 200, fetch(address, open_, sleep)
                except Missing:
                    status, body = 404, None
                except RuntimeError as e:  # one item's failure is reported, not fatal
                    status, body = 0, str(e)
                own = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*own.columns[:-1], pa.array([status], pa.int32()), pa.array([body], pa.string())], names=names)

    names = [*addresses.columns, "status", "body"]
    schema = ", ".join([*(f"`{n}` {t}" for n, t in addresses.dtypes), "status int, body string"])
    return addresses.withColumn("_url", url).repartition(workers).mapInArrow(run, schema)
