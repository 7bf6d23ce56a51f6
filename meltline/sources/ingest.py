"""Results that lie behind a paged service, brought into a table of landed artifacts."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

LANDED = "run_id long, created_at timestamp, artifact_name string, file_name string, csv_text string"
Page = Callable[..., list[dict]]


def paged(page: Page, *args) -> Iterator[dict]:
    """The items of pages 1, 2, ... up to the first empty one."""
    number = 1
    while items := page(*args, number):
        yield from items
        number += 1


def landed(spark: SparkSession, runs: Page, artifacts: Page, download: Callable[[str], bytes], cutoff: str, name_part: str = "tile-result") -> DataFrame:
    """CSV texts of the archives of recent runs (not older than cutoff), a row each file.

    runs(page) gives {id, created_at}, artifacts(run_id, page) gives {name, archive_download_url}, both empty after the
    last page. Listing runs on the driver, with what it lists in a table of one row an artifact; archives are fetched
    and unpacked by tasks, which a lost executor repeats. The table is lazy: write it before using it more than once.
    """
    oldest = pd.Timestamp(cutoff, tz="UTC")
    found = [
        (int(run["id"]), pd.Timestamp(run["created_at"]).tz_convert("UTC").to_pydatetime(), a["name"], a["archive_download_url"])
        for run in paged(runs)
        if pd.Timestamp(run["created_at"]) >= oldest
        for a in paged(artifacts, run["id"])
        if name_part in a["name"]
    ]
    listed = spark.createDataFrame(found, "run_id long, created_at timestamp, artifact_name string, url string")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                with zipfile.ZipFile(io.BytesIO(download(r.url))) as z:
                    rows = [(r.run_id, r.created_at, r.artifact_name, n, z.read(n).decode()) for n in z.namelist() if n.endswith(".csv")]
                if rows:
                    yield pd.DataFrame(rows, columns=["run_id", "created_at", "artifact_name", "file_name", "csv_text"])

    return listed.repartition(max(1, min(len(found), 1000)), "url").mapInPandas(fetch, LANDED)
