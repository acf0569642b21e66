"""A batch of videos, one run each, that goes on after one fails."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def run_each(spark: SparkSession, videos: list[str], run: Callable[[str], None], at_once: int = 1) -> DataFrame:
    """(video, error): ``run`` for each video in order, ``at_once`` of them at a time; error is null where it went well.

    Each run is a Spark job over one video; the list is that of the files of a
    batch, which the driver has anyway.
    """

    def one(video: str) -> tuple[str, str | None]:
        try:
            run(video)
        except Exception as e:  # whatever one video does, the others go on
            return video, f"{type(e).__name__}: {e}"[:1000]
        return video, None

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return spark.createDataFrame(list(pool.map(one, videos)), "video string, error string")
