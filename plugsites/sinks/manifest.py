"""Marks of finished stages, so that a run that failed goes on where it stopped.

A stage's key tells what it was made from: the inputs' files with their sizes and times,
the parameters, the keys of the stages before it. Its mark is written after its data and
removed before it is written anew; it holds the key, the stage's metrics, and the number
and size of the files that were committed. A stage is used again only if all of it fits.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plugsites.sinks.stage import remove_folder, write_stage

#: Raise it whenever stages of an earlier release must not be used again.
RELEASE = 1


def stage_key(*parts: object) -> str:
    """Digest of what a stage depends on; parts are told apart by their ``repr``."""
    return hashlib.sha256(json.dumps([RELEASE, *map(repr, parts)]).encode()).hexdigest()


def input_files(spark: SparkSession, paths: str | list[str]) -> list[tuple]:
    """(path, size, time) of the files, which are not read; fails for a missing path.

    As many rows as a scan of the same paths lists on the driver.
    """
    files = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    return sorted((row.path, row.length, str(row.modificationTime)) for row in files.collect())


@dataclass(frozen=True)
class Manifest:
    spark: SparkSession
    folder: str
    """Where the marks lie, one folder for each stage."""

    def _mark(self, name: str) -> str:
        return f"{self.folder}/{name.replace('/', '.')}"

    def _committed(self, path: str) -> dict:
        files = self.spark.read.format("binaryFile").load(path).select("length")
        return files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes")).first().asDict()

    def finished(self, name: str, path: str, key: str) -> dict | None:
        """The metrics of the stage, if it was finished from the same inputs."""
        try:
            lines = self.spark.read.text(self._mark(name)).collect()
            mark = json.loads(lines[0].value) if lines else {}
            if mark.get("key") == key and mark["committed"] == self._committed(path):
                return mark["metrics"]
        except AnalysisException:  # no mark, or no data
            pass
        return None

    def step(self, name: str, path: str, key: str, work: Callable[[], dict | None]) -> dict:
        """The stage's metrics, found or made by ``work``, which writes ``path``."""
        metrics = self.finished(name, path, key)
        if metrics is None:
            remove_folder(self.spark, self._mark(name))
            metrics = work() or {}
            mark = {"key": key, "committed": self._committed(path), "metrics": metrics}
            line = self.spark.createDataFrame([(json.dumps(mark),)], "value string").coalesce(1)
            line.write.mode("overwrite").text(self._mark(name))
        return metrics

    def stage(
        self,
        name: str,
        path: str,
        key: str,
        rows: Callable[[], DataFrame],
        metrics: dict[str, Column] | None = None,
    ) -> dict:
        """As ``step``, for a Parquet stage; ``rows`` is called only if it has to be made."""
        return self.step(name, path, key, lambda: write_stage(rows(), path, metrics))
