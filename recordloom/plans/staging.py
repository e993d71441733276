"""Written intermediate tables in a folder that all executors share."""

from __future__ import annotations

import uuid

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def stage_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    Where that is unset the folder goes under ``fallback``; a local session may also use its
    warehouse. A cluster without either is refused, as its executors share no other folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir") + "/_stage"
    return f"{base.rstrip('/')}/recordloom-{uuid.uuid4().hex}"


def staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a frame and read it back: readers prune columns, and lineage ends here.

    A table outlives the executors that wrote it, so a lost one costs no recomputation.
    Every call writes a table of its own and never replaces one that is being read.
    """
    path = f"{folder}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Counts:
    """Numbers that fall out of writes which happen anyway; no job is started for them.

    They belong to the last stage of a write, whose tasks count once each, also when an executor
    is lost and a task runs again. ``seen`` has them once the write has ended.
    """

    def __init__(self) -> None:
        self._watched: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, more: Mapping[str, Column] | None = None) -> DataFrame:
        """The frame, to be written by the caller; ``name`` counts its rows."""
        observation = self._watched[name] = Observation()
        extra = [c.alias(n) for n, c in (more or {}).items()]
        return df.observe(observation, F.count(F.lit(1)).alias(name), *extra)

    def __contains__(self, name: str) -> bool:
        return name in self._watched

    @property
    def seen(self) -> dict[str, int]:
        return {k: v for o in self._watched.values() for k, v in o.get.items()}
