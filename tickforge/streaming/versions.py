"""Scoring a stream with the model version that holds at each tick's time.

A registry is a folder with one folder per published version: its number, the
time from which it holds and the model.  Only versions whose write has ended
count.  Every micro-batch reads the registry anew (a model can be replaced while
the stream runs), takes the versions that hold somewhere in its own time span,
and labels each tick by the newest version at or before it; ticks before the
first version are TRAINING.  A replayed batch sees the versions of that moment:
publish versions from times that the stream has not reached yet, and replays
give the same labels.

At most ``LIVE`` versions travel to the tasks at once; a span with more of them is
scored in as many time ranges.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.signals import TRAINING
from ..operators import trees
from ..plans.sequence import order_number
from ..session import list_folder, scratch_path
from .streams import _trigger, committed_write

LIVE = 64
VERSION = "version long, valid_from double, model string"
SCORE = "version long, margin double"


class ModelVersions:
    """The registry in ``folder``; times are ``order_number`` values of the tick's time column."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or scratch_path(spark, f"versions-{uuid.uuid4().hex}")

    def publish(self, version: int, valid_from: float, model: trees.BoostedModel) -> None:
        told = json.dumps({"features": model.features, "cuts": model.cuts, "fill": model.fill, "start": model.start,
                           "trees": [[np.asarray(x).tolist() for x in t] for t in model.trees]})
        self.spark.createDataFrame([(version, float(valid_from), told)], VERSION).coalesce(1).write.parquet(f"{self.folder}/v{version}")

    def known(self) -> list[tuple[float, int]]:
        """(valid from, version) of all whole versions, in order; of one time the last version holds."""
        s = self.spark
        done = [f"{self.folder}/{v}" for v in list_folder(s, self.folder) if "_SUCCESS" in list_folder(s, f"{self.folder}/{v}")]
        if not done:
            return []
        rows = s.read.schema(VERSION).parquet(*done).select("valid_from", "version").collect()  # one row per version
        return sorted({r.valid_from: r.version for r in sorted(rows, key=lambda r: r.version)}.items())

    def load(self, versions: list[int]) -> list[trees.BoostedModel]:
        rows = {r.version: json.loads(r.model) for r in self.spark.read.schema(VERSION).parquet(*[f"{self.folder}/v{v}" for v in versions]).collect()}
        return [trees.BoostedModel(**rows[v]) for v in versions]


def _scorer(starts: list[float], numbers: list[int], models: list[trees.BoostedModel], features: list):
    """A column function (time, features..) -> (version, margin); null before the first start."""
    at = np.array(starts)
    told = [(m, [np.array(e) for e in m.cuts], [tuple(np.array(x) for x in t) for t in m.trees], [features.index(f) for f in m.features]) for m in models]

    @F.pandas_udf(SCORE)
    def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for time, *columns in parts:
            values = np.stack([c.to_numpy(dtype=float) for c in columns], axis=1)
            which = np.searchsorted(at, time.to_numpy(dtype=float), side="right") - 1
            margin = np.full(len(which), np.nan)
            for k in np.unique(which[which >= 0]):
                model, cuts, grown, own = told[k]
                rows = np.flatnonzero(which == k)
                x = values[rows][:, own]
                bins = trees.cut_bins(np.where(np.isnan(x), model.fill, x), cuts)
                margin[rows] = model.start + sum(trees.leaf_values(t, bins) for t in grown)
            yield pd.DataFrame({"version": pd.array([numbers[k] if k >= 0 else None for k in which], dtype="Int64"), "margin": margin})

    return score


def score_as_of(ticks: DataFrame, registry: ModelVersions, features: list, time: str = "ts", name: str = "predicted", live: int = LIVE) -> DataFrame:
    """``ticks`` with ``version`` and ``name`` (UP, DOWN or TRAINING) by the newest version at or before each."""
    when = order_number(ticks, time)
    span = ticks.agg(F.min(when).alias("lo"), F.max(when).alias("hi")).first()
    known = registry.known()
    if span.lo is None or not known or known[0][0] > span.hi:
        return ticks.withColumn("version", F.lit(None).cast("long")).withColumn(name, F.lit(TRAINING))
    held = [(a, v) for k, (a, v) in enumerate(known) if a <= span.hi and (k + 1 == len(known) or known[k + 1][0] > span.lo)]
    out = None
    for lo in range(0, len(held), live):
        part = held[lo:lo + live]
        rows = ticks
        if lo:
            rows = rows.filter(when >= F.lit(part[0][0]))
        if lo + live < len(held):
            rows = rows.filter((when < F.lit(held[lo + live][0])) | (when.isNull() if not lo else F.lit(False)))
        score = _scorer([a for a, _ in part], [v for _, v in part], registry.load([v for _, v in part]), features)
        said = rows.withColumn("_score", score(F.coalesce(when, F.lit(float("-inf"))), *[F.col(f).cast("double") for f in features]))
        label = F.when(F.col("_score.version").isNull(), TRAINING).when(F.col("_score.margin") > 0, "UP").otherwise("DOWN")
        said = said.withColumn("version", F.col("_score.version")).withColumn(name, label).drop("_score")
        out = said if out is None else out.unionByName(said)
    return out


def score_stream(stream: DataFrame, registry: ModelVersions, features: list, name: str, checkpoint: str | None = None, table: str | None = None,
                 processing_time: str | None = None, time: str = "ts"):
    """Start scoring a stream into a table of batch folders; returns (query, table path)."""
    spark, run = stream.sparkSession, uuid.uuid4().hex[:12]
    table = table or scratch_path(spark, f"tables/{name}-{run}")

    def write(batch: DataFrame, batch_id: int) -> None:
        here = ModelVersions(batch.sparkSession, registry.folder)
        committed_write(score_as_of(batch, here, features, time), table, batch_id)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint or scratch_path(spark, f"streams/{name}-{run}"))
    return _trigger(w, processing_time).start(), table
