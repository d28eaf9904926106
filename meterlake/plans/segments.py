"""Behavioural segments: K-Means over the shape of each meter's average day.

The shapes stay a DataFrame throughout. Only centres, sums of 48 values per cluster and task, and one score per fit reach the driver.

MLlib draws the starting centres of every start. From there all fits go on together: a round is one job, in which each task
holds its block of shapes against the centres of every fit that has not come to rest, so the rounds and not the fits count.
A round moves centres, comes to rest and leaves an empty cluster where it is, as MLlib's does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.concurrency import together
from meterlake.operators.pivot import SLOT_COLUMNS, average_by_slot
from meterlake.sources.scratch import materialize

# Fixed values of the model.
SEGMENTS = 3
STARTS = 10
SEED = 42
MAX_ITERATIONS = 300
TOLERANCE = 1e-4
SWEEP = (2, 3, 4, 5, 6)
#: Shapes that a task compares at a time.
BLOCK_ROWS = 4096


def load_shape(readings: DataFrame) -> DataFrame:
    return average_by_slot(readings)


def share_of_day(shape: DataFrame) -> DataFrame:
    """Each slot as its share of the row's sum; a row that sums to zero stays as it is."""
    total = reduce(add, [F.col(c) for c in SLOT_COLUMNS])
    summed = shape.select("*", F.when(total == 0, 1.0).otherwise(total).alias("total"))
    return summed.select("meter_id", *[(F.col(c) / F.col("total")).alias(c) for c in SLOT_COLUMNS])


def shape_vectors(shares: DataFrame) -> DataFrame:
    """``meter_id, features``, written once: every fit reads the vectors, none repeats the pivot.

    Rows are sorted within their partitions so that a seed draws the same starting points again.
    """
    assembler = VectorAssembler(inputCols=list(SLOT_COLUMNS), outputCol="features")
    vectors = assembler.transform(shares).select("meter_id", "features")
    return materialize(vectors.sortWithinPartitions("meter_id"), "load-shapes")


@contextmanager
def _held(vectors: DataFrame) -> Iterator[DataFrame]:
    """One persisted copy that all fits share; without it each would read its files again."""
    held = vectors.persist()
    try:
        yield held
    finally:
        held.unpersist()


@dataclass(frozen=True)
class FitSummary:
    trainingCost: float
    numIter: int


@dataclass(frozen=True)
class Segmentation:
    """Centres of one fit, read as MLlib's model is."""

    centres: np.ndarray
    summary: FitSummary

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, vectors: DataFrame) -> DataFrame:
        """The rows with ``prediction``, the nearest centre; of equally near ones the first."""
        centres = self.centres

        @F.pandas_udf("int")
        def nearest(shapes: pd.Series) -> pd.Series:
            found = [np.zeros(0, np.int64)]
            for low in range(0, len(shapes), BLOCK_ROWS):
                block = np.stack(shapes.iloc[low : low + BLOCK_ROWS].to_numpy())
                found.append(np.argmin([((block - centre) ** 2).sum(axis=1) for centre in centres], axis=0))
            return pd.Series(np.concatenate(found).astype(np.int32))

        return vectors.withColumn("prediction", nearest(vector_to_array("features")))


def _starting_centres(vectors: DataFrame, k: int, starts: int, seed: int) -> list[Callable[[], np.ndarray]]:
    def draw(start_seed: int) -> Callable[[], np.ndarray]:
        estimator = KMeans(k=k, seed=start_seed, maxIter=0)
        return lambda: np.array(estimator.fit(vectors).clusterCenters())

    return [draw(seed + start) for start in range(starts)]


def _blocks(vectors: DataFrame) -> DataFrame:
    """The vectors as matrices of up to ``BLOCK_ROWS`` rows, in bytes."""

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                values = batch.column("shape").slice(low, BLOCK_ROWS).flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array([values.astype(np.float64).tobytes()], pa.binary())], names=["block"])

    return vectors.select(vector_to_array("features").alias("shape")).mapInArrow(packed, "block binary")


def _round(blocks: DataFrame, fits: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all clusters, fit after fit, the sum and number of their vectors; and for each fit its cost. One job."""
    centres, sizes = np.concatenate(fits), [len(fit) for fit in fits]
    cuts, width = np.concatenate([[0], np.cumsum(sizes)]), len(fits[0][0])
    norms = (centres * centres).sum(axis=1)

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, costs = np.zeros(centres.shape), np.zeros(len(centres)), np.zeros(len(sizes))
        for batch in batches:
            for cell in batch.column("block"):
                block = np.frombuffer(cell.as_buffer(), np.float64).reshape(-1, width)
                # a row for each centre; the vector's own norm is left out, as it is the same for all
                apart, own = norms[:, None] - 2.0 * (centres @ block.T), (block * block).sum()
                member = np.empty(apart.shape)
                for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
                    member[low:high] = np.argmin(apart[low:high], axis=0) == np.arange(high - low)[:, None]
                    costs[i] += apart[low:high].min(axis=0).sum() + own
                sums += member @ block
                counts += member.sum(axis=1)
        cell = np.concatenate([sums.ravel(), counts, costs]).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([cell], pa.binary())], names=["part"])

    parts = [np.frombuffer(row.part) for row in blocks.mapInArrow(summed, "part binary").collect()]
    sums, counts, costs = np.split(reduce(add, parts), [centres.size, centres.size + len(centres)])
    return sums.reshape(centres.shape), counts, costs


def _fits(vectors: DataFrame, ks: Sequence[int], starts: int, seed: int) -> list[list[Segmentation]]:
    """All starts for each k, fitted together."""
    spark = vectors.sparkSession
    drawn = together(spark, [job for k in ks for job in _starting_centres(vectors, k, starts, seed)])
    centres, costs, rounds = list(drawn), [0.0] * len(drawn), [0] * len(drawn)
    moving = list(range(len(drawn)))
    with _held(_blocks(vectors)) as blocks:
        while moving:
            sums, counts, cost = _round(blocks, [centres[i] for i in moving])
            still, low = [], 0
            for n, i in enumerate(moving):
                own = slice(low, low := low + len(centres[i]))
                filled = counts[own, None] > 0
                moved = np.where(filled, sums[own] / np.maximum(counts[own, None], 1.0), centres[i])
                far = ((moved - centres[i]) ** 2).sum(axis=1).max() > TOLERANCE**2
                centres[i], costs[i], rounds[i] = moved, float(cost[n]), rounds[i] + 1
                if far and rounds[i] < MAX_ITERATIONS:
                    still.append(i)
            moving = still
    found = [Segmentation(c, FitSummary(cost, n)) for c, cost, n in zip(centres, costs, rounds)]
    return [found[i * starts : (i + 1) * starts] for i in range(len(ks))]


def _cheapest(models: Sequence[Segmentation]) -> Segmentation:
    return min(models, key=lambda model: model.summary.trainingCost)


def fit_segments(
    vectors: DataFrame, k: int = SEGMENTS, starts: int = STARTS, seed: int = SEED
) -> Segmentation:
    """The fit with the lowest cost among several starts."""
    with _held(vectors) as held:
        return _cheapest(_fits(held, [k], starts, seed)[0])


def silhouettes(
    vectors: DataFrame, ks: Sequence[int] = SWEEP, starts: int = STARTS, seed: int = SEED
) -> DataFrame:
    """``k, silhouette`` (squared Euclidean) of the best fit for each k."""
    spark = vectors.sparkSession
    evaluator = ClusteringEvaluator()
    with _held(vectors) as held:
        best = [_cheapest(models) for models in _fits(held, ks, starts, seed)]
        scores = together(spark, [lambda m=m: evaluator.evaluate(m.transform(held)) for m in best])
    return spark.createDataFrame(list(zip(ks, scores)), "k int, silhouette double")


def _by_peak(model: Segmentation) -> list[tuple[int, list[float]]]:
    """(cluster, centre) in the order of the segments: by the slot of the peak, then by the curve.

    K-Means numbers its clusters arbitrarily; this order is a property of the clusters themselves.
    """
    centres = [(i, [float(x) for x in centre]) for i, centre in enumerate(model.clusterCenters())]
    return sorted(centres, key=lambda c: (c[1].index(max(c[1])), c[1]))


def assign(model: Segmentation, vectors: DataFrame) -> DataFrame:
    """``meter_id, segment``; segments are numbered by the slot of their peak."""
    segment_of = {cluster: segment for segment, (cluster, _) in enumerate(_by_peak(model))}
    number = F.array(*[F.lit(segment_of[i]) for i in range(len(segment_of))])
    assigned = model.transform(vectors)
    return assigned.select("meter_id", F.element_at(number, F.col("prediction") + 1).alias("segment"))


def centres(model: Segmentation, vectors: DataFrame) -> DataFrame:
    """``segment, half_hour, share``: the centres as fitted, numbered like the segments."""
    rows = [(segment, slot, share) for segment, (_, centre) in enumerate(_by_peak(model)) for slot, share in enumerate(centre)]
    return vectors.sparkSession.createDataFrame(rows, "segment int, half_hour int, share double")


def distances(shares: DataFrame, centre_rows: DataFrame) -> DataFrame:
    """``meter_id, segment, distance``: squared, of every meter to every centre.

    Shares turned long meet the k x 48 rows of the centres by their slot; a meter costs k rows after the sum in its task.
    """
    slots = [(str(slot), column) for slot, column in enumerate(SLOT_COLUMNS)]
    wide = shares.select("meter_id", *[F.col(column).alias(slot) for slot, column in slots])
    long = wide.unpivot(["meter_id"], [slot for slot, _ in slots], "slot", "own")
    met = long.join(centre_rows, long.slot.cast("int") == centre_rows.half_hour)
    apart = F.col("own") - F.col("share")
    return met.groupBy("meter_id", "segment").agg(F.sum(apart * apart).alias("distance"))


def nearness(shares: DataFrame, labels: DataFrame, centre_rows: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """``meters, not_nearest``: meters, and those with a centre that is nearer than that of their segment or without a segment."""
    nearest = distances(shares, centre_rows).groupBy("meter_id").agg(
        F.min("distance").alias("least"), F.collect_list(F.struct("segment", "distance")).alias("all")
    )
    own = F.element_at(F.filter("all", lambda d: d.segment == F.col("label")), 1).distance
    judged = nearest.join(labels.select("meter_id", F.col("segment").alias("label")), "meter_id", "left")
    far = F.coalesce(F.when(F.size(F.filter("all", lambda d: d.segment == F.col("label"))) > 0, own > F.col("least") + tolerance), F.lit(True))
    return judged.agg(F.count(F.lit(1)).alias("meters"), F.count_if(far).alias("not_nearest"))


def segment_curves(shares: DataFrame, segments: DataFrame) -> DataFrame:
    """``segment, half_hour, share``: the mean shape of each segment.

    Averaged wide, one row per segment, and turned long afterwards.
    """
    wide = shares.join(segments, "meter_id").groupBy("segment").agg(
        *[F.avg(column).alias(str(slot)) for slot, column in enumerate(SLOT_COLUMNS)]
    )
    long = wide.unpivot(["segment"], [str(slot) for slot in range(len(SLOT_COLUMNS))], "half_hour", "share")
    return long.select("segment", F.col("half_hour").cast("int"), "share")


def fitted_segments(readings: DataFrame, k: int = SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """Readings to ``meter_id, segment`` and the centres, both of one fit."""
    return fitted_shares(share_of_day(load_shape(readings)), k)


def fitted_shares(shares: DataFrame, k: int = SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """Shares of the day to ``meter_id, segment`` and the centres, both of one fit."""
    vectors = shape_vectors(shares)
    model = fit_segments(vectors, k)
    return assign(model, vectors), centres(model, vectors)


def segment_meters(readings: DataFrame, k: int = SEGMENTS) -> DataFrame:
    """Readings to ``meter_id, segment``."""
    return fitted_segments(readings, k)[0]
