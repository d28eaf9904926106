"""Models have no SQL twin: their invariants are checked instead."""

from __future__ import annotations

import datetime
import math

import pytest
from frames import rows
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from meterlake.harness import inputs, queries
from meterlake.operators.pivot import SLOT_COLUMNS
from meterlake.operators.split import last_training_day
from meterlake.plans import forecast, segments

D = datetime.date


@pytest.fixture(scope="module")
def shares(spark, sf_dir):
    return segments.share_of_day(segments.load_shape(inputs.readings(spark, sf_dir)))


@pytest.fixture(scope="module")
def two_habits(spark):
    """Twelve morning meters and twenty evening meters, of very different size."""
    data = []
    for i in range(32):
        peak = 16 if i < 12 else 38
        for slot in range(48):
            kwh = (1.0 + i) * (5.0 if abs(slot - peak) <= 1 else 1.0 + ((i * 7 + slot) % 5) / 50)
            data.append((f"M{i:02d}", slot, kwh))
    return spark.createDataFrame(data, "meter_id string, half_hour int, kwh double")


def test_load_shape_against_python(spark):
    readings = spark.createDataFrame(
        [("A", 0, 1.0), ("A", 0, 3.0), ("A", 47, 4.0), ("B", 5, 0.0)], "meter_id string, half_hour int, kwh double"
    )
    shape = {r.meter_id: r for r in segments.load_shape(readings).collect()}
    assert (shape["A"].hh_0, shape["A"].hh_47, shape["A"].hh_1) == (2.0, 4.0, 0.0)
    share = {r.meter_id: r for r in segments.share_of_day(segments.load_shape(readings)).collect()}
    assert share["A"].hh_47 == pytest.approx(2 / 3)
    assert [share["B"][c] for c in SLOT_COLUMNS] == [0.0] * 48


def test_shares_sum_to_one(shares):
    worst = shares.select(F.abs(sum(F.col(c) for c in SLOT_COLUMNS) - 1).alias("off")).agg(F.max("off")).first()[0]
    assert worst < 1e-9


def test_segments_find_the_habits_and_number_them_by_peak(two_habits):
    found = {r.meter_id: r.segment for r in segments.segment_meters(two_habits, k=2).collect()}
    assert found == {f"M{i:02d}": 0 if i < 12 else 1 for i in range(32)}


def test_segments_are_the_same_again_and_cover_every_meter(spark, sf_dir, shares):
    first = rows(queries.ml_segments(spark, sf_dir))
    assert first == rows(queries.ml_segments(spark, sf_dir))
    assert len(first) == shares.count()
    assert {s for _, s in first} == {0, 1, 2}


def test_every_meter_is_in_the_nearest_segment(shares):
    vectors = segments.shape_vectors(shares)
    model = segments.fit_segments(vectors, starts=2)
    centres = [list(c) for c in model.clusterCenters()]
    for row in model.transform(vectors).collect():
        distances = [math.dist(c, row.features) for c in centres]
        assert distances[row.prediction] == pytest.approx(min(distances))


def test_more_starts_never_cost_more(shares):
    vectors = segments.shape_vectors(shares)
    one, many = (segments.fit_segments(vectors, starts=n).summary.trainingCost for n in (1, 4))
    assert many <= one


def test_silhouette_prefers_the_true_number(two_habits):
    vectors = segments.shape_vectors(segments.share_of_day(segments.load_shape(two_habits)))
    scores = {r.k: r.silhouette for r in segments.silhouettes(vectors, ks=(2, 3), starts=3).collect()}
    assert scores[2] > 0.9 and scores[2] > scores[3]


def test_curves_are_the_mean_shapes(two_habits):
    shares = segments.share_of_day(segments.load_shape(two_habits))
    labels = segments.segment_meters(two_habits, k=2)
    curves = segments.segment_curves(shares, labels).collect()
    assert len(curves) == 96
    for segment, peak in ((0, 16), (1, 38)):
        curve = {r.half_hour: r.share for r in curves if r.segment == segment}
        assert sum(curve.values()) == pytest.approx(1)
        assert abs(max(curve, key=curve.get) - peak) <= 1


def days(spark, n):
    """A demand that falls with the temperature, lower on weekends."""
    start = D(2013, 1, 1)
    data = []
    for i in range(n):
        day = start + datetime.timedelta(days=i)
        temperature = 10 - 9 * math.cos(2 * math.pi * i / 365)
        data.append((day, 20 - 0.6 * temperature - (1 if day.weekday() >= 5 else 0), temperature))
    frame = spark.createDataFrame(data, "day date, avg_kwh_per_home double, temp_avg double")
    frame = frame.withColumn("holiday_name", F.lit(None).cast("string"))
    from meterlake.plans.gold import with_day_attributes

    return forecast.features(with_day_attributes(frame).drop("month"))


@pytest.mark.parametrize("n, share, kept", [(8, 0.75, 6), (9, 0.75, 6), (10, 0.75, 7), (1, 0.75, 0), (4, 1.0, 4)])
def test_time_split_takes_the_earliest_days(spark, n, share, kept):
    split = forecast.time_split(days(spark, n), share)
    train = [r.day for r in split.filter("is_train").collect()]
    test = [r.day for r in split.filter("NOT is_train").collect()]
    assert len(train) == kept and len(test) == n - kept
    assert not train or not test or max(train) < min(test)
    assert (last_training_day(days(spark, n), share) is None) == (kept == 0)


def test_features_drop_incomplete_days(spark):
    totals = spark.createDataFrame(
        [(D(2013, 1, 5), 1.0, 2.0, "Winter", 1, 0), (D(2013, 1, 6), None, 2.0, "Winter", 1, 0),
         (D(2013, 1, 7), 1.0, None, "Winter", 0, 0)],
        "day date, avg_kwh_per_home double, temp_avg double, season string, is_weekend int, is_holiday int",
    )
    assert rows(forecast.features(totals)) == [(D(2013, 1, 5), 1.0, 2.0, 1, 5, 1, 0, 3.0)]


def test_forecast_learns_and_its_metrics_are_right(spark):
    fitted = forecast.fit_forecast(days(spark, 730), trees=15)
    assert fitted.predictions.count() == 730 - 547
    assert fitted.model.getNumTrees == 15
    ours = forecast.metrics(fitted.predictions).first()
    for name, value in ours.asDict().items():
        theirs = RegressionEvaluator(labelCol="actual", predictionCol="prediction", metricName=name)
        assert value == pytest.approx(theirs.evaluate(fitted.predictions))
    assert ours.r2 > 0.5
    ranked = forecast.importances(fitted).collect()
    assert ranked[0].feature == "temp_avg"
    assert {r.feature for r in ranked} == set(forecast.FEATURES)
    assert sum(r.importance for r in ranked) == pytest.approx(1)


def test_model_parameters_are_the_published_ones():
    assert (segments.SEGMENTS, segments.STARTS, segments.SEED, segments.SWEEP) == (3, 10, 42, (2, 3, 4, 5, 6))
    assert (forecast.TREES, forecast.DEPTH, forecast.LEARNING_RATE, forecast.TRAINING_SHARE) == (200, 3, 0.05, 0.75)


def test_fits_share_one_copy_and_leave_none(spark, sf_dir):
    vectors = segments.shape_vectors(segments.share_of_day(segments.load_shape(inputs.readings(spark, sf_dir))))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with segments._held(vectors) as held:
        assert held.storageLevel.useMemory  # a fit persists its input only if nothing else has
    segments.fit_segments(vectors, starts=2)
    assert not vectors.storageLevel.useMemory and spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_fits_go_on_together_and_end_where_each_alone_ends(spark, shares):
    from pyspark.ml.clustering import KMeans

    vectors = segments.shape_vectors(shares)
    fitted = segments._fits(vectors, (2, 3), 2, segments.SEED)
    for k, models in zip((2, 3), fitted):
        for start, model in enumerate(models):
            alone = KMeans(k=k, seed=segments.SEED + start, maxIter=segments.MAX_ITERATIONS, tol=segments.TOLERANCE).fit(vectors)
            assert model.summary.numIter == alone.summary.numIter
            assert model.summary.trainingCost == pytest.approx(alone.summary.trainingCost)
            for ours, theirs in zip(model.clusterCenters(), alone.clusterCenters()):
                assert list(ours) == pytest.approx(list(theirs))


def test_rounds_and_not_fits_make_the_jobs(spark, two_habits):
    vectors = segments.shape_vectors(segments.share_of_day(segments.load_shape(two_habits)))
    asked, one_round = [], segments._round
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(segments, "_round", lambda blocks, fits: asked.append(len(fits)) or one_round(blocks, fits))
        fitted = segments._fits(vectors, (2, 3, 4), 3, segments.SEED)
    assert asked[0] == 9 and len(asked) == max(m.summary.numIter for models in fitted for m in models)


def test_an_empty_cluster_stays_where_it_is(spark):
    same = spark.createDataFrame([(f"M{i}", slot, 1.0) for i in range(5) for slot in range(48)], "meter_id string, half_hour int, kwh double")
    labels = segments.segment_meters(same, k=3).collect()
    assert len(labels) == 5 and len({r.segment for r in labels}) == 1
