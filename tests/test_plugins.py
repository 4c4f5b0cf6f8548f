"""Settings, datasets and single functions with hard edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rhapsode.functions import geometry as G
from rhapsode.functions import timing as T
from rhapsode.operators import incremental as I
from rhapsode.operators import joins as J
from rhapsode.operators import report as R
from rhapsode.operators import runs as U
from rhapsode.plans.datasets import Dataset, Settings, find, register


@pytest.mark.parametrize("bad", [{"max_posed": 0}, {"max_posed": 128}, {"pose_score": 1.5}, {"pose_score": 0.05}, {"det_batch": 0}])
def test_settings_are_checked(bad):
    with pytest.raises(ValueError):
        Settings(**bad)
    assert "count_iou" in Settings().derivation_fields() and "count_iou" not in Settings().extraction_fields()


def test_dataset_contract(spark):
    @register
    class Small(Dataset):
        name = "small"
        split_order = ("train", "dev")

        def videos(self):
            rows = [("a", "train", {"k": "v"}, 5), ("a", "dev", {}, None), ("b c", "train", {}, 1), ("d_segment_3", "dev", {}, 1), ("e", "other", {"split": "x"}, 0)]
            return self.spark.createDataFrame(rows, "video_id string, split string, info map<string,string>, expected_frames int").withColumn("path", F.col("video_id"))

    got = {(r["video_id"], r["problem"]) for r in find("small")(spark, "").problems().collect()}
    assert got == {("a", "repeated id"), ("b c", "id"), ("d_segment_3", "id"), ("e", "split"), ("e", "expected_frames"), ("e", "info")}
    with pytest.raises(KeyError):
        find("nobody")
    with pytest.raises(TypeError):
        register(Dataset)


def test_within_ulps_equals_spacing(spark):
    rng = np.random.default_rng(1)
    a = np.concatenate([rng.random(200), [1.0, 2.0, 0.5, 1e-3]]).astype("f4")
    b = a + np.spacing(a) * rng.integers(0, 8, len(a)).astype("f4")
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b, strict=True)], "a double, b double")
    got = [r["n"] for r in df.select(G.within_ulps(F.col("a"), F.col("b"), 4).alias("n")).collect()]
    want = [bool(abs(float(x) - float(y)) <= 4 * float(np.spacing(max(x, y)))) for x, y in zip(a, b, strict=True)]
    assert got == want


def test_roundings(spark):
    row = spark.range(1).select(
        T.round_half_even(F.lit(2.5)).alias("even"), T.seconds_to_frames(0.5, F.lit(25.0)).alias("up"), T.seconds_to_frames(0.0, F.lit(25.0)).alias("one"), T.seconds_to_frames(1.0, F.lit(25.005)).alias("slack"),
        T.to_millis(F.lit("1.0005").cast("decimal(20,9)")).alias("half"), T.parse_timestamp(F.lit("00:26:59.09")).cast("double").alias("t"), T.parse_timestamp(F.lit("1:2:3")).cast("double").alias("short"), T.parse_timestamp(F.lit("x")).alias("none"),
    ).first()
    assert (row["even"], row["up"], row["one"], row["slack"], row["half"], row["t"], row["short"], row["none"]) == (2, 13, 1, 25, 1001, 1619.09, 3723.0, None)
    with pytest.raises(Exception, match="negative"):
        spark.range(1).select(T.format_millis(F.lit(-1))).collect()


def runs(spark, mask):
    df = spark.createDataFrame([(1, t, bool(m)) for t, m in enumerate(mask)], "video_id long, t long, mask boolean")
    return lambda gap, least: sorted((r["a"], r["b"]) for r in U.empty_runs(df, "mask", gap, least).collect())


def test_runs_at_their_limits(spark):
    r = runs(spark, [1, 1, 0, 0, 1, 0, 0, 0, 1, 1])
    assert r(2, 1) == [(0, 2), (4, 5), (8, 10)]  # a gap of exactly the limit keeps runs apart
    assert r(3, 2) == [(0, 5), (8, 10)] and r(9, 10) == [(0, 10)] and r(9, 11) == []
    assert runs(spark, [1] * 4)(3, 4) == [(0, 4)] and runs(spark, [0] * 4)(3, 1) == []


def test_spans_touch_nest_and_vanish(spark):
    df = spark.createDataFrame([(1, 5.0, 6.0), (1, 0.0, 2.0), (1, 2.0, 3.0), (1, 0.5, 1.0), (1, 4.0, 4.0)], "video_id long, a double, b double")
    assert sorted((r["a"], r["b"]) for r in U.merged_spans(df).collect()) == [(0.0, 3.0), (5.0, 6.0)]


def test_upsert_keeps_unknown_columns_and_blanks(spark):
    old = spark.createDataFrame([(1, 10, "n1", "s1"), (2, 20, "n2", "s2"), (9, 90, "n9", "s9")], "id long, width int, note string, spans string")
    new = spark.createDataFrame([(1, 11, None), (2, 22, "[]"), (3, 33, None)], "id long, width int, spans string")
    got = {r["id"]: (r["width"], r["spans"], r["note"]) for r in J.upsert(old, new, "id", {"spans": F.col("id") != 1}).collect()}
    assert got == {1: (11, "s1", "n1"), 2: (22, "[]", "n2"), 3: (33, None, None)}


def test_every_branch_of_resume(spark):
    wanted = spark.createDataFrame([(k, "e", "d", 5, k != 6) for k in range(1, 7)], "video_id long, extraction_hash string, derivation_hash string, bytes long, has_meta boolean")
    done = spark.createDataFrame([(1, "e", "d", 5), (2, "x", "d", 5), (3, "e", "x", 5), (4, "e", "d", 6), (6, "e", "d", 5)], "video_id long, done_extraction string, done_derivation string, done_bytes long")
    assert {r["video_id"]: r["action"] for r in I.resume_action(wanted, done).collect()} == {1: "skip", 2: "extract", 3: "derive", 4: "extract", 5: "extract", 6: "derive"}


def test_limits_follow_the_noise(spark):
    m = spark.createDataFrame([("a", 0.3, 0.2, False), ("b", 0.2, 0.2, False), ("c", 0.2, 0.2, True)], "metric string, value double, fixed double, strict boolean")
    noise = spark.createDataFrame([("a", 0.25)], "metric string, value double")
    assert {r["metric"]: r["passed"] for r in R.limits(m, noise).collect()} == {"a": True, "b": True, "c": False}
    assert {r["metric"]: r["passed"] for r in R.limits(m, None).collect()} == {"a": False, "b": True, "c": False}
