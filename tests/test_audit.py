"""Audits of records against loops."""

import random

import pytest

from rhapsode.operators import audit as U
from rhapsode.sources import archives as A
from rhapsode.sources import recordfiles as R

from .test_recordfiles import tables


def test_tally_keeps_counts_and_the_least_items(spark):
    from pyspark.sql import functions as F

    rng = random.Random(2)
    rows = [(rng.choice("abc"), rng.randrange(10_000), rng.choice([None, 1, 2, 3])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "video_id string, frame long, x int").repartition(7)
    got = {(r["video_id"], r["check"]): (r["n"], r["first"]) for r in U.tally(df, {"one": F.col("x") == 1, "more": F.col("x") > 1, "never": F.lit(False)}, keep=4).collect()}
    for v in "abc":
        for name, ok in (("one", lambda x: x == 1), ("more", lambda x: x > 1)):
            hit = sorted(f for w, f, x in rows if w == v and x is not None and ok(x))
            assert got.pop((v, name)) == (len(hit), hit[:4])
    assert not got


def test_checks_of_frames(spark):
    box = (0.0, 0.0, 1.0, 1.0)
    dets = [("a", 0, 0, 0.5, 7, *box), ("a", 0, 1, 0.6, 3, *box), ("a", 1, 0, 0.5, 4, *box), ("a", 2, 0, 0.9, 3, *box), ("a", 3, 0, 0.9, 5, *box), ("a", 9, 0, 0.1, 0, *box)]
    frames = [("a", 0, 2, 0), ("a", 1, 0, -1), ("a", 2, 2, 0), ("a", 3, 0, 0), ("a", 4, 1, -2)]
    posed = [("a", 0, 0, 0), ("a", 1, 0, 0), ("a", 3, 0, 1), ("a", 3, 1, 2)]
    d = spark.createDataFrame(dets, "video_id string, frame long, det long, score double, flags int, x1 double, y1 double, x2 double, y2 double")
    f = spark.createDataFrame(frames, "video_id string, frame long, num_persons long, primary long")
    p = spark.createDataFrame(posed, "video_id string, frame long, pos long, det long")
    got = {r["check"]: (r["n"], r["first"]) for r in U.record_problems(f, d, p).collect()}
    assert got == {
        "scores rise": (1, [0]), "posed outside the pose set": (1, [1]), "num_persons": (3, [2, 4, 9]), "number of posed rows": (1, [3]), "primary outside the posed rows": (2, [2, 4]),
        "pick isn't posed": (2, [2, 3]), "primary isn't the pick": (1, [4]), "frame not listed": (1, [9]),
    }


def test_sound_archives_have_no_problem_and_damaged_ones_are_named(spark, tmp_path):
    videos, dets = tables(spark, 30, ("a", "b", "c", "d", "e"))
    A.write_archives(videos, dets, str(tmp_path))
    assert R.structure_problems(spark, str(tmp_path)).count() == 0
    kinds = {"a": "scores", "b": "offsets", "c": "rate", "d": "primary"}
    R.damage(spark.createDataFrame([(f"file://{tmp_path}/{v}.npz", k) for v, k in kinds.items()], "path string, kind string"))
    got = {r["video_id"]: r["problem"] for r in R.structure_problems(spark, str(tmp_path)).collect()}
    assert set(got) == set(kinds) and "det_scores" in got["a"] and "end at its rows" in got["b"] and "rate" in got["c"] and "primary" in got["d"]
    (tmp_path / "f.npz").write_bytes(b"none")
    assert "f" in {r["video_id"] for r in R.structure_problems(spark, str(tmp_path)).collect()}
    (tmp_path / "f.npz").unlink()
    found = {r["video_id"] for r in R.check(spark, str(tmp_path), pick=U.first_listed, crc=False).collect()}
    assert found >= set(kinds) | {"e"}


@pytest.mark.parametrize("records", [True, False])
def test_switches(spark, tmp_path, records):
    videos, dets = tables(spark, 10, ("a",))
    A.write_archives(videos, dets, str(tmp_path))
    n = R.check(spark, str(tmp_path), pick=U.first_listed, crc=False, records=records).count()
    assert (n > 0) == records


def test_few_archives_are_twice_on_disk(spark, tmp_path):
    """Videos are few and large: as many tasks as archives would take the disk for all of them twice."""
    for i in range(8):
        (tmp_path / f"v{i}.npz").write_bytes(b"old")
    files = spark.createDataFrame([(f"file://{tmp_path}/v{i}.npz", "rate") for i in range(8)], "path string, kind string").repartition(8)
    assert R.few_at_once(files).rdd.getNumPartitions() == 2 and R.few_at_once(files).count() == 8 and R.few_at_once(files.limit(1)).rdd.getNumPartitions() == 1

    def half(raw, out):
        out.write(b"half")
        raise OSError("disk full")

    with pytest.raises(OSError, match="disk full"):
        R.rewritten(f"file://{tmp_path}/v0.npz", half)
    assert len(list(tmp_path.iterdir())) == 8 and (tmp_path / "v0.npz").read_bytes() == b"old"
