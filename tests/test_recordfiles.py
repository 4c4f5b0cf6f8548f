"""Block reads, two-phase writes, growing arrays and checksums of record files."""

import io
import json
import random
import zipfile
import zlib

import numpy as np
import pytest

from rhapsode.sources import archives as A
from rhapsode.sources import growing as G
from rhapsode.sources import recordfiles as R

VIDEO = "video_id string, width long, height long, fps_num long, fps_den long, n_frames long, primary_rule string, meta string, provenance string"
DETECTION = "video_id string, frame long, det long, x1 double, y1 double, x2 double, y2 double, score double, flags int, is_primary boolean, kpts array<float>"


def tables(spark, frames=40, names=("a", "b", "c"), shift=0.0):
    rng = random.Random(5)
    videos = [(v, 640, 480, 30000, 1001, frames, "first", "{}", "{}") for v in names]
    rows = []
    for v in names:
        for f in range(frames):
            for d in range(rng.randrange(4)):
                posed = rng.random() < 0.6
                rows.append((v, f, d, shift + d, 1.0, 2.0, 3.0 + f, 0.9 - d / 10, rng.randrange(8), d == 0, [float(f + i) for i in range(399)] if posed else None))
    return spark.createDataFrame(videos, VIDEO), spark.createDataFrame(rows, DETECTION)


class Counting(io.BytesIO):
    """Remembers how many bytes of which part of the file were read."""

    def __init__(self, data):
        super().__init__(data)
        self.seen = []

    def read(self, n=-1):
        at = self.tell()
        out = super().read(n)
        self.seen.append((at, len(out)))
        return out


def test_a_block_of_a_large_member_reads_only_its_bytes():
    t, n = 20_000, 100_000
    m = {"schema_version": np.array(1), "num_frames": np.array(t), "det_offsets": np.arange(0, n + 1, 5, dtype="i8"), "det_boxes": np.random.default_rng(1).random((n, 4)).astype("f4"), "det_scores": np.zeros(n, "f4"), "det_flags": np.zeros(n, "u1")}
    out = io.BytesIO()
    np.savez(out, **m)
    raw = Counting(out.getvalue())
    archive = R.Archive(raw)
    raw.seen.clear()
    parts = list(R.block_columns(archive, "detections", ["video_id", "frame", "x1"], 9_000, 9_050))
    got = np.concatenate([p["x1"] for p in parts])
    assert (got == m["det_boxes"][45_000:45_250, 0]).all() and (np.concatenate([p["frame"] for p in parts]) == np.repeat(np.arange(9_000, 9_050), 5)).all()
    assert sum(k for _, k in raw.seen) < 250 * 16 + 51 * 8 + 2_000 < len(raw.getvalue()) / 100


def test_members_stored_by_columns():
    out = io.BytesIO()
    m = {"det_boxes": np.asfortranarray(np.arange(40, dtype="f4").reshape(10, 4)), "kpts": np.asfortranarray(np.arange(3 * 399, dtype="f4").reshape(3, 133, 3))}
    np.savez(out, **m)
    archive = R.Archive(out)
    assert all((archive.rows(k, 1, 3) == v[1:3]).all() for k, v in m.items())


@pytest.mark.parametrize("block", [1 << 30, 20_000, 3_000])
def test_source_equals_the_whole_reader(spark, tmp_path, block):
    videos, dets = tables(spark)
    A.write_archives(videos, dets, str(tmp_path))
    for table in A.TABLES:
        whole = A.read_archives(spark, str(tmp_path), table)
        got = R.read_records(spark, str(tmp_path), table)
        spark.dataSource.register(R.RecordFiles)
        got = spark.read.format("record_files").option("path", str(tmp_path)).option("table", table).option("block_bytes", block).load()
        assert sorted(map(str, got.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
        if block == 3_000 and table == "detections":
            assert got.rdd.getNumPartitions() > 3


def test_filters_reach_the_files(spark, tmp_path):
    videos, dets = tables(spark)
    A.write_archives(videos, dets, str(tmp_path))
    (tmp_path / "broken.npz").write_bytes(b"no archive")  # would fail if it were opened
    got = R.read_records(spark, str(tmp_path), "detections", ["video_id", "frame", "score"]).where("video_id in ('a', 'c') and frame >= 7 and frame < 9 and score > 0.75")
    want = dets.where("video_id in ('a', 'c') and frame >= 7 and frame < 9 and score > 0.75").selectExpr("video_id", "frame", "cast(score as float) score")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    reader = R.RecordReader({"path": str(tmp_path)}, got.schema)
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNotNull, LessThanOrEqual

    left = list(reader.pushFilters([EqualTo(("video_id",), "a"), GreaterThan(("frame",), 3), LessThanOrEqual(("frame",), 9), GreaterThan(("score",), 0.5), IsNotNull(("frame",))]))
    assert reader.videos == {"a"} and reader.frames == [4, 10] and len(left) == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "0.75" in plan and ">= 7" not in plan and "< 9" not in plan and " IN " not in plan  # only the filter on score is left to Spark


def members(path):
    with np.load(path) as z:
        return {k: z[k] for k in z.files}


def test_two_phase_write_equals_one_archive(spark, tmp_path):
    videos, dets = tables(spark)
    A.write_archives(videos, dets, str(tmp_path / "one"))
    done = R.commit_records(videos, dets, str(tmp_path / "two"))
    assert {r["video_id"] for r in done.collect()} == {"a", "b", "c"} and not (tmp_path / "two" / "work" / "x").exists()
    for path, video, size in R.record_paths(str(tmp_path / "two")):
        x, y = members(path.removeprefix("file://")), members(tmp_path / "one" / f"{video}.npz")
        assert list(x) == list(y) and all(x[k].dtype == y[k].dtype and x[k].shape == y[k].shape and (x[k] == y[k]).all() for k in x)
        assert size == next(r["bytes"] for r in done.collect() if r["video_id"] == video)


def test_a_long_video_is_staged_by_several_tasks(spark, tmp_path):
    videos, dets = tables(spark, 300, ("a",))
    R.commit_records(videos, dets.repartition(8), str(tmp_path / "r"))
    got = R.read_records(spark, str(tmp_path / "r"), "detections")
    assert got.count() == dets.count() and got.where("flags is null").count() == 0


@pytest.mark.parametrize("stop", R.STEPS)
def test_a_stop_before_any_step_leaves_the_old_or_the_new_state(spark, tmp_path, stop):
    videos, old = tables(spark, 20, ("a", "b"))
    new = tables(spark, 20, ("a", "b"), shift=100.0)[1]
    folder = str(tmp_path / "r")
    R.commit_records(videos, old, folder)
    state = lambda: sorted(map(tuple, R.read_records(spark, folder, "detections").select("video_id", "frame", "det", "x1").collect()))
    rows = lambda d: sorted((r["video_id"], r["frame"], r["det"], r["x1"]) for r in d.collect())
    before, after = rows(old), rows(new)
    assert state() == before
    with pytest.raises(Exception, match="InterruptedError"):
        R.commit_records(videos, new, folder, stop_before=stop)
    now = state()
    for v in ("a", "b"):
        assert [r for r in now if r[0] == v] in ([r for r in before if r[0] == v], [r for r in after if r[0] == v])
    if stop in ("assemble", "file", "marker"):
        assert now == before
    R.commit_records(videos, new, folder)
    assert state() == after
    assert len(list((tmp_path / "r" / "files" / "a").glob("*.npz"))) == 1


def test_a_failed_job_stages_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    videos, dets = tables(spark, 20, ("a",))
    bad = dets.withColumn("flags", F.when(F.col("frame") < 15, F.col("flags")).otherwise(F.raise_error(F.lit("stop"))))
    with pytest.raises(Exception, match="stop"):
        R.commit_records(videos, bad, str(tmp_path / "r"))
    assert not list((tmp_path / "r").glob("done/*")) and not list((tmp_path / "r").glob("work/*/chunks.json"))


def test_frames_outside_the_video_are_refused(spark, tmp_path):
    videos, dets = tables(spark, 20, ("a",))
    with pytest.raises(Exception, match="outside the video's frames"):
        R.commit_records(videos.selectExpr("video_id", "width", "height", "fps_num", "fps_den", "cast(3 as bigint) n_frames", "primary_rule", "meta", "provenance"), dets, str(tmp_path / "r"))


def test_shifted_crc():
    rng = random.Random(1)
    for _ in range(50):
        a, b = rng.randbytes(rng.randrange(40)), rng.randbytes(rng.randrange(200))
        assert R.shifted_crc(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(a + b)


@pytest.mark.parametrize("block", [1 << 24, 100])
def test_checksums_name_the_damaged_member(spark, tmp_path, block):
    videos, dets = tables(spark)
    A.write_archives(videos, dets, str(tmp_path))
    with zipfile.ZipFile(tmp_path / "packed.npz", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("kpts.npy", b"1234" * 1000)
    got = R.crc_members(spark, str(tmp_path), block).collect()
    for r in got:
        with zipfile.ZipFile(r["path"].removeprefix("file:")) as z:
            assert r["crc32"] == r["stored"] == zlib.crc32(z.read(f"{r['member']}.npy")) and r["problem"] is None
    assert len(got) == 3 * len(A.MEMBERS) + 1 and R.crc_problems(spark, str(tmp_path), block).count() == 0
    raw = bytearray((tmp_path / "b.npz").read_bytes())
    with zipfile.ZipFile(tmp_path / "b.npz") as z:
        at = z.getinfo("det_scores.npy").header_offset + 200
    raw[at] ^= 4
    (tmp_path / "b.npz").write_bytes(raw)
    (tmp_path / "c.npz").write_bytes((tmp_path / "c.npz").read_bytes()[:-30])
    bad = [(r["path"][-5:], r["member"], r["problem"]) for r in R.crc_problems(spark, str(tmp_path), block).collect()]
    assert ("b.npz", "det_scores", "CRC-32 differs") in bad and {b[0] for b in bad} == {"b.npz", "c.npz"} and len(bad) == 2


def stream(spark, tmp_path, name="s"):
    return spark.readStream.schema("array string, position long, value array<float>").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).writeStream.format("growing_arrays").option("path", f"file://{tmp_path}/{name}").option("checkpointLocation", f"file://{tmp_path}/{name}-state").trigger(availableNow=True)


def test_growing_arrays_equal_whole_ones(spark, tmp_path):
    G.register(spark)
    rows = [(f"v{i % 3}", i, [float(i), i / 2]) for i in range(300)]
    for k in range(4):
        spark.createDataFrame(rows[k * 75 : (k + 1) * 75], "array string, position long, value array<float>").repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        stream(spark, tmp_path).start().awaitTermination()
    epochs = sorted((tmp_path / "s" / "epochs").glob("*.json"))
    assert len(epochs) >= 4
    done = {r["array"]: r for r in G.settle(spark, str(tmp_path / "s"), str(tmp_path / "out")).collect()}
    for k in range(3):
        out = io.BytesIO()
        a = np.array(sorted(r[2] for r in rows if r[0] == f"v{k}"), "<f4")
        np.save(out, a)
        got = np.load(tmp_path / "out" / f"v{k}.npy")
        assert done[f"v{k}"]["rows"] == 100 == len(got) and (got[np.argsort(got[:, 0])] == a).all()
        assert (tmp_path / "out" / f"v{k}.npy").read_bytes()[:128] == out.getvalue()[:128] and done[f"v{k}"]["bytes"] == len(out.getvalue())


def test_an_epoch_that_is_done_again_counts_once(tmp_path):
    import pyarrow as pa

    w = G.ArrayWriter(f"file://{tmp_path}/g")
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "a"]), pa.array([1, 0]), pa.array([2.0, 1.0], pa.float32())], names=["array", "position", "value"])
    first, again = w.write(iter([batch])), w.write(iter([batch]))
    w.commit([first], 0), w.commit([again], 0)
    lines = (tmp_path / "g" / "epochs" / "000000000000.json").read_text().splitlines()
    assert [json.loads(x)["file"] for x in lines] == [first.parts[0][4]]
    w.abort([w.write(iter([batch]))], 1)
    assert len(list((tmp_path / "g" / "parts").glob("*"))) == 2 and np.fromfile(tmp_path / "g" / "parts" / first.parts[0][4], "<f4").tolist() == [1.0, 2.0]
    assert len(G.npy_header(0, 0)) == len(G.npy_header(10**18, 399))


def test_archives_are_put_together_from_chunks(spark, tmp_path):
    videos, dets = tables(spark, 200, ("a", "b"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as few rows as these would be one chunk
    try:
        jobs, folder, work = R.staged_jobs(videos, dets.repartition(4), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for v, chunks in R.jobs_of(jobs.toPandas()):
        sizes = []
        for c in chunks:
            import pyarrow as pa

            with pa.ipc.open_file(f"{work}/{c[4]}") as f:
                t = f.read_all()
            assert t.column("posed").to_pylist() == [k is not None for k in t.column("kpts").to_pylist()]
            sizes.append(len(t))
        assert sum(sizes) == dets.where(f"video_id = '{v['video_id']}'").count() and max(sizes) < sum(sizes)


def test_blocks_that_follow_each_other_are_one_sum(spark, tmp_path):
    """A sum of 4 KB costs more in shifts and rows than in reading: as many rows as runs of CRC_BLOCK bytes, not as blocks."""
    with zipfile.ZipFile(tmp_path / "a.npz", "w") as z:
        z.writestr("kpts.npy", random.Random(1).randbytes(400_000))
    from time import perf_counter

    start = perf_counter()
    assert [r["problem"] for r in R.crc_members(spark, str(tmp_path), 8).collect()] == [None]
    assert perf_counter() - start < 20  # 50,000 blocks


def test_keypoints_are_computed_once_rows_are_dealt(spark, tmp_path):
    from pyspark.sql import functions as F

    videos, dets = tables(spark, 60, ("a", "b"))
    points = F.when(F.col("det") == 0, F.transform(F.sequence(F.lit(0), F.lit(398)), lambda i: (F.col("frame") + i).cast("float")))
    plain = dets.drop("kpts")
    plan = R.dealt_rows(plain, {"kpts": points})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("transform(") < plan.index("Sort") < plan.index("RepartitionByExpression")  # above the sort and the shuffle
    A.write_archives(videos, plain, str(tmp_path / "late"), {"kpts": points})
    A.write_archives(videos, plain.withColumn("kpts", points), str(tmp_path / "early"))
    for v in ("a", "b"):
        assert (tmp_path / "late" / f"{v}.npz").read_bytes() == (tmp_path / "early" / f"{v}.npz").read_bytes()


def test_a_batch_is_counted_over_its_own_frames(tmp_path, monkeypatch):
    """A video's frames for each batch would be the square of its length."""
    import pyarrow as pa

    n, sizes, count = 4000, [], np.bincount
    writer = R.ChunkWriter(str(tmp_path), "job")
    frame = np.arange(n)
    cols = [pa.array(["a"] * n), pa.array(frame), pa.array(frame * 0), *[pa.array(frame.astype("f4"))] * 5, pa.array(frame.astype("i4") % 8), pa.array([True] * n), pa.array([[1.0] * 399 if i % 3 == 0 else None for i in range(n)], pa.list_(pa.float32()))]
    whole = pa.RecordBatch.from_arrays(cols, names=R.CHUNK_COLUMNS[:-1])
    message = writer.write(iter([whole.slice(i, 100) for i in range(0, n, 100)]))
    monkeypatch.setattr(np, "bincount", lambda x, minlength=0: sizes.append(minlength) or count(x, minlength=minlength))
    video = {"video_id": "a", "width": 1, "height": 1, "fps_num": 25, "fps_den": 1, "n_frames": n, "primary_rule": "", "meta": "", "provenance": ""}
    R.assemble(str(tmp_path), writer.work, video, message.chunks, str(tmp_path / "a.npz"))
    assert sum(sizes) <= 3 * n
    with np.load(tmp_path / "a.npz") as z:
        assert (z["kpt_primary"] == np.where(frame % 3 == 0, 0, -1)).all() and (np.diff(z["kpt_offsets"]) == (frame % 3 == 0)).all() and (z["num_persons"] == (frame % 8 & 2 != 0)).all()


def test_a_task_writes_few_files_for_many_arrays(tmp_path):
    import pyarrow as pa

    keys = [f"v{i % 500}" for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.arange(2000)), pa.array([[float(i)] for i in range(2000)], pa.list_(pa.float32()))], names=["array", "position", "value"])
    done = G.ArrayWriter(str(tmp_path)).write(iter([batch.slice(0, 900), batch.slice(900)]))
    assert len(list((tmp_path / "parts").glob("*"))) == 1 and len(done.parts) == 500
    raw = np.fromfile(next((tmp_path / "parts").glob("*")), "<f4")
    for name, first, rows, width, _, at in done.parts:
        assert (first, rows, width) == (int(name[1:]), 4, 1) and raw[at // 4 : at // 4 + rows].tolist() == [first + 500.0 * k for k in range(4)]


def test_many_small_files_are_few_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from rhapsode.sources import records as P

    rows = spark.range(3000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("video_id"), (F.col("id") % 7).cast("int").alias("width"))
    P.write_meta_rows(rows, f"file://{tmp_path}/m")
    assert len([p for p in (tmp_path / "m").iterdir()]) == 3000  # drafts are gone
    got = P.read_meta_rows(spark, f"{tmp_path}/m", "video_id string, width int")
    assert got.rdd.getNumPartitions() <= A.tasks(spark) and got.exceptAll(rows).count() == 0 and got.count() == 3000
    (tmp_path / "m" / "v1.json").write_text('{"video_id": "v2", "width": 1}')
    with pytest.raises(Exception, match="isn't the file's name"):
        P.read_meta_rows(spark, f"{tmp_path}/m", "video_id string, width int").collect()


def test_a_video_of_many_frames_is_put_together_in_blocks(tmp_path):
    """Neither a block's ends nor batches that part a frame change a number, and the numbers of all frames are never in memory."""
    import tracemalloc

    import pyarrow as pa

    t, edge = 2_000_000, R.FRAMES
    rows = [(f, d, d != 1, d == 2) for f in (0, edge - 1, edge, edge + 1, 9 * edge, t - 1) for d in range(4)]  # (frame, det, posed, primary)
    kinds = {"frame": "i8", "det": "i8", "x1": "f4", "y1": "f4", "x2": "f4", "y2": "f4", "score": "f4", "flags": "i4"}
    chunks = []
    for k, part in enumerate((rows[:6], rows[6:7], rows[7:])):
        cols = {c: np.array([{"frame": f, "det": d, "flags": 2 * (d % 2)}.get(c, 0.5) for f, d, _, _ in part], v) for c, v in kinds.items()}
        full = {"video_id": ["v"] * len(part), **cols, "is_primary": [m for *_, m in part], "kpts": pa.array([[0.5] * 399 if p else None for _, _, p, _ in part], pa.list_(pa.float32())), "posed": [p for _, _, p, _ in part]}
        batch = pa.RecordBatch.from_pydict(full)
        with pa.ipc.new_file(str(tmp_path / f"{k}.arrow"), batch.schema) as out:
            out.write_batch(batch)
        chunks.append(("v", part[0][0], part[-1][0], len(part), f"{k}.arrow"))
    video = {"video_id": "v", "width": 1, "height": 1, "fps_num": 25, "fps_den": 1, "n_frames": t, "primary_rule": "first", "meta": "{}", "provenance": "{}"}
    tracemalloc.start()
    R.assemble(str(tmp_path), str(tmp_path), video, chunks, str(tmp_path / "v.npz"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20  # eight bytes a frame would be 16 million
    z = np.load(tmp_path / "v.npz")
    frames, posed = np.array([f for f, *_ in rows]), np.array([p for _, _, p, _ in rows])
    assert (np.diff(z["det_offsets"]) == np.bincount(frames, minlength=t)).all() and (np.diff(z["kpt_offsets"]) == np.bincount(frames[posed], minlength=t)).all()
    assert (z["num_persons"] == np.bincount(frames, minlength=t) // 2).all() and (np.flatnonzero(z["kpt_primary"] >= 0) == np.unique(frames)).all()
    assert set(z["kpt_primary"][np.unique(frames)].tolist()) == {1}  # of rows 0, 2 and 3


def test_videos_are_put_together_by_many_tasks(spark, tmp_path):
    videos, dets = tables(spark, 5, [f"v{i}" for i in range(12)])
    A.write_archives(videos, dets, str(tmp_path))
    assert len(list((tmp_path / ".written").glob("part-*"))) > 1


def test_a_job_that_stops_leaves_one_version_and_no_stage(spark, tmp_path):
    """A task that is run again finds the version it made; the next job removes it before it makes another."""
    videos, dets = tables(spark, 10, ("a",))
    folder = f"file://{tmp_path}/r"
    R.commit_records(videos, dets, folder)
    files = lambda: {p.name for p in (tmp_path / "r" / "files" / "a").iterdir()}
    first = files()
    jobs, folder, work = R.staged_jobs(videos, dets.where("det < 1"), folder)
    ((v, chunks),) = R.jobs_of(jobs.toPandas())
    for stop in ("file", "marker", "marker", "marker"):
        with pytest.raises(InterruptedError):
            R.publish(folder, work, v, chunks, stop)
    assert len(files()) == 2 and not [p for p in (tmp_path / "r" / "work").rglob("*.npz")]
    with pytest.raises(Exception, match="InterruptedError"):
        R.commit_records(videos, dets, folder, stop_before="assemble")
    assert files() == first and R.read_records(spark, folder, "detections").count() == dets.count()
    R._store(folder)[0].delete_dir(work)
    assert not [p for p in (tmp_path / "r" / "work").rglob("*.arrow")]
    assert R.publish(folder, work, v, [], None)["n_frames"] == 10 and len(files()) == 1


def test_late_keypoints_are_staged_nowhere(spark, tmp_path):
    """They are computed from the rows as given: numbers that archives round, and columns that they lack."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    videos, dets = tables(spark, 60, ("a", "b"), shift=1 / 3)
    plain = dets.drop("kpts").withColumn("size", F.struct((F.col("frame") + 0.1).alias("w"))).withColumn("score", F.col("score").cast("decimal(9,4)"))
    posed = F.col("det") == 0
    points = F.when(posed, F.transform(F.sequence(F.lit(0), F.lit(398)), lambda i: ((F.col("x1") * 1e7 + F.col("size.w") + i + F.col("score")) % 1000).cast("float")))
    A.write_archives(videos, plain.withColumn("kpts", points), str(tmp_path / "early"))
    for k, late in enumerate(({"kpts": points}, {"kpts": points, "posed": posed})):
        jobs, _, work = R.staged_jobs(videos, plain, str(tmp_path / f"staged{k}"), late=late)
        for _, chunks in R.jobs_of(jobs.toPandas()):
            for c in chunks:
                with pa.ipc.open_file(f"{work}/{c[4]}") as f:
                    t = f.read_all()
                assert not any(t.column("kpts").to_pylist()) and t.column("posed").to_pylist() == [d == 0 for d in t.column("det").to_pylist()]
        A.write_archives(videos, plain, str(tmp_path / f"late{k}"), late)
        for v in ("a", "b"):
            assert (tmp_path / f"late{k}" / f"{v}.npz").read_bytes() == (tmp_path / "early" / f"{v}.npz").read_bytes()
    with pytest.raises(Exception, match="are posed"):
        A.write_archives(videos, plain, str(tmp_path / "wrong"), {"kpts": points, "posed": F.col("det") < 2})
    assert not list((tmp_path / "wrong").rglob("*.arrow")) and not list((tmp_path / "wrong").glob(".[ab].*"))


def test_a_stage_leaves_no_shuffle_files(spark, tmp_path):
    from pathlib import Path
    from time import sleep

    roots = [Path(str(p)) for p in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {p.name for r in roots for p in r.rglob("shuffle_*.data")}
    videos, dets = tables(spark, 60, ("a", "b"))
    before = shuffles()
    kept = R.staged_jobs(videos, dets, str(tmp_path / "r"))  # noqa: F841
    for _ in range(50):
        if shuffles() <= before:
            break
        sleep(0.2)
    assert shuffles() <= before
