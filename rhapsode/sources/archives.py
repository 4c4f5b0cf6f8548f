"""Record files: one .npz archive a video, whose arrays become tables of frames, detections and posed rows.

Tasks open the archives themselves and read only the members that a table needs. An archive holds one video by its format; its rows leave a
task in blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The members of an archive with their number types and the shape of a row (None: text or a single number), and the version.
MEMBERS = {
    "schema_version": ("i8", None), "video_id": ("U", None), "frame_size": ("i8", ()), "fps": ("i8", ()), "num_frames": ("i8", None),
    "det_offsets": ("i8", ()), "det_boxes": ("f4", (4,)), "det_scores": ("f4", ()), "det_flags": ("u1", ()), "num_persons": ("u1", ()),
    "kpt_offsets": ("i8", ()), "kpt_det": ("i4", ()), "kpts": ("f4", (133, 3)), "kpt_primary": ("i1", ()),
    "primary_rule": ("U", None), "meta": ("U", None), "provenance": ("U", None),
}
VERSION = 1
COUNTED, POSED = 2, 4
BLOCK = 50_000

TABLES = {
    "videos": ("video_id string, width long, height long, fps_num long, fps_den long, n_frames long, primary_rule string, meta string, provenance string", ("video_id", "frame_size", "fps", "num_frames", "primary_rule", "meta", "provenance")),
    "rates": ("video_id string, fps_num long, fps_den long", ("fps",)),
    "frames": ("video_id string, frame long, num_persons long, primary long", ("num_persons", "kpt_primary", "num_frames")),
    "detections": ("video_id string, frame long, det long, x1 float, y1 float, x2 float, y2 float, score float, flags int", ("det_offsets", "det_boxes", "det_scores", "det_flags")),
    "posed": ("video_id string, frame long, pos long, det long, kpts array<float>", ("kpt_offsets", "kpt_det", "kpts")),
}


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:/", "file:///", 1) if path.startswith("file:/") else f"file://{path}")


def listed_files(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """(path) of a plain folder's files, dealt evenly over tasks by number, as many small files have few bytes. One task lists the names; Spark's own listing
    keeps them in the driver, and its readers take 32 files a task."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, base = _store(folder)
        head = folder.split("://")[0] + "://" if "://" in folder else "file://"
        for _ in batches:
            found = store.get_file_info(fs.FileSelector(base))
            names = [f.base_name for f in found if f.type == fs.FileType.File and f.base_name.endswith(suffix) and not f.base_name.startswith((".", "_"))]
            at = found[0].path[: -len(found[0].base_name)].lstrip("/") if found else ""
            for lo in range(0, len(names), BLOCK):
                yield pa.RecordBatch.from_pydict({"path": [f"{head}{'/' if head == 'file://' else ''}{at}{n}" for n in names[lo : lo + BLOCK]]})

    return spark.range(0, 1, 1, 1).mapInArrow(run, "path string").repartition(tasks(spark))


def tasks(spark: SparkSession) -> int:
    """How many tasks work on many small files."""
    return 4 * spark.sparkContext.defaultParallelism


def _member(archive, name: str):
    import numpy as np

    with archive.open(f"{name}.npy") as f:
        a = np.lib.format.read_array(f, allow_pickle=False)
    kind, row = MEMBERS[name]
    right = a.dtype.kind == "U" if kind == "U" else a.dtype == np.dtype(kind)
    if not right or (a.shape != () if row is None else a.shape[1:] != row or a.ndim != 1 + len(row)):
        raise ValueError(f"member {name} holds {a.dtype} {a.shape}")
    return a


def _expand(offsets):
    """The frame and the place in it of each row of an offset array."""
    import numpy as np

    n = np.diff(offsets)
    if offsets[0] != 0 or (n < 0).any():
        raise ValueError("offsets must start at 0 and not fall")
    frame = np.repeat(np.arange(len(n)), n)
    return frame, np.arange(len(frame)) - offsets[frame]


def _columns(table: str, m: dict, stem: str) -> dict:
    import numpy as np

    if table == "rates":
        return {"fps_num": m["fps"][:1], "fps_den": m["fps"][1:2]}
    if table == "videos":
        if str(m["video_id"]) != stem:
            raise ValueError(f"the file holds video {m['video_id']}")
        one = lambda a: np.array([a.item()], dtype=object if a.dtype.kind == "U" else None)
        w, h = m["frame_size"]
        return {"width": [w], "height": [h], "fps_num": m["fps"][:1], "fps_den": m["fps"][1:2], "n_frames": one(m["num_frames"]), **{k: one(m[k]) for k in ("primary_rule", "meta", "provenance")}}
    if table == "frames":
        if not len(m["num_persons"]) == len(m["kpt_primary"]) == int(m["num_frames"]):
            raise ValueError("frame members differ in length")
        return {"frame": np.arange(len(m["num_persons"])), "num_persons": m["num_persons"].astype("i8"), "primary": m["kpt_primary"].astype("i8")}
    offsets = m["det_offsets" if table == "detections" else "kpt_offsets"]
    frame, place = _expand(offsets)
    parts = [m[k] for k in TABLES[table][1][1:]]
    if any(len(p) != len(frame) for p in parts):
        raise ValueError(f"members of {table} differ in length")
    if table == "posed":
        return {"frame": frame, "pos": place, "det": parts[0].astype("i8"), "kpts": parts[1].reshape(len(frame), -1)}
    boxes, scores, flags = parts
    return {"frame": frame, "det": place, **{c: boxes[:, i] for i, c in enumerate(("x1", "y1", "x2", "y2"))}, "score": scores, "flags": flags.astype("i4")}


def read_archives(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of TABLES from the .npz files of a folder; a file that lacks a member, or has another version, type or shape, is an error.

    videos checks that all members are there, that the id is the file's name, and the version; the other tables check what they read.
    det in detections counts within a frame; det in posed counts over the video, as stored."""
    schema, needed = TABLES[table]

    def rows(frames):
        import posixpath
        import zipfile

        import pandas as pd

        for f in frames:
            for path in f["path"]:
                store, at = _store(path)
                stem = posixpath.basename(at)[: -len(".npz")]
                with store.open_input_file(at) as raw, zipfile.ZipFile(raw) as z:
                    try:
                        have = {n[: -len(".npy")] for n in z.namelist()}
                        lacking = [k for k in MEMBERS if k not in have] if table == "videos" else [k for k in needed if k not in have]
                        if lacking:
                            raise ValueError(f"missing members {lacking}")
                        if table != "rates" and int(_member(z, "schema_version")) != VERSION:
                            raise ValueError(f"schema_version isn't {VERSION}")
                        columns = _columns(table, {k: _member(z, k) for k in needed}, stem)
                    except ValueError as e:
                        raise ValueError(f"{path}: {e}") from e
                n = len(next(iter(columns.values())))
                for lo in range(0, n, BLOCK):
                    part = {k: list(v[lo : lo + BLOCK]) if k == "kpts" else v[lo : lo + BLOCK] for k, v in columns.items()}
                    yield pd.DataFrame({"video_id": stem, **part}, index=range(min(BLOCK, n - lo)))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(folder).select("path")  # the content isn't read here
    return files.mapInPandas(rows, schema)


def write_archives(videos: DataFrame, detections: DataFrame, folder: str, late: dict[str, Column] | None = None) -> DataFrame:
    """Writes an archive for each row of videos; gives back (video_id, bytes, n_frames), computed once.

    videos: video_id string, width, height, fps_num, fps_den, n_frames, primary_rule, meta, provenance. detections: video_id, frame, det (order
    in the frame), x1..y2, score, flags, is_primary, kpts (399 numbers, null: not posed). A file appears whole or not at all. late: columns that
    detections lack and that are computed from its others, once rows are dealt (keypoints are some 50 times a row's other bytes, and are computed where archives are
    written, so that they lie on disk once); posed, if it is there, tells which rows have keypoints without computing them.

    Rows are staged in chunks by ranges of (video, frame); a file is put together member by member, of which one batch of a chunk is in memory at a time."""
    from .recordfiles import archived, assemble, removed, staged_jobs

    spark = videos.sparkSession
    jobs, root, work = staged_jobs(videos, detections, folder, strict=True, late=late)

    def put(v, chunks, keypoints):
        import uuid

        store, base = _store(root)
        name, draft = f"{base}/{v['video_id']}.npz", f"{base}/.{v['video_id']}.{uuid.uuid4().hex[:8]}"
        try:
            assemble(root, work, v, chunks, draft, keypoints)
            size = store.get_file_info(draft).size
            store.move(draft, name)
        except BaseException:
            removed(store, draft)
            raise
        return {"video_id": v["video_id"], "bytes": size, "n_frames": int(v["n_frames"])}

    try:
        archived(jobs, root, work, detections, late, put).write.mode("overwrite").parquet(f"{root}/.written")  # readers pass over names that begin with a dot
    finally:
        _store(root)[0].delete_dir(work)
    return spark.read.parquet(f"{root}/.written")


def file_problems(markers: DataFrame, folder: str) -> DataFrame:
    """(video_id, problem) of markers (video_id string, bytes, n_frames) against the files of a folder: missing files, sizes and numbers of
    frames that differ, and files without a marker. Sizes come from the listing, frames from the archives' single numbers."""
    spark = markers.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(folder)
    files = files.select(F.regexp_extract("path", r"([^/]+)\.npz$", 1).alias("video_id"), F.col("length").alias("have"))
    frames = read_archives(spark, folder, "videos").select("video_id", F.col("n_frames").alias("frames"))
    j = markers.withColumn("marked", F.lit(True)).join(files.join(frames, "video_id"), "video_id", "full")
    problem = F.when(F.col("have").isNull(), "missing").when(F.col("marked").isNull(), "no marker").when(F.col("have") != F.col("bytes"), "size").when(F.col("frames") != F.col("n_frames"), "frames")
    return j.select("video_id", problem.alias("problem")).where("problem is not null")
