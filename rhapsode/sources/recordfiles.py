"""Record files as a Spark data source: block reads of stored archives, a two-phase writer, and checksums by blocks.

Layout of a committed folder: ``files/<video>/<version>.npz`` and ``done/<video>.json``. The marker names the version; it is replaced by one move after
the file is whole, so a reader that follows markers sees the old or the new record and never a mix. Staged work lies in ``work/<job>``.
"""

from __future__ import annotations

import json
import posixpath
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from ..operators.stage import settled, shuffles_dropped
from .archives import BLOCK, COUNTED, MEMBERS, TABLES, VERSION, _store, tasks

#: Bytes of an archive that one input partition stands for.
PARTITION_BYTES = 64 << 20
#: Bytes of a member that one task reads for a checksum, and how often a member is read before it counts as damaged.
CRC_BLOCK, CRC_READS = 16 << 20, 3
#: Frames whose numbers are in memory at a time while an archive is put together.
FRAMES = 1 << 16


# ---- members of an archive by ranges


@dataclass
class Member:
    """A stored array: where its numbers begin in the file, their type and shape."""

    at: int
    dtype: np.dtype
    shape: tuple
    by_column: bool


class Archive:
    """Members of an open file, of which any rows can be read without the rest. ``raw`` has seek and read."""

    def __init__(self, raw):
        self.raw = raw
        self.zip = zipfile.ZipFile(raw)
        self.info = {i.filename.removesuffix(".npy"): i for i in self.zip.infolist()}

    def data_start(self, name: str) -> int:
        i = self.info[name]
        self.raw.seek(i.header_offset)
        head = self.raw.read(30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"bad local header of {name}")
        return i.header_offset + 30 + sum(struct.unpack("<HH", head[26:30]))

    def member(self, name: str) -> Member:
        if name not in self.info:
            raise ValueError(f"missing members ['{name}']")
        self.raw.seek(self.data_start(name))
        version = np.lib.format.read_magic(self.raw)
        read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        shape, fortran, dtype = read(self.raw)
        kind, row = MEMBERS[name]
        right = dtype.kind == "U" if kind == "U" else dtype == np.dtype(kind)
        if not right or (shape != () if row is None else shape[1:] != row or len(shape) != 1 + len(row)):
            raise ValueError(f"member {name} holds {dtype} {shape}")
        return Member(self.raw.tell(), dtype, shape, fortran and len(shape) > 1)

    def rows(self, name: str, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Rows lo to hi of a member. A compressed member is read from its beginning up to them."""
        if name not in self.info:
            raise ValueError(f"missing members ['{name}']")
        if self.info[name].compress_type != zipfile.ZIP_STORED:
            with self.zip.open(self.info[name]) as f:
                a = np.lib.format.read_array(f, allow_pickle=False)
            return a if a.shape == () else a[lo:hi]
        m = self.member(name)
        if m.shape == ():
            self.raw.seek(m.at)
            return np.frombuffer(self.raw.read(m.dtype.itemsize), m.dtype).reshape(())
        hi = m.shape[0] if hi is None else hi
        if not 0 <= lo <= hi <= m.shape[0]:
            raise ValueError(f"member {name} has {m.shape[0]} rows, {lo} to {hi} asked for")
        width = m.dtype.itemsize * int(np.prod(m.shape[1:], dtype=np.int64))
        if m.by_column:
            each = []
            for k in range(width // m.dtype.itemsize):
                self.raw.seek(m.at + (k * m.shape[0] + lo) * m.dtype.itemsize)
                each.append(np.frombuffer(self.raw.read((hi - lo) * m.dtype.itemsize), m.dtype))
            return np.array(each, m.dtype).reshape((*m.shape[:0:-1], hi - lo)).T
        self.raw.seek(m.at + lo * width)
        return np.frombuffer(self.raw.read((hi - lo) * width), m.dtype).reshape((hi - lo, *m.shape[1:]))

    def one(self, name: str):
        return self.rows(name).item()


def block_columns(archive: Archive, table: str, wanted: list[str], lo: int, hi: int) -> Iterator[dict[str, np.ndarray]]:
    """Columns of a table over the frames lo to hi, in blocks of rows; only members behind wanted columns are read."""
    if table == "frames":
        part = {"frame": np.arange(lo, hi)}
        if "num_persons" in wanted:
            part["num_persons"] = archive.rows("num_persons", lo, hi).astype("i8")
        if "primary" in wanted:
            part["primary"] = archive.rows("kpt_primary", lo, hi).astype("i8")
        yield part
        return
    boxes = table == "detections"
    offsets = archive.rows("det_offsets" if boxes else "kpt_offsets", lo, hi + 1)
    if (lo == 0 and offsets[0] != 0) or (np.diff(offsets) < 0).any():
        raise ValueError("offsets must start at 0 and not fall")
    first, last = int(offsets[0]), int(offsets[-1])
    frame = lo + np.repeat(np.arange(hi - lo), np.diff(offsets))
    place = np.arange(first, last) - offsets[frame - lo]
    step = BLOCK if boxes else 2048
    for a in range(first, last, step):
        b = min(a + step, last)
        here = slice(a - first, b - first)
        part = {"frame": frame[here]}
        if boxes:
            part["det"] = place[here]
            if {"x1", "y1", "x2", "y2"} & set(wanted):
                xy = archive.rows("det_boxes", a, b)
                part |= {c: xy[:, i] for i, c in enumerate(("x1", "y1", "x2", "y2"))}
            if "score" in wanted:
                part["score"] = archive.rows("det_scores", a, b)
            if "flags" in wanted:
                part["flags"] = archive.rows("det_flags", a, b).astype("i4")
        else:
            part["pos"] = place[here]
            if "det" in wanted:
                part["det"] = archive.rows("kpt_det", a, b).astype("i8")
            if "kpts" in wanted:
                part["kpts"] = np.ascontiguousarray(archive.rows("kpts", a, b)).reshape(b - a, -1)
        yield part


def video_columns(archive: Archive, stem: str) -> dict[str, list]:
    lacking = [k for k in MEMBERS if k not in archive.info]
    if lacking:
        raise ValueError(f"missing members {lacking}")
    for k in MEMBERS:
        archive.member(k) if archive.info[k].compress_type == zipfile.ZIP_STORED else None
    if archive.one("video_id") != stem:
        raise ValueError(f"the file holds video {archive.one('video_id')}")
    size, fps = archive.rows("frame_size"), archive.rows("fps")
    return {"width": [int(size[0])], "height": [int(size[1])], "fps_num": [int(fps[0])], "fps_den": [int(fps[1])], "n_frames": [archive.one("num_frames")], **{k: [archive.one(k)] for k in ("primary_rule", "meta", "provenance")}}


# ---- the data source


@dataclass
class Block(InputPartition):
    """Part ``k`` of ``of`` equal ranges of a file's frames; the range is settled by the task, which reads the number of frames."""

    path: str
    video: str
    k: int
    of: int

    def __init__(self, path: str, video: str, k: int, of: int):
        super().__init__(0)
        self.path, self.video, self.k, self.of = path, video, k, of


class RecordReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.folder, self.table = options["path"], options.get("table", "detections")
        self.block = int(options.get("block_bytes", PARTITION_BYTES))
        self.sound_only = str(options.get("sound_only", "false")).lower() == "true"
        self.names = schema.fieldNames()
        self.arrow = schema
        self.videos: set[str] | None = None
        self.frames = [0, None]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and membership of video_id choose files, bounds of frame choose rows; all else stays with Spark."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name == "video_id" and isinstance(f, EqualTo | In):
                found = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.videos = found if self.videos is None else self.videos & found
            elif name == "frame" and self.table not in ("videos", "rates") and isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
                v = int(f.value)
                lo = {EqualTo: v, GreaterThan: v + 1, GreaterThanOrEqual: v}.get(type(f), 0)
                hi = {EqualTo: v + 1, LessThan: v, LessThanOrEqual: v + 1}.get(type(f))
                self.frames[0] = max(self.frames[0], lo)
                self.frames[1] = hi if self.frames[1] is None else min(self.frames[1], hi) if hi is not None else self.frames[1]
            else:
                yield f

    def partitions(self) -> list[Block]:
        """From the listing alone: a file of many bytes is several ranges of frames."""
        out = []
        for path, video, size in record_paths(self.folder):
            if self.videos is None or video in self.videos:
                n = 1 if self.table in ("videos", "rates") else max(1, -(-size // self.block))
                out += [Block(path, video, k, n) for k in range(n)]
        return out

    def read(self, block: Block) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.arrow)
        store, at = _store(block.path)
        with store.open_input_file(at) as raw:
            try:
                archive = Archive(raw)
                if self.sound_only and next(faults_of(archive, block.video), None) is not None:
                    return
                if self.table == "rates":
                    fps = archive.rows("fps")
                    parts = iter([{"fps_num": [int(fps[0])], "fps_den": [int(fps[1])]}])
                else:
                    if archive.one("schema_version") != VERSION:
                        raise ValueError(f"schema_version isn't {VERSION}")
                    if self.table == "videos":
                        parts = iter([video_columns(archive, block.video)])
                    else:
                        n = archive.one("num_frames")
                        lo, hi = n * block.k // block.of, n * (block.k + 1) // block.of
                        lo, hi = max(lo, self.frames[0]), hi if self.frames[1] is None else min(hi, self.frames[1])
                        parts = block_columns(archive, self.table, self.names, lo, hi) if lo < hi else iter([])
                for p in parts:
                    size = len(next(iter(p.values())))
                    cols = [pa.repeat(pa.scalar(block.video), size) if c == "video_id" else lists(p[c]) if c == "kpts" else pa.array(p[c]) for c in self.names]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
            except (ValueError, zipfile.BadZipFile) as e:
                raise ValueError(f"{block.path}: {e}") from e


def lists(rows: np.ndarray) -> pa.ListArray:
    """A list of numbers for each row."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)), pa.array(rows.reshape(-1)))


def record_paths(folder: str) -> list[tuple[str, str, int]]:
    """(path, video, bytes) of a plain folder of .npz files, or of the versions that markers name where the folder has markers."""
    from pyarrow import fs

    store, base = _store(folder)
    uri = lambda p: (folder.split("://")[0] + "://" + p.lstrip("/") if "://" in folder and not folder.startswith("file:") else f"file://{p}")
    if store.get_file_info(f"{base}/done").type == fs.FileType.NotFound:
        files = store.get_file_info(fs.FileSelector(base)) if store.get_file_info(base).type != fs.FileType.NotFound else []
        return sorted((uri(f.path), f.base_name[:-4], f.size) for f in files if f.base_name.endswith(".npz") and not f.base_name.startswith("."))
    out = []
    for f in store.get_file_info(fs.FileSelector(f"{base}/done")):
        if f.base_name.endswith(".json") and not f.base_name.startswith("."):
            with store.open_input_stream(f.path) as s:
                m = json.loads(s.read())
            out.append((uri(f"{base}/files/{m['video_id']}/{m['version']}.npz"), m["video_id"], m["bytes"]))
    return sorted(out)


KEYS = {"video_id": "string", "frame": "long", "det": "long"}
CHUNK_SCHEMA = "video_id string, frame long, det long, x1 float, y1 float, x2 float, y2 float, score float, flags int, is_primary boolean, kpts array<float>"
#: Columns of a staged chunk.
CHUNK_COLUMNS = [*(x.split(" ")[0] for x in CHUNK_SCHEMA.split(", ")), "posed"]


class RecordFiles(DataSource):
    """``record_files``: options path, table (frames, detections, posed, videos, rates), columns (comma-separated, default all)."""

    @classmethod
    def name(cls) -> str:
        return "record_files"

    def schema(self) -> str:
        kind = TABLES[self.options.get("table", "detections")][0]
        keep = self.options.get("columns")
        fields = dict(x.strip().split(" ", 1) for x in kind.split(", "))
        return ", ".join(f"{k} {fields[k]}" for k in (keep.split(",") if keep else fields))

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> ChunkWriter:
        names = [f.name for f in schema]
        if names[: len(CHUNK_COLUMNS)] not in (CHUNK_COLUMNS[:-1], CHUNK_COLUMNS):
            raise ValueError(f"columns must be {CHUNK_SCHEMA}, and may be followed by posed and what late keypoints are computed from")
        return ChunkWriter(self.options["path"], self.options["job"])


def read_records(spark: SparkSession, folder: str, table: str, columns: list[str] | None = None, sound_only: bool = False) -> DataFrame:
    """A table of record files. Filters on video_id and frame reach the files (this switches on pushdown to Python sources for the session).

    sound_only: archives with a fault of structure are passed over instead of being an error."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RecordFiles)
    reader = spark.read.format("record_files").option("path", qualified(spark, folder)).option("table", table).option("sound_only", sound_only)
    return (reader.option("columns", ",".join(columns)) if columns else reader).load()


def qualified(spark: SparkSession, folder: str) -> str:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


# ---- two-phase writes


@dataclass
class Chunks(WriterCommitMessage):
    """Staged chunks of a task: (video, first frame, last frame, rows, file)."""

    chunks: list[tuple]


class ChunkWriter(DataSourceArrowWriter):
    """Phase one: tasks stage chunks as Arrow files; the job's commit lists them in one file, its abort removes them."""

    def __init__(self, folder: str, job: str):
        self.folder, self.job = folder, job

    @property
    def work(self) -> str:
        return f"{_store(self.folder)[1]}/work/{self.job}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Chunks:
        store, _ = _store(self.folder)
        store.create_dir(self.work, recursive=True)
        chunks: list[list] = []
        out = sink = None
        for b in batches:
            if "posed" not in b.schema.names:
                b = b.append_column("posed", b.column("kpts").is_valid())  # which rows have keypoints is known without reading them
            videos = b.column(0).to_pylist()
            cuts = [0, *(i for i in range(1, len(videos)) if videos[i] != videos[i - 1]), len(videos)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                part = b.slice(lo, hi - lo)
                if not chunks or chunks[-1][0] != videos[lo]:
                    if out is not None:
                        out.close(), sink.close()
                    name = f"{uuid.uuid4().hex}.arrow"  # a task that is run again stages files of its own
                    sink = store.open_output_stream(f"{self.work}/{name}")
                    out = pa.ipc.new_file(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression="lz4"))
                    chunks.append([videos[lo], part.column(1)[0].as_py(), 0, 0, name])
                out.write_batch(part)
                chunks[-1][2] = part.column(1)[-1].as_py()
                chunks[-1][3] += part.num_rows
        if out is not None:
            out.close(), sink.close()
        return Chunks([tuple(c) for c in chunks])

    def commit(self, messages: list[Chunks | None]) -> None:
        put_whole(self.folder, f"{self.work}/chunks.json", json.dumps(sorted(c for m in messages if m for c in m.chunks)))

    def abort(self, messages: list[Chunks | None]) -> None:
        store, _ = _store(self.folder)
        if store.get_file_info(self.work).type.name != "NotFound":
            store.delete_dir(self.work)


def put_whole(folder: str, path: str, text: str) -> None:
    """A small file that appears whole, in the place of an older one."""
    store, _ = _store(folder)
    draft = f"{posixpath.dirname(path)}/.{uuid.uuid4().hex}"
    store.create_dir(posixpath.dirname(path), recursive=True)
    with store.open_output_stream(draft) as out:
        out.write(text.encode())
    store.move(draft, path)


#: The steps of a video's publication, in order; a test stops before each.
STEPS = ("assemble", "file", "marker", "clean")


def dense(found: Iterator[tuple[np.ndarray, np.ndarray]], t: int, fill: int, put: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> Iterator[np.ndarray]:
    """A number for each of t frames, in blocks: fill, and what ``put(block, places, values)`` makes of the (frames, values) found, whose frames ascend."""
    lo, now = 0, np.full(min(FRAMES, t), fill, "i8")
    for frame, value in found:
        a = 0
        while a < len(frame):
            b = int(np.searchsorted(frame, lo + len(now)))
            put(now, frame[a:b] - lo, value[a:b])
            if b < len(frame):
                yield now
                lo, now = lo + len(now), np.full(min(FRAMES, t - lo - len(now)), fill, "i8")
            a = b
    yield now
    for lo in range(lo + len(now), t, FRAMES):
        yield np.full(min(FRAMES, t - lo), fill, "i8")


def in_order(chunks: list[tuple]) -> list[tuple]:
    return sorted(chunks, key=lambda c: (c[1], c[2]))


def assemble(folder: str, work: str, video: dict, chunks: list[tuple], target: str, late: Iterator[pa.Array] | None = None) -> None:
    """Phase two, first half: one archive from staged chunks, member by member, of which one batch of a chunk is in memory at a time, and one block of frames.

    late: the keypoints of the posed rows in order, where chunks have none."""
    store, _ = _store(folder)
    chunks = in_order(chunks)
    t = int(video["n_frames"])
    if chunks and not 0 <= chunks[0][1] <= chunks[-1][2] < t:
        raise ValueError(f"{video['video_id']}: a detection lies outside the video's frames")

    def parts(*columns: str) -> Iterator[pa.Table]:
        for c in chunks:
            with store.open_input_file(f"{work}/{c[4]}") as f:
                r = pa.ipc.open_file(f, options=pa.ipc.IpcReadOptions(included_fields=[CHUNK_COLUMNS.index(c) for c in columns]))
                for i in range(r.num_record_batches):
                    yield r.get_batch(i).select(list(columns))

    n = m = 0
    last = (-1, -1)
    for p in parts("frame", "det", "posed"):
        frame, d = np.asarray(p.column(0)), np.asarray(p.column(1))
        if not len(frame):
            continue
        step = np.diff(frame)
        if ((step < 0) | ((step == 0) & (np.diff(d) < 0))).any() or (int(frame[0]), int(d[0])) < last:
            raise ValueError(f"{video['video_id']}: chunks aren't in order")
        last = (int(frame[-1]), int(d[-1]))
        n, m = n + len(frame), m + int(np.asarray(p.column(2)).sum())

    def counts(column: str | None = None, kept: Callable[[np.ndarray], np.ndarray] = lambda x: x) -> Iterator[np.ndarray]:
        """Rows of each frame, or those whose column is kept."""
        batches = parts("frame", *([column] if column else []))
        found = (np.asarray(p.column(0))[kept(np.asarray(p.column(1)))] if column else np.asarray(p.column(0)) for p in batches)
        return dense(((f, f) for f in found), t, 0, lambda now, at, _: np.add.at(now, at, 1))

    def primary() -> Iterator[np.ndarray]:
        """The place of each frame's primary row among its posed rows."""

        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            now, before = -1, 0  # the last frame of the batches so far, and its posed rows
            for p in parts("frame", "is_primary", "posed"):
                frame, has = np.asarray(p.column(0)), np.asarray(p.column(2))
                if len(frame):
                    main = np.flatnonzero(np.asarray(p.column(1)) & has)
                    upto = np.cumsum(has) - has
                    yield frame[main], upto[main] - upto[np.searchsorted(frame, frame[main])] + np.where(frame[main] == now, before, 0)
                    before = int(has[np.searchsorted(frame, frame[-1]) :].sum()) + (before if frame[-1] == now else 0)
                    now = int(frame[-1])

        return dense(found(), t, -1, lambda now, at, place: now.__setitem__(at, place))

    def starts(each: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
        yield np.zeros(1, "i8")
        before = 0
        for c in each:
            yield before + np.cumsum(c)
            before += int(c.sum())

    single = lambda a: iter([np.asarray(a)])

    def kpt_det() -> Iterator[np.ndarray]:
        at = 0
        for p in parts("posed"):
            yield (at + np.flatnonzero(np.asarray(p.column(0)))).astype("i4")
            at += p.num_rows

    def column(name: str, kind: str) -> Iterator[np.ndarray]:
        return (np.asarray(p.column(0)).astype(kind) for p in parts(name))

    def numbers() -> Iterator[np.ndarray]:
        seen = 0
        for p in (p.column(0) for p in parts("kpts")) if late is None else late:
            rows = np.asarray(p.drop_null().flatten(), dtype="f4").reshape(-1, 133, 3)
            seen += len(rows)
            yield rows
        if seen != m:
            raise ValueError(f"{video['video_id']}: {seen} rows have keypoints, {m} are posed")

    boxes = lambda: (np.stack([np.asarray(c) for c in p.columns], 1).astype("f4") for p in parts("x1", "y1", "x2", "y2"))
    members = {
        "schema_version": ((), single(np.array(VERSION, "i8"))), "video_id": ((), single(np.array(video["video_id"]))), "frame_size": ((2,), single(np.array([video["width"], video["height"]], "i8"))),
        "fps": ((2,), single(np.array([video["fps_num"], video["fps_den"]], "i8"))), "num_frames": ((), single(np.array(t, "i8"))), "det_offsets": ((t + 1,), starts(counts())),
        "det_boxes": ((n, 4), boxes()), "det_scores": ((n,), column("score", "f4")), "det_flags": ((n,), column("flags", "u1")), "num_persons": ((t,), (np.minimum(c, 255).astype("u1") for c in counts("flags", lambda x: (x & COUNTED) != 0))),
        "kpt_offsets": ((t + 1,), starts(counts("posed"))), "kpt_det": ((m,), kpt_det()), "kpts": ((m, 133, 3), numbers()), "kpt_primary": ((t,), (c.astype("i1") for c in primary())),
        **{k: ((), single(np.array(video[k] or "{}"))) for k in ("primary_rule", "meta", "provenance")},
    }
    store.create_dir(posixpath.dirname(target), recursive=True)
    with store.open_output_stream(target) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        for name, (shape, blocks) in members.items():
            kind = MEMBERS[name][0]
            first = next(blocks, None)
            dtype = first.dtype if kind == "U" else np.dtype(kind)
            with z.open(zipfile.ZipInfo(f"{name}.npy", (1980, 1, 1, 0, 0, 0)), "w", force_zip64=True) as f:
                np.lib.format.write_array_header_1_0(f, {"descr": np.lib.format.dtype_to_descr(dtype), "fortran_order": False, "shape": shape})
                while first is not None:
                    f.write(np.ascontiguousarray(first).tobytes())
                    first = next(blocks, None)


def removed(store, path: str) -> None:
    """Deletes a draft that may not be there."""
    if store.get_file_info(path).type.name != "NotFound":
        store.delete_file(path)


def publish(folder: str, work: str, video: dict, chunks: list[tuple], stop_before: str | None = None, late: Iterator[pa.Array] | None = None) -> dict:
    """Phase two for one video: assemble, put the file in its place, then the marker, then remove older versions. Any prefix of it can be
    done again: a job has one version of a video, which a task that is run again finds in its place, and what a job that stopped left without
    a marker goes before another file is made. Two jobs mustn't publish a video at the same time."""

    def step(name: str) -> None:
        if name == stop_before:
            raise InterruptedError(name)

    from pyarrow import fs

    store, base = _store(folder)
    name, version = video["video_id"], posixpath.basename(work)
    marker, at = f"{base}/done/{name}.json", f"{base}/files/{name}"
    target = f"{at}/{version}.npz"

    def clean(*kept: str) -> None:
        for f in store.get_file_info(fs.FileSelector(at, allow_not_found=True)):
            if f.base_name not in kept:
                store.delete_file(f.path)

    named = ""
    if store.get_file_info(marker).type != fs.FileType.NotFound:
        with store.open_input_stream(marker) as f:
            named = json.loads(f.read())["version"]
    clean(f"{named}.npz", f"{version}.npz")
    step("assemble")
    if store.get_file_info(target).type == fs.FileType.NotFound:
        draft = f"{work}/{name}.{uuid.uuid4().hex[:8]}.npz"
        try:
            assemble(folder, work, video, chunks, draft, late)
            step("file")
            store.create_dir(at, recursive=True)
            store.move(draft, target)
        except BaseException:
            removed(store, draft)
            raise
    size = store.get_file_info(target).size
    step("marker")
    put_whole(folder, marker, json.dumps({"video_id": name, "version": version, "bytes": size, "n_frames": int(video["n_frames"])}, sort_keys=True))
    step("clean")
    clean(f"{version}.npz")
    return {"video_id": name, "bytes": size, "n_frames": int(video["n_frames"])}


def dealt_rows(detections: DataFrame, late: dict[str, Column] | None = None) -> DataFrame:
    """Rows of chunks in order, dealt by ranges of (video, frame). late: columns that are computed from a row's others once it is dealt, so that no shuffle or sort carries them;
    those that chunks lack follow the others. Numbers that an archive holds as floats stay doubles if they come as such."""
    late = late or {}
    rows = detections.withColumns({c: F.col(c).cast(k) for c, k in KEYS.items()}).repartitionByRange("video_id", "frame").sortWithinPartitions(*KEYS)
    have = dict(detections.dtypes)
    kinds = {c: "double" if k == "float" and have.get(c) == "double" and c not in late else k for c, k in (x.split(" ") for x in CHUNK_SCHEMA.split(", "))}
    return rows.select(*[late.get(c, F.col(c)).cast(k).alias(c) for c, k in kinds.items()], *[x.alias(c) for c, x in late.items() if c not in kinds])


def staged_rows(detections: DataFrame, late: dict[str, Column] | None = None) -> DataFrame:
    """Rows of chunks as they are staged. Late keypoints, which are some 50 times a row's other bytes, aren't: only whether a row has any (late's ``posed``, or else what the
    keypoints say) and, as ``given``, the columns that chunks lack or hold in another type, so that ``archived`` can compute them from the staged row."""
    if not late or "kpts" not in late:
        return dealt_rows(detections, late)
    late = {**late, "kpts": F.array(), "posed": F.coalesce(late.get("posed", late["kpts"].isNotNull()), F.lit(False))}
    same = dealt_rows(detections, late).dtypes  # empty lists, as Arrow takes the square of the rows' number for a column of null ones
    given = [c for c, k in detections.dtypes if (c, k) not in same and c not in KEYS]
    return dealt_rows(detections, late | ({"given": F.struct(*given)} if given else {}))


def staged_jobs(videos: DataFrame, detections: DataFrame, folder: str, strict: bool = False, late: dict[str, Column] | None = None) -> tuple[DataFrame, str, str]:
    """Phase one: detections staged in chunks, dealt by ranges of (video, frame), so that a long video is staged by several tasks. Gives videos with their chunks, the folder
    qualified, and the work folder within it. strict: a video that isn't in exactly one row is an error once its row is read by ``jobs_of``. late: as in ``staged_rows``."""
    spark = videos.sparkSession
    folder, job = qualified(spark, folder), uuid.uuid4().hex[:12]
    spark.dataSource.register(RecordFiles)
    with shuffles_dropped(spark):
        staged_rows(detections, late).write.format("record_files").mode("append").option("path", folder).option("job", job).save()
    work = f"{_store(folder)[1]}/work/{job}"
    listed = spark.read.option("wholetext", True).text(f"{folder}/work/{job}/chunks.json").select(F.explode(F.from_json("value", "array<array<string>>")).alias("c"))
    staged = listed.select(F.col("c")[0].alias("video_id"), F.struct(F.col("c")[1].cast("long").alias("first"), F.col("c")[2].cast("long").alias("last"), F.col("c")[4].alias("file")).alias("chunk")).groupBy("video_id").agg(F.collect_list("chunk").alias("chunks"))
    times = F.count("*").over(Window.partitionBy("video_id")) if strict else F.lit(1)
    jobs = videos.withColumn("times", times).join(staged, "video_id", "full" if strict else "left")
    return jobs.repartition(tasks(spark), "video_id"), folder, work  # a fixed number: rows of few bytes would be put into one task, which would write all videos


def jobs_of(f) -> Iterator[tuple[dict, list[tuple]]]:
    """Videos of a pandas frame of ``staged_jobs`` with their chunks as ``assemble`` takes them."""
    for v in f.to_dict("records"):
        if v["times"] != 1:
            raise ValueError(f"{v['video_id']}: each video needs exactly one row")
        yield v, [] if v["chunks"] is None else [(v["video_id"], c["first"], c["last"], 0, c["file"]) for c in v["chunks"]]


def archived(jobs: DataFrame, folder: str, work: str, detections: DataFrame, late: dict[str, Column] | None, put: Callable) -> DataFrame:
    """(video_id, bytes, n_frames): what ``put(video, chunks, keypoints)`` gives for each video of ``staged_jobs``.

    Late keypoints are computed where the archive is written and lie nowhere else: a task reads a video's posed rows from its chunks, Spark computes their keypoints, and the
    same task writes them, as a stream. keypoints is None where chunks have them."""
    out = "video_id string, bytes long, n_frames long"
    names = [x.split(" ")[0] for x in out.split(", ")]
    if not late or "kpts" not in late:

        def whole(frames):
            import pandas as pd

            for f in frames:
                yield pd.DataFrame([put(v, chunks, None) for v, chunks in jobs_of(f)], columns=names)

        return jobs.mapInPandas(whole, out)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StringType, StructField, StructType

    kind = StructType([StructField("job_", StringType()), *(StructField(f.name, f.dataType) for f in detections.withColumns({c: F.col(c).cast(k) for c, k in KEYS.items()}).schema)])
    schema = to_arrow_schema(kind)

    def posed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row that holds a video's job, and then its posed rows as they were given."""
        store, _ = _store(folder)
        for b in batches:
            for v, chunks in jobs_of(b.to_pandas()):
                job = json.dumps([{k: x for k, x in v.items() if k != "chunks"}, chunks])
                yield pa.RecordBatch.from_arrays([pa.array([job]), *(pa.nulls(1, f.type) for f in list(schema)[1:])], schema=schema)
                for c in in_order(chunks):
                    with store.open_input_file(f"{work}/{c[4]}") as f:
                        fields = pa.ipc.open_file(f).schema.names
                        f.seek(0)
                        r = pa.ipc.open_file(f, options=pa.ipc.IpcReadOptions(included_fields=[i for i, x in enumerate(fields) if x != "kpts"]))
                        for i in range(r.num_record_batches):
                            p = r.get_batch(i)
                            p = p.filter(p.column("posed"))
                            own = {x.name: p.column("given").field(k) for k, x in enumerate(r.schema.field("given").type)} if "given" in fields else {}
                            if p.num_rows:
                                cols = [own[x.name] if x.name in own else p.column(x.name) for x in list(schema)[1:]]
                                yield pa.RecordBatch.from_arrays([pa.nulls(p.num_rows, pa.string()), *(x.cast(y.type) for x, y in zip(cols, list(schema)[1:], strict=True))], schema=schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for job, keypoints in by_job(batches):
            v, chunks = json.loads(job)
            done = put(v, chunks, keypoints)
            for _ in keypoints:  # of an archive that was there already
                pass
            yield pa.RecordBatch.from_pylist([done], pa.schema([("video_id", pa.string()), ("bytes", pa.int64()), ("n_frames", pa.int64())]))

    points = F.when(F.col("job_").isNull(), late["kpts"]).cast("array<float>")
    return jobs.mapInArrow(posed, kind).select("job_", points.alias("kpts")).mapInArrow(write, out)


def by_job(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[pa.Array]]]:
    """From batches of (job, value): each job, and the values of the rows up to the next one. The values of a job are to be read before the next is asked for."""
    rest = None

    def more() -> bool:
        nonlocal rest
        while rest is None or not rest.num_rows:
            rest = next(batches, None)
            if rest is None:
                return False
        return True

    def values() -> Iterator[pa.Array]:
        nonlocal rest
        while more():
            heads = np.flatnonzero(np.asarray(rest.column(0).is_valid()))
            n = int(heads[0]) if len(heads) else rest.num_rows
            part, rest = rest.slice(0, n), rest.slice(n)
            if n:
                yield part.column(1)
            if len(heads):
                return

    batches = iter(batches)
    while more():
        job, rest = rest.column(0)[0].as_py(), rest.slice(1)
        yield job, values()


def commit_records(videos: DataFrame, detections: DataFrame, folder: str, stop_before: str | None = None, late: dict[str, Column] | None = None) -> DataFrame:
    """Writes records in two phases; gives back (video_id, bytes, n_frames) of what was published, as a table.

    videos, detections and late are as in ``archives.write_archives``. Phase one stages chunks, phase two publishes each video by itself. A job that fails leaves videos in
    their old or their new state and removes what it staged; writing again repairs the rest."""
    spark = videos.sparkSession
    jobs, folder, work = staged_jobs(videos, detections, folder, late=late)

    def put(v: dict, chunks: list[tuple], keypoints) -> dict:
        return publish(folder, work, v, chunks, stop_before, keypoints)

    out = f"{folder}/work/{posixpath.basename(work)}-published"
    try:
        archived(jobs, folder, work, detections, late, put).write.parquet(out)
    finally:
        _store(folder)[0].delete_dir(work)
    return spark.read.parquet(out)


# ---- checksums

_POLY = 0xEDB88320


def _times(matrix: list[int], v: int) -> int:
    out, i = 0, 0
    while v:
        if v & 1:
            out ^= matrix[i]
        v, i = v >> 1, i + 1
    return out


_ZEROS: list[list[int]] = []  # a plain list: a decorated function would only unpickle where the package can be imported


def _zeros(j: int) -> list[int]:
    """What 2^j zero bytes do to each bit of a checksum."""
    while len(_ZEROS) <= j:
        matrix = _ZEROS[-1] if _ZEROS else [_POLY, *(1 << i for i in range(31))]  # one zero bit
        for _ in range(1 if _ZEROS else 3):  # eight of them: one zero byte
            matrix = [_times(matrix, x) for x in matrix]
        _ZEROS.append(matrix)
    return _ZEROS[j]


def shifted_crc(crc: int, n: int) -> int:
    """What a checksum becomes when n zero bytes follow, less what those add by themselves: CRC(a + b) is shifted_crc(CRC(a), len(b)) xor CRC(b)."""
    j = 0
    while n:
        if n & 1:
            crc = _times(_zeros(j), crc)
        n, j = n >> 1, j + 1
    return crc


def crc_members(spark: SparkSession, folder: str, block: int = CRC_BLOCK, only: DataFrame | None = None) -> DataFrame:
    """(path, member, stored, crc32, problem) for each member of the archives of a folder (or of those whose path ``only`` lists).

    A stored member is read in blocks by many tasks; blocks that follow each other, up to CRC_BLOCK bytes, are one row and one sum. Its checksum is shifted by the bytes that follow
    it, so that the member's checksum is the exclusive or of them in any order. A compressed member is read by one task, as a stream."""
    run = block * max(1, CRC_BLOCK // block)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").option("recursiveFileLookup", True).load(folder).select("path")
    if only is not None:
        files = files.join(only.select("path").distinct(), "path", "left_semi")

    def members(frames):
        import pandas as pd

        for f in frames:
            for path in f["path"]:
                store, at = _store(path)
                rows = []
                with store.open_input_file(at) as raw:
                    try:
                        archive = Archive(raw)
                    except zipfile.BadZipFile as e:
                        yield pd.DataFrame({"path": [path], "member": [""], "stored": [None], "start": [-1], "size": [0], "packed": [False], "problem": [str(e)]})
                        continue
                    for name, i in archive.info.items():
                        try:
                            start, problem = archive.data_start(name), None
                            if start + i.compress_size > raw.size():
                                problem = "runs past the end of the file"
                        except (ValueError, struct.error) as e:
                            start, problem = -1, str(e)
                        rows.append((path, name, i.CRC, start, i.file_size, i.compress_type != zipfile.ZIP_STORED, problem))
                yield pd.DataFrame(rows, columns=["path", "member", "stored", "start", "size", "packed", "problem"])

    m = files.mapInPandas(members, "path string, member string, stored long, start long, size long, packed boolean, problem string")
    k = F.when(F.col("packed") | F.col("problem").isNotNull(), 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("size") / run)))
    blocks = m.select("*", F.explode(F.sequence(F.lit(0), k.cast("int") - 1)).alias("k")).repartition("path", "member", "k")

    def sums(frames):
        for f in frames:
            out = []
            for path, name, start, size, packed, problem, k in zip(f["path"], f["member"], f["start"], f["size"], f["packed"], f["problem"], f["k"], strict=True):
                if problem is not None:
                    out.append((0, problem))
                    continue
                store, file = _store(path)
                with store.open_input_file(file) as raw:
                    try:
                        if packed:
                            crc, z = 0, Archive(raw)
                            with z.zip.open(z.info[name]) as member:
                                while part := member.read(1 << 20):
                                    crc = zlib.crc32(part, crc)
                        else:
                            at, hi, crc = k * run, min((k + 1) * run, size), 0
                            raw.seek(start + at)
                            while at < hi and (part := raw.read(min(block, hi - at))):
                                crc, at = zlib.crc32(part, crc), at + len(part)
                            crc = shifted_crc(crc, size - at)
                        out.append((crc, None))
                    except (zipfile.BadZipFile, EOFError, NotImplementedError, RuntimeError, zlib.error) as e:
                        out.append((0, str(e) or type(e).__name__))
            yield f[["path", "member", "stored"]].assign(crc=[c for c, _ in out], problem=[p for _, p in out])

    got = blocks.mapInPandas(sums, "path string, member string, stored long, crc long, problem string")
    got = got.groupBy("path", "member").agg(F.max("stored").alias("stored"), F.bit_xor("crc").alias("crc32"), F.max("problem").alias("problem"))
    wrong = F.when(F.col("stored") != F.col("crc32"), F.lit("CRC-32 differs"))
    return got.select("path", "member", "stored", "crc32", F.coalesce("problem", wrong).alias("problem"))


def crc_problems(spark: SparkSession, folder: str, block: int = CRC_BLOCK) -> DataFrame:
    """(path, member, problem) of members that fail on each of up to CRC_READS reads; only files that failed are read again."""
    bad = None
    for _ in range(CRC_READS):
        now = crc_members(spark, folder, block, bad).where("problem is not null").select("path", "member", "problem")
        bad = settled(now if bad is None else now.join(bad.select("path", "member"), ["path", "member"], "left_semi"))
        if bad.limit(1).count() == 0:
            break
    return bad


def faults_of(archive: Archive, stem: str) -> Iterator[str]:
    """What is wrong with an archive's members; boxes and keypoints aren't read."""
    lacking = [k for k in MEMBERS if k not in archive.info]
    if lacking:
        yield f"missing members {lacking}"
        return
    shape = {}
    for k in MEMBERS:
        try:
            shape[k] = archive.member(k).shape
        except ValueError as e:
            yield str(e)
    if len(shape) < len(MEMBERS):
        return
    t, n, m = archive.one("num_frames"), shape["det_boxes"][0], shape["kpts"][0]
    if archive.one("schema_version") != VERSION:
        yield f"schema_version isn't {VERSION}"
    if archive.one("video_id") != stem:
        yield "another video's file"
    if t < 1:
        yield "no frames"
    rows = {"det_scores": ("det_boxes", n), "det_flags": ("det_boxes", n), "kpt_det": ("kpts", m), "num_persons": ("num_frames", t), "kpt_primary": ("num_frames", t), "det_offsets": ("num_frames", t + 1), "kpt_offsets": ("num_frames", t + 1)}
    wrong = [k for k, (_, size) in rows.items() if shape[k][0] != size]
    yield from (f"{k} has another number of rows than {rows[k][0]}" for k in wrong)
    if shape["frame_size"] != (2,) or (archive.rows("frame_size") < 1).any():
        yield "bad frame size"
    if shape["fps"] != (2,) or (archive.rows("fps") < 1).any():
        yield "bad rate"
    if wrong:
        return
    for k, size in (("det_offsets", n), ("kpt_offsets", m)):
        x = archive.rows(k)
        if x[0] != 0 or (np.diff(x) < 0).any():
            yield f"{k} doesn't rise from 0"
        elif x[-1] != size:
            yield f"{k} does not end at its rows"
    det = archive.rows("kpt_det")
    if m and not (0 <= det.min() and det.max() < n):
        yield "kpt_det outside the detections"
    primary = archive.rows("kpt_primary").astype("i8")
    if ((primary < -1) | (primary >= np.diff(archive.rows("kpt_offsets")))).any():
        yield "primary outside the posed rows"


def structure_problems(spark: SparkSession, folder: str) -> DataFrame:
    """(video_id, problem) of archives whose members have wrong types, shapes or indices: what makes other checks meaningless.

    Headers, offsets and numbers a frame or row are read, boxes and keypoints aren't."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").option("recursiveFileLookup", True).load(folder).select("path")

    def run(frames):
        import pandas as pd

        for f in frames:
            out = []
            for path in f["path"]:
                store, at = _store(path)
                stem = posixpath.basename(at)[:-4]
                with store.open_input_file(at) as raw:
                    try:
                        out += [(stem, p) for p in faults_of(Archive(raw), stem)]
                    except (zipfile.BadZipFile, ValueError, struct.error) as e:
                        out.append((stem, str(e)))
            yield pd.DataFrame(out, columns=["video_id", "problem"])

    return files.mapInPandas(run, "video_id string, problem string")


def check(spark: SparkSession, folder: str, pick=None, crc: bool = True, records: bool = True, skip: tuple[str, ...] = ()) -> DataFrame:
    """(video_id, problem, n) of a folder of archives: structure, checksums (crc), and the frames of records of sound structure (records), whose rule picks by
    ``pick``; ``skip``: checks of frames that are left out."""
    from ..operators.audit import frames_of, local_posed, record_checks, tally

    out = structure_problems(spark, folder).select("video_id", "problem", F.lit(1).cast("long").alias("n"))
    if crc:
        bad = crc_problems(spark, folder)
        out = out.union(bad.select(F.regexp_extract("path", r"([^/]+)\.npz$", 1), F.concat("member", F.lit(": "), "problem"), F.lit(1).cast("long")))
    if records:
        of = lambda table, columns: read_records(spark, folder, table, columns, sound_only=True)
        d = of("detections", None)
        rows = frames_of(of("frames", None), d, local_posed(of("posed", ["video_id", "frame", "pos", "det"]), d))
        checks = {k: v for k, v in record_checks(pick).items() if k not in skip}
        out = out.union(tally(rows, checks).select("video_id", F.col("check").alias("problem"), "n"))
    return out


#: Bytes that are copied at a time.
COPY = 8 << 20


def rewritten(path: str, write: Callable) -> None:
    """Puts what ``write(raw, out)`` makes of a file in its place, once it is whole."""
    store, at = _store(path)
    draft = f"{posixpath.dirname(at)}/.{uuid.uuid4().hex}"
    try:
        with store.open_input_file(at) as raw, store.open_output_stream(draft) as out:
            write(raw, out)
        store.move(draft, at)
    except BaseException:
        removed(store, draft)
        raise


def few_at_once(files: DataFrame) -> DataFrame:
    """Files dealt over so few tasks that at most a quarter of them lie on disk twice while they are rewritten."""
    return files.repartition(max(1, min(tasks(files.sparkSession), files.count() // 4)))


def flip_bit(files: DataFrame) -> None:
    """Damages stored members (path, member): one bit of the number in the middle is flipped. For tests of what should find it."""

    def run(frames):
        for f in frames:
            for path, name in zip(f["path"], f["member"], strict=True):

                def write(raw, out):
                    m = Archive(raw).member(name)
                    at, done = m.at + m.dtype.itemsize * (int(np.prod(m.shape)) // 2), 0
                    raw.seek(0)
                    while part := bytearray(raw.read(COPY)):
                        if done <= at < done + len(part):
                            part[at - done] ^= 1
                        out.write(bytes(part))
                        done += len(part)

                rewritten(path, write)
            yield f

    files.mapInPandas(run, "path string, member string").count()


def damage(files: DataFrame) -> None:
    """Rewrites archives (path, kind) with a fault of structure: scores, offsets, rate or primary. For tests of what should find it.

    The member with the fault is held whole (a number a frame or row), the others are copied in blocks, and few archives at a time."""

    def faulty(kind: str, a: np.ndarray) -> np.ndarray:
        if kind == "scores":
            return a[:-1]
        a = a.copy()
        at, value = {"offsets": (-1, a[-1] + 1), "rate": (1, 0), "primary": (0, 100)}[kind]
        a[at] = value
        return a

    def run(frames):
        import shutil

        for f in frames:
            for path, kind in zip(f["path"], f["kind"], strict=True):
                hurt = {"scores": "det_scores", "offsets": "det_offsets", "rate": "fps", "primary": "kpt_primary"}.get(kind)

                def write(raw, out):
                    archive = Archive(raw)
                    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
                        for name, info in archive.info.items():
                            with z.open(zipfile.ZipInfo(info.filename, info.date_time), "w", force_zip64=True) as member:
                                if name == hurt:
                                    np.lib.format.write_array(member, faulty(kind, archive.rows(name)))
                                else:
                                    with archive.zip.open(info) as stored:
                                        shutil.copyfileobj(stored, member, COPY)

                rewritten(path, write)
            yield f

    few_at_once(files).mapInPandas(run, "path string, kind string").count()
