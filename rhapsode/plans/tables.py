"""Queries over whole tables: sources and sinks, captions, metadata, splits, state, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import strings as S
from ..functions import timing as T
from ..operators import incremental as I
from ..operators import joins as J
from ..operators import report as R
from ..operators import runs as U
from ..operators.stage import settled
from ..sources import archives as A
from ..sources import captions as C
from ..sources import recordfiles as B
from ..sources import records as P
from .fixtures import Tables
from .frames import COUNT, nms_sql
from .registry import query
from .scalars import CLEAN, CLOCK
from .series import ISLANDS, joined, merged

# ---- sources and sinks


def record_parts(t: Tables) -> tuple[DataFrame, DataFrame, dict[str, Column]]:
    """Videos and detections of record files, and the keypoints. The first detection of a frame is its primary, posed where its score is above 0.9."""
    n = t.frames.groupBy("video_id").agg((F.max("frame") + 1).alias("n_frames"))
    v = F.col("video_id")
    kind = v % 3
    videos = n.select(F.concat(F.lit("v"), v.cast("string")).alias("video_id"), (640 + v).alias("width"), (480 + v).alias("height"), F.when(kind == 0, 25).when(kind == 1, 30000).otherwise(24).alias("fps_num"), F.when(kind == 1, 1001).otherwise(1).alias("fps_den"), "n_frames", F.lit("first").alias("primary_rule"), F.lit("{}").alias("meta"), F.lit("{}").alias("provenance"))
    first = F.col("det") == 0
    points = F.transform(F.sequence(F.lit(0), F.lit(398)), lambda i: (F.col("x1") + i).cast("float"))
    d = _record(t).select(F.concat(F.lit("v"), v.cast("string")).alias("video_id"), "frame", "det", "x1", "y1", "x2", "y2", "score", "flags", first.alias("is_primary"))
    posed = first & (F.col("score") > 0.9)
    return videos, d, {"kpts": F.when(posed, points), "posed": posed}


def archives(t: Tables) -> tuple[str, DataFrame]:
    """A folder of record files of all videos, and their markers."""
    path = scratch(t, "archives")
    videos, d, points = record_parts(t)
    return path, A.write_archives(videos, d, path, points)


@query("src_persons", "select 'v' || video_id as video_id, frame, det, x1::float::double as x1, y2::float::double as y2, score::float::double as score from det", "det")
def src_persons(t: Tables) -> DataFrame:
    """Record files written and read back by blocks of frames; all members, the version, types and shapes are checked."""
    path, _ = archives(t)
    known = settled(B.read_records(t.spark, path, "videos", ["video_id"]))
    known = F.broadcast(known) if known.count() <= 200_000 else known
    d = B.read_records(t.spark, path, "detections", ["video_id", "frame", "det", "x1", "y2", "score"]).join(known, "video_id", "left_semi")
    return d.select("video_id", "frame", "det", *[F.col(c).cast("double").alias(c) for c in ("x1", "y2", "score")])


@query("src_fps_only", "select distinct 'v' || video_id as video_id, cast(case cast(video_id % 3 as int) when 0 then 25 when 1 then 30000 else 24 end as bigint) as fps_num, cast(case cast(video_id % 3 as int) when 1 then 1001 else 1 end as bigint) as fps_den from frames", "frames")
def src_fps_only(t: Tables) -> DataFrame:
    """Only the member with the rate is read."""
    return B.read_records(t.spark, archives(t)[0], "rates")


@query("sink_persons", "select video_id, frame, num_persons from (select video_id, frame, video_id + frame % 3 as num_persons from frames)", "frames")
def sink_persons(t: Tables) -> DataFrame:
    """A round trip through the record tables."""
    path = scratch(t, "record")
    P.write_record({"frames": t.frames.withColumn("num_persons", F.col("video_id") + F.col("frame") % 3)}, path)
    return P.read_record(t.spark, path, "frames").select(F.col("video_id").cast("long").alias("video_id"), "frame", "num_persons")


def scratch(t: Tables, name: str) -> str:
    """A new folder in the shared work folder (spark.checkpoint.dir); where that is unset, a temporary one in local mode, and an error on a cluster."""
    import tempfile
    import uuid

    root = t.spark.conf.get("spark.checkpoint.dir", None)
    if not root and not t.spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{root}/frames/{name}-{uuid.uuid4().hex[:12]}" if root else f"file://{tempfile.mkdtemp(prefix='frames-')}/{name}"


@query("sink_spill", "select 'v' || video_id as video_id, count(*) as n_rows, count(*) filter (where det = 0 and score > 0.9) as n_posed, count(distinct frame) as n_frames from det group by video_id", "det")
def sink_spill(t: Tables) -> DataFrame:
    """Records staged in chunks by ranges of frames, assembled one archive a video, and read back."""
    path = scratch(t, "spill")
    videos, d, points = record_parts(t)
    B.commit_records(videos, d, path, late=points)
    posed = B.read_records(t.spark, path, "posed", ["video_id", "frame"]).groupBy("video_id").agg(F.count("*").alias("n_posed"))
    d = B.read_records(t.spark, path, "detections", ["video_id", "frame"]).groupBy("video_id").agg(F.count("*").alias("n_rows"), F.count_distinct("frame").alias("n_frames"))
    return d.join(posed, "video_id", "left").select("video_id", "n_rows", F.coalesce("n_posed", F.lit(0)).alias("n_posed"), "n_frames")


@query("src_probe", "select video_id, width, height, fps_num, fps_den, nb_frames, case when video_id % 7 = 0 then 'no video stream' when video_id % 11 = 0 then 'variable frame rate' end as problem from (select video_id, case when video_id % 7 <> 0 then width end as width, case when video_id % 7 <> 0 then height end as height, case when video_id % 7 <> 0 then fps_num end as fps_num, case when video_id % 7 <> 0 then fps_den end as fps_den, case when video_id % 7 <> 0 then nb_frames end as nb_frames from clips)", "clips")
def src_probe(t: Tables) -> DataFrame:
    """Probe texts of all clips, some without a stream or with a rate that varies."""
    n = F.col("video_id")
    rate = F.concat_ws("/", (F.col("fps_num") * 2).cast("string"), (F.col("fps_den") * 2).cast("string"))
    other = F.concat_ws("/", (F.col("fps_num") * 2 + 1).cast("string"), (F.col("fps_den") * 2).cast("string"))
    stream = F.struct("width", "height", rate.alias("r_frame_rate"), F.when(n % 11 == 0, other).otherwise(rate).alias("avg_frame_rate"), F.col("nb_frames").cast("string").alias("nb_frames"))
    text = F.to_json(F.struct(F.filter(F.array(F.when(n % 7 != 0, stream)), lambda x: x.isNotNull()).alias("streams")))
    return P.probed(t.clips.select("video_id", text.alias("value")), strict=False)


@query("src_decode", "select c.video_id, c.nb_frames as expected, coalesce(f.n, 0) as decoded from clips c left join (select video_id, count(*) as n from frames group by video_id) f on c.video_id = f.video_id where c.nb_frames <> coalesce(f.n, 0)", "clips frames")
def src_decode(t: Tables) -> DataFrame:
    """Videos whose frames are not exactly as many as the container says (with strict on, an error)."""
    return P.decoded_counts(t.clips.select("video_id", F.col("nb_frames").alias("expected")), t.frames, strict=False)


def vtt_files(t: Tables) -> DataFrame:
    """A WebVTT text of each conversation, with a note and ids."""
    c = t.cues.where("end_ms > start_ms")
    b = F.concat(F.when(F.col("seq") % 3 == 0, F.concat(F.lit("cue "), F.col("seq").cast("string"), F.lit("\n"))).otherwise(""), T.format_millis(F.col("start_ms")), F.lit(" --> "), T.format_millis(F.col("end_ms")), F.lit(" align:start\n"), F.substring(F.regexp_replace("text", r"\s+", " "), 1, 40))
    parts = F.array_sort(F.collect_list(F.struct("seq", b.alias("b"))))
    return c.groupBy("video_id").agg(F.concat(F.lit("WEBVTT head\n\nNOTE a note\nof two lines\n\n"), F.array_join(F.transform(parts, lambda p: p["b"]), "\n \t\n")).alias("text"))


@query("src_vtt", "select video_id, start_ms, end_ms, trim(substr(regexp_replace(text, '\\s+', ' ', 'g'), 1, 40)) as text from cues where end_ms > start_ms", "cues")
def src_vtt(t: Tables) -> DataFrame:
    return C.in_millis(C.cues_of(vtt_files(t), "video_id")).select("video_id", "start_ms", "end_ms", F.trim("text").alias("text"))


KEPT = f"k as (select video_id, track, seq, start_ms, end_ms, replace({CLEAN}, '-->', '->') as text from cues where end_ms > start_ms and {CLEAN} <> '')"


@query("clean_cues", f"with {KEPT} select video_id, track, seq, text from k", "cues")
def clean_cues(t: Tables) -> DataFrame:
    return C.cleaned(t.cues).select("video_id", "track", "seq", "text")


VTT = f"{KEPT}, v as (select video_id, track, 'WEBVTT' || chr(10) || chr(10) || string_agg({CLOCK.format('start_ms')} || ' --> ' || {CLOCK.format('end_ms')} || chr(10) || text || chr(10), chr(10) order by seq) as vtt from k group by video_id, track)"


@query("sink_vtt", f"with {VTT} select video_id, track, vtt from v", "cues")
def sink_vtt(t: Tables) -> DataFrame:
    return C.vtt_texts(C.cleaned(t.cues), ["video_id", "track"])


@query("cue_counts", f"select track, sum(case when end_ms > start_ms and {CLEAN} <> '' then 1 else 0 end)::bigint as kept, sum(case when end_ms > start_ms and {CLEAN} <> '' then 0 else 1 end)::bigint as dropped from cues group by track", "cues")
def cue_counts(t: Tables) -> DataFrame:
    return C.dropped(t.cues, ["track"])


@query("sink_subs", f"""with {VTT}, old as (select video_id, track, case when video_id % 4 = 0 then vtt || ' ' else vtt end as vtt from v where video_id % 3 <> 0 union all select -1, 'gone', 'x'),
    j as (select coalesce(v.video_id, o.video_id) as video_id, coalesce(v.track, o.track) as track, case when v.vtt is null then 'delete' when v.vtt = o.vtt then 'keep' else 'write' end as action from v full join old o on v.video_id = o.video_id and v.track = o.track) select track, action, count(*) as files from j group by track, action""", "cues")
def sink_subs(t: Tables) -> DataFrame:
    v = C.vtt_texts(C.cleaned(t.cues), ["video_id", "track"]).select(F.struct("video_id", "track").alias("k"), "vtt")
    gone = t.spark.sql("select named_struct('video_id', -1L, 'track', 'gone') k, 'x' vtt")
    n = F.col("k.video_id")
    old = v.where(n % 3 != 0).withColumn("vtt", F.when(n % 4 == 0, F.concat("vtt", F.lit(" "))).otherwise(F.col("vtt"))).union(gone)
    return P.changed_only(v, old, "k", "vtt").groupBy("k.track", "action").agg(F.count("*").alias("files"))


@query("sink_splits", "select 'splits' as file, split, count(*) as videos, min(video_id) as first_id from splits group by split union all select 'splits_manual', split, count(*), min(video_id) from splits where video_id % 2 = 0 group by split", "splits")
def sink_splits(t: Tables) -> DataFrame:
    """Split files of two names written over older ones, and read back."""
    path = scratch(t, "split-files")
    s = t.splits.select(F.lit("").alias("name"), "video_id", "split")
    P.write_splits(s.limit(1).withColumn("name", F.lit("stale")), path)
    P.write_splits(s.union(s.where("video_id % 2 = 0").withColumn("name", F.lit("manual"))), path)
    files = t.spark.read.schema("video_id long, split string, file string").csv(path, header=True)
    return files.groupBy("file", "split").agg(F.count("*").alias("videos"), F.min("video_id").alias("first_id"))


@query("split_counts", "select coalesce(nullif(split, 'BUILDING'), '(none)') as split, count(*) as videos from splits group by 1", "splits")
def split_counts(t: Tables) -> DataFrame:
    s = F.coalesce(F.nullif(F.col("split"), F.lit("BUILDING")), F.lit("(none)"))
    return t.splits.groupBy(s.alias("split")).agg(F.count("*").alias("videos"))


SPAN_TEXT = "string_agg('[' || cast(cast(a as bigint) as varchar) || ', ' || cast(cast(b as bigint) as varchar) || ']', ', ' order by a)"


@query("sink_meta_files", f"""with {merged('spans')}, x as (select video_id, '[' || {SPAN_TEXT} || ']' as spans from m group by video_id) select s.split, s.video_id, coalesce(x.spans, '[]') as unreliable_spans from splits s join clips c on s.video_id = c.video_id left join x on s.video_id = x.video_id""", "spans splits clips")
def sink_meta_files(t: Tables) -> DataFrame:
    spans = U.as_text(U.merged_spans(t.spans), "video_id", "spans")
    rows = t.splits.join(t.clips.select("video_id"), "video_id").join(spans, "video_id", "left")
    path = scratch(t, "meta-files")
    rows.select("split", "video_id", F.coalesce("spans", F.lit("[]")).alias("unreliable_spans")).write.partitionBy("split").csv(path, header=True, quote='"', escape='"')
    return t.spark.read.schema("video_id long, unreliable_spans string, split string").csv(path, header=True, quote='"', escape='"')


@query("sink_index", "select video_id, split, 'n/' || cast(video_id as varchar) as source, case when video_id % 2 = 0 then cast(width as varchar) else '' end as width, case when video_id % 3 = 0 then name else '' end as name from clips", "clips")
def sink_index(t: Tables) -> DataFrame:
    n = F.col("video_id")
    info = F.map_from_entries(F.filter(F.array(F.struct(F.lit("width").alias("k"), F.when(n % 2 == 0, F.col("width").cast("string")).alias("v")), F.struct(F.lit("name").alias("k"), F.when(n % 3 == 0, F.col("name")).alias("v"))), lambda e: e["v"].isNotNull()))
    v = t.clips.select("video_id", "split", F.concat(F.lit("n/"), n.cast("string")).alias("source"), info.alias("info"))
    keys = [r["k"] for r in v.select(F.explode(F.map_keys("info")).alias("k")).distinct().orderBy("k").limit(1001).collect()]  # column names, not rows
    if len(keys) > 1000:
        raise ValueError("more than 1000 different info names: not a table of columns")
    return v.select("video_id", "split", "source", *[F.coalesce(F.col("info")[k], F.lit("")).alias(k) for k in keys])


@query("src_tsv", "select video_id, name as video_name, cast(split_part(name, '#', 2) as bigint) as number from clips", "clips")
def src_tsv(t: Tables) -> DataFrame:
    path = scratch(t, "tsv")
    c = t.clips
    rows = c.select(F.col("video_id").cast("string").alias("VIDEO_ID"), F.col("name").alias("VIDEO_NAME"), F.translate("name", "#", "_").alias("SENTENCE_ID"), *[F.lit("x").alias(k) for k in P.SENTENCE_COLUMNS[3:]])
    rows.write.csv(path, sep="\t", header=True, quote="")
    s = P.read_sentences(t.spark, path)
    return s.select(F.col("VIDEO_ID").cast("long").alias("video_id"), F.col("VIDEO_NAME").alias("video_name"), F.substring_index("SENTENCE_ID", "_", -1).cast("long").alias("number"))


def _listed(t: Tables) -> DataFrame:
    """(split, id): some ids are in two splits."""
    s = t.splits.union(t.splits.where("video_id % 5 = 0").select("video_id", F.lit("MACHINERY")))
    return s.select("split", F.col("video_id").cast("string").alias("id"))


FIRST = "with s as (select video_id, split from splits union select video_id, 'MACHINERY' from splits where video_id % 5 = 0), r as (select *, case split when 'MACHINERY' then 1 when 'AUTOMOBILE' then 2 else 3 end as k from s) select cast(video_id as varchar) as id, arg_min(split, struct_pack(k := k, s := split)) as split from r group by video_id"


@query("src_json_splits", FIRST, "splits")
def src_json_splits(t: Tables) -> DataFrame:
    """JSON texts {split: [id, ...]}, several of each split, written and read back."""
    path = scratch(t, "splits")
    part = F.pmod(F.xxhash64("id"), F.lit(16))
    listed = _listed(t).distinct().groupBy("split", part.alias("part")).agg(F.collect_list("id").alias("ids"))
    listed.select(F.to_json(F.create_map("split", "ids"))).write.text(path)
    return P.split_ids(t.spark.read.text(path), ("MACHINERY", "AUTOMOBILE"))


@query("first_split_wins", FIRST, "splits")
def first_split_wins(t: Tables) -> DataFrame:
    return P.first_split(_listed(t), ("MACHINERY", "AUTOMOBILE"))


def _meta_rows(t: Tables) -> DataFrame:
    c = t.clips
    return c.select(F.concat(F.lit("v"), F.col("video_id").cast("string")).alias("video_id"), F.col("width").cast("int").alias("width"), F.when(F.col("video_id") % 4 != 0, F.col("video_id") / 7).alias("undetected_ratio"))


@query("src_meta_json_dir", "select 'v' || cast(video_id as varchar) as video_id, cast(width as int) as width, round(case when video_id % 4 <> 0 then video_id / 7 end, 6) as undetected_ratio from clips", "clips")
def src_meta_json_dir(t: Tables) -> DataFrame:
    """A folder with a file for each video, written and read back."""
    path = scratch(t, "rows")
    P.write_meta_rows(_meta_rows(t), path)
    got = P.read_meta_rows(t.spark, path, "video_id string, width int, undetected_ratio double")
    return got.select("video_id", "width", F.round("undetected_ratio", 6).alias("undetected_ratio"))


@query("src_video_meta", "select 'v' || cast(video_id as varchar) as video_id, cast(width as int) as width, round(case when video_id % 4 <> 0 then cast(printf('%.4f', video_id / 7) as double) end, 4) as undetected_ratio, 'note, \"' || cast(video_id as varchar) || '\"' as note from clips", "clips")
def src_video_meta(t: Tables) -> DataFrame:
    path = scratch(t, "meta")
    rows = _meta_rows(t).withColumn("masked_runs", F.lit("[]")).withColumn("note", F.concat(F.lit('note, "'), F.substring("video_id", 2, 9), F.lit('"')))
    P.write_meta_table(rows, path)
    m = P.read_meta_table(t.spark, path)
    return m.select("video_id", "width", "undetected_ratio", "note")


CELLS = "select 'v' || cast(video_id as varchar) as video_id, cast(width as varchar) as width, case when video_id % 4 <> 0 then printf('%.4f', video_id / 7) else '' end as undetected_ratio, '' as copy_of from clips"


@query("sink_video_meta", CELLS, "clips")
def sink_video_meta(t: Tables) -> DataFrame:
    return P.meta_cells(_meta_rows(t)).select("video_id", "width", "undetected_ratio", "copy_of")


@query("csv_row", "select 'v' || cast(video_id as varchar) as video_id, cast(width as int) as width, round(case when video_id % 4 <> 0 then video_id / 7 end, 6) as undetected_ratio, '[]' as switch_runs, '[]' as default_signing_runs from clips", "clips")
def csv_row(t: Tables) -> DataFrame:
    return P.csv_row(_meta_rows(t).withColumn("people", F.lit(1))).withColumn("undetected_ratio", F.round("undetected_ratio", 6))


@query("sink_failed", "select user_id as video_id, count(*) as failures from events where event_type = 'error' group by user_id")
def sink_failed(t: Tables) -> DataFrame:
    path = scratch(t, "failed")
    rows = t.events.where("event_type = 'error'").select(F.col("user_id").alias("video_id"), F.lit("decode").alias("error"), F.lit(1).alias("attempt"))
    P.append_failure(t.spark, path, rows)
    return t.spark.read.schema("video_id long, error string, attempt int").json(path).groupBy("video_id").agg(F.count("*").alias("failures"))


@query("src_gpu_csv", "select user_id % 4 as gpu, count(*) as samples, round(avg(value), 6) as util_pct from events group by 1")
def src_gpu_csv(t: Tables) -> DataFrame:
    path = scratch(t, "gpu")
    t.events.select((F.col("user_id") % 4).alias("gpu"), F.col("value").alias("util_pct"), F.lit(0).alias("memory_mib"), F.col("ts").alias("time")).write.csv(path, header=True)
    s = t.spark.read.schema("gpu long, util_pct double, memory_mib long, time string").csv(path, header=True)
    return s.groupBy("gpu").agg(F.count("*").alias("samples"), F.round(F.avg("util_pct"), 6).alias("util_pct"))


@query("sink_report", "select video_id, count(*) as n from det group by video_id", "det")
def sink_report(t: Tables) -> DataFrame:
    path = scratch(t, "report")
    t.det.groupBy("video_id").agg(F.count("*").alias("n")).select(F.to_json(F.struct("video_id", "n")).alias("value")).write.text(path)
    return t.spark.read.text(path).select(F.from_json("value", "video_id long, n long").alias("r")).select("r.*")


@query("sink_render", "select video_id, frame, det, cast(round(x1) as int) as x1, cast(round(y1) as int) as y1, cast(round(x2) as int) as x2, cast(round(y2) as int) as y2, case when det = 0 then 'primary' else 'other' end as style from det where score > 0.3", "det")
def sink_render(t: Tables) -> DataFrame:
    """The draw list of each frame; drawing and encoding are out of scope."""
    return t.det.where("score > 0.3").select("video_id", "frame", "det", *[F.round(c).cast("int").alias(c) for c in ("x1", "y1", "x2", "y2")], F.when(F.col("det") == 0, "primary").otherwise("other").alias("style"))


@query("crc_check", "select 'v' || video_id as video_id, case when video_id % 4 = 1 then 'det_scores' else 'det_boxes' end as member, 'CRC-32 differs' as problem from (select distinct video_id from frames where video_id % 4 in (1, 2))", "frames")
def crc_check(t: Tables) -> DataFrame:
    """Record files, of which one bit in a member of every second one or so is flipped; blocks of 4 KB are summed by tasks of their own."""
    path, _ = archives(t)
    files = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("path", F.regexp_extract("path", r"v([0-9]+)\.npz$", 1).cast("long").alias("v"))
    hurt = files.where("v % 4 in (1, 2)").select("path", F.when(F.col("v") % 4 == 1, "det_scores").otherwise("det_boxes").alias("member"))
    B.flip_bit(hurt)
    return B.crc_problems(t.spark, path, 4096).select(F.regexp_extract("path", r"([^/]+)\.npz$", 1).alias("video_id"), "member", "problem")


# ---- joins on tables

@query("annotation_join", "select c.video_id, c.name, k.seq, k.text from clips c join cues k on c.video_id = k.video_id", "clips cues")
def annotation_join(t: Tables) -> DataFrame:
    return t.clips.select("video_id", "name").join(t.cues.select("video_id", "seq", "text"), "video_id")


@query("committed_semi", "select video_id, split from splits where video_id in (select video_id from videos)", "splits videos")
def committed_semi(t: Tables) -> DataFrame:
    return t.splits.join(t.videos, "video_id", "left_semi")


@query("stale_anti", "select video_id, split from splits where video_id not in (select video_id from videos)", "splits videos")
def stale_anti(t: Tables) -> DataFrame:
    return t.splits.join(t.videos, "video_id", "left_anti")


@query("caption_source_left", "select c.video_id, coalesce(s.source, c.split) as caption_source from clips c left join (select video_id, 'human' as source from videos where video_id % 2 = 0) s on c.video_id = s.video_id", "clips videos")
def caption_source_left(t: Tables) -> DataFrame:
    s = t.videos.where("video_id % 2 = 0").select("video_id", F.lit("human").alias("source"))
    return t.clips.join(s, "video_id", "left").select("video_id", F.coalesce("source", "split").alias("caption_source"))


@query("meta_upsert", """with o as (select video_id, width, name as note, split as unreliable_spans from clips where video_id % 3 <> 0), n as (select video_id, height as width, case when video_id % 2 = 0 then '[]' end as unreliable_spans, video_id % 2 = 0 as known from clips where video_id % 5 <> 0)
    select n.video_id, n.width, case when n.known then n.unreliable_spans else o.unreliable_spans end as unreliable_spans, o.note from n left join o on n.video_id = o.video_id""", "clips")
def meta_upsert(t: Tables) -> DataFrame:
    n = F.col("video_id")
    old = t.clips.where(n % 3 != 0).select("video_id", "width", F.col("name").alias("note"), F.col("split").alias("unreliable_spans"))
    new = t.clips.where(n % 5 != 0).select("video_id", F.col("height").alias("width"), F.when(n % 2 == 0, "[]").alias("unreliable_spans"))
    return J.upsert(old, new, "video_id", {"unreliable_spans": n % 2 == 0})


@query("split_meta_join", "select s.video_id, s.split, c.width from splits s join clips c on s.video_id = c.video_id where c.width > 700", "splits clips")
def split_meta_join(t: Tables) -> DataFrame:
    return t.splits.join(t.clips.where("width > 700").select("video_id", "width"), "video_id")


# ---- the summary of a video

META = f"""with recursive {nms_sql(COUNT)}, c as (select f.video_id, f.frame as t, count(k.det) as n from frames f left join nms_k k on f.video_id = k.video_id and f.frame = k.frame group by f.video_id, f.frame),
    g as (select video_id, t, t - row_number() over (partition by video_id order by t) as g from c where n <= 1), i as (select video_id, min(t) as a, max(t) + 1 as b from g group by video_id, g), {joined(3, 3)},
    rt as (select video_id, '[' || {SPAN_TEXT} || ']' as runs from r group by video_id), s as (select video_id, count(*) as frames, round(avg(case when n = 0 then 1.0 else 0.0 end), 9) as undetected_ratio from c group by video_id)
    select s.video_id, frames, undetected_ratio, coalesce(runs, '[]') as empty_runs, cast(frames / 25 as double) as duration_s from s left join rt on s.video_id = rt.video_id"""


@query("meta_row", META, "det frames")
def meta_row(t: Tables) -> DataFrame:
    from .frames import count_per_frame

    c = count_per_frame(t)
    s = c.groupBy("video_id").agg(F.count("*").alias("frames"), F.round(F.avg((F.col("num_persons") == 0).cast("double")), 9).alias("undetected_ratio"))
    runs = U.empty_runs(c.select("video_id", F.col("frame").alias("t"), (F.col("num_persons") <= 1).alias("mask")), "mask", 3, 3)
    r = s.join(U.as_text(runs, "video_id", "empty_runs"), "video_id", "left")
    return r.select("video_id", "frames", "undetected_ratio", F.coalesce("empty_runs", F.lit("[]")).alias("empty_runs"), (F.col("frames") / 25).alias("duration_s"))


# ---- orders, sets, samples

@query("schedule", "select video_id, split, nb_frames as size from clips order by case split when 'MACHINERY' then 1 when 'BUILDING' then 2 else 3 end, size desc, video_id limit 200", "clips")
def schedule(t: Tables) -> DataFrame:
    return I.schedule(t.clips.select("video_id", "split", F.col("nb_frames").alias("size")), ("MACHINERY", "BUILDING"), 200)


@query("sort_videos", "select video_id, name from clips order by name", "clips")
def sort_videos(t: Tables) -> DataFrame:
    return t.clips.select("video_id", "name").orderBy("name")


ROUND = "r as (select video_id, split, case split when 'MACHINERY' then 1 when 'BUILDING' then 2 else 3 end as k, sha256('0/' || cast(video_id as varchar)) as h from clips), rr as (select *, row_number() over (partition by k order by h) as turn from r), ro as (select video_id, split, cast(row_number() over (order by turn, k) as int) as place from rr)"


@query("round_robin_sample", f"with {ROUND} select video_id, split, place from ro", "clips")
def round_robin_sample(t: Tables) -> DataFrame:
    return I.round_robin(t.clips.select("video_id", "split"), ("MACHINERY", "BUILDING"))


WINDOWS = """w as (select video_id, nb_frames as n, k, floor(k * nb_frames / 3)::bigint as lo, floor((k + 1) * nb_frames / 3)::bigint as hi, ('0x' || substr(sha256('0/' || cast(video_id as varchar) || '/' || cast(k as varchar)), 1, 12))::bigint as d from clips, range(0, 3) r(k) where nb_frames > 3 * 750),
    sw as (select video_id, lo + d % (hi - lo - 750 + 1) as start, 750::bigint as count from w union all select video_id, 0::bigint, nb_frames from clips where nb_frames <= 3 * 750)"""


@query("spread_windows", f"with {WINDOWS} select video_id, start, count from sw", "clips")
def spread_windows(t: Tables) -> DataFrame:
    return I.spread_windows(t.clips, 3, 750)


@query("plan_windows", f"with {ROUND}, {WINDOWS} select ro.place, sw.video_id, sw.start, sw.count from ro join sw on ro.video_id = sw.video_id where ro.place <= 20 union all select ro.place, ro.video_id, 0, c.nb_frames from ro join clips c on ro.video_id = c.video_id where ro.place in (21, 22)", "clips")
def plan_windows(t: Tables) -> DataFrame:
    order = round_robin_sample(t).select("video_id", "place")
    some = order.where("place <= 20").join(I.spread_windows(t.clips, 3, 750), "video_id")
    full = order.where("place in (21, 22)").join(t.clips, "video_id").select("video_id", "place", F.lit(0).cast("long").alias("start"), F.col("nb_frames").alias("count"))
    return some.select("place", "video_id", "start", "count").union(full.select("place", "video_id", "start", "count"))


@query("limit_first_n", "select video_id, name from clips order by video_id limit 100", "clips")
def limit_first_n(t: Tables) -> DataFrame:
    return t.clips.select("video_id", "name").orderBy("video_id").limit(100)


@query("unique_ids", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def unique_ids(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("set_operations", "select video_id, 'only' as kind from (select video_id from splits except select video_id from videos) union all select video_id, 'both' from (select video_id from splits intersect select video_id from videos)", "splits videos")
def set_operations(t: Tables) -> DataFrame:
    s, v = t.splits.select("video_id"), t.videos.select("video_id")
    return s.exceptAll(v).distinct().withColumn("kind", F.lit("only")).union(s.intersect(v).withColumn("kind", F.lit("both")))


@query("union", "select video_id, 'splits' as origin from splits union all select video_id, 'videos' from videos", "splits videos")
def union(t: Tables) -> DataFrame:
    return t.splits.select("video_id", F.lit("splits").alias("origin")).unionByName(t.videos.select("video_id", F.lit("videos").alias("origin")))


# ---- state

@query("resume_action", """select c.video_id, case when c.video_id % 7 = 0 or c.video_id % 11 = 0 or c.nb_frames % 13 = 0 then 'extract' when c.video_id % 5 = 0 or c.video_id % 17 = 0 then 'derive' else 'skip' end as action from clips c""", "clips")
def resume_action(t: Tables) -> DataFrame:
    n = F.col("video_id")
    wanted = t.clips.select("video_id", F.lit("e1").alias("extraction_hash"), F.lit("d1").alias("derivation_hash"), F.col("nb_frames").alias("bytes"), (n % 17 != 0).alias("has_meta"))
    done = t.clips.where(n % 7 != 0).select("video_id", F.when(n % 11 == 0, "e0").otherwise("e1").alias("done_extraction"), F.when(n % 5 == 0, "d0").otherwise("d1").alias("done_derivation"), (F.col("nb_frames") + F.when(F.col("nb_frames") % 13 == 0, 1).otherwise(0)).alias("done_bytes"))
    return I.resume_action(wanted, done)


OUTCOME = "case event_type when 'error' then 'failed' when 'purchase' then 'ok' else 'suspected' end"


@query("retry_policy", f"""with a as (select user_id as video_id, {OUTCOME} as o from events), g as (select video_id, count(*) filter (where o = 'ok') as oks, count(*) filter (where o = 'failed') as failures, count(*) filter (where o = 'suspected') as suspicions from a group by video_id)
    select video_id, failures, suspicions, case when oks > 0 then 'done' when failures >= 2 or suspicions >= 2 then 'failed' else 'queued' end as status from g""")
def retry_policy(t: Tables) -> DataFrame:
    e = F.col("event_type")
    o = F.when(e == "error", "failed").when(e == "purchase", "ok").otherwise("suspected")
    return I.retry_policy(t.events.select(F.col("user_id").alias("video_id"), o.alias("outcome")))


@query("watchdog", """with g as (select user_id, ts, epoch_us(lead(ts) over (partition by user_id order by ts)) - epoch_us(ts) as us from events), s as (select user_id, ts, us, epoch_us(ts) as at_us from g where us > 600000000),
    n as (select *, count(*) over (partition by user_id order by at_us range between 604800000000 preceding and current row) as recent from s)
    select user_id, ts as last_seen, us // 1000000 as silence_s, recent, max(case when recent > 3 then 1 else 0 end) over (partition by user_id order by at_us range between unbounded preceding and current row) = 0 as allowed from n""")
def watchdog(t: Tables) -> DataFrame:
    """Silences of more than 600 seconds, and whether the respawn after each is within three a week."""
    silent = I.silent_periods(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", 600)
    return I.respawns(silent, "user_id", "last_seen", 600, 3, 7 * 86_400).withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz"))


@query("freshness_check", "select video_id, case when video_id % 5 = 0 then 'delete' when video_id % 3 = 0 then 'write' else 'keep' end as action from clips", "clips")
def freshness_check(t: Tables) -> DataFrame:
    n = F.col("video_id")
    now = t.clips.where(n % 5 != 0).select("video_id", F.crc32(F.concat_ws("/", "name", F.col("width").cast("string"))).alias("crc"))
    old = t.clips.select("video_id", (F.crc32(F.concat_ws("/", "name", F.col("width").cast("string"))) + F.when(n % 3 == 0, 1).otherwise(0)).alias("crc"))
    return P.changed_only(now, old, "video_id", "crc").select("video_id", "action")


@query("exactly_once_commit", "select 'v' || video_id as video_id, count(*) as n_rows, round(sum(x1::float::double), 6) as x1, 1 as n_files from det where det < 2 group by video_id", "det")
def exactly_once_commit(t: Tables) -> DataFrame:
    """Records committed, committed again with fewer rows by a job that stops before its markers, and then by one that doesn't: one version of each video is left."""
    path = scratch(t, "commit")
    videos, d, points = record_parts(t)
    B.commit_records(videos, d, path, late=points)
    for stop in ("marker", None):
        try:
            B.commit_records(videos, d.where("det < 2"), path, stop_before=stop, late=points)
        except Exception as e:
            if stop is None or "InterruptedError" not in str(e):
                raise
    files = t.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.npz").load(f"{path}/files")
    n = files.select(F.regexp_extract("path", "/([^/]+)/[^/]+$", 1).alias("video_id")).groupBy("video_id").agg(F.count("*").cast("int").alias("n_files"))
    rows = B.read_records(t.spark, path, "detections", ["video_id", "x1"]).groupBy("video_id").agg(F.count("*").alias("n_rows"), F.round(F.sum(F.col("x1").cast("double")), 6).alias("x1"))
    return rows.join(n, "video_id").select("video_id", "n_rows", "x1", "n_files")


# ---- checks

def _record(t: Tables) -> DataFrame:
    bit = lambda c, v: F.when(c, v).otherwise(0)
    s = F.col("score")
    odd = (F.col("video_id") + F.col("frame") + F.col("det")) % 50 != 0
    return t.det.withColumn("flags", bit(s > 0.3, 1).bitwiseOR(bit(s > 0.45, 2)).bitwiseOR(bit((F.col("det") < 3) & odd, 4)))


#: Faults of the stored record by arithmetic on frames: a score that rises, a count off by one, a posed row that lacks, one that is another, a primary off by one.
FAULTS = {"scores": 31, "persons": 37, "fewer": 41, "other": 43, "primary": 47}
AUDIT = f"""r as (select *, score + case when frame % {FAULTS['scores']} = 0 and det = 1 then 2 else 0 end as s, (x2 - x1) * (y2 - y1) as area, (score > 0.3) as f1, (score > 0.45) as f2, (det < 3 and (video_id + frame + det) % 50 <> 0) as f4 from det),
    b as (select *, lag(s) over (partition by video_id, frame order by det) as before, row_number() over (partition by video_id, frame order by case when f1 then 0 else 1 end, area desc, det) as rank, sum(f4::int) over (partition by video_id, frame order by det) as np from r),
    d as (select video_id, frame, bool_or(s > before) as rises, bool_or(f4 and not f1) as outside, count(*) filter (f2) as counted, count(*) filter (f4) as posed, max(det) filter (rank = 1 and f1) as chosen, bool_or(f4) filter (rank = 1 and f1) as chosen_posed, max(np - 1) filter (rank = 1 and f1) as place from b group by video_id, frame),
    g as (select f.video_id, f.frame, coalesce(rises, false) as rises, coalesce(outside, false) as outside, coalesce(counted, 0) as counted, coalesce(posed, 0) as posed, chosen, coalesce(chosen_posed, false) as cp, place,
    case when f.frame % {FAULTS['fewer']} = 0 then greatest(coalesce(posed, 0) - 1, 0) else coalesce(posed, 0) end as kept, f.frame % {FAULTS['other']} = 0 as other from frames f left join d on d.video_id = f.video_id and d.frame = f.frame),
    h as (select *, coalesce(case when chosen is not null and cp and not other and place < kept then place end, -1) as spot, coalesce(case when chosen is not null and cp then place end, -1) + case when frame % {FAULTS['primary']} = 0 then 1 else 0 end as prim from g),
    c as (select video_id, frame, unnest([case when rises then 'scores rise' end, case when outside then 'posed outside the pose set' end, case when frame % {FAULTS['persons']} = 0 then 'num_persons' end, case when posed <> kept then 'number of posed rows' end, case when posed = kept and kept > 0 and other then 'posed rows' end,
    case when prim < -1 or prim >= kept then 'primary outside the posed rows' end, case when chosen is not null and spot < 0 then 'pick isn''t posed' end, case when (chosen is null or spot >= 0) and spot <> prim then 'primary isn''t the pick' end]) as check from h)"""


def _stored(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frames, detections and posed rows of a record with FAULTS: posed rows other than theirs are numbered 100 higher."""
    from pyspark.sql import Window

    from ..operators.audit import largest

    r = _record(t)
    w = Window.partitionBy("video_id", "frame").orderBy("det")
    posed = r.where(F.col("flags").bitwiseAND(4) != 0).withColumn("pos", F.row_number().over(w) - 1)
    n = r.groupBy("video_id", "frame").agg(F.array_sort(F.collect_list(F.struct("det", "score", "flags", "x1", "y1", "x2", "y2"))).alias("d"))
    chosen = n.select("video_id", "frame", F.size(F.filter("d", lambda x: x["flags"].bitwiseAND(2) != 0)).alias("counted"), largest(F.col("d")).alias("det"))
    at = chosen.join(posed.select("video_id", "frame", "det", "pos"), ["video_id", "frame", "det"], "left")
    off = lambda k: (F.col("frame") % FAULTS[k] == 0).cast("int")
    frames = t.frames.join(at, ["video_id", "frame"], "left").select("video_id", "frame", (F.coalesce("counted", F.lit(0)) + off("persons")).alias("num_persons"), (F.coalesce("pos", F.lit(-1)) + off("primary")).alias("primary"))
    last = F.lead("pos").over(w).isNull()
    kept = posed.withColumn("last", last).where(~F.col("last") | (off("fewer") == 0))
    return frames, r.withColumn("score", F.col("score") + F.when(F.col("det") == 1, off("scores") * 2).otherwise(0)), kept.select("video_id", "frame", "pos", (F.col("det") + 100 * off("other")).alias("det"))


@query("record_problems", f"with {AUDIT} select video_id, \"check\", count(*) as n, array_to_string(list(frame order by frame)[1:5], ',') as first from c where \"check\" is not null group by video_id, \"check\"", "det frames")
def record_problems(t: Tables) -> DataFrame:
    """All checks of all frames in one pass, over a record with faults of each kind."""
    from ..operators.audit import record_problems as audit

    return audit(*_stored(t)).withColumn("first", F.concat_ws(",", "first"))


STRUCTURE = """case video_id % 5 when 1 then 'det_scores has another number of rows than det_boxes' when 2 then 'det_offsets does not end at its rows' when 3 then 'bad rate' when 4 then 'primary outside the posed rows' end"""


@query("structure_problems", f"select 'v' || video_id as video_id, {STRUCTURE} as problem from (select distinct video_id from frames) where video_id % 5 <> 0", "frames")
def structure_problems(t: Tables) -> DataFrame:
    """Record files with a fault of structure in all but every fifth: lengths, offsets, rates, primaries."""
    return B.structure_problems(t.spark, _faulty(t))


def _faulty(t: Tables) -> str:
    path, _ = archives(t)
    files = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("path", F.regexp_extract("path", r"v([0-9]+)\.npz$", 1).cast("long").alias("v"))
    kind = F.element_at(F.array(F.lit("scores"), F.lit("offsets"), F.lit("rate"), F.lit("primary")), (F.col("v") % 5).cast("int"))
    B.damage(files.where("v % 5 <> 0").select("path", kind.alias("kind")))
    return path


@query("check", f"""with p as (select 'v' || video_id as video_id, video_id as v, {STRUCTURE} as problem from (select distinct video_id from frames)), d as (select 'v' || f.video_id as video_id, count(*) as n from frames f left join (select video_id, frame, max(case when score > 0.9 then 1 else 0 end) as posed from det where det = 0 group by video_id, frame) x on x.video_id = f.video_id and x.frame = f.frame where coalesce(posed, 0) = 0 and x.frame is not null and f.video_id % 5 = 0 group by f.video_id)
    select video_id, problem, 1::bigint as n from p where problem is not null union all select video_id, 'pick isn''t posed', n from d""", "frames det")
def check(t: Tables) -> DataFrame:
    """Structure, checksums, and the checks of records of sound structure, which lack a posed pick where its score is low."""
    from ..operators.audit import first_listed

    return B.check(t.spark, _faulty(t), pick=first_listed, skip=("posed outside the pose set", "number of posed rows", "posed rows", "scores rise"))


@query("rule_primary", "with k as (select *, row_number() over (partition by video_id, frame order by (x2 - x1) * (y2 - y1) desc, det) as a from det where score > 0.3) select video_id, frame, det, det >= 3 as not_posed from k where a = 1", "det")
def rule_primary(t: Tables) -> DataFrame:
    from ..operators.select import LARGEST, pick

    return pick(t.det.where("score > 0.3"), LARGEST).withColumn("not_posed", F.col("det") >= 3)


@query("file_problems", "select 'v' || video_id as video_id, case when video_id = 3 then 'size' when video_id = 4 then 'frames' else 'no marker' end as problem from (select distinct video_id from frames where video_id in (3, 4, 5)) union all select 'gone', 'missing'", "frames")
def file_problems(t: Tables) -> DataFrame:
    """Markers of the record files, four of them wrong, against the files."""
    path, markers = archives(t)
    v = F.col("video_id")
    wrong = markers.where(v != "v5").select("video_id", (F.col("bytes") + (v == "v3").cast("int")).alias("bytes"), (F.col("n_frames") + (v == "v4").cast("int")).alias("n_frames"))
    return A.file_problems(wrong.union(t.spark.sql("select 'gone', 1L, 1L")), path)


@query("derivation_problems", "select video_id from clips where video_id % 6 = 0", "clips")
def derivation_problems(t: Tables) -> DataFrame:
    n = F.col("video_id")
    want = S.commit_hash({"w": F.col("width")}, F.lit("largest_bbox"))
    have = S.commit_hash({"w": F.col("width") + F.when(n % 6 == 0, 1).otherwise(0)}, F.lit("largest_bbox"))
    return t.clips.where(want != have).select("video_id")


@query("dataset_contract", "select video_id, 'id' as problem from clips where not regexp_full_match(name, '[A-Za-z0-9._-]+') union all select video_id, 'split' from clips where split not in ('MACHINERY', 'BUILDING', 'AUTOMOBILE') union all select video_id, 'frames' from clips where expected_frames < 1000", "clips")
def dataset_contract(t: Tables) -> DataFrame:
    c = t.clips
    a = c.where(~S.id_valid(F.col("name"))).select("video_id", F.lit("id").alias("problem"))
    b = c.where(~F.col("split").isin("MACHINERY", "BUILDING", "AUTOMOBILE")).select("video_id", F.lit("split").alias("problem"))
    return a.union(b).union(c.where("expected_frames < 1000").select("video_id", F.lit("frames").alias("problem")))


@query("holds_poses", "select 'v' || video_id as video_id, frame, video_id = 2 as differs from det where det = 0 and score > 0.9", "det")
def holds_poses(t: Tables) -> DataFrame:
    """Posed rows of the record files against rows computed again, bit for bit; one video is computed otherwise."""
    stored = B.read_records(t.spark, archives(t)[0], "posed", ["video_id", "frame", "kpts"]).select("video_id", "frame", F.xxhash64("kpts").alias("stored"))
    v = F.concat(F.lit("v"), F.col("video_id").cast("string"))
    d = t.det.where("det = 0 and score > 0.9").select(v.alias("video_id"), "frame", (F.col("x1") + (F.col("video_id") == 2).cast("int")).alias("x1"))
    points = F.transform(F.sequence(F.lit(0), F.lit(398)), lambda i: (F.col("x1") + i).cast("float"))
    again = d.select("video_id", "frame", F.xxhash64(points).alias("again"))
    return again.join(stored, ["video_id", "frame"], "full").select("video_id", "frame", (~F.col("stored").eqNullSafe(F.col("again"))).alias("differs"))


LIM = "m as (select label as g, avg(case when score > 0.3 then 1.0 else 0.0 end) as v, avg(case when x > y then 0.4 else 0.0 end) as noise from kpts group by label)"


@query("gate_limits", f"with {LIM} select cast(g as varchar) as metric, round(v, 9) as value, round(greatest(0.3, 1.5 * noise), 9) as effective, v <= greatest(0.3::double, 1.5::double * noise) as passed from m", "kpts")
def gate_limits(t: Tables) -> DataFrame:
    return _limits(t).select("metric", F.round("value", 9).alias("value"), F.round("effective", 9).alias("effective"), "passed")


def _limits(t: Tables) -> DataFrame:
    m = t.kpts.groupBy(F.col("label").cast("string").alias("metric")).agg(F.avg((F.col("score") > 0.3).cast("double")).alias("value"), F.avg(F.when(F.col("x") > F.col("y"), 0.4).otherwise(0.0)).alias("noise"))
    measured = m.select("metric", "value", F.lit(0.3).alias("fixed"), F.lit(False).alias("strict"))
    return R.limits(measured, m.select("metric", F.col("noise").alias("value")))


@query("gate", f"with {LIM} select bool_and(v <= greatest(0.3::double, 1.5::double * noise)) as passed, cast(sum(case when v <= greatest(0.3::double, 1.5::double * noise) then 0 else 1 end) as bigint) as failed from m", "kpts")
def gate(t: Tables) -> DataFrame:
    return _limits(t).agg(F.bool_and("passed").alias("passed"), F.sum((~F.col("passed")).cast("long")).alias("failed"))


# ---- datasets

@query("list_videos_official", "select c.video_id, coalesce(s.split, '') as split, case when c.video_id % 2 = 0 then coalesce(s.split, '') else '' end as manual_split from clips c left join (select * from splits where video_id % 3 <> 0) s on c.video_id = s.video_id", "clips splits")
def list_videos_official(t: Tables) -> DataFrame:
    s = t.splits.where("video_id % 3 <> 0")
    split = F.coalesce("s", F.lit(""))
    return t.clips.select("video_id").join(s.withColumnRenamed("split", "s"), "video_id", "left").select("video_id", split.alias("split"), F.when(F.col("video_id") % 2 == 0, split).otherwise("").alias("manual_split"))


@query("list_videos_folder", "select page_id, split_part(url, '/', 4) as split, case page_id when 1 then 100 when 5 then 700 end as expected_frames from pages")
def list_videos_folder(t: Tables) -> DataFrame:
    known = t.spark.sql("select * from values (1L, 100), (5L, 700) as k(page_id, expected_frames)")
    p = t.pages.select("page_id", F.coalesce(F.get(F.split("url", "/"), F.lit(3)), F.lit("")).alias("split"))
    return p.join(F.broadcast(known), "page_id", "left")


@query("list_videos_dated", "select 'news_' || cast(2000 + video_id % 24 as varchar) || '-' || lpad(cast(1 + video_id % 12 as varchar), 2, '0') || '-' || lpad(cast(1 + video_id % 28 as varchar), 2, '0') as id, case when split = 'BUILDING' then 'dev' when split = 'MACHINERY' then 'test' else 'train' end as split from clips", "clips")
def list_videos_dated(t: Tables) -> DataFrame:
    n = F.col("video_id")
    name = F.concat_ws(" ", F.lit("x"), (1 + n % 28).cast("string"), (1 + n % 12).cast("string"), (2000 + n % 24).cast("string"))
    return t.clips.select(S.id_from_date(name, "news").alias("id"), F.when(F.col("split") == "BUILDING", "dev").when(F.col("split") == "MACHINERY", "test").otherwise("train").alias("split"))


@query("list_videos_generic", "select c.video_id, s.split from clips c left join (select * from splits where video_id % 2 = 0) s on c.video_id = s.video_id", "clips splits")
def list_videos_generic(t: Tables) -> DataFrame:
    return t.clips.select("video_id").join(t.splits.where("video_id % 2 = 0"), "video_id", "left")


@query("splits_named", "select '' as name, video_id, split from splits where split <> 'BUILDING' union all select 'manual', video_id, split from splits where video_id % 2 = 0 and split <> 'BUILDING'", "splits")
def splits_named(t: Tables) -> DataFrame:
    s = t.splits.where("split <> 'BUILDING'")
    return s.select(F.lit("").alias("name"), "video_id", "split").union(s.where("video_id % 2 = 0").select(F.lit("manual"), "video_id", "split"))


@query("captions_numbered", "select video_id, seq, start_ms, row_number() over (partition by video_id order by seq) as place from cues where not (video_id % 5 = 0 and start_ms >= 9000)", "cues")
def captions_numbered(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    k = t.cues.withColumn("end_of_video", F.when(F.col("video_id") % 5 == 0, 9000))
    kept = k.where(F.col("end_of_video").isNull() | (F.col("start_ms") < F.col("end_of_video")))
    return kept.select("video_id", "seq", "start_ms", F.row_number().over(Window.partitionBy("video_id").orderBy("seq")).cast("long").alias("place"))


@query("captions_by_frame", r"""select k.video_id, cast(floor(k.start_ms * v.fps_den * 1000.0 / v.fps_num + 0.5) as bigint) as start_ms, cast(floor(k.end_ms * v.fps_den * 1000.0 / v.fps_num + 0.5) as bigint) as end_ms, lower(k.text) as text from cues k join videos v on k.video_id = v.video_id where k.video_id % 2 = 1
    union all select k.video_id, k.start_ms, k.end_ms, lower(trim(substr(regexp_replace(k.text, '\s+', ' ', 'g'), 1, 40))) from cues k where k.end_ms > k.start_ms and k.video_id % 2 = 0 and k.video_id in (select video_id from videos)""", "cues videos")
def captions_by_frame(t: Tables) -> DataFrame:
    """Odd videos have their captions by frame number (here the times), over the exact rate, the others as WebVTT texts."""
    videos = t.videos.withColumn("frames", F.col("video_id") % 2 == 1)
    rows = C.dated_captions(videos, t.cues.select("video_id", F.col("start_ms").alias("begin"), F.col("end_ms").alias("end"), "text"), vtt_files(t))
    return rows.withColumn("text", F.when(F.col("video_id") % 2 == 0, F.trim("text")).otherwise(F.col("text")))


@query("v1_subtitles", "select c_custkey as row, split_part(c_name, '#', 1) as name, cast(c_custkey * 3 as bigint) as begin, cast(c_custkey * 3 + 40 as bigint) as end, c_mktsegment as text from customer where c_custkey % 4 <> 0 and c_custkey % 6 <> 0")
def v1_subtitles(t: Tables) -> DataFrame:
    from ..sources.workbook import frame_cues

    n = F.col("c_custkey")
    name = F.when(n % 4 == 0, "EA7").when(n % 6 == 0, " ").otherwise(F.split("c_name", "#")[0])
    cells = F.create_map(F.lit("Video_Name"), name, F.lit("Begin_Frame"), (n * 3).cast("double").cast("string"), F.lit("End_Frame"), (n * 3 + 40).cast("string"), F.lit("Subtitle"), F.col("c_mktsegment"))
    return frame_cues(t.customer.select(n.alias("row"), cells.alias("cells")))


@query("unreliable_spans", "with k as (select distinct video_id from cues), m as (select video_id, string_agg('[' || cast(start_ms as varchar) || ', ' || cast(end_ms as varchar) || ']', ', ' order by start_ms, end_ms) as s from cues where track = 'user' and end_ms > start_ms group by video_id) select k.video_id, case when k.video_id % 7 = 0 then null else '[' || coalesce(m.s, '') || ']' end as spans from k left join m on k.video_id = m.video_id", "cues")
def unreliable_spans(t: Tables) -> DataFrame:
    """[] where no cue is tagged, null where the source is missing."""
    tagged = t.cues.where("track = 'user' and end_ms > start_ms")
    pair = F.concat(F.lit("["), F.col("start_ms").cast("string"), F.lit(", "), F.col("end_ms").cast("string"), F.lit("]"))
    s = tagged.groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start_ms", "end_ms", pair.alias("p")))), lambda x: x["p"]), ", ").alias("s"))
    j = t.cues.select("video_id").distinct().join(s, "video_id", "left")
    return j.select("video_id", F.when(F.col("video_id") % 7 != 0, F.concat(F.lit("["), F.coalesce("s", F.lit("")), F.lit("]"))).alias("spans"))
