"""Queries of the scalar functions: geometry, keypoints, time, text, hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import strings as S
from ..functions import timing as T
from .fixtures import Tables
from .registry import query

DET = ["video_id", "frame", "det"]


@query("filter_candidates", "select video_id, frame, det, score from det where score > 0.1", "det")
def filter_candidates(t: Tables) -> DataFrame:
    return t.det.where("score > 0.1").select(*DET, "score")


@query("score_filter", "select video_id, frame, det, score > 0.3 as pose, score > 0.45 as count from det where score > 0.3 or score > 0.45", "det")
def score_filter(t: Tables) -> DataFrame:
    return t.det.where("score > 0.3").select(*DET, (F.col("score") > 0.3).alias("pose"), (F.col("score") > 0.45).alias("count"))


@query("flag_bits", """with f as (select video_id, frame, det, case when score > 0.3 then 1 else 0 end + case when score > 0.45 then 2 else 0 end + case when score > 0.6 then 4 else 0 end as f from det)
    select video_id, frame, det, cast(f as int) as flags, cast(f & 251 as int) as cleared, (f & 4) <> 0 as posed, (f & 4) = 0 or (f & 1) <> 0 as subset_ok from f""", "det")
def flag_bits(t: Tables) -> DataFrame:
    bit = lambda thr, v: F.when(F.col("score") > thr, v).otherwise(0)
    f = F.col("flags")
    d = t.det.withColumn("flags", bit(0.3, 1).bitwiseOR(bit(0.45, 2)).bitwiseOR(bit(0.6, 4)))
    return d.select(*DET, "flags", f.bitwiseAND(251).alias("cleared"), (f.bitwiseAND(4) != 0).alias("posed"), ((f.bitwiseAND(4) == 0) | (f.bitwiseAND(1) != 0)).alias("subset_ok"))


@query("box_area", "select video_id, frame, det, (x2 - x1) * (y2 - y1) as area from det", "det")
def box_area(t: Tables) -> DataFrame:
    return t.det.select(*DET, G.area(G.box_of()).alias("area"))


@query("iou", """with p as (select a.video_id, a.frame, a.det as det_a, b.det as det_b, greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0) as i,
    (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) as s from det a join det b on a.video_id = b.video_id and a.frame = b.frame and a.det + 1 = b.det)
    select video_id, frame, det_a, det_b, round(case when s - i > 0 then i / (s - i) else 0 end, 9) as iou from p""", "det")
def iou(t: Tables) -> DataFrame:
    a, b = t.det.alias("a"), t.det.withColumn("det", F.col("det") - 1).alias("b")
    j = a.join(b, (F.col("a.video_id") == F.col("b.video_id")) & (F.col("a.frame") == F.col("b.frame")) & (F.col("a.det") == F.col("b.det")))
    return j.select("a.video_id", "a.frame", F.col("a.det").alias("det_a"), (F.col("b.det") + 1).alias("det_b"), F.round(G.iou(G.box_of("a."), G.box_of("b.")), 9).alias("iou"))


@query("box_decode", """select video_id, frame, det, round(x1 + score * 8 - exp(score) * 4, 6) as x1, round(y1 - score * 8 - exp(-score) * 4, 6) as y1, round(x1 + score * 8 + exp(score) * 4, 6) as x2,
    round(y1 - score * 8 + exp(-score) * 4, 6) as y2 from det""", "det")
def box_decode(t: Tables) -> DataFrame:
    s = F.col("score")
    b = G.decode_box(F.col("x1"), F.col("y1"), F.lit(8.0), s, -s, s, -s)
    return t.det.withColumn("b", b).select(*DET, *[F.round(f"b.{c}", 6).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query("rescale_boxes", "select video_id, frame, det, round(x1 / 0.5, 6) as x1, round(y1 / 0.5625, 6) as y1, round(x2 / 0.5, 6) as x2, round(y2 / 0.5625, 6) as y2 from det", "det")
def rescale_boxes(t: Tables) -> DataFrame:
    return t.det.select(*DET, *[F.round(F.col(c) / k, 6).alias(c) for c, k in (("x1", 0.5), ("y1", 0.5625), ("x2", 0.5), ("y2", 0.5625))])


@query("letterbox_geometry", """select video_id, cast(floor(width * (640.0::double / greatest(width, height)) + 0.5) as bigint) as new_w, cast(floor(height * (640.0::double / greatest(width, height)) + 0.5) as bigint) as new_h from clips""", "clips")
def letterbox_geometry(t: Tables) -> DataFrame:
    w, h = G.letterbox(F.col("width"), F.col("height"))
    return t.clips.select("video_id", w.alias("new_w"), h.alias("new_h"))


CROP_SQL = """c as (select video_id, frame, det, score, (x1 + x2) / 2 as cx, (y1 + y2) / 2 as cy, (x2 - x1) * 1.25::double as w0, (y2 - y1) * 1.25::double as h0 from det),
    p as (select video_id, frame, det, score, cx, cy, case when w0 > h0 * 0.75 then w0 else h0 * 0.75 end as w, case when w0 > h0 * 0.75 then w0 / 0.75 else h0 end as h from c)"""


@query("crop_params", f"with {CROP_SQL} select video_id, frame, det, round(cx, 6) as cx, round(cy, 6) as cy, round(w, 6) as w, round(h, 6) as h from p", "det")
def crop_params(t: Tables) -> DataFrame:
    return t.det.withColumn("p", G.crop(G.box_of())).select(*DET, *[F.round(f"p.{c}", 6).alias(c) for c in ("cx", "cy", "w", "h")])


@query("back_project", f"with {CROP_SQL} select video_id, frame, det, round(score * 101.7 / 288 * w + cx - 0.5 * w + 1e-8, 6) as x, round(score * 203.3 / 384 * h + cy - 0.5 * h + 1e-8, 6) as y from p", "det")
def back_project(t: Tables) -> DataFrame:
    d = t.det.withColumn("p", G.crop(G.box_of()))
    x = G.back_project(F.col("score") * 101.7, G.CROP_WIDTH, F.col("p.w"), F.col("p.cx"))
    return d.select(*DET, F.round(x + 1e-8, 6).alias("x"), F.round(G.back_project(F.col("score") * 203.3, G.CROP_HEIGHT, F.col("p.h"), F.col("p.cy")) + 1e-8, 6).alias("y"))


@query("simcc_step", f"with {CROP_SQL} select video_id, frame, det, round(h / 768, 9) as step from p", "det")
def simcc_step(t: Tables) -> DataFrame:
    return t.det.select(*DET, F.round(G.bin_step(G.crop(G.box_of())["h"]), 9).alias("step"))


@query("simcc_decode", """with a as (select vec_id, embedding[1:32] as sx, embedding[33:64] as sy from embeddings), m as (select *, list_max(sx) as mx, list_max(sy) as my from a)
    select vec_id, round(cast(least(mx, my) as double), 6) as score, case when least(mx, my) <= 0 then -0.5 else (list_position(sx, mx) - 1) / 2 end as x, case when least(mx, my) <= 0 then -0.5 else (list_position(sy, my) - 1) / 2 end as y from m""")
def simcc_decode(t: Tables) -> DataFrame:
    sx, sy = F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)
    score = F.least(F.array_max(sx), F.array_max(sy))
    at = lambda s: F.when(score <= 0, -0.5).otherwise(G.first_max(s) / 2)
    return t.embeddings.select("vec_id", F.round(score.cast("double"), 6).alias("score"), at(sx).alias("x"), at(sy).alias("y"))


@query("flip_merge", """with a as (select vec_id, embedding[1:32] as s, embedding[33:64] as f from embeddings), m as (select vec_id, list_transform(range(1, 33), lambda i: (cast(s[i] as double) + cast(f[33 - i] as double)) * 0.5) as m from a)
    select vec_id, round(list_max(m), 6) as top, cast(list_position(m, list_max(m)) - 1 as bigint) as at, round(m[1], 6) as first from m""")
def flip_merge(t: Tables) -> DataFrame:
    cast = lambda a: a.cast("array<double>")
    m = F.zip_with(cast(F.slice("embedding", 1, 32)), F.reverse(cast(F.slice("embedding", 33, 32))), lambda x, y: (x + y) * 0.5)
    return t.embeddings.select("vec_id", m.alias("m")).select("vec_id", F.round(F.array_max("m"), 6).alias("top"), G.first_max(F.col("m")).alias("at"), F.round(F.col("m")[0], 6).alias("first"))


@query("encode_kpts", "select vec_id, k, round(x / 444, 9) as x, round(y / 256, 9) as y, score from kpts", "kpts")
def encode_kpts(t: Tables) -> DataFrame:
    return t.kpts.select("vec_id", "k", F.round(F.col("x") / 444, 9).alias("x"), F.round(F.col("y") / 256, 9).alias("y"), "score")


SEEN = "score > 0.3 and x >= -0.25 and x <= 1.25 and y >= -0.25 and y <= 1.25"


@query("visible_joint", f"select vec_id, k, {SEEN} as visible from kpts", "kpts")
def visible_joint(t: Tables) -> DataFrame:
    p = F.struct("x", "y", "score")
    return t.kpts.select("vec_id", "k", G.visible(p).alias("visible"))


def joints(t: Tables) -> DataFrame:
    """(vec_id, label, joints): the keypoints of a vector as one array, in order."""
    sorted_ = F.array_sort(F.collect_list(F.struct("k", "x", "y", "score")))
    return t.kpts.groupBy("vec_id", "label").agg(sorted_.alias("joints"))


@query("real_body", f"""with v as (select vec_id, sum(case when {SEEN} and k < 17 then 1 else 0 end) as n, avg(case when k in (5, 6) then x end) as nx, avg(case when k in (5, 6) then y end) as ny,
    min(case when k in (5, 6) then score end) as ns from kpts group by vec_id) select vec_id, n + case when ns > 0.3 and nx between -0.25 and 1.25 and ny between -0.25 and 1.25 then 1 else 0 end >= 8 as real from v""", "kpts")
def real_body(t: Tables) -> DataFrame:
    return joints(t).select("vec_id", G.real_body(F.col("joints")).alias("real"))


@query("has_hand", "select vec_id, count(*) filter (where score > 0.3) >= 10 as hand from kpts group by vec_id", "kpts")
def has_hand(t: Tables) -> DataFrame:
    return joints(t).select("vec_id", G.hand_shown(F.col("joints")).alias("hand"))


PAIR = """w as (select vec_id, max(case when k = 5 then x end) * 640 as lx, max(case when k = 5 then y end) * 360 as ly, max(case when k = 6 then x end) * 640 as rx, max(case when k = 6 then y end) * 360 as ry,
    min(case when k in (5, 6) then score end) as s, max(case when k = 9 then x end) * 640 as wx, max(case when k = 9 then y end) * 360 as wy, max(case when k = 9 then score end) as ws from kpts group by vec_id),
    d as (select *, sqrt((lx - rx) * (lx - rx) + (ly - ry) * (ly - ry)) as d from w)"""


@query("shoulder_width", f"with {PAIR} select vec_id, round(case when s > 0.3 and d > 1e-6 then d end, 6) as width from d", "kpts")
def shoulder_width(t: Tables) -> DataFrame:
    return joints(t).select("vec_id", F.round(G.shoulder_width(F.col("joints"), 640.0, 360.0), 6).alias("width"))


@query("wrist_points", f"""with {PAIR} select vec_id, round(case when s > 0.3 and d > 1e-6 and ws > 0.3 then wx - (lx + rx) / 2 end, 6) as x, round(case when s > 0.3 and d > 1e-6 and ws > 0.3 then wy - (ly + ry) / 2 end, 6) as y from d""", "kpts")
def wrist_points(t: Tables) -> DataFrame:
    w = G.wrist(F.col("joints"), 10, 640.0, 360.0)
    return joints(t).select("vec_id", F.round(w["x"], 6).alias("x"), F.round(w["y"], 6).alias("y"))


@query("spot_prior", "select video_id, median((x1 + x2) / 2) as right_prior, -median((x1 + x2) / 2) as left_prior from det group by video_id", "det")
def spot_prior(t: Tables) -> DataFrame:
    m = F.median(G.center_x(G.box_of()))
    return t.det.groupBy("video_id").agg(m.alias("right_prior"), (-m).alias("left_prior"))


@query("fits_scale", """with p as (select video_id, frame, det, (x2 - x1) * (y2 - y1) as a, case when det % 3 = 0 then null else score end as w from det)
    select video_id, frame, det, sqrt(a / 12000) between 1 / 1.25 and 1.25 and coalesce(w / 0.5 between 1 / 1.25 and 1.25, true) as fits from p""", "det")
def fits_scale(t: Tables) -> DataFrame:
    w = F.when(F.col("det") % 3 != 0, F.col("score"))
    return t.det.select(*DET, G.fits_scale(G.area(G.box_of()), w, F.lit(12000.0), F.lit(0.5), 1.25).alias("fits"))


FPS = "(fps_num / fps_den)"


@query("seconds_to_frames", f"select video_id, cast(greatest(1, ceil(0.5 * {FPS} - 0.01)) as bigint) as mask_run, cast(greatest(1, ceil(balance / 1000 * {FPS} - 0.01)) as bigint) as frames from clips", "clips")
def seconds_to_frames(t: Tables) -> DataFrame:
    fps = F.col("fps_num") / F.col("fps_den")
    return t.clips.select("video_id", T.seconds_to_frames(0.5, fps).alias("mask_run"), T.seconds_to_frames(F.col("balance") / 1000, fps).alias("frames"))


@query("round_half_even", f"select video_id, cast(round_even((video_id % 40) * 0.5, 0) as bigint) as halves, cast(round_even(1.7 * {FPS}, 0) as bigint) as frames from clips", "clips")
def round_half_even(t: Tables) -> DataFrame:
    return t.clips.select("video_id", T.round_half_even((F.col("video_id") % 40) * 0.5).alias("halves"), T.round_half_even(1.7 * (F.col("fps_num") / F.col("fps_den"))).alias("frames"))


@query("loader_fps", "select video_id, nb_frames * fps_den / fps_num as duration_s, nb_frames / (nb_frames * fps_den / fps_num) as fps from clips", "clips")
def loader_fps(t: Tables) -> DataFrame:
    n, num, den = F.col("nb_frames"), F.col("fps_num"), F.col("fps_den")
    return t.clips.select("video_id", T.duration(n, num, den).alias("duration_s"), T.loader_fps(n, num, den).alias("fps"))


@query("within_ulps", """with p as (select video_id, frame, det, cast(cast(score as float) as double) as a, cast(cast(score * (1 + det * 0.0000001) as float) as double) as b from det)
    select video_id, frame, det, abs(a - b) <= 4 * pow(2.0::double, floor(log2(greatest(a, b))) - 23) as near from p""", "det")
def within_ulps(t: Tables) -> DataFrame:
    return t.det.select(*DET, G.within_ulps(F.col("score"), F.col("score") * (1 + F.col("det") * 0.0000001), 4).alias("near"))


@query("frame_in_part", "select range as k, case when range < 17 then 'body' when range < 23 then 'feet' when range < 91 then 'face' when range < 112 then 'lhand' else 'rhand' end as part from range(0, 133)")
def frame_in_part(t: Tables) -> DataFrame:
    return t.spark.range(133).select(F.col("id").alias("k"), G.part_of(F.col("id")).alias("part"))


@query("chunk_frames", """with n as (select video_id, greatest(1, 536870912 // (width * height * 3 + 640 * 640 * 3)) as m from clips), k as (select video_id, least(256, m) as n from n)
    select video_id, cast(case when n >= 64 then n - n % 64 else n end as bigint) as frames from k""", "clips")
def chunk_frames(t: Tables) -> DataFrame:
    per = F.col("width") * F.col("height") * 3 + 640 * 640 * 3
    n = F.least(F.lit(256), F.greatest(F.lit(1), F.floor(F.lit(512 << 20) / per)))
    return t.clips.select("video_id", n.alias("n")).select("video_id", F.when(F.col("n") >= 64, F.col("n") - F.col("n") % 64).otherwise(F.col("n")).cast("long").alias("frames"))


# ---- text

STAMP = "case when video_id % 2 = 0 then lpad(cast(start_ms // 3600000 as varchar), 2, '0') || ':' else '' end || lpad(cast(start_ms // 60000 % 60 as varchar), 2, '0') || ':' || lpad(cast(start_ms // 1000 % 60 as varchar), 2, '0') || ',' || cast(start_ms % 1000 as varchar)"


@query("parse_timestamp", f"""with s as (select video_id, track, seq, start_ms, {STAMP} as stamp from cues) select video_id, track, seq, round(case when video_id % 2 = 0 then start_ms // 3600000 * 3600.0 else 0.0 end
    + start_ms // 60000 % 60 * 60 + start_ms // 1000 % 60 + (start_ms % 1000) / pow(10, length(cast(start_ms % 1000 as varchar))), 6) as seconds from s""", "cues")
def parse_timestamp(t: Tables) -> DataFrame:
    ms = F.col("start_ms")
    pad = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    hours = F.when(F.col("video_id") % 2 == 0, F.concat(pad(ms / 3_600_000), F.lit(":"))).otherwise("")
    stamp = F.concat(hours, pad(ms / 60_000 % 60), F.lit(":"), pad(ms / 1000 % 60), F.lit(","), (ms % 1000).cast("string"))
    return t.cues.select("video_id", "track", "seq", F.round(T.parse_timestamp(stamp).cast("double"), 6).alias("seconds"))


@query("to_millis", "select video_id, track, seq, cast(floor(cast(start_ms as decimal(20,9)) / 1 * 1.0005 + 0.5) as bigint) as ms from (select *, start_ms from cues)", "cues")
def to_millis(t: Tables) -> DataFrame:
    seconds = (F.col("start_ms").cast("decimal(18,0)") * F.lit("1.0005").cast("decimal(5,4)") / F.lit(1000)).cast("decimal(20,9)")
    return t.cues.select("video_id", "track", "seq", T.to_millis(seconds).alias("ms"))


CLOCK = "lpad(cast({0} // 3600000 as varchar), 2, '0') || ':' || lpad(cast({0} // 60000 % 60 as varchar), 2, '0') || ':' || lpad(cast({0} // 1000 % 60 as varchar), 2, '0') || '.' || lpad(cast({0} % 1000 as varchar), 3, '0')"


@query("format_timestamp", f"select video_id, track, seq, {CLOCK.format('start_ms')} as stamp from cues", "cues")
def format_timestamp(t: Tables) -> DataFrame:
    return t.cues.select("video_id", "track", "seq", T.format_millis(F.col("start_ms")).alias("stamp"))


CLEAN = "trim(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))"


@query("quality_tag", "select video_id, track, seq, cast(start_ms as bigint) as start_ms, cast(end_ms as bigint) as end_ms from cues where regexp_matches('[' || upper(track) || '] ' || text, '\\[(USER|NOT)[A-Z _-]*\\]')", "cues")
def quality_tag(t: Tables) -> DataFrame:
    tagged = F.concat(F.lit("["), F.upper("track"), F.lit("] "), F.col("text"))
    return t.cues.where(tagged.rlike(r"\[(USER|NOT)[A-Z _-]*\]") & tagged.rlike(S.TAG)).select("video_id", "track", "seq", "start_ms", "end_ms")


@query("lower_text", "select video_id, track, seq, lower(text) as text from cues", "cues")
def lower_text(t: Tables) -> DataFrame:
    return t.cues.select("video_id", "track", "seq", F.lower("text").alias("text"))


@query("safe_id", "select page_id, trim(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '_') as id from pages")
def safe_id(t: Tables) -> DataFrame:
    return t.pages.select("page_id", S.safe_id(F.col("url")).alias("id"))


DAY = "name || ' ' || cast(1 + video_id % 28 as varchar) || ' ' || cast(1 + video_id % 12 as varchar) || ' ' || cast(2000 + video_id % 24 as varchar)"


@query("id_from_date", "select video_id, 'news_' || cast(2000 + video_id % 24 as varchar) || '-' || lpad(cast(1 + video_id % 12 as varchar), 2, '0') || '-' || lpad(cast(1 + video_id % 28 as varchar), 2, '0') as id from clips", "clips")
def id_from_date(t: Tables) -> DataFrame:
    n = F.col("video_id")
    name = F.concat_ws(" ", "name", (1 + n % 28).cast("string"), (1 + n % 12).cast("string"), (2000 + n % 24).cast("string"))
    return t.clips.select("video_id", S.id_from_date(name, "news").alias("id"))


@query("id_valid", "select page_id, regexp_full_match(split_part(url, '/', 3), '[A-Za-z0-9._-]+') and not regexp_matches(split_part(url, '/', 3), '_segment_[0-9]+$') as host_ok, regexp_full_match(url, '[A-Za-z0-9._-]+') as url_ok from pages")
def id_valid(t: Tables) -> DataFrame:
    host = F.coalesce(F.get(F.split("url", "/"), F.lit(2)), F.lit(""))
    return t.pages.select("page_id", S.id_valid(host).alias("host_ok"), S.id_valid(F.col("url")).alias("url_ok"))


@query("split_of", "select video_id, case when split in ('BUILDING') then 'dev' when split in ('MACHINERY', 'FURNITURE') then 'test' else 'train' end as split from clips", "clips")
def split_of(t: Tables) -> DataFrame:
    s = F.col("split")
    return t.clips.select("video_id", F.when(s.isin("BUILDING"), "dev").when(s.isin("MACHINERY", "FURNITURE"), "test").otherwise("train").alias("split"))


@query("sentence_number", "select video_id, cast(regexp_extract(replace(name, '#', '_'), '_([^_]*)$', 1) as bigint) as number from clips", "clips")
def sentence_number(t: Tables) -> DataFrame:
    return t.clips.select("video_id", F.substring_index(F.translate("name", "#", "_"), "_", -1).cast("long").alias("number"))


@query("relative_path", "select page_id, case when starts_with(url, 'https://') then substr(url, 9) else url end as path from pages")
def relative_path(t: Tables) -> DataFrame:
    return t.pages.select("page_id", S.relative_path(F.col("url"), "https://").alias("path"))


@query("csv_cells", """select video_id, cast(width as varchar) as width, case when expected_frames is null then '' else cast(expected_frames as varchar) end as frames, case when expected_frames is null then '' else printf('%.4f', expected_frames / nb_frames) end as ratio,
    case when expected_frames is null then '' else '[[' || cast(video_id as varchar) || ', ' || cast(video_id + 1 as varchar) || ']]' end as runs from clips""", "clips")
def csv_cells(t: Tables) -> DataFrame:
    n = F.col("expected_frames")
    runs = F.when(n.isNotNull(), F.concat(F.lit("[["), F.col("video_id").cast("string"), F.lit(", "), (F.col("video_id") + 1).cast("string"), F.lit("]]")))
    return t.clips.select("video_id", S.cell(F.col("width")).alias("width"), S.cell(n).alias("frames"), F.when(n.isNull(), "").otherwise(S.ratio_cell(n / F.col("nb_frames"))).alias("ratio"), S.cell(runs).alias("runs"))


def canonical(fields: str) -> str:
    """SQL of the canonical hash of 'name: expression' pairs, in the order of names."""
    parts = [f"'{k}=' || coalesce(cast({v} as varchar), 'null')" for k, v in sorted(x.split(": ") for x in fields.split("; "))]
    return f"sha256(concat_ws(chr(10), {', '.join(parts)}))"


@query("json_hash", f"select video_id, {canonical('width: width; height: height; name: name; frames: expected_frames')} as hash from clips", "clips")
def json_hash(t: Tables) -> DataFrame:
    c = F.col
    return t.clips.select("video_id", S.canonical_hash(width=c("width"), height=c("height"), name=c("name"), frames=c("expected_frames")).alias("hash"))


RULE = "case cast(video_id % 3 as int) when 0 then 'largest_bbox' when 1 then 'highest_score' else 'side_largest' end"
OWN = f"case when video_id % 3 = 2 then {RULE} end"


def _rule():
    return F.element_at(F.array(F.lit("largest_bbox"), F.lit("highest_score"), F.lit("side_largest")), (F.col("video_id") % 3 + 1).cast("int"))


@query("extraction_hash", f"select video_id, {canonical(f'width: width; height: height; posing_rule: {OWN}; posing_rule_params: case when video_id % 3 = 2 then split end')} as hash from clips", "clips")
def extraction_hash(t: Tables) -> DataFrame:
    return t.clips.select("video_id", S.extraction_hash({"width": F.col("width"), "height": F.col("height")}, _rule(), F.col("split")).alias("hash"))


@query("derivation_hash", f"select video_id, {canonical(f'k: width; primary_rule: {RULE}; primary_rule_params: split; meta_version: 5')} as hash from clips", "clips")
def derivation_hash(t: Tables) -> DataFrame:
    return t.clips.select("video_id", S.derivation_hash({"k": F.col("width")}, _rule(), F.col("split"), 5).alias("hash"))


@query("commit_derivation_hash", f"select video_id, {canonical(f'k: width; primary_rule: {RULE}')} as hash from clips", "clips")
def commit_derivation_hash(t: Tables) -> DataFrame:
    return t.clips.select("video_id", S.commit_hash({"k": F.col("width")}, _rule()).alias("hash"))


LINES = "case cast(event_id % 5 as int) when 0 then '[h264 @ 0x55d0c2] error' when 1 then 'CUDA error: ' || event_type when 2 then '[ WARN:0] videoio: ' || event_type when 3 then 'TensorRT ' || props else event_type end"


@query("is_decoder_line", f"""with l as (select event_id, {LINES} as line from events) select event_id, regexp_matches(line, '\\[[^\\[\\]@]+ @ 0x[0-9A-Fa-f]+\\] ') or regexp_matches(line, '\\[ ?(WARN|ERROR|FATAL)[^\\]]*\\].*(videoio|cap_)') as decoder,
    regexp_matches(lower(line), 'cuda|cudnn|cublas|tensorrt|nvrtc|device-side assert') as gpu from l""")
def is_decoder_line(t: Tables) -> DataFrame:
    e = F.col("event_type")
    k = F.col("event_id") % 5
    line = F.when(k == 0, "[h264 @ 0x55d0c2] error").when(k == 1, F.concat(F.lit("CUDA error: "), e)).when(k == 2, F.concat(F.lit("[ WARN:0] videoio: "), e)).when(k == 3, F.concat(F.lit("TensorRT "), F.col("props"))).otherwise(e)
    return t.events.select("event_id", line.rlike(S.DECODER_LINE).alias("decoder"), line.rlike(S.GPU_ERROR).alias("gpu"))


@query("caption_source_valid", "select page_id, split_part(url, '/', 4) in ('human', 'mt', 'shard', 'none') as valid from pages")
def caption_source_valid(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.coalesce(F.get(F.split("url", "/"), F.lit(3)), F.lit("")).isin(*S.CAPTION_SOURCES).alias("valid"))
