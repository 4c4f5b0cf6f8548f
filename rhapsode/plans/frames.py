"""Queries over frames: suppression, rules, posed rows, joins and aggregations of detections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import joins as J
from ..operators import report as R
from ..operators import select as S
from ..operators import suppress as N
from .fixtures import Tables
from .registry import query

KEYS = ["video_id", "frame"]
BOX = "{{'x1': s.x1, 'y1': s.y1, 'x2': s.x2, 'y2': s.y2}}"


def nms_sql(over: str, where: str = "score > 0.3", name: str = "nms") -> str:
    """A recursive CTE that keeps boxes one by one; over: whether kept box b suppresses row s."""
    box = "{'x1': s.x1, 'y1': s.y1, 'x2': s.x2, 'y2': s.y2}"
    hit = f"len(list_filter(n.boxes, lambda b: {over})) > 0"
    return f"""{name}_s as (select video_id, frame, det, x1, y1, x2, y2, row_number() over (partition by video_id, frame order by score desc, det) as rn from det where {where}),
    {name} as (select video_id, frame, rn, [det] as kept, [{box}] as boxes from {name}_s s where rn = 1
      union all select n.video_id, n.frame, s.rn, case when {hit} then n.kept else list_append(n.kept, s.det) end, case when {hit} then n.boxes else list_append(n.boxes, {box}) end
      from {name} n join {name}_s s on s.video_id = n.video_id and s.frame = n.frame and s.rn = n.rn + 1),
    {name}_k as (select video_id, frame, unnest(arg_max(kept, rn)) as det from {name} group by video_id, frame)"""


INTER = "greatest(least(b.x2, s.x2) - greatest(b.x1, s.x1), 0) * greatest(least(b.y2, s.y2) - greatest(b.y1, s.y1), 0)"
AREAS = "((b.x2 - b.x1) * (b.y2 - b.y1) + (s.x2 - s.x1) * (s.y2 - s.y1))"
INTER1 = "greatest(least(b.x2, s.x2) - greatest(b.x1, s.x1) + 1, 0) * greatest(least(b.y2, s.y2) - greatest(b.y1, s.y1) + 1, 0)"
AREAS1 = "((b.x2 - b.x1 + 1) * (b.y2 - b.y1 + 1) + (s.x2 - s.x1 + 1) * (s.y2 - s.y1 + 1))"
COUNT = f"{INTER} > 0.45::double * ({AREAS} - {INTER})"
POSE = f"{INTER1} / ({AREAS1} - {INTER1}) > 0.3::double"
HEAD = f"{INTER} > 0.65::double * ({AREAS} - {INTER})"


@query("nms_count", f"with recursive {nms_sql(COUNT)} select video_id, frame, det from nms_k", "det")
def nms_count(t: Tables) -> DataFrame:
    return N.survivors(t.det, N.standard(N.COUNT_IOU), least_score=0.3)


@query("nms_pose", f"with recursive {nms_sql(POSE)} select video_id, frame, det from nms_k", "det")
def nms_pose(t: Tables) -> DataFrame:
    return N.survivors(t.det, N.end_pixels(N.POSE_IOU), least_score=0.3)


@query("nms_head", f"with recursive {nms_sql(HEAD, 'score > 0.1')} select video_id, frame, det from nms_k", "det")
def nms_head(t: Tables) -> DataFrame:
    return N.survivors(t.det, N.standard(N.HEAD_IOU), least_score=0.1)


@query("count_per_frame", f"""with recursive {nms_sql(COUNT)} select f.video_id, f.frame, count(k.det) as num_persons from frames f left join nms_k k on f.video_id = k.video_id and f.frame = k.frame group by f.video_id, f.frame""", "det frames")
def count_per_frame(t: Tables) -> DataFrame:
    kept = N.suppressed(t.det, N.standard(N.COUNT_IOU), least_score=0.3).select(*KEYS, F.size("kept").cast("long").alias("n"))
    return t.frames.join(kept, KEYS, "left").select(*KEYS, F.coalesce("n", F.lit(0)).alias("num_persons"))


def argbest(order: str, where: str = "score > 0.3", name: str = "det") -> str:
    return f"select video_id, frame, det as {name} from (select *, row_number() over (partition by video_id, frame order by {order}, det) as k from det where {where}) where k = 1"


AREA = "(x2 - x1) * (y2 - y1)"


@query("largest_bbox", argbest(f"{AREA} desc"), "det")
def largest_bbox(t: Tables) -> DataFrame:
    return S.pick(t.det.where("score > 0.3"), S.LARGEST)


@query("highest_score", argbest("score desc"), "det")
def highest_score(t: Tables) -> DataFrame:
    return S.pick(t.det.where("score > 0.3"), S.HIGHEST)


@query("right_largest", argbest(f"(x1 + x2) / 2 >= 0.6 * 400 desc, {AREA} desc"), "det")
def right_largest(t: Tables) -> DataFrame:
    return S.pick(t.det.where("score > 0.3"), S.side_largest("right_largest", 0.6, 400.0))


@query("left_largest", argbest(f"(x1 + x2) / 2 < 0.4 * 400 desc, {AREA} desc"), "det")
def left_largest(t: Tables) -> DataFrame:
    return S.pick(t.det.where("score > 0.3"), S.side_largest("left_largest", 0.4, 400.0, right=False))


@query("rule_registry", argbest(f"(x1 + x2) / 2 >= 0.6 * 400 desc, {AREA} desc"), "det")
def rule_registry(t: Tables) -> DataFrame:
    rules = S.Rules(S.side_largest("right_largest", 0.6, 400.0))
    return S.pick(t.det.where("score > 0.3"), rules["right_largest"])


RANKS = f"""r as (select *, row_number() over (partition by video_id, frame order by {AREA} desc, det) as ra, row_number() over (partition by video_id, frame order by score desc, det) as rs from det where score > 0.3),
    o as (select *, row_number() over (partition by video_id, frame order by case when ra = 1 then 0 when rs = 1 then 1 else 2 end, det) as ro from r),
    k as (select video_id, frame, det, ra, row_number() over (partition by video_id, frame order by det) - 1 as pos from o where ro <= 3)"""


@query("select_frame", f"with {RANKS} select video_id, frame, string_agg(cast(det as varchar), ',' order by det) as posed, max(case when ra = 1 then pos end) as primary_pos from k group by video_id, frame", "det")
def select_frame(t: Tables) -> DataFrame:
    p = S.posed(t.det.where("score > 0.3"), S.LARGEST)
    return p.select(*KEYS, F.concat_ws(",", F.transform("posed", lambda x: x.cast("string"))).alias("posed"), F.col("primary").alias("primary_pos"))


@query("select_chunk", f"with {RANKS} select d.video_id, d.frame, d.det, cast(case when d.score > 0.3 then 1 else 0 end + case when k.det is not null then 4 else 0 end as int) as flags from det d left join k on d.video_id = k.video_id and d.frame = k.frame and d.det = k.det", "det")
def select_chunk(t: Tables) -> DataFrame:
    d = t.det
    p = S.posed(d.where("score > 0.3"), S.LARGEST).drop("primary")
    pose = F.when(F.col("score") > 0.3, N.POSE).otherwise(0)
    return d.join(p, KEYS, "left").select(*KEYS, "det", pose.bitwiseOR(F.when(F.array_contains("posed", F.col("det")), N.POSED).otherwise(0)).alias("flags"))


FRAME_SQL = f"""with recursive {nms_sql(COUNT)}, c as (select video_id, frame, count(*) as n from nms_k group by video_id, frame), {RANKS},
    g as (select video_id, frame, string_agg(cast(det as varchar), ',' order by det) as posed, max(case when ra = 1 then pos end) as p from k group by video_id, frame)
    select f.video_id, f.frame, coalesce(c.n, 0) as num_persons, coalesce(g.posed, '') as posed, coalesce(g.p, -1) as primary_pos
    from frames f left join c on f.video_id = c.video_id and f.frame = c.frame left join g on f.video_id = g.video_id and f.frame = g.frame"""


@query("frame_people", FRAME_SQL, "det frames")
def frame_people(t: Tables) -> DataFrame:
    """The flagship: people counted, posed rows and the primary one of every frame."""
    return people(t).select(*KEYS, "num_persons", F.concat_ws(",", F.transform(F.coalesce("posed", F.array().cast("array<bigint>")), lambda x: x.cast("string"))).alias("posed"), F.coalesce("primary", F.lit(-1)).cast("long").alias("primary_pos"))


def people(t: Tables) -> DataFrame:
    """One shuffle of the candidates serves suppression and selection."""
    rows = N.gathered(t.det, least_score=0.3)
    posed, primary = S.posed_rows(F.col("rows"))
    each = rows.select(*KEYS, F.size(N.kept_of(F.col("rows"), N.standard(N.COUNT_IOU))).cast("long").alias("n"), posed.alias("posed"), primary.alias("primary"))
    return t.frames.join(each, KEYS, "left").withColumn("num_persons", F.coalesce("n", F.lit(0)))


# ---- joins

@query("csr_explode", f"with {RANKS} select k.video_id, k.frame, k.pos, k.det from k", "det")
def csr_explode(t: Tables) -> DataFrame:
    p = S.posed(t.det.where("score > 0.3"), S.LARGEST)
    return p.select(*KEYS, F.posexplode("posed").alias("pos", "det")).withColumn("pos", F.col("pos").cast("long"))


@query("gather_posed_det", f"with {RANKS} select k.video_id, k.frame, k.pos, k.det, d.x1, d.y2, d.score from k join det d on k.video_id = d.video_id and k.frame = d.frame and k.det = d.det", "det")
def gather_posed_det(t: Tables) -> DataFrame:
    return J.gather(S.posed(t.det.where("score > 0.3"), S.LARGEST), t.det).select(*KEYS, F.col("pos").cast("long").alias("pos"), "det", "x1", "y2", "score")


@query("primary_pose", f"with p as ({argbest(f'{AREA} desc')}) select f.video_id, f.frame, coalesce(d.x1, 0.0) as x1, coalesce(d.y1, 0.0) as y1, coalesce(d.score, 0.0) as score from frames f left join p on f.video_id = p.video_id and f.frame = p.frame left join det d on p.video_id = d.video_id and p.frame = d.frame and p.det = d.det", "det frames")
def primary_pose(t: Tables) -> DataFrame:
    return J.primary_rows(t.frames, S.posed(t.det.where("score > 0.3"), S.LARGEST), t.det, ["x1", "y1", "score"])


PAIRS = """p as (select a.video_id, a.frame, a.det as det_a, b.det as det_b, greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0) as i,
    (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) as s from det a join det b on a.video_id = b.video_id and a.frame = b.frame and a.det < b.det)"""


@query("iou_self_join", f"with {PAIRS} select video_id, frame, det_a, det_b, round(i / (s - i), 9) as iou from p where i / (s - i) >= 0.5", "det")
def iou_self_join(t: Tables) -> DataFrame:
    return J.overlapping_pairs(t.det, 0.5).withColumn("iou", F.round("iou", 9))


@query("point_in_region", f"with p as ({argbest(f'{AREA} desc', name='m')}) select d.video_id, d.frame, d.det, coalesce((d.x1 + d.x2) / 2 between m.x1 and m.x2 and (d.y1 + d.y2) / 2 between m.y1 and m.y2, false) as inside from det d left join p on d.video_id = p.video_id and d.frame = p.frame left join det m on m.video_id = p.video_id and m.frame = p.frame and m.det = p.m", "det")
def point_in_region(t: Tables) -> DataFrame:
    top = t.det.where("score > 0.3").groupBy(*KEYS).agg(F.min_by(G.box_of(), S.LARGEST.key()).alias("region"))
    return t.det.join(top, KEYS, "left").select(*KEYS, "det", G.inside(G.box_of(), F.col("region")).alias("inside"))


SPANS = "s as (select video_id, a, b, k from spans where b > a)"


@query("segment_span_contains", f"with {SPANS} select s.video_id, s.k, f.t, f.value from s join series f on f.video_id = s.video_id and f.t >= s.a and f.t <= s.b", "spans series")
def segment_span_contains(t: Tables) -> DataFrame:
    pts = t.series.select("video_id", "t", "value")
    return J.by_bucket(pts, t.spans.where("b > a"), "video_id", "t", "a", "b", 32).select("video_id", "k", "t", "value")


@query("gap_overlap", f"with {SPANS} select x.video_id, x.k as k_x, y.k as k_y from s x join s y on x.video_id = y.video_id and x.a < y.b and y.a < x.b and x.k < y.k", "spans")
def gap_overlap(t: Tables) -> DataFrame:
    return J.overlaps(t.spans, t.spans, "video_id", 64).where("k_x < k_y").select("video_id", "k_x", "k_y")


PRIMARY = f"m as ({argbest(f'{AREA} desc')}), b as (select d.video_id, d.frame, d.x1, d.y1, d.x2, d.y2 from det d join m on d.video_id = m.video_id and d.frame = m.frame and d.det = m.det)"


@query("adjacent_frames", f"with {PRIMARY} select x.video_id, x.frame, x.x1, y.x1 as p_x1 from b x join b y on x.video_id = y.video_id and y.frame = x.frame - 1", "det")
def adjacent_frames(t: Tables) -> DataFrame:
    return J.adjacent(primary_boxes(t)).select(*KEYS, "x1", "p_x1")


def primary_boxes(t: Tables) -> DataFrame:
    b = t.det.where("score > 0.3").groupBy(*KEYS).agg(F.min_by(G.box_of(), S.LARGEST.key()).alias("b"))
    return b.select(*KEYS, "b.*")


@query("primary_switches", f"""with {PRIMARY}, q as (select x.video_id, x.frame, greatest(least(x.x2, y.x2) - greatest(x.x1, y.x1), 0) * greatest(least(x.y2, y.y2) - greatest(x.y1, y.y1), 0) as i,
    (x.x2 - x.x1) * (x.y2 - x.y1) + (y.x2 - y.x1) * (y.y2 - y.y1) as s from b x join b y on x.video_id = y.video_id and y.frame = x.frame - 1) select video_id, frame from q where i / (s - i) < 0.3""", "det")
def primary_switches(t: Tables) -> DataFrame:
    before = G.box(*[F.col(f"p_{c}") for c in ("x1", "y1", "x2", "y2")])
    return J.adjacent(primary_boxes(t)).where(G.iou(G.box_of(), before) < 0.3).select(*KEYS)


MOVED = "o as (select video_id, frame, det as j, x1 + (det % 3) * 0.4 as x1, y1 + (det % 2) * 0.9 as y1, x2 + (det % 5) * 0.3 as x2, y2 as y2 from det where score > 0.25)"
DIST = "greatest(abs(a.x1 - o.x1), abs(a.y1 - o.y1), abs(a.x2 - o.x2), abs(a.y2 - o.y2))"


def _moved(t: Tables) -> DataFrame:
    d = F.col("det")
    return t.det.where("score > 0.25").select(*KEYS, d.alias("j"), (F.col("x1") + d % 3 * 0.4).alias("u1"), (F.col("y1") + d % 2 * 0.9).alias("v1"), (F.col("x2") + d % 5 * 0.3).alias("u2"), F.col("y2").alias("v2"))


def _close(t: Tables) -> DataFrame:
    dist = F.greatest(F.abs(F.col("x1") - F.col("u1")), F.abs(F.col("y1") - F.col("v1")), F.abs(F.col("x2") - F.col("u2")), F.abs(F.col("y2") - F.col("v2")))
    p = t.det.where("score > 0.3").join(_moved(t), KEYS).where(dist < 1.0)
    return p.select(*KEYS, F.col("det").alias("i"), "j", dist.alias("dist"))


MATCH = f"""{MOVED}, c as (select a.video_id, a.frame, a.det as i, o.j, {DIST} as d from det a join o on a.video_id = o.video_id and a.frame = o.frame where a.score > 0.3 and {DIST} < 1.0),
    c2 as (select *, row_number() over (partition by video_id, frame order by d, i, j) as rn from c),
    m as (select video_id, frame, rn, [i] as us, [j] as vs from c2 where rn = 1 union all select m.video_id, m.frame, c2.rn, case when list_contains(us, c2.i) or list_contains(vs, c2.j) then us else list_append(us, c2.i) end,
      case when list_contains(us, c2.i) or list_contains(vs, c2.j) then vs else list_append(vs, c2.j) end from m join c2 on c2.video_id = m.video_id and c2.frame = m.frame and c2.rn = m.rn + 1),
    g as (select video_id, frame, arg_max(us, rn) as us, arg_max(vs, rn) as vs from m group by video_id, frame), pairs as (select video_id, frame, unnest(us) as i, unnest(vs) as j from g)"""


@query("match_boxes", f"with recursive {MATCH} select video_id, frame, i, j from pairs", "det")
def match_boxes(t: Tables) -> DataFrame:
    from ..operators.tracks import match_boxes as match

    return match(_close(t))


@query("unmatched_both", f"""with recursive {MATCH} select a.video_id, a.frame, 'first' as side, a.det as det from det a where a.score > 0.3 and not exists (select 1 from pairs p where p.video_id = a.video_id and p.frame = a.frame and p.i = a.det)
    union all select o.video_id, o.frame, 'second', o.j from o where not exists (select 1 from pairs p where p.video_id = o.video_id and p.frame = o.frame and p.j = o.j)""", "det")
def unmatched_both(t: Tables) -> DataFrame:
    from ..operators.tracks import match_boxes as match

    m = match(_close(t))
    a = t.det.where("score > 0.3").join(m.select(*KEYS, F.col("i").alias("det")), [*KEYS, "det"], "left_anti").select(*KEYS, F.lit("first").alias("side"), "det")
    b = _moved(t).join(m.select(*KEYS, "j"), [*KEYS, "j"], "left_anti").select(*KEYS, F.lit("second").alias("side"), F.col("j").alias("det"))
    return a.unionByName(b)


# ---- aggregations

@query("undetected_ratio", f"""with recursive {nms_sql(COUNT)}, c as (select distinct video_id, frame from nms_k) select f.video_id, round(avg(case when c.frame is null then 1.0 else 0.0 end), 9) as ratio from frames f left join c on f.video_id = c.video_id and f.frame = c.frame group by f.video_id""", "det frames")
def undetected_ratio(t: Tables) -> DataFrame:
    empty = (F.col("num_persons") == 0).cast("double")
    return count_per_frame(t).groupBy("video_id").agg(F.round(F.avg(empty), 9).alias("ratio"))


@query("presence", "select video_id, det as segment, count(*) as n_rows, count(distinct frame) as n_frames from det group by video_id, det", "det")
def presence(t: Tables) -> DataFrame:
    return t.det.groupBy("video_id", F.col("det").alias("segment")).agg(F.count("*").alias("n_rows"), F.countDistinct("frame").alias("n_frames"))


@query("main_spot", """with n as (select video_id, max(frame) + 1 as n from frames group by video_id), g as (select video_id, det as spot, count(distinct frame) as p, round(median((x1 + x2) / 2), 6) as pr from det group by video_id, det)
    select video_id, spot as main from (select *, row_number() over (partition by video_id order by pr desc, p desc, spot) as k from g join n using (video_id) where p >= 0.2 * n) where k = 1""", "det frames")
def main_spot(t: Tables) -> DataFrame:
    from ..operators.tracks import main_spot as main

    n = t.frames.groupBy("video_id").agg((F.max("frame") + 1).alias("n"))
    return main(t.det.withColumn("spot", F.col("det")), n, 0.2, F.round(F.median(G.center_x(G.box_of())), 6))


@query("track_median_box", "select video_id, det as track, count(*) as length, median(x1) as x1, median(y1) as y1, median(x2) as x2, median(y2) as y2 from det group by video_id, det", "det")
def track_median_box(t: Tables) -> DataFrame:
    from ..operators.tracks import track_summary

    return track_summary(t.det.withColumn("track", F.col("det"))).drop("scale")


@query("track_scale", "select video_id, det as track, case when count(*) >= 500 then median(case when frame % 3 <> 0 then score end) end as scale from det group by video_id, det", "det")
def track_scale(t: Tables) -> DataFrame:
    from ..operators.tracks import track_summary

    d = t.det.withColumn("track", F.col("det")).withColumn("w", F.when(F.col("frame") % 3 != 0, F.col("score")))
    return track_summary(d, 500, "w").select("video_id", "track", "scale")


@query("pooled_std", """with s as (select label as video_id, vec_id % 7 as person, k, count(*) as n, stddev_pop(x) as sx, stddev_pop(y) as sy from kpts where k in (7, 8, 9, 10) and score > 0.3 group by label, vec_id % 7, k)
    select cast(video_id as int) as video_id, round(max(case when n >= 10 then greatest(sx, sy) end), 6) as motion from s group by video_id""", "kpts")
def pooled_std(t: Tables) -> DataFrame:
    from ..operators.tracks import pooled_std as pooled

    seen = t.kpts.where("k in (7, 8, 9, 10) and score > 0.3")
    rows = seen.groupBy(F.col("label").alias("video_id"), (F.col("vec_id") % 7).alias("person"), "vec_id").pivot("k", [7, 8, 9, 10]).agg(F.first("x").alias("x"), F.first("y").alias("y"))
    return pooled(rows, ["video_id"], [(f"{k}_x", f"{k}_y") for k in (7, 8, 9, 10)]).withColumn("motion", F.round("motion", 6))


BIN = "case when d < 1e-6 then 0 else least(1000, 1 + floor((log10(d) + 6) * 100 + 1e-9)) end"


@query("hist_log", f"with b as (select video_id, cast({BIN} as bigint) as bin from (select video_id, score * (1 + det) as d from det)) select video_id, bin, count(*) as n from b group by video_id, bin", "det")
def hist_log(t: Tables) -> DataFrame:
    return t.det.withColumn("bin", R.log_bin(F.col("score") * (1 + F.col("det")))).groupBy("video_id", "bin").agg(F.count("*").alias("n"))


@query("hist_quantile", f"""with d as (select video_id, score * (1 + det) as d from det), b as (select video_id, cast({BIN} as bigint) as bin, d from d), h as (select video_id, bin, count(*) as n from b group by video_id, bin),
    m as (select video_id, max(d) as most, count(*) as total from b group by video_id), c as (select h.*, sum(n) over (partition by video_id order by bin) as c from h)
    select c.video_id, round(min(least(pow(10.0::double, bin / 100.0 - 6), most)), 9) as p95 from c join m using (video_id) where c >= greatest(1, ceil(total * 0.95)) group by c.video_id""", "det")
def hist_quantile(t: Tables) -> DataFrame:
    d = t.det.withColumn("d", F.col("score") * (1 + F.col("det")))
    most = d.groupBy("video_id").agg(F.max("d").alias("most"))
    h = d.withColumn("bin", R.log_bin(F.col("d"))).groupBy("video_id", "bin").agg(F.count("*").alias("n")).join(most, "video_id").withColumn("top", R.bin_top(F.col("bin")))
    return R.hist_quantile(h, 0.95, ["video_id"]).select("video_id", F.round("value", 9).alias("p95"))


@query("exceed_share", "select part, round(sum(case when conf and move > 0.5 then 1 else 0 end) / greatest(sum(case when conf then 1 else 0 end), 1), 9) as share from (select case when k < 17 then 'body' else 'feet' end as part, score > 0.3 as conf, abs(x - y) as move from kpts) group by part", "kpts")
def exceed_share(t: Tables) -> DataFrame:
    move = F.abs(F.col("x") - F.col("y")) > 0.5
    return t.kpts.groupBy(G.part_of(F.col("k")).alias("part")).agg(F.round(R.share(move, F.col("score") > 0.3), 9).alias("share"))


@query("max_with_argument", "select video_id, max(score) as most, arg_max(frame, struct_pack(s := score, f := -frame, d := -det)) as frame from det group by video_id", "det")
def max_with_argument(t: Tables) -> DataFrame:
    return t.det.groupBy("video_id").agg(F.max("score").alias("most"), F.max_by("frame", F.struct("score", -F.col("frame"), -F.col("det"))).alias("frame"))


@query("step_stats", "select video_id, min(score) as low, round(avg(score), 9) as mean, max(score) as high from det group by video_id", "det")
def step_stats(t: Tables) -> DataFrame:
    return t.det.groupBy("video_id").agg(F.min("score").alias("low"), F.round(F.avg("score"), 9).alias("mean"), F.max("score").alias("high"))


@query("first_listed", "select video_id, frame, det from (select *, row_number() over (partition by video_id order by frame, det) as k from det where score < 0.02) where k <= 100", "det")
def first_listed(t: Tables) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("video_id").orderBy("frame", "det"))
    return t.det.where("score < 0.02").withColumn("k", n).where("k <= 100").select(*KEYS, "det")


@query("csr_concat", "select video_id, frame, det, 0 as chunk from det where frame < 500 union all select video_id, frame, det, 1 from det where frame >= 500", "det")
def csr_concat(t: Tables) -> DataFrame:
    d = t.det.select("video_id", "frame", "det")
    return d.where("frame < 500").withColumn("chunk", F.lit(0)).unionByName(d.where("frame >= 500").withColumn("chunk", F.lit(1)))


@query("spot_keys", "select video_id, det as spot, median((x1 + x2) / 2) as prior from det group by video_id, det", "det")
def spot_keys(t: Tables) -> DataFrame:
    return t.det.groupBy("video_id", F.col("det").alias("spot")).agg(F.median(G.center_x(G.box_of())).alias("prior"))
