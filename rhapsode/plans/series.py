"""Queries over per-frame series: runs, spans, range windows, segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ranges as W
from ..operators import runs as R
from ..operators import tracks as K
from ..operators.stage import settled
from .fixtures import Tables
from .registry import query

ISLANDS = "g as (select video_id, t, t - row_number() over (partition by video_id order by t) as g from series where mask), i as (select video_id, min(t) as a, max(t) + 1 as b from g group by video_id, g)"


def joined(gap: int, least: int, of: str = "i", name: str = "r") -> str:
    return f"""{name}_n as (select *, case when a - lag(b) over (partition by video_id order by a) < {gap} then 0 else 1 end as new from {of}), {name}_g as (select *, sum(new) over (partition by video_id order by a) as gg from {name}_n),
    {name} as (select video_id, min(a) as a, max(b) as b from {name}_g group by video_id, gg having max(b) - min(a) >= {least})"""


@query("edges", f"with {ISLANDS} select video_id, a, b from i", "series")
def edges(t: Tables) -> DataFrame:
    return R.islands(t.series, "mask")


@query("empty_runs", f"with {ISLANDS}, {joined(3, 2)} select video_id, a, b from r", "series")
def empty_runs(t: Tables) -> DataFrame:
    return R.empty_runs(t.series, "mask", 3, 2)


@query("handless_runs", f"with {ISLANDS} select video_id, a, b from i where b - a >= 2", "series")
def handless_runs(t: Tables) -> DataFrame:
    return R.islands(t.series, "mask").where("b - a >= 2")


QUALIFY = """q as (select video_id, t, case when t - lag(t) over (partition by video_id order by t) <= 4 then 0 else 1 end as new from series where value > 20), qg as (select *, sum(new) over (partition by video_id order by t) as g from q),
    qr as (select video_id, min(t) as a, max(t) + 1 as b from qg group by video_id, g having max(t) + 1 - min(t) >= 4)"""


def _qualifying(t: Tables) -> DataFrame:
    return R.split_runs(t.series.where("value > 20"), 4, 4)


@query("qualifying_runs", f"with {QUALIFY} select video_id, a, b from qr", "series")
def qualifying_runs(t: Tables) -> DataFrame:
    return _qualifying(t)


HOPS = "h as (select video_id, a, b, unnest(case when b - 6 > a then list_append(range(a, b - 6, 3), greatest(a, b - 6)) else [greatest(a, b - 6)] end) as lo from qr)"


@query("hop_windows", f"with {QUALIFY}, {HOPS} select video_id, a, b, lo, least(lo + 6, b) as hi from h", "series")
def hop_windows(t: Tables) -> DataFrame:
    return R.hop_windows(_qualifying(t), 6)


def merged(of: str, name: str = "m") -> str:
    return f"""{name}_n as (select *, case when a <= max(b) over (partition by video_id order by a, b rows between unbounded preceding and 1 preceding) then 0 else 1 end as new from {of} where b > a),
    {name}_g as (select *, sum(new) over (partition by video_id order by a, b rows unbounded preceding) as gg from {name}_n), {name} as (select video_id, min(a) as a, max(b) as b from {name}_g group by video_id, gg)"""


@query("merge_spans", f"with {merged('spans')} select video_id, a, b from m", "spans")
def merge_spans(t: Tables) -> DataFrame:
    return R.merged_spans(t.spans)


@query("merge_windows", f"with n as (select video_id, max(t) + 1 as n from series group by video_id), k as (select video_id, greatest(0, t - 5) as a, least(n, t + 5) as b from series join n using (video_id) where mask), {merged('k')} select video_id, a, b from m", "series")
def merge_windows(t: Tables) -> DataFrame:
    n = t.series.groupBy("video_id").agg((F.max("t") + 1).alias("n"))
    return R.review_windows(t.series.where("mask"), 5, n)


@query("range_median", "select video_id, t, round(quantile_cont(v, 0.5) over (partition by video_id order by t range between 3 preceding and 3 following), 6) as med from (select *, case when event_type <> 'view' then value end as v from series)", "series")
def range_median(t: Tables) -> DataFrame:
    v = F.when(F.col("event_type") != "view", F.col("value"))
    return t.series.select("video_id", "t", F.round(W.range_median(v, W.near("video_id", "t", 3)), 6).alias("med"))


NEAR3 = "over (partition by video_id order by t range between 3 preceding and 3 following)"


@query("range_spread", f"""with s as (select video_id, t, case when not mask then value / 10 end as x, case when not mask then value % 7 end as y from series)
    select video_id, t, round(case when count(x) {NEAR3} >= 2 then sqrt(greatest(var_pop(x) {NEAR3} + var_pop(y) {NEAR3}, 0)) end, 5) as spread from s""", "series")
def range_spread(t: Tables) -> DataFrame:
    x, y = F.when(~F.col("mask"), F.col("value") / 10), F.when(~F.col("mask"), F.col("value") % 7)
    return t.series.select("video_id", "t", x.alias("x"), y.alias("y")).select("video_id", "t", F.round(W.range_spread(F.col("x"), F.col("y"), W.near("video_id", "t", 3), W.needed(0.25, 3)), 5).alias("spread"))


WRISTS = """s as (select video_id, t, case when t % 5 <> 0 then 40 + value % 10 end as width, 200.0::double as height, case when not mask then value - 50 end as lx, case when not mask then value % 30 end as ly, case when t % 3 <> 0 then value / 2 end as rx, case when t % 3 <> 0 then value % 11 end as ry from series),
    c as (select *, quantile_cont(width, 0.5) over (partition by video_id order by t range between 4 preceding and 4 following) as med from s), d as (select *, case when med is not null then greatest(med, height * 0.1) end as sc from c),
    e as (select video_id, t, case when sqrt(lx / sc * (lx / sc) + ly / sc * (ly / sc)) <= 3 then lx / sc end as lx, case when sqrt(lx / sc * (lx / sc) + ly / sc * (ly / sc)) <= 3 then ly / sc end as ly, case when sqrt(rx / sc * (rx / sc) + ry / sc * (ry / sc)) <= 3 then rx / sc end as rx, case when sqrt(rx / sc * (rx / sc) + ry / sc * (ry / sc)) <= 3 then ry / sc end as ry from d),
    f as (select video_id, t, quantile_cont(lx, 0.5) over w as lx, quantile_cont(ly, 0.5) over w as ly, quantile_cont(rx, 0.5) over w as rx, quantile_cont(ry, 0.5) over w as ry from e window w as (partition by video_id order by t range between 1 preceding and 1 following)),
    h as (select video_id, t, case when count(lx) over w >= 3 then sqrt(greatest(var_pop(lx) over w + var_pop(ly) over w, 0)) end as ml, case when count(rx) over w >= 3 then sqrt(greatest(var_pop(rx) over w + var_pop(ry) over w, 0)) end as mr from f window w as (partition by video_id order by t range between 4 preceding and 4 following)),
    motion as (select video_id, t, greatest(ml, mr) as motion from h)"""


def _motion(t: Tables) -> DataFrame:
    v, c = F.col("value"), F.col
    s = t.series.select("video_id", "t", F.when(c("t") % 5 != 0, 40 + v % 10).alias("width"), F.lit(200.0).alias("height"), F.when(~c("mask"), v - 50).alias("lx"), F.when(~c("mask"), v % 30).alias("ly"), F.when(c("t") % 3 != 0, v / 2).alias("rx"), F.when(c("t") % 3 != 0, v % 11).alias("ry"))
    return W.sorted_motion(s, "video_id", "t", 4, 1)


@query("sorted_motion", f"with {WRISTS} select video_id, t, round(motion, 5) as motion from motion", "series")
def sorted_motion(t: Tables) -> DataFrame:
    return _motion(t).select("video_id", "t", F.round("motion", 5).alias("motion"))


@query("signing_boxes", f"with {WRISTS}, q as (select *, coalesce(motion >= 0.4, false) as act from motion) select video_id, t, act and sum(case when act then 1 else 0 end) over w >= 0.75 * count(motion) over w as signs from q window w as (partition by video_id order by t range between 4 preceding and 4 following)", "series")
def signing_boxes(t: Tables) -> DataFrame:
    return W.signing(_motion(t), "video_id", "t", 4, 0.4).select("video_id", "t", "signs")


@query("narrow", f"select video_id, t, coalesce(quantile_cont(case when not mask then value end, 0.5) {NEAR3} between 0.5 * 40 and 1.3 * 40, false) as ok from series", "series")
def narrow(t: Tables) -> DataFrame:
    v = F.when(~F.col("mask"), F.col("value"))
    return t.series.select("video_id", "t", W.narrow(v, F.lit(40.0), W.near("video_id", "t", 3), 0.5, 1.3).alias("ok"))


@query("best_per_spot_frame", "select video_id, spot, frame, det from (select *, x1 as spot, row_number() over (partition by video_id, x1, frame order by score desc, det) as k from det) where k = 1", "det")
def best_per_spot_frame(t: Tables) -> DataFrame:
    d = t.det.withColumn("spot", F.col("x1"))
    return W.best_per(d, ["video_id", "spot", "frame"], [F.desc("score"), F.col("det")]).select("video_id", "spot", "frame", "det")


SEGMENTS = """b as (select video_id, cast(x1 / 40 as bigint) as spot, frame, det, score from (select *, row_number() over (partition by video_id, x1, frame order by score desc, det) as k from det where score > 0.5) where k = 1),
    c as (select *, case when frame - lag(frame) over (partition by video_id, spot order by frame) - 1 <= 8 then 0 else 1 end as new from b), d as (select *, sum(new) over (partition by video_id, spot order by frame) as c from c),
    e as (select video_id, spot, c, min(frame) as f from d group by video_id, spot, c), n as (select *, row_number() over (partition by video_id order by f, spot, c) - 1 as segment from e), seg as (select d.*, n.segment from d join n on d.video_id = n.video_id and d.spot = n.spot and d.c = n.c)"""


def _segments(t: Tables) -> DataFrame:
    d = t.det.where("score > 0.5").withColumn("spot", (F.col("x1") / 40).cast("long"))
    return W.segments(W.best_per(d, ["video_id", "spot", "frame"], [F.desc("score"), F.col("det")]), "video_id", "spot", "frame", 8)


@query("segment_cut", f"with {SEGMENTS} select video_id, spot, frame, det, segment from seg", "det")
def segment_cut(t: Tables) -> DataFrame:
    return _segments(t).select("video_id", "spot", "frame", "det", "segment")


STEADY = f"""{SEGMENTS}, sp as (select video_id, segment, min(frame) as lo, max(frame) as hi from seg group by video_id, segment), gr as (select video_id, segment, lo, hi, unnest(range(lo, hi + 1)) as t from sp),
    jo as (select gr.*, seg.frame is not null as s, coalesce(seg.score > 0.7, false) as m from gr left join seg on gr.video_id = seg.video_id and gr.segment = seg.segment and gr.t = seg.frame),
    co as (select *, sum(case when s then 1 else 0 end) over w as cover, sum(case when m then 1 else 0 end) over w as moving from jo window w as (partition by video_id, segment order by t range between 10 preceding and 10 following)),
    steady as (select video_id, segment, t, cast(cover as bigint) as cover from co where cover >= 0.6 * (least(hi, t + 10) - greatest(lo, t - 10) + 1) and moving >= 0.2 * cover)"""


def _steady(t: Tables, seg: DataFrame | None = None) -> DataFrame:
    return K.steady_segments((_segments(t) if seg is None else seg).withColumn("active", F.col("score") > 0.7), 10, 0.6, 0.2)


@query("presence_density", f"with {STEADY} select video_id, segment, t, cover from steady", "det")
def presence_density(t: Tables) -> DataFrame:
    return _steady(t)


INFO = "inf as (select video_id, segment, min(spot) as prior, count(*) as presence, min(spot) as spot, min(frame) as lo, max(frame) as hi from seg group by video_id, segment)"
BEST = f"{STEADY}, {INFO}, best as (select video_id, t, segment from (select s.*, row_number() over (partition by s.video_id, t order by cover desc, prior desc, presence desc, s.segment) as k from steady s join inf on s.video_id = inf.video_id and s.segment = inf.segment) where k = 1)"


def _info(seg: DataFrame) -> DataFrame:
    return seg.groupBy("video_id", "segment").agg(F.min("spot").alias("prior"), F.count("*").alias("presence"), F.min("spot").alias("spot"), F.min("frame").alias("lo"), F.max("frame").alias("hi"))


@query("segment_per_frame", f"with {BEST} select video_id, t, segment from best", "det")
def segment_per_frame(t: Tables) -> DataFrame:
    seg = settled(_segments(t))
    return K.segment_per_frame(_steady(t, seg), _info(seg).select("video_id", "segment", "prior", "presence"))


MAIN = f"{BEST}, own as (select video_id, max(segment) as m, t from (select video_id, segment, unnest(range(lo, hi + 1)) as t from inf where spot = 2) group by video_id, t), ch as (select coalesce(b.video_id, o.video_id) as video_id, coalesce(b.t, o.t) as t, coalesce(o.m, b.segment) as segment from best b full join own o on b.video_id = o.video_id and b.t = o.t)"


def _chosen(t: Tables, seg: DataFrame) -> DataFrame:
    best = K.segment_per_frame(_steady(t, seg), _info(seg).select("video_id", "segment", "prior", "presence"))
    return K.with_main(best, _info(seg).where("spot = 2").select("video_id", "segment", "lo", "hi"))


@query("main_override", f"with {MAIN} select video_id, t, segment from ch", "det")
def main_override(t: Tables) -> DataFrame:
    return _chosen(t, settled(_segments(t)))


@query("choice", f"with {MAIN} select ch.video_id, ch.t, ch.segment, seg.det from ch join seg on ch.video_id = seg.video_id and ch.segment = seg.segment and ch.t = seg.frame", "det")
def choice(t: Tables) -> DataFrame:
    seg = settled(_segments(t))
    at = seg.select("video_id", "segment", F.col("frame").alias("t"), "det")
    return _chosen(t, seg).join(at, ["video_id", "segment", "t"]).select("video_id", "t", "segment", "det")


GAPS = f"""{SEGMENTS}, {INFO}, ms as (select * from inf where spot = 2), gt as (select ms.video_id, ms.segment as own, unnest(range(lo, hi + 1)) as t from ms), sn as (select distinct video_id, frame as t from seg where spot = 2),
    go as (select gt.* from gt left join sn on gt.video_id = sn.video_id and gt.t = sn.t where sn.t is null), gi as (select video_id, own, min(t) as a, max(t) + 1 as b from (select *, t - row_number() over (partition by video_id, own order by t) as g from go) group by video_id, own, g having count(*) >= 3),
    hi_ as (select gi.video_id, own, a, b, s.segment, count(*) as present, sum(case when s.score > 0.7 then 1 else 0 end) as moving from gi join seg s on s.video_id = gi.video_id and s.spot <> 2 and s.frame >= a and s.frame < b group by all having count(*) >= 0.3 * (b - a) and sum(case when s.score > 0.7 then 1 else 0 end) >= 0.2 * count(*)),
    gs as (select video_id, a, b, segment from (select *, row_number() over (partition by video_id, a, b order by moving desc, present desc, segment) as k from hi_) where k = 1)"""


@query("gap_signers", f"with {GAPS} select video_id, a, b, segment from gs", "det")
def gap_signers(t: Tables) -> DataFrame:
    seg = settled(_segments(t)).withColumn("active", F.col("score") > 0.7)
    return K.gap_signers(seg, _info(seg).where("spot = 2"), 3, 0.3, 0.2)


@query("eta_window", "select video_id, t, round(case when t > first_value(t) over w then (value - first_value(value) over w) / (t - first_value(t) over w) end, 6) as rate from series window w as (partition by video_id order by t rows between 10 preceding and current row)", "series")
def eta_window(t: Tables) -> DataFrame:
    w = Window.partitionBy("video_id").orderBy("t").rowsBetween(-10, 0)
    t0, v0 = F.first("t").over(w), F.first("value").over(w)
    return t.series.select("video_id", "t", F.round(F.when(F.col("t") > t0, (F.col("value") - v0) / (F.col("t") - t0)), 6).alias("rate"))


PEOPLE_RUNS = f"""with recursive {{nms}}, c as (select f.video_id, f.frame as t, count(k.det) <= 1 as mask from frames f left join nms_k k on f.video_id = k.video_id and f.frame = k.frame group by f.video_id, f.frame),
    g as (select video_id, t, t - row_number() over (partition by video_id order by t) as g from c where mask), i as (select video_id, min(t) as a, max(t) + 1 as b from g group by video_id, g), {joined(3, 3)} select video_id, a, b from r"""
from .frames import COUNT, count_per_frame, nms_sql  # noqa: E402


@query("few_people_runs", PEOPLE_RUNS.format(nms=nms_sql(COUNT)), "det frames")
def few_people_runs(t: Tables) -> DataFrame:
    """Suppression, zero-filled counts and runs in one plan."""
    s = count_per_frame(t).select("video_id", F.col("frame").alias("t"), (F.col("num_persons") <= 1).alias("mask"))
    return R.empty_runs(s, "mask", 3, 3)
