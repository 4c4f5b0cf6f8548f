"""The signer of each frame on small hand-made videos."""

from rhapsode.operators import tracks as K

P = K.TrackParams(min_track_s=1.0, window_s=1.0, merge_gap_s=1.0, min_visit_s=0.4, anchor_s=1.0, max_gap_s=0.2)
BOXES = "video_id long, frame long, det long, x1 double, y1 double, x2 double, y2 double"


def box(t, det, x):
    return (1, t, det, float(x), 0.0, float(x + 40), 100.0)


def choose(spark, rows, n, p=P, **options):
    lengths = spark.createDataFrame([(1, n)], "video_id long, n long")
    got = K.signer_choice(spark.createDataFrame(rows, BOXES), lengths, p, 10.0, **options).collect()
    return {r["t"]: r["det"] for r in got}


def test_the_main_spot_wins_where_it_is(spark):
    rows = [box(t, 0, 0) for t in range(100) if not 40 <= t < 45] + [box(t, 1, 200) for t in range(30, 70)]
    got = choose(spark, rows, 100)
    assert got == {t: 0 for t in range(100) if not 40 <= t < 45}  # a short gap inside the segment is its own


def test_another_steady_person_takes_over_after_the_main_one(spark):
    rows = [box(t, 0, 0) for t in range(60)] + [box(t, 1, 200) for t in range(50, 100)]
    assert choose(spark, rows, 100) == {t: 0 if t < 60 else 1 for t in range(100)}


def test_short_visits_are_nobody(spark):
    rows = [box(t, 0, 0) for t in range(60)] + [box(t, 1, 200) for t in range(70, 73)]
    assert choose(spark, rows, 100) == {t: 0 for t in range(60)}


def test_the_prior_breaks_presence(spark):
    from pyspark.sql import functions as F

    rows = [box(t, 0, 0) for t in range(100)] + [box(t, 1, 200) for t in range(10, 90)]
    right = choose(spark, rows, 100, prior=F.median((F.col("x1") + F.col("x2")) / 2))
    assert all(right[t] == 1 for t in range(10, 90)) and right[5] == 0


def test_gaps_of_the_main_person_are_filled(spark):
    from dataclasses import replace

    rows = [box(t, 0, 0) for t in range(100) if not 40 <= t < 60] + [box(t, 1, 200) for t in range(35, 65)]
    p = replace(P, merge_gap_s=5.0, fill_min_s=1.0)
    assert set(choose(spark, rows, 100, p)) == {t for t in range(100) if not 40 <= t < 60}
    filled = choose(spark, rows, 100, p, fill=True)
    assert all(filled[t] == 1 for t in range(40, 60)) and filled[39] == 0


def test_empty_and_gated(spark):
    from dataclasses import replace

    assert choose(spark, [], 100) == {}
    rows = [box(t, 0, 0) for t in range(60)] + [box(t, 1, 200) for t in range(60, 100)]
    assert choose(spark, rows, 100, replace(P, other_iou=0.5, other_scale=1.3)) == {t: 0 for t in range(60)}


def test_each_video_has_its_own_rate(spark):
    """Videos of three rates in one table: each equals the same video alone, with its rate for all."""
    import random
    from dataclasses import replace

    from pyspark.sql import functions as F

    r = random.Random(7)
    rows, lengths = [], []
    for v, (num, den) in enumerate([(24, 1), (25, 1), (30000, 1001), (10, 1), (24, 1)]):
        n = r.randrange(60, 130)
        lengths.append((v, n, num, den))
        for person in range(3):
            x, a = 90.0 * person, r.randrange(0, 30)
            for t in range(a, n - r.randrange(0, 20)):
                if r.random() < 0.9:
                    w = 20.0 + r.random() * 8 if r.random() < 0.8 else None
                    rows.append((v, t, person, x + r.random() * 4, 0.0, x + 40 + r.random() * 4, 100.0, w, r.random() < 0.7))
    kind = BOXES + ", width double, active boolean"
    p = replace(P, fill_min_s=0.3, min_active=0.3, other_iou=0.0, other_scale=1.5, max_visit_share=0.3)
    options = {"width": "width", "prior": F.median((F.col("x1") + F.col("x2")) / 2), "fill": True}
    every = spark.createDataFrame(lengths, "video_id long, n long, fps_num long, fps_den long")
    table = spark.createDataFrame(rows, kind)
    got = sorted(tuple(x) for x in K.signer_choice(table, every, p, **options).collect())
    assert len({x[0] for x in got}) == 5
    for v, n, num, den in lengths:
        alone = K.signer_choice(table.where(F.col("video_id") == v), every.where(F.col("video_id") == v).select("video_id", "n"), p, num / den, **options)
        assert sorted(tuple(x) for x in alone.collect()) == [x for x in got if x[0] == v]


def test_clips_shorter_than_a_visit_have_spots(spark):
    rows = [box(t, 0, 0) for t in range(6)]
    from dataclasses import replace

    long_visits = replace(P, min_visit_s=2.0)  # 20 frames, of a clip of 6: half of the clip is enough
    assert choose(spark, rows, 6, long_visits) == {t: 0 for t in range(6)}
    assert choose(spark, rows, 100, long_visits) == {}


def test_steady_frames_equal_a_loop(spark):
    import random

    from pyspark.sql import functions as F

    r = random.Random(2)
    rows = [(v, s, t, r.random() < 0.5) for v in range(3) for s in range(2) for t in range(80) if r.random() < 0.6]
    half = {0: 3, 1: 7, 2: 20}
    df = spark.createDataFrame(rows, "video_id long, segment long, frame long, active boolean").withColumn("w", F.when(F.col("video_id") == 0, 3).when(F.col("video_id") == 1, 7).otherwise(20))
    got = {(x["video_id"], x["segment"], x["t"]): x["cover"] for x in K.steady_segments(df, F.col("w"), 0.6, 0.4).collect()}
    want = {}
    for v in range(3):
        for s in range(2):
            seen = {t: a for vv, ss, t, a in rows if (vv, ss) == (v, s)}
            lo, hi = min(seen), max(seen)
            for t in range(lo, hi + 1):
                span = range(max(lo, t - half[v]), min(hi, t + half[v]) + 1)
                inside = [seen[u] for u in span if u in seen]
                if len(inside) >= 0.6 * len(span) and sum(inside) >= 0.4 * len(inside):
                    want[v, s, t] = len(inside)
    assert got == want


def test_steady_frames_are_counted_without_a_row_a_frame(spark):
    """A segment of two rows that are far apart sorts four ends; at a density of 0 its empty frames count as well, with a cover of 0."""
    df = spark.createDataFrame([(1, 0, 0, True), (1, 0, 40_000, None), (2, 7, 5, None)], "video_id long, segment long, frame long, active boolean")
    out = K.steady_segments(df, 3, 0.0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(sequence") < plan.index("Window")  # frames become rows above the windows
    got = {(x["video_id"], x["t"]): x["cover"] for x in out.collect()}
    assert got == {**{(1, t): int(t <= 3 or t >= 39_997) for t in range(40_001)}, (2, 5): 1}
    assert {x["t"] for x in K.steady_segments(df.where("video_id = 1"), 3, 0.1, 0.5).collect()} == {0, 1, 2, 3}


def test_segments_of_others_must_fit_an_anchor_of_the_main_spot(spark):
    from dataclasses import replace

    rows = [box(t, 0, 0) for t in range(60)] + [(1, t, 1, 10.0, 0.0, 50.0, 100.0) for t in range(62, 100)]
    tight = replace(P, merge_gap_s=0.1, link_iou=0.7)  # another spot, that overlaps the main one by 0.6
    assert set(choose(spark, rows, 100, replace(tight, other_iou=0.5))) == {*range(60), *range(62, 100)}
    assert set(choose(spark, rows, 100, replace(tight, other_iou=0.65))) == set(range(60))
    small = [box(t, 0, 0) for t in range(60)] + [(1, t, 1, 0.0, 0.0, 24.0, 100.0) for t in range(62, 100)]
    assert set(choose(spark, small, 100, replace(tight, other_scale=1.2))) == set(range(60))
    assert set(choose(spark, small, 100, replace(tight, other_scale=1.4))) == {*range(60), *range(62, 100)}


def test_spots_are_found_as_by_searching_all_of_them():
    import numpy as np

    p, rng = K.TrackParams(), np.random.default_rng(3)
    spots, seen, anchors = K.Founding(p), [], []  # of spots and anchors in the order they came, the first that overlaps most
    for _ in range(600):
        x, y, q = rng.integers(0, 4) * 40, rng.integers(0, 3) * 60, rng.integers(0, 12) * 4
        box, width, long = np.array([x, y, x + 60 + q, y + 80 + q], dtype=float), rng.choice([np.nan, 30.0, 36.0, 50.0]), bool(rng.random() < 0.3)
        at = -1
        if seen:
            over = K.pair_iou(box[None], np.array([s[0] for s in seen]))[0]
            k = int(np.argmax(over))
            side = lambda b: float(np.sqrt((b[2] - b[0]) * (b[3] - b[1])))
            if over[k] >= p.link_iou and K.alike((side(box), side(seen[k][0])), (width, seen[k][1]), p.fit_scale) and (long or K.pair_iou(box[None], np.array(anchors[k])).max() >= p.fit_iou):
                at = k
        new = at < 0
        if new:
            at = len(seen)
            seen.append((box, width))
            anchors.append([])
        if new or long:
            anchors[at].append(box)
        assert spots.place(box, width, long) == (at, new or long, new)


def test_a_box_asked_again_is_held_against_new_boxes_only(monkeypatch):
    import numpy as np

    b, sizes, pair = K.Boxes(), [], K.pair_iou
    for i in range(50):
        b.add(np.array([i, 0.0, i + 10, 10.0]), i)
    monkeypatch.setattr(K, "pair_iou", lambda x, y: sizes.append(len(y)) or pair(x, y))
    for _ in range(100):
        assert b.nearest(np.array([7.0, 0.0, 17.0, 10.0])) == (1.0, 7)
    assert sizes == [50]


def test_tracks_and_people_of_a_video_are_read_as_streams(spark):
    t = spark.createDataFrame([(0, 0, 3, 0.0, 0.0, 9.0, 9.0, None), (0, 1, 1, 0.0, 0.0, 9.0, 9.0, None)], "video_id long, track long, length long, x1 double, y1 double, x2 double, y2 double, scale double")
    found = K.found_spots(t, K.TrackParams(), 2, 3)
    people = K.person_tracks(spark.createDataFrame([(0, 0, 0, 0.1, 0.1)], "video_id long, frame long, pos long, cx double, cy double"))
    assert [tuple(r) for r in found.collect()] == [(0, 0, 0, True, True)]
    for df in (found, people):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "FlatMapGroups" not in plan
