"""Arm motion and masked runs against a loop over frames and people."""

import math
import random

import numpy as np
import pytest

from rhapsode.operators import motion as M

SCHEMA = "video_id long, frame long, pos long, kept boolean, joints array<struct<x:double,y:double,score:double>>"


def people(rng, frames=90):
    rows = []
    for v in range(3):
        for f in range(frames):
            if rng.random() < 0.08:
                continue
            n = rng.choice([0, 1, 2, 2, 3])
            kept = rng.choice([-1, 0, 0, 0])
            order = rng.sample(range(3), n)
            for pos, who in enumerate(order):
                base = 0.2 + 0.3 * who
                j = [(base + rng.gauss(0, 0.02), 0.4 + 0.02 * k + rng.gauss(0, 0.02 + 0.05 * v), rng.choice([0.9, 0.9, 0.9, 0.2])) for k in range(17)]
                if rng.random() < 0.1:
                    j[5] = j[6] = (base, 0.5, 0.9)
                if rng.random() < 0.05:
                    j[9] = (1.4, 0.5, 0.9)
                rows.append((v, f, pos, pos == kept, j))
    return rows


def seen(p):
    return p[2] > 0.3 and all(-0.25 <= c <= 1.25 for c in p[:2])


def real(j):
    neck = ((j[5][0] + j[6][0]) / 2, (j[5][1] + j[6][1]) / 2, 1.0 if j[5][2] > 0.3 and j[6][2] > 0.3 else 0.0)
    return sum(map(seen, j)) + seen(neck) >= 8


def loop_motion(rows, lo, hi, aspect, least, jump):
    rows = sorted(r for r in rows if lo <= r[0] < hi)
    width = {}
    for f, _, kept, j in rows:
        if kept and seen(j[5]) and seen(j[6]) and math.dist(j[5][:2], j[6][:2]) > 1e-6:
            width[f] = math.dist(j[5][:2], j[6][:2])
    extra = [(f, j) for f, _, kept, j in rows if not kept and real(j) and any(seen(j[k]) for k in (7, 8, 9, 10))]
    unknown = None if extra else 0.0
    if not width:
        return unknown
    median = float(np.median(list(width.values())))
    last, joints, before, used = [], [], None, set()
    for f, j in extra:
        if not (seen(j[5]) and seen(j[6]) and math.dist(j[5][:2], j[6][:2]) > 1e-6):
            continue
        if f != before:
            before, known, used = f, len(last), set()
        mx, my = (j[5][0] + j[6][0]) / 2, (j[5][1] + j[6][1]) / 2
        near = [(math.hypot(last[k][0] - mx * aspect, last[k][1] - my), k) for k in range(known) if k not in used]
        if near and min(near)[0] <= jump:
            k = min(near)[1]
        else:
            k = len(last)
            last.append(None), joints.append({i: [] for i in (7, 8, 9, 10)})
        used.add(k)
        last[k] = (mx * aspect, my)
        scale = max(width.get(f, median), 0.5 * median)
        for i in joints[k]:
            if seen(j[i]):
                joints[k][i].append(((j[i][0] - mx) / scale, (j[i][1] - my) / scale))
    found = [max(np.std(v, axis=0)) for person in joints for v in person.values() if len(v) >= least]
    return max(found) if found else unknown


@pytest.mark.parametrize("least", [3, 10])
def test_arm_motion_equals_a_loop(spark, least):
    rows = people(random.Random(least))
    df = spark.createDataFrame(rows, SCHEMA)
    windows = [(v, lo, lo + size) for v in range(4) for lo, size in ((0, 10), (5, 20), (10, 20), (0, 90), (88, 4), (200, 5))]
    w = spark.createDataFrame(windows, "video_id long, lo long, hi long")
    got = {(r["video_id"], r["lo"], r["hi"]): r["motion"] for r in M.arm_motion(M.bodies(df, 1.5), w, least, 0.2).collect()}
    assert len(got) == len(windows)
    states = set()
    for v, lo, hi in windows:
        want = loop_motion([r[1:] for r in rows if r[0] == v], lo, hi, 1.5, least, 0.2)
        states.add(None if want is None else want > 0)
        assert got[v, lo, hi] == (want if want is None else pytest.approx(want))
    assert states == {None, False, True}


@pytest.mark.parametrize(("gap", "block", "most"), [(2, 8, 0.4), (3, 7, 1.0), (1, 20, 0.2)])
def test_masked_runs_equal_a_loop(spark, gap, block, most):
    rows = people(random.Random(gap))
    limits = spark.createDataFrame([(v, gap, block) for v in range(3)], "video_id long, gap long, block long")
    got = sorted((r["video_id"], r["a"], r["b"]) for r in M.masked_runs(M.bodies(spark.createDataFrame(rows, SCHEMA), 1.5), limits, most, 4, 0.2).collect())
    want = []
    for v in range(3):
        mine = [r[1:] for r in rows if r[0] == v]
        good = [f for f in sorted({r[0] for r in mine}) if sum(real(r[3]) for r in mine if r[0] == f) >= 2]
        runs = []
        for f in good:
            if runs and f - runs[-1][1] <= gap:
                runs[-1][1] = f
            else:
                runs.append([f, f])
        masked = set()
        for a, b in ((a, b + 1) for a, b in runs if b + 1 - a >= gap):
            for lo in [*range(a, b - block, max(1, block // 2)), max(a, b - block)]:
                hi = min(lo + block, b)
                m = loop_motion(mine, lo, hi, 1.5, 4, 0.2)
                m = loop_motion(mine, a, b, 1.5, 4, 0.2) if m is None else m
                if m is None or m > most:
                    masked.add((lo, hi))
        merged = []
        for lo, hi in sorted(masked):
            if merged and lo <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], hi)
            else:
                merged.append([lo, hi])
        want += [(v, *m) for m in merged]
    assert got == sorted(want) and want


def test_nobody(spark):
    limits = spark.createDataFrame([(1, 2, 4)], "video_id long, gap long, block long")
    assert M.masked_runs(M.bodies(spark.createDataFrame([], SCHEMA), 1.0), limits).count() == 0
