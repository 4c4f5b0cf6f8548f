import math

import numpy as np

from rhapsode.llm.egojoin import near_vectors

from .helpers import SF


def brute(rows, least=0.93):
    n = len(rows)
    ok, unit = [], []
    for _, v, label in rows:
        good = label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        ok.append(good)
        x = np.array(v, dtype=float) if good else None
        unit.append(x / np.linalg.norm(x) if good else None)
    comp, links = list(range(n)), [0] * n
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                if comp[i] != comp[j]:
                    old, new = comp[i], comp[j]
                    comp = [new if c == old else c for c in comp]
    out = []
    for i in range(n):
        least_id = min((rows[j][0] for j in range(n) if comp[j] == comp[i] and rows[j][0] is not None), default=None)
        out.append((rows[i][0], links[i], least_id, rows[i][0] == least_id))
    return sorted(out, key=repr)


def check(df):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert sorted((tuple(r) for r in near_vectors(df).collect()), key=repr) == brute(rows)


def test_table(spark):
    check(spark.read.parquet(f"{SF}/embeddings.parquet"))


def clustered(n, seed, dims=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dims))
    rows = [(int(i), (base[i % 12] + rng.normal(size=dims) * (0.15 if i % 3 else 0.5)).astype("f4").tolist(), int(i % 2)) for i in range(n)]
    return rows + [(n + i, rows[0][1], 0) for i in range(60)]  # copies of one vector


def test_chains_and_copies_over_many_intervals(spark, monkeypatch):
    import rhapsode.llm.egojoin as E

    monkeypatch.setattr(E, "INTERVAL", 32)
    monkeypatch.setattr(E, "PART", 8)
    monkeypatch.setattr(E, "PARTNERS", 2)
    monkeypatch.setattr(E, "PART", 8)
    check(spark.createDataFrame(clustered(400, 3), "vec_id long, embedding array<float>, label int"))


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, v, None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0, 0.0], 0), (7, [1.0, None, 3.0], 0), (8, [1.0, math.nan, 3.0], 0), (9, [math.inf, 2.0, 3.0], 0), (10, v, 1), (None, v, 1), (11, [*v, 0.0], 0), (None, [3.0, -2.0, 0.0], 1), (12, [2.0, 4.0, 6.0], 0), (13, [0.0, -0.0, 1.0], 1), (14, [-0.0, 0.0, 1.0], 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, grp string, n int")
    check(df)
    assert near_vectors(df.limit(0)).count() == 0


def test_dimensions_that_the_sample_misses(spark, monkeypatch):
    import rhapsode.llm.egojoin as E

    monkeypatch.setattr(E, "AXES_SAMPLE", 0)
    v, w = [1.0, 2.0, 3.0], [float(i % 7) for i in range(12)]
    rows = [*clustered(40, 5), (900, v, 0), (901, [1.0, 2.0, 3.01], 0), (902, [-3.0, 2.0, 1.0], 0), (903, w, 0), (904, [*w[:11], 3.5], 0), (905, [5.0], 0), (906, [2.0], 0)]
    check(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
