"""Operator 8: embedding near-dedup by an epsilon grid order join.

Vectors of one label are scaled to length 1, so that cosine >= c is distance <= eps = sqrt(2 - 2c). Their leading
principal coordinates are cut into cells of width eps; sorted by cells, vectors near each other are near in the
sequence. The sequence is cut into intervals, each with a bounding box; only intervals whose boxes lie within eps are joined
(in a join on the cells of the first KEY_AXES axes). Such a pair is joined recursively: intervals whose boxes are provably apart are skipped,
others are halved down to PART vectors, whose cosines are computed. A task reads an interval once and its partners one
after the other. Principal axes come from a bounded sample (AXES_SAMPLE); they decide what can be skipped, never what links.

Equal vectors of a label form a class, so a vector that fills a third of the table is one point of the join. Pairs of
intervals return, for each class, the number of vectors it links with and one link to a representative, never
all pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches
from .components import connected_components

AXES, KEY_AXES, AXES_SAMPLE, INTERVAL, PART = 8, 3, 20_000, 2048, 128
#: Partners of an interval that one task compares with it; more of them are dealt to several.
PARTNERS = 32
#: Allowance for rounding when intervals are skipped.
SLACK = 1e-9


def _classes(rows: DataFrame, wide: bool) -> DataFrame:
    """(vec_id, grp, point, vec): vec as its bytes, point a digest of it; both null where the vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grp, point, vec = [], [], []
            for label, v in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                x = np.array([]) if label is None or not v.is_valid else v.values.to_numpy(zero_copy_only=False)
                if v.is_valid and v.values.null_count or not len(x) or not np.isfinite(x).all() or not x.any():
                    grp.append(None), point.append(None), vec.append(None)
                    continue
                raw = (x + 0).astype("<f8" if wide else "<f4").tobytes()  # -0.0 is 0.0
                grp.append(f"{label}/{len(x)}")
                point.append(hashlib.blake2b(raw, digest_size=16).digest())
                vec.append(raw)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(grp, pa.string()), pa.array(point, pa.binary()), pa.array(vec, pa.binary())], names=["vec_id", "grp", "point", "vec"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, grp string, point binary, vec binary")


def unit_rows(raw: bytes, n: int, wide: bool) -> np.ndarray:
    """n vectors, one after the other, scaled to length 1 in double precision."""
    x = np.frombuffer(raw, dtype="<f8" if wide else "<f4").reshape(n, -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in norms
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _axes(classes: DataFrame, wide: bool) -> dict[int, np.ndarray]:
    """Axes for each number of dimensions: principal ones of at most AXES_SAMPLE vectors in all, plain coordinates where the sample holds none."""
    n, width = classes.count(), 8 if wide else 4
    part = classes.where(F.pmod(F.xxhash64("point"), F.lit(1 << 20)) <= int(min(1.0, AXES_SAMPLE / max(n, 1)) * (1 << 20))).select("vec").limit(AXES_SAMPLE)
    by: dict[int, list] = {}
    for v in part.toPandas()["vec"]:
        by.setdefault(len(v) // width, []).append(v)
    dims = [r["d"] for r in classes.select((F.length("vec") / width).cast("int").alias("d")).distinct().collect()]
    out = {d: np.eye(d)[:, :AXES].copy() for d in dims}
    for d, vs in by.items():
        _, axes = np.linalg.eigh(np.cov(unit_rows(b"".join(vs), len(vs), wide), rowvar=False, bias=True).reshape(d, d))
        out[d] = axes[:, ::-1][:, : min(AXES, d)].copy()
    return out


def near_parts(p: np.ndarray, q: np.ndarray, eps2: float, same: bool) -> Iterator[tuple[int, int, int, int]]:
    """Parts (begin, end of each) of two intervals that may hold links; both are halved while their boxes lie within eps. same: pairs once."""
    stack = [(0, len(p), 0, len(q))]
    while stack:
        a, b, c, d = stack.pop()
        if same and d <= a:
            continue
        x, y = p[a:b], q[c:d]
        gap = np.maximum(0, np.maximum(y.min(axis=0) - x.max(axis=0), x.min(axis=0) - y.max(axis=0)))
        if gap @ gap > eps2 + SLACK:
            continue
        if b - a <= PART and d - c <= PART:
            yield a, b, c, d
        elif b - a >= d - c:
            m = (a + b) // 2
            stack += [(a, m, c, d), (m, b, c, d)]
        else:
            m = (c + d) // 2
            stack += [(a, b, c, m), (a, b, m, d)]


def join_intervals(a: np.ndarray, p: np.ndarray, b: np.ndarray, q: np.ndarray, least: float, eps2: float, same: bool = False) -> np.ndarray:
    """The matrix of links between two intervals of unit vectors a and b with their projections p and q."""
    out = np.zeros((len(a), len(b)), dtype=bool)
    for s, e, t, f in near_parts(p, q, eps2, same):
        out[s:e, t:f] = a[s:e] @ b[t:f].T >= least
    if same:
        np.fill_diagonal(out, False)
        out |= out.T
    return out


def representatives(links: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns, the least row or column index (columns after rows) that links reach within this matrix."""
    n, m = links.shape
    r = np.arange(n)
    c = r.copy() if same else np.arange(n, n + m)
    while True:
        r2 = np.minimum(r, np.where(links, c[None, :], n + m).min(axis=1, initial=n + m))
        c2 = np.minimum(c, np.where(links, r2[:, None], n + m).min(axis=0, initial=n + m))
        if same:
            r2 = c2 = np.minimum(r2, c2)
        if (r2 == r).all() and (c2 == c).all():
            return r, c
        r, c = r2, c2


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", least: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row.

    Vectors link when labels are equal and not null, dimensions agree, and the cosine, in double precision, is at least
    ``least``. Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Rows that repeat are
    vectors of their own and link with each other. A null id is never the least one; a component of null ids only has a null
    component_id and is kept. Extra columns play no part. An empty table gives an empty table.
    """
    eps = math.sqrt(2 - 2 * least)
    base = rows.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).alias("vec"))
    wide = base.schema["vec"].dataType.elementType.simpleString() != "float"
    table = materialize(_classes(base, wide), "vectors")
    classes = table.where("point is not null").groupBy("grp", "point").agg(F.first("vec").alias("vec"), F.count("*").alias("n"), F.min("vec_id").alias("least_id"))
    classes = materialize(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    axes, width = _axes(classes, wide), 8 if wide else 4

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for size, g in f.groupby(f["vec"].str.len()):
                cells = np.floor(unit_rows(b"".join(g["vec"]), len(g), wide) @ axes[size // width] / eps).astype(np.int64)
                yield pd.DataFrame({"grp": g["grp"], "c": g["c"], "n": g["n"], "vec": g["vec"], "cells": cells.tolist()})

    kinds = "grp string, c long, n long, vec binary, cells array<long>"
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    projected = classes.select("grp", "c", "n", "vec").mapInPandas(project, kinds)
    sorted_ = projected.repartitionByRange(parts, "grp", "cells", "c").sortWithinPartitions("grp", "cells", "c")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Intervals of the sequence: at most INTERVAL points of one group each."""
        held: list[tuple] = []

        def interval() -> pd.DataFrame:
            raw = b"".join(h[3] for h in held)
            x = unit_rows(raw, len(held), wide)
            p = x @ axes[x.shape[1]]
            lo, hi = p.min(axis=0), p.max(axis=0)
            return pd.DataFrame([{"grp": held[0][0], "lo": lo.tolist(), "hi": hi.tolist(), "ids": [h[1] for h in held], "ns": [h[2] for h in held], "x": raw}])

        for f in frames:
            for row in f[["grp", "c", "n", "vec"]].itertuples(index=False):
                if held and (row[0] != held[0][0] or len(held) == INTERVAL):
                    yield interval()
                    held = []
                held.append(tuple(row))
        if held:
            yield interval()

    blocks = sorted_.mapInPandas(cut, "grp string, lo array<double>, hi array<double>, ids array<long>, ns array<long>, x binary")
    blocks = materialize(blocks.withColumn("b", F.monotonically_increasing_id()), "intervals")
    boxes = blocks.select("b", "grp", "lo", "hi")

    def with_cells(side: DataFrame, more: int) -> DataFrame:
        """A row for each cell, on the first axes, that a box comes to within so many cells of."""
        for k in range(KEY_AXES):
            edge = lambda c: F.coalesce(F.floor(F.try_element_at(c, F.lit(k + 1)) / eps), F.lit(0))  # noqa: E731, B023
            side = side.withColumn(f"k{k}", F.explode(F.sequence(edge(F.col("lo")) - more, edge(F.col("hi")) + more)))
        return side

    one, two = with_cells(boxes, 1).alias("p"), with_cells(boxes, 0).alias("q")
    gap = F.zip_with(F.zip_with("p.lo", "q.hi", lambda x, y: x - y), F.zip_with("q.lo", "p.hi", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    near = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g) <= eps * eps + SLACK
    cell = [F.col(f"p.k{k}") == F.col(f"q.k{k}") for k in range(KEY_AXES)]
    pairs = one.join(two, [F.col("p.grp") == F.col("q.grp"), *cell, F.col("p.b") <= F.col("q.b"), near])
    pairs = materialize(pairs.select(F.col("p.b").alias("b1"), F.col("q.b").alias("b2")).distinct(), "interval_pairs")

    # an interval comes first, with no partner's number, and then its partners; of the interval itself no second copy
    pieces = pairs.groupBy("b1").agg(F.ceil(F.count("*") / PARTNERS).alias("pieces"))
    dealt = materialize(pairs.join(pieces, "b1").select("b1", F.pmod(F.xxhash64("b2"), "pieces").alias("piece"), "b2"), "dealt_pairs")
    body = blocks.select(F.col("b").alias("b2"), "ids", "ns", "x")
    own = dealt.select("b1", "piece").distinct().join(body.withColumnRenamed("b2", "b1"), "b1").select("b1", "piece", F.lit(None).cast("long").alias("b2"), "ids", "ns", "x")
    itself = dealt.where("b1 = b2").select("b1", "piece", "b2", F.array().cast("array<long>").alias("ids"), F.array().cast("array<long>").alias("ns"), F.lit(b"").alias("x"))
    partners = dealt.where("b1 <> b2").join(body, "b2").select("b1", "piece", "b2", "ids", "ns", "x")
    work = own.union(itself).union(partners).repartition(parts, "b1", "piece").sortWithinPartitions("b1", "piece", F.col("b2").asc_nulls_first())

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                ids, ns = np.asarray(r.ids, dtype=np.int64), np.asarray(r.ns, dtype=np.int64)
                same = r.b2 == r.b1
                if not same:
                    x = unit_rows(r.x, len(ids), wide)
                    p = x @ axes[x.shape[1]]
                if pd.isna(r.b2):
                    ids1, ns1, a, pa_ = ids, ns, x, p
                    continue
                if same:
                    ids, ns, x, p = ids1, ns1, a, pa_
                links = join_intervals(a, pa_, x, p, least, eps * eps, same)
                rows_, cols = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
                if not len(rows_):
                    continue
                n1, n2 = links @ ns, ns1 @ links
                r1, r2 = representatives(links[np.ix_(rows_, cols)], same)
                every = np.concatenate([ids1[rows_], ids[cols]])
                out = [pd.DataFrame({"c": ids1[rows_], "rep": every[r1], "n": n1[rows_]})]
                if not same:
                    out.append(pd.DataFrame({"c": ids[cols], "rep": every[r2], "n": n2[cols]}))
                yield pd.concat(out)

    with small_batches(rows.sparkSession, 16):
        found = materialize(work.mapInPandas(compare, "c long, rep long, n long"), "vector_links")
    comp = connected_components(found, "c", "rep").withColumnRenamed("node", "c")
    x = classes.select("grp", "point", "c", F.col("n").alias("copies"), "least_id").join(found.groupBy("c").agg(F.sum("n").alias("linked")), "c", "left").join(comp, "c", "left")
    x = materialize(x.withColumn("component", F.coalesce("component", "c")), "vector_components")
    top = x.groupBy("component").agg(F.min("least_id").alias("component_id"))
    x = x.join(top, "component").select("grp", "point", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = table.select("vec_id", "grp", "point").join(x, ["grp", "point"], "left")
    alone = F.col("point").isNull()
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
