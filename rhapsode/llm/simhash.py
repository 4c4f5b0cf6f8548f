"""Operator 10: SimHash near-dedup; equal-radius pairs of 64-bit fingerprints by vantage-point partitioning.

Fingerprints are computed in Arrow batches. Distinct fingerprints are then dealt by a vantage-point tree: each level
has a vantage point, and each node a threshold, the median distance of a bounded sample. A fingerprint whose distance is
at most the threshold goes to the inner child, others to the outer one; by the triangle inequality a pair within
RADIUS that this separates has an inner member less than RADIUS below the threshold, so such members are copied to
the outer child as well. Each leaf then holds every pair at least once, and the shards (leaves) are searched for
themselves: further vantage levels in memory, then exact comparison. A dense family, which no vantage point parts, is dealt into blocks, and each pair of
blocks is a shard. Shards return links along which their members connect, at most one for each member and shard, never all pairs; components join them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, materialize, small
from .components import connected_components

RADIUS, SHINGLE = 2, 3
#: Fingerprints that a shard is meant to hold; how many more make it dense; sample from which the thresholds are taken; size below which all are compared.
SHARD, DENSE, SAMPLE, BRUTE = 2048, 8, 65536, 256


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """SimHash of the n-word shingles, repeats included; no words, or a null text: 0."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    grams = map(b" ".join, zip(*[words[i:] for i in range(n)], strict=False)) if len(words) >= n else [b" ".join(words)]
    count = max(1, len(words) - n + 1)
    of = xxhash.xxh64_intdigest
    h = np.fromiter((of(g, 42) for g in grams), dtype="<u8", count=count)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, count, 8192):  # bounded memory, and counts that fit uint16
        bits = np.unpackbits(h[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str, name: str, n: int = SHINGLE) -> DataFrame:
    """docs without the text, which need not come back from the workers, and a column of fingerprints as signed longs."""
    at = docs.columns.index(text_col)
    rest = [i for i in range(len(docs.columns)) if i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), n) for t in b.column(at)], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in rest), pa.array(fp)], names=[*(b.schema.names[i] for i in rest), name])

    return docs.mapInArrow(run, T.StructType([*(docs.schema.fields[i] for i in rest), T.StructField(name, T.LongType())]))


def vantage_points(levels: int) -> np.ndarray:
    """Pseudo-random 64-bit points, the same in each run; hashed, as they must not lie near each other."""
    x = (np.arange(1, levels + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fit_thresholds(sample: np.ndarray, levels: int) -> list[np.ndarray]:
    """The thresholds of each level's nodes: the median distance of the sample's points there, boundary copies included."""
    points, nodes, out = sample, np.zeros(len(sample), dtype=np.int64), []
    for level, p in enumerate(vantage_points(levels)):
        d = np.bitwise_count(points ^ p).astype(np.int64)
        cut = np.full(2**level, 32, dtype=np.int64)
        order = np.lexsort((d, nodes))
        start = np.searchsorted(nodes[order], np.arange(2**level + 1))
        filled = start[1:] > start[:-1]
        cut[filled] = d[order][((start[:-1] + start[1:] - 1) // 2)[filled]]
        out.append(cut)
        points, nodes, _ = step(points, nodes, np.arange(len(points)), p, cut)
    return out


def step(points: np.ndarray, nodes: np.ndarray, rows: np.ndarray, p: np.uint64, cut: np.ndarray | int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One level down: inner points, outer points, and copies of inner points near the boundary in the outer child. cut: one threshold, or one for each node."""
    d = np.bitwise_count(points ^ p).astype(np.int64)
    limit = cut if isinstance(cut, int) else cut[nodes]
    inner = d <= limit
    near = inner & (d + radius > limit)
    return np.concatenate([points, points[near]]), np.concatenate([2 * nodes + ~inner, 2 * nodes[near] + 1]), np.concatenate([rows, rows[near]])


def links_within(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (indexes) that connect just those points which chains of pairs within radius connect, each point once at most."""
    parent = np.arange(len(fps))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    stack = [(np.arange(len(fps)), 0)]
    points = vantage_points(128)[64:]
    while stack:
        rows, level = stack.pop()
        if len(rows) > BRUTE and level < len(points):
            d = np.bitwise_count(fps[rows] ^ points[level]).astype(np.int64)
            cut = np.sort(d)[(len(d) - 1) // 2]
            inner, outer = rows[d <= cut], rows[d + radius > cut]
            if max(len(inner), len(outer)) <= 0.9 * len(rows):
                stack += [(inner, level + 1), (outer, level + 1)]
                continue
            if level + 1 < len(points) and len(rows) > 8 * BRUTE:  # a poor vantage point here; the next may do
                stack.append((rows, level + 1))
                continue
        x, own = fps[rows], np.arange(len(rows))
        for i in range(0, len(x), 512):  # the least row that each row of these reaches through them; one link for each row that lies in a pair
            near = np.bitwise_count(x[i : i + 512, None] ^ x[None, :]) <= radius
            least, before = own.copy(), None
            while before is None or (least != before).any():
                before = least
                low = np.where(near, least, len(x)).min(axis=1)
                least = np.minimum(least, np.where(near, low[:, None], len(x)).min(axis=0))
            for s, t in zip(rows[least != own].tolist(), rows[least[least != own]].tolist(), strict=True):
                s, t = root(s), root(t)
                if s != t:
                    parent[max(s, t)] = min(s, t)
    roots = np.array([root(i) for i in range(len(fps))], dtype=np.int64)
    member = np.nonzero(roots != np.arange(len(fps)))[0]
    return member, roots[member]


def near_fingerprints(fps: DataFrame, col: str, radius: int = RADIUS) -> DataFrame:
    """(a, b): links whose chains connect exactly the fingerprints that chains of pairs within radius connect.

    fps: distinct signed longs. The sample that sets thresholds is bounded (SAMPLE) and only balances shards.
    """
    count = fps.count()
    share = min(1.0, SAMPLE / max(count, 1))
    drawn = fps.where(F.pmod(F.xxhash64(F.col(col), F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20))).select(col).limit(2 * SAMPLE).toPandas()
    levels = 0
    while levels < 40 and count * 0.62**levels > SHARD:
        levels += 1
    sample = drawn[col].to_numpy(dtype="<i8").view("<u8")
    deep = min(levels, 14)  # below that the sample is too thin; deeper levels cut at their parent's usual distance
    cuts, points = fit_thresholds(sample, deep), vantage_points(levels)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x = f[col].to_numpy(dtype="<i8").view("<u8")
            nodes, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
            for level in range(levels):
                cut = cuts[level] if level < deep else 31 + level % 2
                x, nodes, rows = step(x, nodes, rows, points[level], cut, radius)
            yield pd.DataFrame({"shard": nodes, "fp": x.view("<i8")})

    def search(f: pd.DataFrame) -> pd.DataFrame:
        x = f["fp"].drop_duplicates().to_numpy(dtype="<i8")
        a, b = links_within(x.view("<u8"), radius)
        return pd.DataFrame({"a": x[a], "b": x[b]})

    dealt = materialize(fps.select(col).mapInPandas(deal, "shard long, fp long"), "shards")
    dense = dealt.groupBy("shard").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("blocks")).where(F.col("blocks") > DENSE)
    dealt = dealt.join(small(materialize(dense, "dense_shards")), "shard", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("fp", F.lit(3)), "blocks").cast("int")
    dealt = dealt.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = ["shard", F.least("block", "other"), F.greatest("block", "other")]
    return dealt.groupBy(*unit).applyInPandas(search, "a long, b long")


def fingerprint_components(table: DataFrame, fp: str, doc_id: str) -> DataFrame:
    """(fp, component, component_id) for each fingerprint of table; component_id: the least doc_id reachable, null where all are null."""
    (least,) = fresh(table, "least_id")
    each = materialize(table.groupBy(fp).agg(F.min(doc_id).alias(least)), "fingerprints")
    comp = connected_components(near_fingerprints(each, fp), "a", "b")
    x = each.join(comp.withColumnRenamed("node", fp), fp, "left").withColumn("component", F.coalesce("component", fp))
    x = materialize(x, "components")
    top = x.groupBy("component").agg(F.min(least).alias("component_id"))
    return x.join(top, "component").select(fp, "component", "component_id")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each row of docs.

    Null and empty texts have fingerprint zero and link with each other. component_id is the least id of the
    component, null only where all its ids are null. Rows that repeat each get a row. Extra columns play no part.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fp = materialize(with_fingerprints(base, "text", "fp"), "simhash")
    comp = fingerprint_components(fp, "fp", "doc_id")
    return fp.join(comp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component: the one of the least id (nulls last); columns unchanged.

    Rows are told apart by a 128-bit hash of all their columns (maps aside); of rows that repeat in all of them one stays. Texts are
    never shuffled, only hashes are.
    """
    fp, h1, h2 = fresh(docs, "fp", "h1", "h2")
    cols = [F.col(f.name) for f in docs.schema if not isinstance(f.dataType, T.MapType)]
    keyed = docs.withColumn(h1, F.xxhash64(*cols)).withColumn(h2, F.xxhash64(F.lit(1), *cols))
    slim = keyed.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(h1).alias("h1"), F.col(h2).alias("h2"))
    table = materialize(with_fingerprints(slim, "text", "fp"), "simhash")
    comp = fingerprint_components(table, "fp", "doc_id")
    # of one fingerprint the first row stands for all; a component's first of those stays
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")
    first = materialize(table.groupBy("fp").agg(F.min(place).alias("k")).join(comp, "fp"), "firsts")
    keep = first.groupBy("component").agg(F.min("k").alias("k")).select(F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2"))
    rows = materialize(table.groupBy("h1", "h2").agg(F.count("*").alias("n")).join(keep.withColumn("kept", F.lit(True)), ["h1", "h2"], "left"), "rows")
    gone = rows.where("kept is null").select(F.col("h1").alias(h1), F.col("h2").alias(h2))
    left = keyed.join(small(gone, 1_000_000), [h1, h2], "left_anti")
    again = rows.where("kept and n > 1").select(F.col("h1").alias(h1), F.col("h2").alias(h2))
    if not again.isEmpty():
        again = small(again, 1_000_000)
        left = left.join(again, [h1, h2], "left_anti").union(left.join(again, [h1, h2], "left_semi").dropDuplicates([h1, h2]).select(left.columns))
    return left.select(docs.columns)
