"""Operator 6: suffix-array dedup over sparse suffixes at content-selected minimiser positions.

Of every LONG words in a row, each holds LONG - GRAM + 1 grams of GRAM words; the gram of the least hash is its minimiser. Passages of LONG words or
more that occur twice thus have a minimiser in common, so only suffixes that start at minimisers are kept (about one in 22 words), and of
those only the ones whose gram occurs twice. The suffixes of a gram go to one partition, where all are sorted by their words; each is compared with
its neighbours before it, as far as they share the gram, and the match is extended to the right and, by the words in front, to the left. Where both together
reach LONG words, the later of the two is a copy. Of grams that more than LOOK + 1 suffixes share, which could fill a partition, each run of LONG
words whose minimiser they are is hashed instead, and all places of a hash but the first are copies. Copies that overlap form the runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialize, small_batches
from .wordseq import gram_hashes, minimizers, sliding_min, word_hashes

LONG, GRAM = 50, 8
#: Words kept in front of a minimiser: a passage of LONG words starts no further from its first one.
FRONT = LONG - GRAM
#: Neighbours in front with which a suffix is compared: all that share its gram, as grams of more suffixes go the other way.
LOOK = 16


def anchors(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, minimiser positions and their grams' hashes; texts of fewer than LONG words have none."""
    h = word_hashes(words)
    if len(h) < LONG:
        return h, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    g = gram_hashes(h, GRAM)
    at = minimizers(g, LONG - GRAM + 1)
    return h, at, g[at]


def _select(docs: DataFrame, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, grams = [], []
            for t in b.column(2):
                _, a, g = anchors((t.as_py() or "").encode().lower().split())
                at.append(a.astype(np.int32))
                grams.append(g.view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.list_(pa.int32())), pa.array(grams, pa.list_(pa.int64()))], names=["doc_id", "text_key", "at", "grams"])

    return docs.mapInArrow(run, f"doc_id {kind}, text_key long, at array<int>, grams array<long>")


def windows(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each LONG words in a row, and the position of their minimiser."""
    g = gram_hashes(h, GRAM)
    low = np.uint64((1 << 32) - 1)
    m = sliding_min((g & ~low) | np.arange(len(g), dtype=np.uint64), LONG - GRAM + 1)
    return gram_hashes(h, LONG).view(np.int64), (m & low).astype(np.int64)


def _crowded(rows: DataFrame, kind: str) -> DataFrame:
    """(doc_id, text_key, at, run): the place and hash of each LONG words in a row whose minimiser is at one of the places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                b = batch.slice(lo, 64)
                which, ats, runs = [], [], []
                for i, (text, places) in enumerate(zip(b.column(2), b.column(3).to_pylist(), strict=True)):
                    w, owner = windows(word_hashes(text.as_py().encode().lower().split()))
                    p = np.nonzero(np.isin(owner, places))[0]
                    which.append(np.full(len(p), i)), ats.append(p.astype(np.int32)), runs.append(w[p])
                if which:
                    at = pa.array(np.concatenate(which))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(np.concatenate(ats)), pa.array(np.concatenate(runs))], names=["doc_id", "text_key", "at", "run"])

    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, at int, run long")


def _contexts(rows: DataFrame, kind: str) -> DataFrame:
    """(doc_id, text_key, at, ahead, front): the LONG words from each position and, backwards, the FRONT words before it, as hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                b = batch.slice(lo, 64)
                ids, keys, ats, ahead, front = [], [], [], [], []
                for doc_id, key, text, places in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                    h = word_hashes(text.as_py().encode().lower().split()).astype(">u4")
                    n, fore, back = len(h), h.tobytes(), h[::-1].tobytes()
                    for p in places:
                        ids.append(doc_id), keys.append(key), ats.append(p)
                        ahead.append(fore[4 * p : 4 * (p + LONG)])
                        front.append(back[4 * (n - p) : 4 * (n - p + FRONT)])
                yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(keys, pa.int64()), pa.array(ats, pa.int32()), pa.array(ahead, pa.binary()), pa.array(front, pa.binary())], names=["doc_id", "text_key", "at", "ahead", "front"])

    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, at int, ahead binary, front binary")


def _matrix(col: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(x) // 4 for x in col], dtype=np.int64)
    return np.frombuffer(b"".join(x.ljust(4 * width, b"\0") for x in col), dtype=">u4").reshape(-1, width), size


def common(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each pair of rows."""
    differ = x != y
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])
    return np.minimum(first, np.minimum(nx, ny))


def compare(rows: pd.DataFrame, start: int) -> pd.DataFrame:
    """Copies found by comparing rows from ``start`` on (sorted suffixes) with the LOOK rows before each.

    All matches of a suffix hold its first words, so that one row says what they cover together: from the furthest left end to the furthest right one.
    """
    n = len(rows)
    ahead, na = _matrix(rows["ahead"].tolist(), LONG)
    front, nf = _matrix(rows["front"].tolist(), FRONT)
    ids = rows["doc_id"].tolist()
    none = np.array([x is None for x in ids], dtype=bool)
    order = [none, np.array([0 if x is None else x for x in ids], dtype=np.int64), rows["text_key"].to_numpy(dtype=np.int64), rows["at"].to_numpy(dtype=np.int64)]
    at, left, right, source = order[3], np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for k in range(1, min(LOOK, n - 1) + 1):
        r = common(ahead[k:], ahead[:-k], na[k:], na[:-k])
        a = np.nonzero(r >= GRAM)[0]
        if not len(a):
            break  # rows further apart share no more
        b, r = a + k, r[a]
        f = common(front[b], front[a], nf[b], nf[a])
        first, tied = np.zeros(len(a), dtype=bool), np.ones(len(a), dtype=bool)  # a comes first in the order of documents
        for x in order:
            first |= tied & (x[a] < x[b])
            tied &= x[a] == x[b]
        ok = (f + r >= LONG) & (b >= start) & ~tied
        for side, later, earlier in ((ok & first, b, a), (ok & ~first, a, b)):
            t, s, fl, fr = later[side], earlier[side], f[side], r[side]  # each row is later at most once here
            more = fl > left[t]
            source[t[more]] = s[more]
            left[t], right[t] = np.maximum(left[t], fl), np.maximum(right[t], fr)
    t = np.nonzero(left >= 0)[0]
    s = source[t]
    pick = lambda i: [ids[j] for j in i.tolist()]
    return pd.DataFrame({"doc_id": pd.Series(pick(t), dtype=object), "text_key": order[2][t], "lo": at[t] - left[t], "hi": at[t] + right[t], "from_id": pd.Series(pick(s), dtype=object), "from_at": at[s] - left[t]})


def _neighbours(suffix: DataFrame, kind: str) -> DataFrame:
    """Copies found by sorting the suffixes of each gram and comparing neighbours."""
    parts = int(suffix.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for f in frames:
            if not len(f):
                continue
            f = f.astype({"doc_id": object}).where(f.notna(), None)
            rows, start = (f, 0) if held is None else (pd.concat([held, f], ignore_index=True), len(held))
            yield compare(rows, start)
            held = rows.tail(LOOK)

    dealt = suffix.repartition(parts, F.xxhash64(F.substring("ahead", 1, 4 * GRAM)))
    ordered = dealt.sortWithinPartitions("ahead", "front", "doc_id", "text_key", "at")
    return materialize(ordered.mapInPandas(scan, f"doc_id {kind}, text_key long, lo int, hi int, from_id {kind}, from_at int"), "copies")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, word_from, n_words, first_doc_id, first_word): runs of words to delete, as later copies of LONG words or more.

    Words are lower-cased (A-Z) runs without ASCII white space; word_from counts from 0. Later: in the order of doc_id (nulls last), then of the text's
    hash, then of the position. first_doc_id and first_word: the copy with which the run's beginning was matched. Null and empty texts, and
    those of fewer than LONG words, have no runs. Rows that repeat (id and text) count as one document. Ids are integers. Extra columns play no part.
    """
    base = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    with small_batches(docs.sparkSession):
        found = materialize(_select(base, kind).where(F.size("at") > 0), "minimisers")
    each = found.select("doc_id", "text_key", F.explode(F.arrays_zip("at", "grams")).alias("m")).select("doc_id", "text_key", F.col("m.at").alias("at"), F.col("m.grams").alias("gram"))
    twice = each.groupBy("gram").agg((F.count("*") > LOOK + 1).alias("crowded"), F.count("*").alias("n")).where("n > 1").select("gram", "crowded")
    twice = materialize(twice, "grams")  # a table of its own, so that a gram with very many places can be split in the join
    one = lambda crowded: F.collect_set(F.when(F.col("crowded") == crowded, F.col("at")))
    places = each.join(twice, "gram").groupBy("doc_id", "text_key").agg(one(False).alias("places"), one(True).alias("crowded"))
    places = materialize(places, "places")
    drop(found)
    d, p = base.alias("d"), places.alias("p")
    asked = d.join(p, F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.text_key") == F.col("p.text_key"))).select("d.doc_id", "d.text_key", "text", "places", "crowded")
    with small_batches(docs.sparkSession):
        suffix = materialize(_contexts(asked.where(F.size("places") > 0).drop("crowded"), kind), "suffixes")
        runs = materialize(_crowded(asked.where(F.size("crowded") > 0).drop("places"), kind), "runs")
    copies = _neighbours(suffix, kind)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "at")
    first = runs.groupBy("run").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("run", "first")
    first = materialize(first, "first_runs")  # so that a run with very many places can be split in the join
    later = runs.join(first, "run").where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")) & (F.col("at") == F.col("first.at"))))
    copies = copies.union(later.select("doc_id", "text_key", F.col("at").alias("lo"), (F.col("at") + LONG).alias("hi"), F.col("first.doc_id").alias("from_id"), F.col("first.at").alias("from_at"))).distinct()
    per = Window.partitionBy("doc_id", "text_key").orderBy("lo", "hi")
    apart = F.col("lo") > F.max("hi").over(per.rowsBetween(Window.unboundedPreceding, -1))
    runs = copies.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(per.rowsBetween(Window.unboundedPreceding, 0)))
    g = runs.groupBy("doc_id", "text_key", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min(F.struct("lo", F.col("from_id").isNull().alias("none"), "from_id", "from_at")).alias("a"))
    return g.select("doc_id", F.col("lo").alias("word_from"), (F.col("hi") - F.col("lo")).alias("n_words"), F.col("a.from_id").alias("first_doc_id"), F.col("a.from_at").alias("first_word")).distinct()
