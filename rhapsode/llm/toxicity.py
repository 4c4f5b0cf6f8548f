"""Operator 5: toxicity by the nearest labelled examples, exact TF-IDF cosine over a block-max inverted index.

Terms are words (runs of ASCII letters and characters beyond ASCII, lower-cased), known by 64-bit hashes. From a bounded sample of labelled rows (EXAMPLES of each label, by hash order)
come the examples, and every term of theirs is indexed. A term's idf counts every document; it is multiplied by what the term tells about the label:
its log odds ratio over the sample, drawn towards nothing by n / (n + PRIOR) where few (n) examples hold it, to the power SHARP. No term is left
out by a limit; what tells nothing weighs next to nothing. PRIOR and SHARP were set by cross-validation over learned rows only (README).
A text's neighbours are its K most similar examples, exactly: the terms that can add most are summed over their postings first, what the
others could add at most to any example, or to those of a block of examples, is known, and those that could still be among the K are summed whole. Their votes, weighted by squared
similarity and by what share of its label the sample holds, give the score; a few pseudo-votes at the base rate keep it calibrated. The
neighbours are the evidence.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, materialize, small_batches
from .ppm import Lookup
from .wordseq import words_in

EXAMPLES, K, BLOCK, PSEUDO, PRIOR, SHARP = 4000, 25, 64, 0.2, 5.0, 2.5
#: What terms that are left for later may add to a similarity altogether; any value gives the same neighbours.
SLACK = 0.02
#: More examples than this that could still be among the nearest are told apart by blocks.
FEW = 100
#: Every byte that no word holds becomes a space.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
PIECE, ROWS = 1 << 20, 256


def term_occurrences(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, key) of all term occurrences, in pieces of about PIECE bytes that hold whole texts; null texts have none."""
    held: list[bytes] = []
    size = first = 0
    for i, t in enumerate(texts):
        held.append((t or "").lower().encode().translate(_LETTERS))
        size += len(held[-1])
        if size >= PIECE or i + 1 == len(texts):
            raw = b"\n".join(held)
            begin = np.cumsum([0] + [len(x) + 1 for x in held[:-1]])
            start, _, key = words_in(raw)
            of = first + np.searchsorted(begin, start, "right") - 1
            yield of, key
            held, size, first = [], 0, i + 1


class TermCounts:
    """Counts the index terms, given by their sorted keys, of many texts at a time."""

    def __init__(self, keys: np.ndarray):
        self.n, self.at = max(1, len(keys)), Lookup(keys)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first entry of each text and the end, term, count)."""
        pairs, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for of, key in term_occurrences(texts):
            term = self.at(key)
            pair, n = np.unique(of[term >= 0] * self.n + term[term >= 0], return_counts=True)
            pairs.append(pair), counts.append(n)
        pair, n = np.concatenate(pairs), np.concatenate(counts)
        return np.searchsorted(pair, np.arange(len(texts) + 1) * self.n), pair % self.n, n


Vector = tuple[np.ndarray, np.ndarray]


def _lists(starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the elements of the given lists in their flat array, and the lists' sizes."""
    n = starts[which + 1] - starts[which]
    return np.repeat(starts[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum())), n


@dataclass
class BlockMaxIndex:
    """Unit TF-IDF vectors of the examples by term and by example, and each term's largest weight in each block of examples."""

    ids: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    by_term: tuple[np.ndarray, np.ndarray, np.ndarray]  # starts, examples, weights
    by_block: tuple[np.ndarray, np.ndarray, np.ndarray]  # starts, blocks, largest weights
    by_example: tuple[np.ndarray, np.ndarray, np.ndarray]  # starts, terms, weights
    top: np.ndarray
    dense: np.ndarray | None = None  # a query by term, while it is asked

    @classmethod
    def build(cls, vectors: list[Vector], ids: list, labels: list[int], votes: list[float]) -> BlockMaxIndex:
        strongest = [int(t[np.argmax(w)]) for t, w in vectors]
        order = sorted(range(len(vectors)), key=lambda e: (strongest[e], e))
        sizes = np.array([len(vectors[e][0]) for e in order], dtype=np.int64)
        flat = lambda k, kind: np.concatenate([np.zeros(0, dtype=kind), *(vectors[e][k].astype(kind) for e in order)])
        terms, weights = flat(0, np.int32), flat(1, np.float64)
        n_terms = int(terms.max()) + 1 if len(terms) else 0
        by = np.argsort(terms, kind="stable")
        t, w = terms[by], weights[by]
        e = np.repeat(np.arange(len(order), dtype=np.int32), sizes)[by]
        del by
        starts = lambda keys, n: np.searchsorted(keys, np.arange(n + 1, dtype=keys.dtype))
        block = e // np.int32(BLOCK)
        cut = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (block[1:] != block[:-1])])) if len(t) else np.zeros(0, dtype=np.int64)
        most = np.maximum.reduceat(w, cut) if len(t) else w
        top = np.zeros(n_terms)
        np.maximum.at(top, t[cut], most)
        take = lambda v, kind: np.array([v[x] for x in order], dtype=kind)
        return cls(
            take(ids, object), take(labels, np.int64), take(votes, np.float64),
            (starts(t, n_terms), e, w),
            (starts(t[cut], n_terms), block[cut], most),
            (np.concatenate([[0], np.cumsum(sizes)]), terms, weights),
            top,
        )

    def _sums(self, lists: tuple, terms: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
        at, size = _lists(lists[0], terms)
        return np.bincount(lists[1][at], weights=np.repeat(weights, size) * lists[2][at], minlength=n).astype(np.float64)

    def _whole(self, at: np.ndarray) -> np.ndarray:
        """Similarities of the given examples with the query in ``dense``."""
        if not len(at):
            return np.zeros(0)
        place, size = _lists(self.by_example[0], at)
        return np.add.reduceat(self.dense[self.by_example[1][place]] * self.by_example[2][place], np.cumsum(size) - size)

    def nearest(self, query: Vector, k: int = K) -> Vector:
        """(examples, similarities) of the k most similar examples of similarity above 0, ties to the earlier one."""
        terms, weights = query
        known = terms < len(self.top)
        terms, weights = terms[known], weights[known]
        bound = weights * self.top[terms]
        by = np.argsort(-bound, kind="stable")
        terms, weights, bound = terms[by], weights[by], bound[by]
        rest = np.cumsum(bound[::-1])[::-1]
        first = int(np.count_nonzero(rest > SLACK))
        n = len(self.labels)
        sims = self._sums(self.by_term, terms[:first], weights[:first], n)
        if first < len(terms) and n:
            floor = (np.partition(sims, n - k)[n - k] if n > k else 0.0) - 1e-11
            at = np.flatnonzero(sims + rest[first] * (1 + 1e-9) >= floor)
            if len(at) > FEW:
                later = self._sums(self.by_block, terms[first:], weights[first:], -(-n // BLOCK))
                at = np.flatnonzero(sims + np.repeat(later, BLOCK)[:n] * (1 + 1e-9) >= floor)
            if len(at) * 8 > n:
                sims += self._sums(self.by_term, terms[first:], weights[first:], n)
                at = np.flatnonzero(sims > 0)
                s = sims[at]
            else:
                at = at[np.argsort(-sims[at], kind="stable")]
                if self.dense is None:
                    self.dense = np.zeros(len(self.top))
                self.dense[terms] = weights
                s = self._whole(at[:k])
                if len(at) > k:  # the k-th of some is a better floor
                    more = at[k:][sims[at[k:]] + rest[first] * (1 + 1e-9) >= s.min() - 1e-11]
                    at, s = np.concatenate([at[:k], more]), np.concatenate([s, self._whole(more)])
                self.dense[terms] = 0.0
        else:
            at = np.flatnonzero(sims > 0)
            s = sims[at]
        at, s = at[s > 0], s[s > 0]
        if len(at) > k:
            near = s >= np.partition(s, len(s) - k)[len(s) - k] - 1e-11
            at, s = at[near], s[near]
        best = np.lexsort((at, -np.round(s, 12)))[:k]
        return at[best], s[best]


def term_weights(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """What terms tell that a of n1 toxic and b of n0 clean examples hold; nothing where either label has no example."""
    if not n1 or not n0:
        return np.zeros(len(a))
    odds = np.log((a + 0.5) / (n1 - a + 0.5)) - np.log((b + 0.5) / (n0 - b + 0.5))
    return np.abs(odds * (a + b) / (a + b + PRIOR)) ** SHARP


@dataclass
class ToxicityModel:
    terms: np.ndarray
    weights: np.ndarray
    index: BlockMaxIndex
    base: float

    def vector(self, t: np.ndarray, n: np.ndarray) -> Vector:
        """Terms and weights of the unit vector of terms that occur n times; both empty where no term weighs anything."""
        v = (1 + np.log(n)) * self.weights[t]
        norm = float(np.sqrt((v * v).sum()))
        return (t[v > 0], v[v > 0] / norm) if norm else (t[:0], v[:0])

    def score(self, vector: Vector) -> tuple[float, list, list[float]]:
        """(score, ids of the nearest examples, their similarities); texts without index terms get the base rate."""
        if not len(vector[0]):
            return self.base, [], []
        at, sims = self.index.nearest(vector)
        w = sims * sims * self.index.votes[at]
        s = (float((w * self.index.labels[at]).sum()) + PSEUDO * self.base) / (float(w.sum()) + PSEUDO)
        return min(1.0, max(0.0, s)), self.index.ids[at[:3]].tolist(), [round(float(x), 6) for x in sims[:3]]


def is_held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", examples: int = EXAMPLES, train_on=None) -> ToxicityModel:
    """Learns from labelled rows (by default those that aren't held out): ``examples`` of each label at most.

    Labels that are null, or whose id is null or has no document, are passed over; of rows that repeat an id, the largest label
    and the document of the least text hash count. The driver receives the index terms and the examples' sparse vectors only.
    """
    train_on = train_on or (lambda c: ~is_held_out(c))
    lab = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y is not null")
    lab = lab.where(train_on(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    lab = materialize(lab, "toxic_labels")
    totals = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}
    drawn = None
    for y in (0, 1):
        part = lab.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(examples)
        drawn = part if drawn is None else drawn.union(part)
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = text.join(F.broadcast(materialize(drawn, "toxic_sample")), "id")  # 2 * examples rows at most
    sample = sample.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = materialize(sample, "toxic_examples")

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = np.asarray(b.column(1))
            for of, key in term_occurrences(b.column(0).to_pylist()):
                by = np.lexsort((of, key))
                of, key = of[by], key[by]
                new = np.concatenate([[True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])]) if len(key) else np.zeros(0, dtype=bool)
                found, at = np.unique(key[new], return_inverse=True)
                n1 = np.bincount(at, weights=y[of[new]], minlength=len(found)).astype(np.int64)
                n = np.bincount(at, minlength=len(found))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n1), pa.array(n - n1)], names=["term", "a", "b"])

    n1, n0 = (sample.where(F.col("y") == y).count() for y in (1, 0))
    table = sample.select("text", "y").mapInArrow(presence, "term long, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow()  # bounded by the sample
    terms = np.asarray(table.column("term")).view(np.uint64)
    tells = term_weights(np.asarray(table.column("a"), dtype=np.float64), np.asarray(table.column("b"), dtype=np.float64), n1, n0)
    by = np.argsort(terms)
    terms, tells = terms[by], tells[by]
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, df, total = TermCounts(shared.value), np.zeros(len(shared.value) + 1, dtype=np.int64), 0
        for b in batches:
            total += b.num_rows
            df[:-1] += np.bincount(count(b.column(0).to_pylist())[1], minlength=len(df) - 1)
        df[-1] = total
        there = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(df[there])], names=["term", "n"])

    df = np.zeros(len(terms) + 1)
    with small_batches(docs.sparkSession):
        found = text.select("text").mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df[np.asarray(found.column("term"))] = np.asarray(found.column("n"))
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = TermCounts(shared.value)
        for b in batches:
            begin, term, n = count(b.column(2).to_pylist())
            lists = [pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(x)) for x in (term, n)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1), *lists], names=["id", "y", "t", "n"])

    got = sample.select("id", "y", "text").mapInArrow(sparse, "id string, y int, t array<bigint>, n array<bigint>").toArrow().sort_by("id")
    share = {y: totals.get(y, 0) / max(1, k) for y, k in ((0, n0), (1, n1))}  # each example stands for so many labelled rows
    top = max([*share.values(), 1e-9])
    model = ToxicityModel(terms, idf * tells, BlockMaxIndex.build([], [], [], []), 0.0)
    kept, none = [], Counter()
    for i in range(got.num_rows):
        name, y = got.column("id")[i].as_py(), got.column("y")[i].as_py()
        v = model.vector(*(np.asarray(got.column(x)[i].values) for x in ("t", "n")))
        none[y] += not len(v[0])
        if len(v[0]):
            kept.append((v, int(name) if name.lstrip("-").isdigit() else name, y, share[y] / top))
    del got, table, found
    pa.default_memory_pool().release_unused()
    model.index = BlockMaxIndex.build(*([k[i] for k in kept] for i in range(4)))
    clean, toxic = none[0] * share[0], none[1] * share[1]
    model.base = (toxic + 0.5) / (clean + toxic + 10)
    drop(lab, sample)
    return model


def scored(docs: DataFrame, model: ToxicityModel, text_col: str = "text", names: tuple[str, str, str] = ("score", "evidence", "similarity"), below: float | None = None) -> DataFrame:
    """docs without the text and three columns: score, ids of the nearest examples as text, and their similarities. Null texts are empty.

    below: whole rows come back instead, those of lower scores only.
    """
    at = docs.columns.index(text_col)
    rest = [i for i in range(len(docs.columns)) if i != at or below is not None]

    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        count, known = TermCounts(model.terms), {}

        def scored(t: np.ndarray, n: np.ndarray) -> tuple[float, list, list[float]]:
            same = hashlib.blake2b(t.tobytes() + n.tobytes(), digest_size=16).digest()  # copies are scored once
            if same not in known:
                if len(known) > 20_000:
                    known.clear()
                known[same] = model.score(model.vector(t, n))
            return known[same]

        for b in (whole.slice(lo, ROWS) for whole in batches for lo in range(0, whole.num_rows, ROWS)):
            begin, term, n = count(b.column(at).to_pylist())
            out = [scored(term[lo:hi], n[lo:hi]) for lo, hi in zip(begin, begin[1:], strict=False)]
            cols = [pa.array([o[0] for o in out], pa.float64()), pa.array([[str(x) for x in o[1]] for o in out], pa.list_(pa.string())), pa.array([o[2] for o in out], pa.list_(pa.float64()))]
            out_batch = pa.RecordBatch.from_arrays([*(b.column(i) for i in rest), *cols], names=[*(b.schema.names[i] for i in rest), *names])
            yield out_batch if below is None else out_batch.filter(pa.array([o[0] < below for o in out], pa.bool_()))

    kinds = [T.DoubleType(), T.ArrayType(T.StringType()), T.ArrayType(T.DoubleType())]
    return docs.mapInArrow(run, T.StructType([*(docs.schema.fields[i] for i in rest), *(T.StructField(n, k) for n, k in zip(names, kinds, strict=True))]))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, similarity), a row for each row of docs.

    held_out: crc32 of the id as text is a multiple of 5; such rows are never learned from; a null id is not held out. Null and
    empty texts get the rate of examples without index terms. Rows that repeat get equal scores. Without usable labels the score is the
    pseudo-rate 0.05 for every row. Ids, sources and languages are never inputs of a score. Extra columns play no part.
    """
    model = fit(docs, labels, id_col, text_col, label_col)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = scored(base, model).withColumn("held_out", is_held_out(F.col("doc_id")))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "similarity")


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """docs without the rows that score 0.5 or more; columns unchanged."""
    from .common import fresh

    model = fit(docs, labels, id_col, text_col, label_col)
    names = fresh(docs, "score", "evidence", "similarity")
    return scored(docs, model, text_col, tuple(names), below=0.5).drop(*names)
