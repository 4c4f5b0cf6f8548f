"""Operator 12: log-probabilities of texts by prediction by partial matching over bytes, pretrained, and a unigram baseline.

The model predicts each byte, and an end symbol, from the ORDER symbols before it (a text begins after pads). Counts of all sequences of
up to ORDER + 1 symbols, from every training text, are the context trie. A symbol is coded in the longest context that has been seen; where it never followed
that context, an escape is coded and the next shorter context is asked, without the symbols that the longer one has shown (exclusion), down to
an even choice among symbols never seen. Escapes are estimated by method C: a context of total T that has shown D different symbols gives an escape
D / (T + D).

Counts don't change while texts are scored, and the symbols of a context are among those of each shorter one. So what exclusion takes away in the shorter
context is a number of the longer context alone, and the trie carries finished logarithms: joins and aggregations over the counts make them (``trie``).
Tasks that score hold one part of the trie at a time (PART_NODES); parts are dealt by the last two symbols of the context, and
every position of a text is scored in the part of its own context, so the trie may grow beyond any one task's memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, materialize, new_path, small_batches
from .textscan import LOWER, Tally, bytes_of, segments
from .tokenio import _fs, _uri
from .wordseq import words_in

#: Symbols of context (at most 5, so that a sequence fits into 54 bits); nodes of a part of the trie that a task holds.
ORDER, PART_NODES = 4, 3_000_000
#: Bytes of text that are scored at a time.
CHUNK = 1 << 21
BITS, END, SYMBOLS = 9, 257, 257
#: Words more frequent than one in so many are looked up while texts are read: there are fewer than HOT of them, whatever the corpus.
HOT = 10_000


def mask(length: int) -> int:
    return (1 << (BITS * length)) - 1


@dataclass
class Chunk:
    """Symbols of texts or segments of texts, each after ``order`` symbols of context that don't count themselves."""

    symbols: np.ndarray
    begin: np.ndarray  # first counted symbol of each part
    end: np.ndarray
    text: list[int]  # which text of the task each part belongs to
    raw: bytes  # all parts, a line break after each
    raw_begin: np.ndarray

    def codes(self, order: int) -> np.ndarray:
        """The order + 1 symbols that end at each position, the newest in the low bits, from position ``order`` on."""
        x = self.symbols.astype(np.uint64)
        c = np.zeros(max(0, len(x) - order), dtype=np.uint64)
        for k in range(order + 1):
            c = (c << np.uint64(BITS)) | x[k : k + len(c)]
        return c

    def counted(self) -> np.ndarray:
        m = np.zeros(len(self.symbols) + 1, dtype=np.int8)
        m[self.begin] += 1
        m[self.end] -= 1
        return np.cumsum(m[:-1]).astype(bool)


def chunks(texts: Iterator[bytes], order: int, size: int = CHUNK) -> Iterator[Chunk]:
    """Lower-cased texts in chunks; a text longer than ``size`` is cut at white space, each segment with the bytes before it as context."""
    held: list[tuple[int, bytes, bytes, bool]] = []
    total = 0
    for i, text in enumerate(texts):
        raw = text.translate(LOWER)
        for lo, hi in segments(raw, size):
            held.append((i, raw[max(0, lo - order) : lo], raw[lo:hi], hi == len(raw)))
            total += hi - lo + order + 1
            if total >= size:
                yield _chunk(held, order)
                held, total = [], 0
    if held:
        yield _chunk(held, order)


def _chunk(held: list[tuple[int, bytes, bytes, bool]], order: int) -> Chunk:
    raw = b"\n".join([p[2] for p in held] + [b""])
    sizes = np.array([len(p[2]) for p in held])
    raw_begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    last = np.array([p[3] for p in held])
    end = np.cumsum(order + sizes + last)
    begin = end - sizes - last
    x = np.zeros(int(end[-1]), dtype=np.uint16)
    body = np.frombuffer(raw, dtype=np.uint8)
    for k, (_, before, text, _) in enumerate(held):
        x[begin[k] : begin[k] + len(text)] = body[raw_begin[k] : raw_begin[k] + len(text)]
        x[begin[k] : begin[k] + len(text)] += 1
        if before:
            x[begin[k] - len(before) : begin[k]] = np.frombuffer(before, dtype=np.uint8).astype(np.uint16) + 1
    x[end[last] - 1] = END
    return Chunk(x, begin, end, [p[0] for p in held], raw, raw_begin)


def corpus_counts(texts: DataFrame, order: int) -> DataFrame:
    """(kind, key, n): kind 0 words by hash, 1 sequences of order + 1 symbols, 2 texts; of a table with the one column text."""

    def rows(kind: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, dtype=np.int32)), pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["kind", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies, seen = (Tally(), Tally()), 0

        def texts() -> Iterator[bytes]:
            nonlocal seen
            for b in batches:
                seen += b.num_rows
                yield from bytes_of(b.column(0))

        for c in chunks(texts(), order):
            tallies[0].add(words_in(c.raw)[2])
            tallies[1].add(c.codes(order)[c.counted()[order:]])
            for kind, t in enumerate(tallies):
                if t.full():
                    yield rows(kind, *t.take())
        for kind, t in enumerate(tallies):
            yield rows(kind, *t.take())
        yield rows(2, np.zeros(1, dtype=np.uint64), np.array([seen]))

    return texts.mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _low(code: str, length: Column) -> Column:
    """The newest ``length`` symbols of a code."""
    return F.col(code).bitwiseAND(F.element_at(F.array(*(F.lit(mask(i)) for i in range(8 * 8 // BITS))), (length + 1).cast("int")))


def trie(sequences: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """From (code, n) of all sequences of order + 1 symbols: (grams, contexts) with the logarithms that scoring adds up.

    grams: (size, code, first, plain): ln p of the last symbol where coding starts in the context before it, and ln of its count.
    contexts: (size, code, escape, chain, room): ln of an escape where coding starts here; the sum of the ln of further escapes from here down to
    the empty context, after exclusion; ln of what exclusion by this context leaves in the next shorter one.
    """
    g = sequences.select(F.explode(F.sequence(F.lit(1), F.lit(order + 1))).alias("size"), "code", "n").select("size", _low("code", F.col("size")).alias("code"), "n")
    g = materialize(g.groupBy("size", "code").agg(F.sum("n").alias("n")), "ppm_grams")
    shorter = g.select((F.col("size") + 1).alias("size"), F.col("code").alias("low"), F.col("n").alias("m"))
    both = g.withColumn("low", _low("code", F.col("size") - 1)).join(shorter, ["size", "low"], "left")
    up = F.shiftrightunsigned("code", BITS)
    ctx = both.groupBy((F.col("size") - 1).alias("size"), up.alias("code")).agg(F.sum("n").alias("t"), F.count("*").alias("d"), F.sum("m").alias("x"))
    ctx = materialize(ctx, "ppm_contexts")
    below = ctx.select((F.col("size") + 1).alias("size"), F.col("code").alias("low"), F.col("t").alias("st"), F.col("d").alias("sd"))
    left = F.col("sd") - F.col("d")
    room = F.col("st") - F.col("x") + left
    step = ctx.where("size > 0").withColumn("low", _low("code", F.col("size") - 1)).join(below, ["size", "low"])
    step = step.select("size", "code", F.when(room > 0, F.ln(room.cast("double"))).otherwise(0.0).alias("room"), F.when(left > 0, F.ln(left / room)).otherwise(0.0).alias("step"))
    step = materialize(step, "ppm_steps")
    path = ctx.where("size > 0").select("size", "code", F.explode(F.sequence(F.lit(1), F.col("size"))).alias("k")).withColumn("low", _low("code", F.col("k")))
    chain = path.join(step.select(F.col("size").alias("k"), F.col("code").alias("low"), "step"), ["k", "low"]).groupBy("size", "code").agg(F.sum("step").alias("chain"))
    contexts = ctx.join(step.drop("step"), ["size", "code"], "left").join(chain, ["size", "code"], "left")
    contexts = contexts.select("size", "code", F.ln(F.col("d") / (F.col("t") + F.col("d"))).alias("escape"), F.coalesce("chain", F.lit(0.0)).alias("chain"), F.coalesce("room", F.lit(0.0)).alias("room"), "d")
    grams = g.withColumn("up", up).join(ctx.select((F.col("size") + 1).alias("size"), F.col("code").alias("up"), "t", "d"), ["size", "up"])
    grams = grams.select("size", "code", (F.ln(F.col("n").cast("double")) - F.ln((F.col("t") + F.col("d")).cast("double"))).alias("first"), F.ln(F.col("n").cast("double")).alias("plain"))
    return grams, contexts


class Lookup:
    """Rows by 64-bit key, open addressing."""

    EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, keys: np.ndarray):
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.wrap = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.rows = np.full(1 << bits, self.EMPTY), np.zeros(1 << bits, dtype=np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            s = slot[left]
            free = np.flatnonzero(self.keys[s] == self.EMPTY)
            _, one = np.unique(s[free], return_index=True)
            put = free[one]
            self.keys[s[put]], self.rows[s[put]] = keys[left[put]], left[put]
            rest = np.ones(len(left), dtype=bool)
            rest[put] = False
            left = left[rest]
            slot[left] = (slot[left] + 1) & self.wrap

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        slot = self._slot(keys)
        there = self.keys[slot]
        hit = there == keys
        out = np.where(hit, self.rows[slot], np.int32(-1))
        left = np.flatnonzero(~hit & (there != self.EMPTY))
        while len(left):
            s = slot[left] = (slot[left] + 1) & self.wrap
            there = self.keys[s]
            hit = there == keys[left]
            out[left[hit]] = self.rows[s[hit]]
            left = left[~hit & (there != self.EMPTY)]
        return out


def keyed(size: np.ndarray | int, code: np.ndarray) -> np.ndarray:
    return code | (np.uint64(size) << np.uint64(56) if np.isscalar(size) else size.astype(np.uint64) << np.uint64(56))


@dataclass
class TriePart:
    order: int
    gram: Lookup
    first: np.ndarray
    plain: np.ndarray
    context: Lookup
    escape: np.ndarray
    chain: np.ndarray
    room: np.ndarray
    novel: float  # ln of one of the symbols never seen

    @classmethod
    def read(cls, path: str, order: int, part: int) -> TriePart:
        fs, root = _fs(path)

        def table(name: str, *columns: str) -> list[np.ndarray]:
            t = ds.dataset(f"{root}/{name}", filesystem=fs, format="parquet", partitioning=ds.partitioning(pa.schema([("part", pa.int32())]), flavor="hive"))
            if not t.files:  # nothing was learned
                return [np.zeros(0, dtype=np.int64)] * 2 + [np.zeros(0)] * len(columns)
            t = t.to_table(columns=["size", "code", *columns], filter=ds.field("part").isin([-1, part]))
            return [np.asarray(t.column(i)) for i in range(t.num_columns)]

        gs, gc, first, plain = table("grams", "first", "plain")
        cs, cc, escape, chain, room, d = table("contexts", "escape", "chain", "room", "d")
        seen = d[cs == 0]
        novel = -np.log(max(1, SYMBOLS - int(seen[0]))) if len(seen) else -np.log(SYMBOLS)
        return cls(order, Lookup(keyed(gs, gc.view(np.uint64))), first, plain, Lookup(keyed(cs, cc.view(np.uint64))), escape, chain, room, float(novel))

    def log_p(self, codes: np.ndarray) -> np.ndarray:
        """ln p of the newest symbol of each code of order + 1 symbols, given those before."""
        out = np.empty(len(codes))
        row = self.gram(keyed(self.order + 1, codes))
        hit = row >= 0
        out[hit] = self.first[row[hit]]
        left = np.flatnonzero(~hit)
        if len(left):
            out[left] = self._slow(codes[left])
        return out

    def _slow(self, codes: np.ndarray) -> np.ndarray:
        n = len(codes)
        before = codes >> np.uint64(BITS)
        start, at = np.full(n, -1), np.full(n, -1)  # size and row of the longest context seen
        for k in range(self.order, -1, -1):
            todo = np.flatnonzero(at < 0)
            at[todo] = self.context(keyed(k, before[todo] & np.uint64(mask(k))))
            start[todo[at[todo] >= 0]] = k
        found, row = np.zeros(n, dtype=np.int64), np.full(n, -1)  # size and row of the longest sequence seen
        for size in range(self.order, 0, -1):
            todo = np.flatnonzero(row < 0)
            row[todo] = self.gram(keyed(size, codes[todo] & np.uint64(mask(size))))
            found[todo[row[todo] >= 0]] = size
        out = np.zeros(n)
        straight = (row >= 0) & (found == start + 1)
        out[straight] = self.first[row[straight]]
        bent = np.flatnonzero(~straight)
        known = bent[start[bent] >= 0]
        out[known] = self.escape[at[known]] + self.chain[at[known]]
        low = known[row[known] >= 0]  # found in a shorter context: further escapes end there
        lower = self.context(keyed(found[low], before[low] & np.array([mask(i) for i in range(self.order + 2)], dtype=np.uint64)[found[low]]))
        out[low] += self.plain[row[low]] - self.chain[lower] - self.room[lower]
        out[bent[row[bent] < 0]] += self.novel
        return out


_held: dict[tuple, TriePart] = {}


@dataclass
class PpmModel:
    """Where the trie's tables are; tasks read the part they need."""

    path: str
    order: int
    parts: int

    def part(self, k: int) -> TriePart:
        key = (self.path, k)
        if key not in _held:
            _held.clear()
            _held[key] = TriePart.read(self.path, self.order, k)
        return _held[key]

    def log_p(self, codes: np.ndarray) -> np.ndarray:
        if self.parts == 1:
            return self.part(0).log_p(codes)
        out = np.empty(len(codes))
        part = part_of((codes >> np.uint64(BITS)) & np.uint64(mask(2)), self.parts)
        for k in range(self.parts):
            at = np.flatnonzero(part == k)
            if len(at):
                out[at] = self.part(k).log_p(codes[at])
        return out


def part_of(last_two, parts: int):
    """Which part a context of two symbols or more goes to, for columns and arrays alike."""
    if isinstance(last_two, Column):
        return ((last_two * 40503) % 65521 % parts).cast("int")
    return ((last_two.astype(np.int64) * 40503) % 65521 % parts).astype(np.int64)


def fit(counts: DataFrame, order: int = ORDER, part_nodes: int = PART_NODES) -> PpmModel:
    """The trie of ``corpus_counts``, written to the shared folder."""
    spark = counts.sparkSession
    grams, contexts = trie(counts.where("kind = 1").select(F.col("key").alias("code"), "n"), order)
    grams, contexts = materialize(grams, "ppm_grams"), materialize(contexts, "ppm_contexts")
    parts = max(1, -(-grams.count() // part_nodes))
    path = _uri(spark, new_path(spark, "ppm"))
    last = F.when(F.col("size") > 2, part_of(F.shiftrightunsigned("code", BITS).bitwiseAND(mask(2)), parts)).otherwise(-1)
    grams.withColumn("part", last).repartition("part").write.partitionBy("part").parquet(f"{path}/grams")
    last = F.when(F.col("size") > 1, part_of(F.col("code").bitwiseAND(mask(2)), parts)).otherwise(-1)
    contexts.withColumn("part", last).repartition("part").write.partitionBy("part").parquet(f"{path}/contexts")
    drop(grams, contexts)
    return PpmModel(path, order, parts)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(7)) == 2, F.lit(False))


def scored(docs: DataFrame, model: PpmModel, hot: dict[int, int], size: int = CHUNK) -> DataFrame:
    """docs, whose last column is text, with (n_words, n_hot, hot_n, score, rare) in its place.

    score: log10 p of the text and its end. hot_n: for each word of ``hot`` that occurs, as log10 of its count plus one, summed; n_hot: their
    number. rare: hashes of the other words.
    """
    keys = np.array(sorted(hot), dtype=np.uint64)
    logs = np.log10(np.array([hot[int(k)] for k in keys], dtype=np.float64) + 1)
    names = docs.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = Lookup(keys)
        for b in batches:
            n = b.num_rows
            n_words, n_hot, hot_sum, score = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n), np.zeros(n)
            rare_text, rare_key = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for c in chunks(iter(bytes_of(b.column(b.num_columns - 1))), model.order, size):
                text = np.array(c.text)
                p = np.zeros(len(c.symbols) + 1)
                here = np.flatnonzero(c.counted())
                p[here] = model.log_p(c.codes(model.order)[here - model.order])
                some = c.end > c.begin
                np.add.at(score, text[some], np.add.reduceat(p, np.stack([c.begin, c.end], 1)[some].ravel())[::2] / np.log(10))
                start, _, h = words_in(c.raw)
                of = text[np.searchsorted(c.raw_begin, start, "right") - 1]
                row = often(h)
                known = row >= 0
                n_words += np.bincount(of, minlength=n)
                n_hot += np.bincount(of[known], minlength=n)
                hot_sum += np.bincount(of[known], weights=logs[row[known]], minlength=n)
                rare_text.append(of[~known]), rare_key.append(h[~known].view(np.int64))
            rare_of, rare = np.concatenate(rare_text), np.concatenate(rare_key)  # parts come in the order of texts
            offsets = np.concatenate([[0], np.cumsum(np.bincount(rare_of, minlength=n))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(rare))
            cols = [*(b.column(i) for i in range(len(names))), pa.array(n_words), pa.array(n_hot), pa.array(hot_sum), pa.array(score), lists]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "n_words", "n_hot", "hot_n", "score", "rare"])

    schema = T.StructType([*docs.schema.fields[:-1]]).add("n_words", T.LongType()).add("n_hot", T.LongType()).add("hot_n", T.DoubleType()).add("score", T.DoubleType())
    return docs.mapInArrow(run, schema.add("rare", T.ArrayType(T.LongType())))


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, held_out: Column | None = None, part_nodes: int = PART_NODES, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row for each row of docs.

    A-Z are lower-cased, in the words and in the bytes of the model alike. held_out: crc32 of the id as text leaves 2 modulo 7 (or the given
    column); such rows are never learned from; a null id is not held out. Null texts are empty: their one token is the end. score is the model's log10 probability of the bytes of the text and its end, base_score that of its
    words and end by counts plus one. Rows that repeat get equal scores and count each time. Without a row to learn from, symbols are equally likely and
    base_score is 0. Other columns play no part. Words are known by 64-bit hashes.
    """
    if not 0 <= order <= 5:
        raise ValueError("order must be 0 to 5")
    spark: SparkSession = docs.sparkSession
    out = F.coalesce(held_out, F.lit(False)) if held_out is not None else is_held_out(F.col(id_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    with small_batches(spark):
        counts = materialize(corpus_counts(rows.where("not held_out").select("text"), order), "ppm_counts")
    words = counts.where("kind = 0").select("key", "n")
    n_words, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    texts = counts.where("kind = 2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    total, distinct = n_words + texts, distinct + (texts > 0)
    hot = {r["key"] % (1 << 64): r["n"] for r in words.where(F.col("n") * HOT > n_words).collect()}  # fewer than HOT
    model = fit(counts, order, part_nodes)
    with small_batches(spark):
        part = materialize(scored(rows.withColumn("row", F.monotonically_increasing_id()).select("doc_id", "held_out", "row", "text"), model, hot, chunk), "ppm_scores")
    found = part.select("row", F.explode("rare").alias("key")).join(words, "key").groupBy("row").agg(F.count("*").alias("k"), F.sum(F.log10(F.col("n") + 1)).alias("logs"))
    part = part.drop("rare").join(found, "row", "left")
    known = F.col("n_hot") + F.coalesce("k", F.lit(0)) + int(texts > 0)
    base = F.col("hot_n") + F.coalesce("logs", F.lit(0.0)) + float(np.log10(texts + 1)) - (F.col("n_words") + 1) * float(np.log10(total + distinct + 1))
    return part.select("doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"), known.alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
