"""Operator 13: phrases that occur often, and how much oftener than their parts let expect, per language.

Contiguous pattern growth in the manner of PrefixSpan. Words are counted first, then each frequent word is extended by one word to the
right; the occurrences of frequent pairs are projected: a row holds a pair and the up to three words that follow it for as long as each
next pair is frequent. Rows are dealt by their prefix, and a prefix grows inside one task, depth first: the pointers of its occurrences
are sorted by the next word, each frequent run is a longer prefix, and so on. A prefix of more than ``local`` different rows
is extended by a distributed count first, so that its extensions become prefixes, and tasks, of their own.

What tells frequent words and pairs from others inside the scans is a bit filter of bounded size. Its false positives cost rows, never
results: all counts are exact, as occurrences that pass are counted anew. Words are known by 64-bit hashes of language and word.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialize, small_batches
from .textscan import LOWER, Tally, bytes_of, groups, segments
from .wordseq import mixed, words_in

LONGEST, LEAST, FIRST = 5, 100, 2000
#: Bytes of text that are scanned at a time; different rows of a prefix that one task takes.
CHUNK, LOCAL = 1 << 22, 500_000
#: Bits of a filter, at least and at most.
BITS = (1 << 16, 1 << 28)
BREAKS = b".,;:!?\x0b\x0c\r"
_FOLD = LOWER.translate(bytes.maketrans(BREAKS, b"\n" * len(BREAKS)))
_AHEAD = re.compile(rb"(?:[\x20\x09]*[^\x20\x09\n]+){0,%d}" % (LONGEST - 1))
W = [f"w{i}" for i in range(1, LONGEST + 1)]


class Words:
    """The words of many texts: hash with language, same piece as the next word, and whether an occurrence counts here."""

    def __init__(self, parts: list[bytes], limits: list[int], langs: list[str]):
        self.raw = b"\n".join(parts)
        self.langs = sorted(set(langs))
        code = {x: i for i, x in enumerate(self.langs)}
        seeds = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs], dtype=np.uint64)
        self.start, self.end, h = words_in(self.raw)
        begin = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
        part = np.searchsorted(begin, self.start, "right") - 1
        self.lang = np.array([code[x] for x in langs])[part]
        self.counts = self.start - begin[part] < np.array(limits)[part]
        self.key = np.maximum(mixed(h ^ seeds[self.lang]), np.uint64(1)) if len(h) else h
        piece = np.cumsum(np.frombuffer(self.raw, dtype=np.uint8) == 10)[self.start] if len(h) else self.start
        self.joined = np.zeros(len(h), dtype=bool)
        self.joined[:-1] = piece[1:] == piece[:-1]

    def pairs(self) -> np.ndarray:
        """A hash of each word and the next one."""
        return mixed(mixed(self.key, 5) + np.roll(self.key, -1), 6)


def scanned(batches: Iterator[pa.RecordBatch], chunk: int = CHUNK) -> Iterator[Words]:
    """Words of (text, lang) rows; of a text longer than a chunk, a segment carries the next words, which don't count as beginnings."""
    parts: list[bytes] = []
    limits: list[int] = []
    langs: list[str] = []
    size = 0
    for b in batches:
        for text, lang in zip(bytes_of(b.column(0)), b.column(1).to_pylist(), strict=True):
            raw = text.translate(_FOLD)
            for lo, hi in segments(raw, chunk):
                parts.append(raw[lo : _AHEAD.match(raw, hi).end()]), limits.append(hi - lo), langs.append("und" if lang is None else lang)
                size += len(parts[-1])
                if size >= chunk:
                    yield Words(parts, limits, langs)
                    parts, limits, langs, size = [], [], [], 0
    if parts:
        yield Words(parts, limits, langs)


class BitFilter:
    """A set of hashes that may hold more than it was given, never less; its size is bounded."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(keys: np.ndarray, n_bits: int) -> np.ndarray:
        return np.concatenate([mixed(keys, s) & np.uint64(n_bits - 1) for s in (11, 12)])

    @classmethod
    def of(cls, keys: DataFrame) -> BitFilter:
        """From a column of hashes; the driver receives the bits, BITS[1] at most."""
        n_bits = min(BITS[1], max(BITS[0], 1 << (16 * keys.count()).bit_length()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                p = cls.places(np.asarray(b.column(0)).view(np.uint64), n_bits)
                yield pa.RecordBatch.from_arrays([pa.array((p >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (p & np.uint64(63))).view(np.int64))], names=["at", "bits"])

        got = keys.mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
        bits = np.zeros(n_bits >> 6, dtype=np.uint64)
        bits[np.asarray(got.column("at"))] = np.asarray(got.column("bits")).view(np.uint64)
        return cls(bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        p = self.places(keys, len(self.bits) << 6)
        hit = (self.bits[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)
        return (hit[: len(keys)] & hit[len(keys) :]).astype(bool)


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, key, n): partial counts by word, lang null, and by language, key null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()

        def taken() -> pa.RecordBatch:
            key, n = tally.take()
            return pa.RecordBatch.from_arrays([pa.nulls(len(key), pa.string()), _longs(key), _longs(n)], names=["lang", "key", "n"])

        for w in scanned(batches):
            tally.add(w.key[w.counts])
            total = np.bincount(w.lang[w.counts], minlength=len(w.langs))
            yield pa.RecordBatch.from_arrays([pa.array(w.langs, pa.string()), pa.nulls(len(total), pa.int64()), _longs(total)], names=["lang", "key", "n"])
            if tally.full():
                yield taken()
        yield taken()

    return rows.mapInArrow(run, "lang string, key long, n long")


def pair_counts(rows: DataFrame, words: BitFilter) -> DataFrame:
    """(key, n): partial counts of pairs of frequent words in one piece."""
    shared = rows.sparkSession.sparkContext.broadcast(words.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tally = BitFilter(shared.value), Tally()

        def taken() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([_longs(x) for x in tally.take()], names=["key", "n"])

        for w in scanned(batches):
            often = known.has(w.key)
            tally.add(w.pairs()[w.counts & w.joined & often & np.roll(often, -1)])
            if tally.full():
                yield taken()
        yield taken()

    return rows.mapInArrow(run, "key long, n long")


def projections(rows: DataFrame, pairs: BitFilter) -> DataFrame:
    """(w1 .. w5, n, lang, word): frequent pairs with the words after them, 0 where there is none; and the spelling of each such word (n null)."""
    shared = rows.sparkSession.sparkContext.broadcast(pairs.bits)
    names = [*W, "n", "lang", "word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = BitFilter(shared.value)
        for w in scanned(batches):
            link = w.joined & known.has(w.pairs())
            at = np.flatnonzero(link & w.counts)
            rows, more, mix = [w.key[at]], np.ones(len(at), dtype=bool), mixed(w.key[at], 9)
            for k in range(1, LONGEST):
                there = np.minimum(at + k, len(link) - 1)
                more = more & link[there - 1] & (at + k < len(link))
                rows.append(np.where(more, w.key[there], np.uint64(0)))
                mix = mixed(mix + rows[-1], k)
            _, first, n = np.unique(mix, return_index=True, return_counts=True)
            none = pa.nulls(len(first), pa.string())
            yield pa.RecordBatch.from_arrays([*(_longs(r[first]) for r in rows), _longs(n), none, none], names=names)
            used = link | np.concatenate([[False], link[:-1]])
            at = np.flatnonzero(used)
            key, first = np.unique(w.key[at], return_index=True)
            at = at[first]
            text = pa.array([w.raw[a:b] for a, b in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)], pa.binary()).cast(pa.string())
            none = pa.nulls(len(key), pa.int64())
            yield pa.RecordBatch.from_arrays([_longs(key), *[none] * LONGEST, pa.array(w.langs, pa.string()).take(pa.array(w.lang[at])), text], names=names)

    return rows.mapInArrow(run, ", ".join(f"{x} long" for x in [*W, "n"]) + ", lang string, word string")


def grow(rows: np.ndarray, n: np.ndarray, least: int, depth: int, out: list) -> None:
    """Adds (words, count) of the frequent prefix that all rows share in their first ``depth`` words, and of all it grows into."""
    total = int(n.sum())
    if total < least:
        return
    out.append((rows[0, :depth].tolist(), total))
    if depth == rows.shape[1]:
        return
    on = np.flatnonzero(rows[:, depth])  # pointers of the occurrences that go on
    if not len(on):
        return
    on = on[np.argsort(rows[on, depth], kind="stable")]
    cuts = np.flatnonzero(np.diff(rows[on, depth])) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(on)], strict=True):
        grow(rows[on[lo:hi]], n[on[lo:hi]], least, depth + 1, out)


def frequent_phrases(windows: DataFrame, least: int, local: int = LOCAL) -> DataFrame:
    """(words array of hashes, a) for all prefixes of the rows, of two words or more, with a count of at least ``least``."""
    rows = materialize(windows.groupBy(*W).agg(F.sum("n").alias("n")), "phrase_rows")
    found = None
    own = [rows]

    def locally(part: DataFrame, depth: int) -> DataFrame:
        key = W[:depth]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done: list = []
            for g in groups(batches, key):
                grow(np.stack([np.asarray(g.column(x)) for x in W], axis=1), np.asarray(g.column("n")), least, depth, done)
                if len(done) > 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.list_(pa.int64())), pa.array([d[1] for d in done], pa.int64())], names=["words", "a"])
                    done = []
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.list_(pa.int64())), pa.array([d[1] for d in done], pa.int64())], names=["words", "a"])

        return part.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "words array<long>, a long")

    for depth in range(2, LONGEST + 1):
        key = W[:depth]
        if depth > 2:
            rows = rows.where(F.col(key[-1]) != 0)
        sizes = rows.groupBy(*key).agg(F.count("*").alias("rows"), F.sum("n").alias("a")).where(F.col("a") >= least)
        sizes = materialize(sizes, "phrase_sizes")
        own.append(sizes)
        few = sizes.where(F.col("rows") <= local) if depth < LONGEST else sizes.where("false")
        many = sizes if depth == LONGEST else sizes.where(F.col("rows") > local)
        got = many.select(F.array(*key).alias("words"), "a")
        if depth < LONGEST:
            got = got.union(locally(rows.join(few.select(*key), key, "left_semi"), depth))
        found = got if found is None else found.union(got)
        if depth == LONGEST or many.limit(1).count() == 0:
            break
        rows = materialize(rows.join(many.select(*key), key, "left_semi"), "phrase_rows")
        own.append(rows)
    out = materialize(found, "phrases")
    drop(*own)
    return out


def score_of(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 a n / (left right)) in whole decimals, which hold products of up to 38 digits."""
    return F.expr(f"(cast(1000 as decimal(4,0)) * cast({a} as decimal(17,0)) * cast({n} as decimal(17,0))) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, first: int = FIRST, local: int = LOCAL) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases by score.

    Phrases are of two to five words inside a piece of text between marks, occur ``least`` times or more, and aren't part of a longer
    phrase that occurs as often. score is floor(1000 a n / (l r)) at the cut into two parts where that is least, the first such cut where
    several are; n counts all words of the language, l and r the parts. Null texts are empty, a null language is ``und``. Rows that repeat count each time.
    Ties in score go to the larger a, then to the lesser phrase by UTF-8 bytes. An empty table gives an empty table; other columns
    play no part, whatever their names.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    with small_batches(spark):
        counts = word_counts(rows).groupBy("lang", "key").agg(F.sum("n").alias("n"))
        counts = materialize(counts.where(F.col("key").isNull() | (F.col("n") >= least)), "phrase_words")
        words = counts.where("key is not null").select("key", "n")
        pairs = materialize(pair_counts(rows, BitFilter.of(words.select("key"))).groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key"), "phrase_pairs")
        scan = materialize(projections(rows, BitFilter.of(pairs)), "phrase_scan")
    drop(pairs)
    spelled = scan.where("n is null").groupBy(F.col("w1").alias("key")).agg(F.max(F.struct("lang", "word")).alias("s")).select("key", "s.lang", "s.word")
    phrases = frequent_phrases(scan.where("n is not null").select(*W, "n"), least, local)

    size = F.size("words")
    totals = counts.where("key is null").select("lang", "n")
    known = words.select(F.array("key").alias("part"), F.col("n").alias("f")).union(phrases.select("words", "a"))
    longer = phrases.where(size > 2).select("a", F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))).alias("words"))
    longer = longer.groupBy("words").agg(F.max("a").alias("most"))
    kept = phrases.join(longer, "words", "left").where(F.col("most").isNull() | (F.col("most") < F.col("a"))).drop("most")
    cut = kept.select("words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cut = cut.select("*", F.slice("words", F.lit(1), F.col("k")).alias("left"), F.slice("words", F.col("k") + 1, size - F.col("k")).alias("right"))
    cut = cut.join(known.select(F.col("part").alias("left"), F.col("f").alias("l")), "left").join(known.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    named = kept.select("words", F.posexplode("words").alias("pos", "key")).join(spelled, "key")
    named = named.groupBy("words").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda s: s["word"]), " ").alias("phrase"), F.min("lang").alias("lang"))
    named = named.join(totals, "lang")
    cut = cut.join(named, "words")
    cut = cut.withColumn("score", score_of("a", "n", "l", "r"))
    best = cut.groupBy("words", "lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    best = best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
