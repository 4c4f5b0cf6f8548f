"""Operator 3: substring dedup, by MinHash banding over content-cut paragraphs.

Passages repeat anywhere, also inside lines, so a text's paragraphs are cut where its words say so: a boundary lies before a word whose hash
(with the word after it) is the least among REACH words to either side: in 99.7 % of random passages of 50 words, two such cuts or more. Equal passages get equal boundaries whatever surrounds them, and no
paragraph is shorter than REACH + 1 words but for a text's first and last. A paragraph's bands are the least hashes of its s distinct five-word
shingles, s - ceil(LEAST s) + 1 of them: two sets of similarity LEAST have one of these in common, so that no pair is missed. Paragraphs that
collide are joined, their exact Jaccard similarity is verified, and the components of verified links are clusters: the first paragraph of a
cluster stays, later ones are removed.

A bucket's members come with the size of their set and 56 parity bits of it, which tell nearly all strangers apart before any text is read. In
buckets of up to CROWD members all pairs are asked so. The members of larger ones (and of the first and last bucket of a partition, which may go on in the
next one) are joined exactly by the prefixes of their shingles in order of rarity, of which two paragraphs of similarity LEAST have one in common.
Those that share a prefix shingle are compared all against all, but for members that are connected already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, materialize, small, small_batches
from .components import connected_components
from .wordseq import gram_hashes, mixed, sliding_min, word_hashes, words_in

REACH, SHINGLE, LEAST = 5, 5, 0.8
#: A text's first and last paragraph count from so many words on: shorter ones hold no shingle. A text of one paragraph always counts.
EDGE = SHINGLE
#: Members of a bucket that are all compared with each other at once.
CROWD = 16
#: Paragraph keys that a task remembers, so that copies within a task are banded once; bytes of text that are cut at a time.
SEEN, BYTES = 200_000, 1 << 20
#: Keys (with a cluster each at most) that may be broadcast, so that no text is shuffled to find theirs; more of them are joined by a shuffle.
KEYS = 1_000_000
#: Members of a crowded prefix shingle that are compared in one piece; more of them are dealt into blocks, and every pair of blocks is compared.
BLOCK = 512


def boundaries(h: np.ndarray, text: np.ndarray, reach: int = REACH) -> np.ndarray:
    """First words of all paragraphs of a row of texts, given the hash and the text of each word."""
    first = np.flatnonzero(np.diff(text, prepend=-1))
    width = 2 * reach + 1
    if len(h) <= width:
        return first
    g = mixed(h[:-1] * np.uint64(3) + h[1:], 5)
    centre = g[reach : len(g) - reach]
    at = np.flatnonzero((centre == sliding_min(g, width)) & (text[: len(centre)] == text[width:])) + reach
    near = (np.diff(at, prepend=-width) <= reach) & (text[at] == text[np.concatenate([at[:1], at[:-1]])])
    return np.union1d(first, at[~near])  # near: ties, in texts of one repeated word


def wanted(s: np.ndarray) -> np.ndarray:
    """How many of the least hashes of s shingles two sets of similarity LEAST surely have one of in common."""
    return s - np.ceil(s * LEAST - 1e-9).astype(np.int64) + 1


def bands_of(h: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bands of all paragraphs, number of bands of each, size and parity of each one's set of shingles)."""
    counts = np.maximum(1, sizes - (SHINGLE - 1))
    at = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(first)), counts)
    place = np.arange(at[-1]) - at[:-1][owner] + first[owner]
    flat = gram_hashes(h, SHINGLE)[np.minimum(place, max(0, len(h) - SHINGLE))]
    for n in range(1, SHINGLE):
        few = sizes[owner] == n
        if few.any():
            flat[few] = gram_hashes(h, n)[place[few]]
    flat = mixed(flat, 7)
    order = np.lexsort((flat, owner))
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), dtype=bool)
    new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    flat, owner = flat[new], owner[new]
    s = np.bincount(owner, minlength=len(first))
    begin = np.cumsum(s) - s
    k = wanted(s)
    bits = np.uint64(1) << ((mixed(flat, 3) >> np.uint64(32)) % np.uint64(56))
    parity = np.bitwise_xor.reduceat(bits, begin) if len(begin) else np.zeros(0, dtype=np.uint64)
    shape = (parity << np.uint64(8)) | np.minimum(s, 255).astype(np.uint64)
    return flat[np.arange(len(flat)) - begin[owner] < k[owner]], k, shape


def cut(texts: list[str | None], seen: set[int]) -> tuple[dict[str, np.ndarray], bytes]:
    """Paragraphs of all texts, in arrays, and the text that their bytes are counted in; bands only of those whose key isn't seen yet."""
    parts = [(t or "").encode().lower() for t in texts]
    raw = b"\n".join(parts)
    offsets = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])
    begin, end, h = words_in(raw)
    text = np.searchsorted(offsets, begin, side="right") - 1
    first = boundaries(h, text)
    last = np.append(first, len(h))[1:]
    sizes, of = last - first, text[first]
    alone = (np.bincount(of, minlength=len(texts)) == 1)[of] if len(of) else np.zeros(0, dtype=bool)
    kept = alone | (sizes >= EDGE)
    place = np.arange(len(h)) - np.repeat(first, sizes)
    key = np.add.reduceat(mixed(h ^ mixed(place.astype(np.uint64), 9), 11), first).view(np.int64) if len(first) else np.zeros(0, dtype=np.int64)
    opening = np.flatnonzero(np.diff(text, prepend=-1))
    origin = np.zeros(len(texts), dtype=np.int64)
    origin[text[opening]] = opening
    new = np.zeros(len(key), dtype=bool)
    for i in np.flatnonzero(kept).tolist():
        x = int(key[i])
        if x not in seen:
            seen.add(x)
            new[i] = True
    bands, k, shape = bands_of(h, first[new], sizes[new])
    n_bands, shapes = np.zeros(len(key), dtype=np.int64), np.zeros(len(key), dtype=np.uint64)
    n_bands[new], shapes[new] = k, shape
    out = {"text": of, "word_from": first - origin[of], "n_words": sizes, "key": key, "n_bands": n_bands, "shape": shapes.view(np.int64), "new": new, "from": begin[first], "to": end[last - 1]}
    return {c: x[kept] for c, x in out.items()} | {"bands": bands.view(np.int64)}, raw


def _cut(docs: DataFrame, kind: str) -> DataFrame:
    """(doc_id, word_from, n_words, key, shape, bands, body): paragraphs; shape, bands and body only where a task first meets the key."""

    def groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lo, held = 0, 0
        for i, n in enumerate(pc.binary_length(batch.column(1)).fill_null(0).to_pylist()):
            if i > lo and held + n > BYTES:
                yield batch.slice(lo, i - lo)
                lo, held = i, 0
            held += n
        if lo < batch.num_rows:
            yield batch.slice(lo)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in groups(batch):
                p, raw = cut(part.column(1).to_pylist(), seen)
                if len(seen) > SEEN:
                    seen.clear()
                at = np.flatnonzero(p["new"])
                # new bodies lie in the text one after the other; their gaps are skipped by taking every other piece
                spots = np.stack([p["from"][at], p["to"][at]], axis=1).ravel().astype(np.int32)
                pieces = pa.StringArray.from_buffers(max(0, len(spots) - 1), pa.py_buffer(spots.tobytes()), pa.py_buffer(raw)) if len(spots) else pa.array([], pa.string())
                slot = np.zeros(len(p["new"]), dtype=np.int64)
                slot[at] = 2 * np.arange(len(at))
                body = pieces.take(pa.array(slot, mask=~p["new"]))
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(p["n_bands"])]).astype(np.int32)), pa.array(p["bands"]))
                cols = [part.column(0).take(pa.array(p["text"])), pa.array(p["word_from"].astype(np.int32)), pa.array(p["n_words"].astype(np.int32)), pa.array(p["key"]), pa.array(p["shape"], mask=~p["new"]), bands, body]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "word_from", "n_words", "key", "shape", "bands", "body"])

    return docs.mapInArrow(run, f"doc_id {kind}, word_from int, n_words int, key long, shape long, bands array<long>, body string")


def like(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether sets of these shapes may have a similarity of LEAST: by their sizes, and by how many parities differ."""
    s, t = ((v & np.uint64(255)).astype(np.int64) for v in (x, y))
    differ = np.bitwise_count((x ^ y) >> np.uint64(8))
    full = (s == 255) | (t == 255)
    return full | ((np.minimum(s, t) >= LEAST * np.maximum(s, t) - 1e-9) & (differ <= (s + t) * (1 - LEAST) / (1 + LEAST) + 1e-9))


def bucket_pairs(members: DataFrame, parts: int) -> DataFrame:
    """(a, b): keys that share a bucket and may be near; b is null where a lies in a crowded bucket. members: (band, key, shape), repeats allowed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = key = shape = None  # the bucket that is open
        first, over = True, None
        for batch in batches:
            x, y, z = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if band is not None:
                x, y, z = np.concatenate([band, x]), np.concatenate([key, y]), np.concatenate([shape, z])
            again = np.zeros(len(x), dtype=bool)
            again[1:] = (x[1:] == x[:-1]) & (y[1:] == y[:-1])
            x, y, z = x[~again], y[~again], z[~again]
            if not len(x):
                continue
            begin = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            n = np.diff(begin, append=len(x))
            crowded = n > CROWD
            crowded[0] |= first or (over is not None and x[0] == over)
            open_ = begin[-1]
            if n[-1] > CROWD or crowded[-1] and len(n) == 1:  # no need to hold what is crowded anyway
                over, done = x[-1], len(x)
                band, key, shape = x[-1:], y[-1:], z[-1:]
            else:
                done = open_
                band, key, shape = x[open_:], y[open_:], z[open_:]
            first &= len(n) == 1
            full = np.repeat(crowded, n)[:done]
            a, b = [], []
            x, y, z = x[:done], y[:done], z[:done].view(np.uint64)
            i = np.flatnonzero(~full)
            x, many, y, z = x[i], y[:done][full], y[i], z[i]
            for k in range(1, min(CROWD, len(x))):
                j = np.flatnonzero(x[k:] == x[:-k])
                if not len(j):
                    break
                j = j[like(z[j], z[j + k])]
                a.append(y[j]), b.append(y[j + k])
            some = np.concatenate([*a, many]) if len(a) or len(many) else np.zeros(0, dtype=np.int64)
            other = np.concatenate([*b, np.zeros(len(many), dtype=np.int64)]) if len(some) else some
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(other, pa.int64(), mask=np.arange(len(other)) >= len(other) - len(many))], names=["a", "b"])
        if band is not None:  # the last bucket may go on in the next partition
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.nulls(len(key), pa.int64())], names=["a", "b"])

    return members.repartitionByRange(parts, "band", "key").sortWithinPartitions("band", "key").mapInArrow(run, "a long, b long")


def grams(text: str) -> set[tuple[bytes, ...]]:
    words = text.encode().split()  # at ASCII white space
    return set(zip(*[words[k:] for k in range(min(SHINGLE, len(words)))], strict=False))


def jaccard(a: str, b: str) -> float:
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y)


def near(s: set[int], t: set[int]) -> bool:
    """Whether two sets of shingles have a Jaccard similarity of LEAST or more."""
    if min(len(s), len(t)) < LEAST * max(len(s), len(t)):
        return False
    n = len(s & t)
    return n / (len(s) + len(t) - n) >= LEAST


def connecting(members: list[tuple[int, int, set[int]]], across: bool) -> list[tuple[int, int]]:
    """Near pairs that connect whatever all near pairs connect. members: (key, block, shingles); across: pairs within a block don't count."""
    out, groups = [], []
    for key, block, s in members:
        mine, others = [(key, block, s)], []
        for g in groups:
            hit = next((k for k, b, t in g if not (across and b == block) and near(s, t)), None)
            if hit is None:
                others.append(g)
            else:
                out.append((min(key, hit), max(key, hit)))
                mine = g + mine
        groups = [*others, mine]
    return out


def crowded_links(bodies: DataFrame, parts: int) -> DataFrame:
    """(a, b): near pairs that connect whatever all near pairs of these paragraphs connect. bodies: (key, body), a row a key."""

    def shingles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"key": f["key"], "grams": [np.unique(gram_hashes(word_hashes(x.encode().split()), SHINGLE)).view(np.int64) for x in f["body"]]})

    table = materialize(bodies.mapInPandas(shingles, "key long, grams array<long>"), "shingles")
    each = table.select("key", F.explode("grams").alias("gram"))
    often = materialize(each.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "gram_counts")  # so that a very common gram can be split in the join
    rare = each.join(often, "gram", "left").groupBy("key").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "gram"))).alias("g"))
    prefix = F.slice("g", 1, F.size("g") - F.ceil(F.size("g") * LEAST - 1e-9).cast("int") + 1)
    held = materialize(rare.select("key", F.explode(prefix).alias("g")).where("g.n > 1").select("key", F.col("g.gram").alias("gram")), "prefixes")
    blocks = materialize(held.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "prefix_counts")
    dealt = held.join(blocks, "gram").withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    dealt = dealt.select("gram", "key", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    unit = ["gram", "lo", "hi"]
    work = dealt.join(table, "key").select("gram", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "key", "block", "grams")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, members = None, []
        for f in frames:
            found = []
            for gram, lo, hi, key, block, grams_ in zip(*[f[c].tolist() for c in (*unit, "key", "block")], f["grams"], strict=True):
                if now != (gram, lo, hi):
                    found += connecting(members, now is not None and now[1] != now[2])
                    now, members = (gram, lo, hi), []
                members.append((key, block, set(grams_.tolist())))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
        if members:
            yield pd.DataFrame(connecting(members, now[1] != now[2]), columns=["a", "b"], dtype="int64")

    return materialize(work.repartition(parts, *unit).sortWithinPartitions(*unit, "key").mapInPandas(compare, "a long, b long").distinct(), "crowded_links")


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, word_from, n_words, kept_doc_id, kept_word_from, cluster): the paragraphs to remove, and what stays of each cluster.

    Words are lower-cased (A-Z) runs without ASCII white space; word_from counts from 0. Of a cluster, the paragraph of the least doc_id (nulls
    last), then word_from, stays. Null and empty texts have no paragraphs. A text's first and last paragraph count from EDGE words on; a text that
    is one paragraph counts whatever its length, one under SHINGLE words as a single shingle. Rows that repeat (id and text) count as one document.
    Extra columns play no part.
    """
    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"a": f["a"], "b": f["b"], "near": [jaccard(x, y) >= LEAST for x, y in zip(f["x"], f["y"], strict=True)]})

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with small_batches(docs.sparkSession):
        table = materialize(_cut(base, base.schema["doc_id"].dataType.simpleString()), "paragraphs", "zstd")
    first = table.where("shape is not null")
    pairs = materialize(bucket_pairs(first.select(F.explode("bands").alias("band"), "key", "shape"), parts).distinct(), "bucket_pairs")
    asked = pairs.where("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    crowd = materialize(pairs.where("b is null").select(F.col("a").alias("key")).distinct(), "crowded")
    named = small(materialize(asked.select(F.col("a").alias("key")).union(asked.select("b")).union(crowd).distinct(), "named"), KEYS)
    body = materialize(first.select("key", "body").join(named, "key", "left_semi").dropDuplicates(["key"]), "bodies", "zstd")
    both = asked.join(body.select(F.col("key").alias("a"), F.col("body").alias("x")), "a").join(body.select(F.col("key").alias("b"), F.col("body").alias("y")), "b")
    said = materialize(both.mapInPandas(verify, "a long, b long, near boolean"), "verified")
    links = said.where("near").select("a", "b").union(crowded_links(body.join(small(crowd, KEYS), "key", "left_semi"), parts))
    comp = connected_components(links, "a", "b").withColumnRenamed("node", "key")
    counts = table.groupBy("key").agg(F.count("*").alias("rows"))
    many = counts.join(comp, "key", "left").where("component is not null or rows > 1").select("key", F.coalesce("component", "key").alias("cluster"))
    many = materialize(many, "clustered").hint("merge")  # it grows with the input, so it is never broadcast
    found = materialize(table.select("doc_id", "word_from", "n_words", "key").join(many, "key").select("doc_id", "word_from", "n_words", "cluster"), "found")
    drop(table, body)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "word_from")
    kept = materialize(found.groupBy("cluster").agg(F.min(place).alias("kept")), "kept")  # so that a very large cluster can be split in the join
    out = found.join(kept, "cluster").where(~(F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("word_from") == F.col("kept.word_from"))))
    return out.select("doc_id", "word_from", "n_words", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.word_from").alias("kept_word_from"), "cluster").distinct()
