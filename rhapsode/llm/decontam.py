"""Operator 9: benchmark decontamination, by size-partitioned MinHash containment search.

The min-hash of an item under a random permutation is a uniformly random one of its shingles, so the share of
its min-hashes that a document's shingles contain estimates the containment of the item in that document, however
long the document is. Items are partitioned by size into CLASSES: those of the smallest have all their shingles for a signature; each other
class has its own number of min-hashes, and asks for as many hits as a contained item misses with a chance of
1e-6 at most. Documents too short to contain an item are passed over. Candidates are then verified by
exact containment over all shingles. Items of fewer than n words are one shingle, their whole sequence, and documents have the shingles of that
length too. Only built-in functions run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP, WORD, materialize, small

#: (largest number of shingles, min-hashes) of each class of items; None: all shingles, or any number.
CLASSES, MISS = ((16, None), (64, 24), (256, 32), (None, 48)), 1e-6


def hits_needed(hashes: int, least: float, miss: float = MISS) -> int:
    """The largest number of hits that an item of containment ``least`` stays below with a chance of ``miss`` at most."""
    below = 0.0
    for k in range(hashes + 1):
        below += math.comb(hashes, k) * least**k * (1 - least) ** (hashes - k)
        if below > miss:
            return max(1, k)
    return hashes


def shingles(text: Column, sizes: list[int], least: int = 0) -> Column:
    """Hashes of the shingles of so many words each of a lower-cased text, repeats included; null text or fewer words: none.

    least: texts of fewer words, but not of none, are one shingle of all their words, if they have that many.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    none = F.array().cast("array<bigint>")

    def of(h: Column, n: int) -> Column:
        steps = F.sequence(F.lit(1), F.size(h) - (n - 1))
        return F.when(F.size(h) >= n, F.transform(steps, lambda i: F.xxhash64(*[F.element_at(h, (i + k).cast("int")) for k in range(n)]))).otherwise(none)

    def every(h: Column) -> Column:
        parts = [of(h, n) for n in sizes] + [F.when(F.size(h) == n, of(h, n)).otherwise(none) for n in range(1, least)]
        return F.concat(*parts) if len(parts) > 1 else parts[0]

    # one element arrays bind the word hashes once, so that no step computes them again
    return F.element_at(F.transform(F.array(hashed), every), 1)


def by_class(size: Column, values: list) -> Column:
    """The value of the class of a size."""
    out = F.lit(values[-1])
    for (top, _), v in reversed(list(zip(CLASSES[:-1], values[:-1], strict=True))):
        out = F.when(size <= top, v).otherwise(out)
    return out


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", least: float = 0.8, n: int = 5, keys: bool = False) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment) of each item whose distinct shingles a document holds to ``least`` or more.

    Words are lower-cased runs without ASCII white space. An item of fewer than n words is contained where all its words follow each other. Null and empty texts
    contain and match nothing. A row that repeats is reported once; items that repeat under one id count as
    one with all their shingles. Null ids are ids like others. Extra columns play no part. keys: also the text hash by which
    a row of docs is known (text_key).
    """
    item = items.select(F.col(item_id).alias("item_id"), F.explode(shingles(F.col(item_text), [n], n)).alias("h")).distinct()
    count = item.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    item = item.alias("a").join(count.alias("b"), F.col("a.item_id").eqNullSafe(F.col("b.item_id"))).select("a.item_id", "h", "n_shingles")
    item = materialize(item, "items")
    words = F.regexp_count(F.coalesce(F.col(item_text), F.lit("")), F.lit(WORD))
    short = [r["n"] for r in items.select(words.alias("n")).where(F.col("n").between(1, n - 1)).distinct().collect()]  # n - 1 lengths at most
    lengths = [n, *sorted(short)]
    size = F.col("n_shingles")
    draws = by_class(size, [k or 0 for _, k in CLASSES])
    whole = item.where(draws == 0).select("item_id", "n_shingles", "h", F.lit(1).alias("times"))
    turns = item.where(draws > 0).select("*", F.explode(F.sequence(F.lit(1), draws)).alias("j"))
    drawn = turns.groupBy("item_id", "n_shingles", "j").agg(F.min_by("h", F.xxhash64("h", "j")).alias("h"))
    drawn = drawn.groupBy("item_id", "n_shingles", "h").agg(F.count("*").cast("int").alias("times"))
    # all shingles known: the containment itself; else the bound for the class's draws
    need = F.when(draws == 0, F.ceil(size * F.lit(least) - 1e-9)).otherwise(by_class(size, [hits_needed(k, least) if k else 1 for _, k in CLASSES]))
    signature = materialize(whole.union(drawn).withColumn("need", need.cast("int")), "signature")

    text = F.col(text_col)
    keyed = docs.where(text.isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("body"))
    split = keyed.select("doc_id", "text_key", shingles(F.col("body"), lengths).alias("hs"))
    found = split.select("doc_id", "text_key", F.size("hs").alias("n_doc"), F.explode("hs").alias("h"))
    hits = found.join(small(signature), "h").where(F.col("n_doc") >= F.col("n_shingles") * F.lit(least) - 1e-9)
    hits = hits.select("doc_id", "text_key", "item_id", "need", "times", "h").distinct()
    candidates = hits.groupBy("doc_id", "text_key", "item_id", "need").agg(F.sum("times").alias("hits")).where("hits >= need")
    candidates = materialize(candidates.select("doc_id", "text_key", "item_id"), "candidates")

    rows = small(candidates.select("doc_id", "text_key").distinct(), 500_000)
    k, c = keyed.alias("k"), rows.alias("c")
    same = F.col("k.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("k.text_key") == F.col("c.text_key"))
    asked = k.join(c, same, "left_semi").select("doc_id", "text_key", F.explode(F.array_distinct(shingles(F.col("body"), lengths))).alias("h"))
    pairs = asked.join(small(item), "h").distinct()
    p, c = pairs.alias("p"), small(candidates, 500_000).alias("c")
    same = F.col("p.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("p.text_key") == F.col("c.text_key")) & F.col("p.item_id").eqNullSafe(F.col("c.item_id"))
    got = p.join(c, same, "left_semi").groupBy("doc_id", "text_key", "item_id", "n_shingles").agg(F.count("*").alias("n_found"))
    got = got.withColumn("containment", F.col("n_found") / F.col("n_shingles")).where(F.col("n_found") >= F.col("n_shingles") * F.lit(least) - 1e-9)
    if keys:
        return got
    return got.select("doc_id", "item_id", "n_shingles", "n_found", "containment").distinct()


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without the rows that contain an item, columns unchanged; rows with null text stay."""
    leaks = contained_items(docs, items, id_col, text_col, keys=True, **options)
    leaks = materialize(leaks.select(F.col("doc_id").alias("leak_id"), "text_key").distinct(), "leaks")
    d, x = docs.alias("d"), small(leaks, 500_000).alias("x")
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("x.leak_id")) & (F.xxhash64(F.col(f"d.{text_col}")) == F.col("x.text_key")) & F.col(f"d.{text_col}").isNotNull()
    return d.join(x, same, "left_anti")
