import math
import re

from rhapsode.llm.mixing import mix_sources, mixed_documents

from .helpers import documents, odd_documents


def targets_by_rounds(sizes):
    """The stated resharing, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, t = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if left * w[s] / total >= 2 * sizes[s]}
        if not full:
            return t | {s: left * w[s] / total for s in open_}
        for s in full:
            t[s] = 2.0 * sizes[s]
            left -= t[s]
        open_ -= full
    return t


def check(docs, rows):
    size = {}
    for d in docs:
        size.setdefault(d["source"], []).append(len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")))
    want = targets_by_rounds({s: sum(v) for s, v in size.items()})
    got = {}
    for r in rows:
        got.setdefault(r["source"], []).append(r)
    for s, t in want.items():
        sized = sorted(r["size"] for r in got[s])
        assert sized == sorted(size[s])
        taken = sum(r["taken"] for r in got[s])
        for r in got[s]:
            assert math.isclose(r["target"], t, rel_tol=1e-12) and r["source_size"] == sum(size[s])
            assert 0 <= r["taken"] <= 2 * r["size"]
            assert r["taken"] in [r["size"] * c for c in (int(t // max(1, sum(size[s]))), int(t // max(1, sum(size[s]))) + 1)]
        assert abs(taken - t) <= max(sized) / 2 + 1e-6, (s, taken, t)


def run(docs):
    return [r.asDict() | {"source": r["row"]["source"]} for r in mix_sources(docs, keep_rows=True).collect()]


def test_every_source_meets_its_target(spark):
    docs = documents(spark)
    first = run(docs)
    check([r.asDict() for r in docs.collect()], first)
    assert sorted((r["doc_id"], r["taken"]) for r in run(docs.repartition(5))) == sorted((r["doc_id"], r["taken"]) for r in first)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    check([r.asDict() for r in docs.collect()], run(docs))
    assert mix_sources(docs.limit(0)).count() == 0
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed_documents(docs.limit(0)).count() == 0


def test_quality_weights_draw_more_often(spark):
    from pyspark.sql import functions as F

    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    w = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    rows = mix_sources(docs, share=0.25, quality=w).collect()
    even = sum(r["taken"] for r in rows if r["doc_id"] % 2 == 0)
    assert 0.70 < even / sum(r["taken"] for r in rows) < 0.85


def test_the_smallest_keys_are_taken(spark):
    """The keys, in Spark's hash but summed and sorted here, decide on each row: all smaller keys of a source are in the mix."""
    from pyspark.sql import functions as F

    docs = documents(spark)
    junk = docs.select((F.col("doc_id") + 10**6).alias("doc_id"), F.regexp_replace("text", " ", "_").alias("text"), "lang", "source", "n_chars")  # words of great length: the least weight
    docs = docs.union(junk)
    want = {}
    rows = docs.select("doc_id", "source", "text", F.shiftrightunsigned(F.xxhash64(F.lit(1), "doc_id", "text"), 11).alias("u")).collect()
    for r in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        weight = max(0.1, math.exp(-(((len(r["text"]) / n - 6) / 4) ** 2))) if n else 0.1
        want.setdefault(r["source"], []).append((-math.log((r["u"] + 0.5) / 2**53) / weight, r["doc_id"], n))
    got = {r["doc_id"]: r for r in mix_sources(docs).collect()}
    for rows in want.values():
        one = got[rows[0][1]]
        epochs, words = divmod(one["target"], one["source_size"])[0], 0
        for _, d, n in sorted(rows):
            more = 2 * (words + n) - n <= 2 * (one["target"] - epochs * one["source_size"])
            assert got[d]["taken"] == n * (epochs + more) or n == 0
            words += n
