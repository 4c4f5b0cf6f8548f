import zlib
from collections import Counter

import numpy as np
import pytest

from rhapsode.llm import toxicity as X

from .helpers import odd_documents


@pytest.mark.parametrize(("slack", "few"), [(0.0, 0), (0.03, 0), (0.4, 0), (0.4, 200), (9.0, 0)])
def test_index_is_exact(slack, few, monkeypatch):
    monkeypatch.setattr(X, "SLACK", slack)
    monkeypatch.setattr(X, "FEW", few)
    rng = np.random.default_rng(5)

    def vector():
        t = rng.choice(60, size=rng.integers(1, 9), replace=False)
        w = rng.random(len(t)) + 0.1
        return dict(zip(t.tolist(), (w / np.linalg.norm(w)).tolist(), strict=True))

    examples = [vector() for _ in range(900)]
    arrays = lambda v: tuple(np.array(x) for x in zip(*sorted(v.items()), strict=True))
    index = X.BlockMaxIndex.build([arrays(v) for v in examples], list(range(900)), [0] * 900, [1.0] * 900)
    for _ in range(60):
        q = vector()
        sims = np.array([sum(q.get(t, 0) * x for t, x in examples[e].items()) for e in index.ids])
        want = np.lexsort((np.arange(900), -np.round(sims, 12)))[:10]
        want = want[sims[want] > 0]
        at, got = index.nearest(arrays(q), 10)
        assert at.tolist() == want.tolist() and np.allclose(got, sims[want])


def corpus(spark, n=1500):
    """Documents of random words; the toxic ones hold some of ten insults."""
    rng = np.random.default_rng(2)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ner", "tu") for b in ("ra", "sil", "ton", "ve", "xu", "dal")]
    bad = [f"zor{x}k" for x in "abcdefghij"]
    rows, labels = [], []
    for i in range(n):
        w = rng.choice(words, size=60).tolist()
        toxic = i % 5 == 0
        if toxic:
            for b in rng.choice(bad, size=3):
                w[rng.integers(60)] = str(b)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_calibration(spark):
    docs, labels = corpus(spark)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in X.toxicity_scores(docs, labels).collect()]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert abs(np.mean([r["score"] for r in held]) - np.mean([truth[r["doc_id"]] for r in held])) < 0.05
    assert all(truth[int(e)] for r in held if r["predicted"] for e in r["evidence"][:1])
    kept = X.without_toxic(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if not r["predicted"]}


def test_labels_of_held_out_rows_play_no_part(spark):
    from pyspark.sql import functions as F

    docs, labels = corpus(spark, 400)
    turned = labels.withColumn("toxic", F.when(X.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda lab: sorted((r["doc_id"], r["score"]) for r in X.toxicity_scores(docs, lab).collect())
    assert score(labels) == score(turned)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(4, 1, 1), (4, 1, 0), (5, 1, None), (None, 1, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    rows = X.toxicity_scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert X.toxicity_scores(docs.limit(0), labels).count() == 0
    assert {round(r["score"], 9) for r in X.toxicity_scores(docs, labels.limit(0)).collect()} == {0.05}
    left = X.without_toxic(docs.withColumnRenamed("row", "score"), labels)
    assert "score" in left.columns and left.count() == docs.count()


def test_counts_terms_of_whole_texts():
    keys = np.sort(np.concatenate([k for _, k in X.term_occurrences(["idiot", "élanvital lowei"])]))
    assert len(keys) == 3
    idiot = next(k for _, k in X.term_occurrences(["idiot"]))[0]
    begin, term, n = X.TermCounts(keys)(["Idiot, idiot " + "x " * 50_000 + "lowei3Élan ÉLANVITAL", None, "", "élan_idiot"])
    assert begin.tolist() == [0, 3, 3, 3, 4] and n[keys[term] == idiot].tolist() == [2, 1] and sorted(n.tolist()) == [1, 1, 1, 2]


def test_scores_equal_brute_force(spark):
    """The whole query in plain Python: weights of all terms, frequencies, cosines with all examples, votes."""
    import math
    import re

    docs, labels = corpus(spark, 500)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    y = {r["doc_id"]: r["toxic"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5}

    def terms(text):
        out = Counter()
        for w in re.findall(rb"[a-z\x80-\xff]+", text.lower().encode()):
            out[w] += 1
        return out

    counts = {d: terms(t) for d, t in texts.items()}
    n, n1 = len(y), sum(y.values())
    n0, tells = n - n1, {}
    for t in {t for d in y for t in counts[d]}:
        a, b = (sum(t in counts[d] and y[d] == k for d in y) for k in (1, 0))
        odds = math.log((a + 0.5) / (n1 - a + 0.5)) - math.log((b + 0.5) / (n0 - b + 0.5))
        tells[t] = abs(odds * (a + b) / (a + b + X.PRIOR)) ** X.SHARP
    idf = {t: math.log((1 + len(texts)) / (1 + sum(t in c for c in counts.values()))) + 1 for t in tells}

    def vector(c):
        v = {t: (1 + math.log(k)) * idf[t] * tells[t] for t, k in c.items() if t in tells}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    examples = {d: vector(counts[d]) for d in y if vector(counts[d])}
    none = [y[d] for d in y if d not in examples]
    base = (sum(none) + 0.5) / (len(none) + 10)
    for r in X.toxicity_scores(docs, labels).collect():
        q = vector(counts[r["doc_id"]])
        sims = sorted((round(sum(x * e.get(t, 0) for t, x in q.items()), 12), d) for d, e in examples.items())[::-1]
        top = [s for s in sims if s[0] > 0]
        edge = top[X.K - 1][0] if len(top) >= X.K else 0
        sure = [(s, y[d]) for s, d in top if s > edge]  # of those tied at the edge, any may vote
        tied = [y[d] for s, d in top if s == edge] if edge else []
        room = min(X.K - len(sure), len(tied))
        scores = set()
        for ones in range(max(0, room - tied.count(0)), min(room, tied.count(1)) + 1):
            votes = [*sure, *[(edge, 1)] * ones, *[(edge, 0)] * (room - ones)]
            scores.add((sum(s * s * v for s, v in votes) + X.PSEUDO * base) / (sum(s * s for s, _ in votes) + X.PSEUDO) if q else base)
        assert any(abs(r["score"] - s) < 1e-9 for s in scores)
