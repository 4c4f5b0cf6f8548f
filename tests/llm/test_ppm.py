import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rhapsode.llm import ppm

SCHEMA = "doc_id long, text string, row int, score string, n_words long, held_out string"


def lower(t):
    return (t or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))


class Brute:
    """Symbol by symbol: contexts as tuples, exclusion by sets, escapes by method C."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for t in texts:
            s = [0] * order + [b + 1 for b in lower(t)] + [257]
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.seen[tuple(s[i - k : i])][s[i]] += 1

    def p(self, context, symbol):
        p, out = 1.0, set()
        for k in range(self.order, -1, -1):
            c = self.seen.get(tuple(context[len(context) - k :]))
            if c is None:
                continue
            left = {s: n for s, n in c.items() if s not in out}
            total = sum(left.values()) + len(left)
            if symbol in left:
                return p * left[symbol] / total
            if left:
                p *= len(left) / total
            out |= set(c)
        return p / max(1, 257 - len(out))

    def score(self, t):
        s = [0] * self.order + [b + 1 for b in lower(t)] + [257]
        return sum(math.log10(self.p(s[i - self.order : i], s[i])) for i in range(self.order, len(s)))


def brute_base(rows):
    words = lambda t: [w for w in re.split(rb"[\x20\x09-\x0d]+", lower(t)) if w] + [None]
    c = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    return {(i, t): (len(words(t)), sum(c[w] > 0 for w in words(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t))) for i, t in rows}


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def rows_of(rng, n=60):
    words = ["the", "The", "of", "hat", "that", "Éa", "\x00", "ﬁ", "x" * 30, "A-B"] + [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 40))) + rng.choice(["", "\n", "!", "\t "])) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (None, "the of"), rows[3], rows[3], (5000, "ÿþ 漢字 unseen"), (5001, " ".join(rng.choices(words, k=900)))]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "s", 2, "h") for i, t in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(("order", "part_nodes", "chunk"), [(4, 3_000_000, 1 << 21), (4, 700, 50), (2, 300, 20), (5, 3_000_000, 1000), (0, 10, 64)])
def test_brute_force(spark, order, part_nodes, chunk):
    rows = rows_of(random.Random(order))
    got = ppm.lm_scores(frame(spark, rows), order=order, part_nodes=part_nodes, chunk=chunk).collect()
    model, base = Brute([t for i, t in rows if not held(i)], order), brute_base(rows)
    assert len(got) == len(rows)
    text = dict(rows)
    assert any(r.held_out for r in got)
    for r in got:
        n, known, total, b = base[(r.doc_id, text[r.doc_id])]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), n, known, total)
        assert r.base_score == pytest.approx(b, rel=1e-9)
        assert r.score == pytest.approx(model.score(text[r.doc_id]), rel=1e-9)


def test_probabilities_of_all_symbols_sum_to_one(spark):
    rows = rows_of(random.Random(1))
    brute = Brute([t for _, t in rows], 4)
    model = ppm.fit(ppm.corpus_counts(frame(spark, rows).select("text"), 4))
    for context in (b"the ", b"hat ", b"zzzz", b"\x00 th", b"w1 w"):
        code = 0
        for b in context:
            code = code << 9 | (b + 1)
        codes = np.array([code << 9 | s for s in range(1, 258)], dtype=np.uint64)
        p = np.exp(model.log_p(codes))
        assert p.sum() <= 1 + 1e-9
        assert p.sum() == pytest.approx(sum(brute.p([b + 1 for b in context], s) for s in range(1, 258)))


def test_nothing_to_learn_from(spark):
    df = frame(spark, [(1, "ab"), (2, None)])
    got = {r.doc_id: r for r in ppm.lm_scores(df, held_out=F.lit(True)).collect()}
    assert got[1].score == pytest.approx(3 * math.log10(1 / 257)) and got[1].base_score == 0 and got[1].n_known == 0
    assert got[2].score == pytest.approx(math.log10(1 / 257)) and got[2].train_tokens == 0
    assert ppm.lm_scores(frame(spark, [(1, "a")]).where("false")).collect() == []


def test_held_out_texts_are_likelier_with_longer_contexts(spark):
    from .helpers import documents

    total = [ppm.lm_scores(documents(spark), order=k).where("held_out").agg(F.sum("score")).first()[0] for k in (0, 2, 4)]
    assert total[0] < 1.3 * total[1] < 1.3 * total[2] < 0


def test_lookup():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 60, 50_000).astype(np.uint64))
    table = ppm.Lookup(keys)
    assert (table(keys) == np.arange(len(keys))).all()
    other = rng.integers(0, 1 << 60, 50_000).astype(np.uint64)
    assert (table(other)[~np.isin(other, keys)] == -1).all()
    assert (ppm.Lookup(keys[:0])(keys[:5]) == -1).all()
