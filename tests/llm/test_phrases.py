import random
import re
from collections import Counter, defaultdict

import pytest

from rhapsode.llm import phrases

SCHEMA = "doc_id long, text string, lang string, W1 long, n string, key int"


def brute(rows, least, first=2000):
    words, f = defaultdict(int), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            words[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if 2 <= len(p) <= 5 and a >= least}
        kept = []
        for p, a in cand.items():
            inside = any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items())
            if not inside:
                cuts = [(1000 * a * words[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for i, (s, a, p, x, y) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, i, p.decode(), -a, x, y, words[lang], -s))
    return sorted(out)


def table(rng, n):
    vocabulary = ["the", "The", "of", "house", "Éa", "éa", "\x0bx", " ", "ox", "z" * 40] + [f"w{i}" for i in range(12)]
    phrase = ["to be or not", "once upon a time there", "in the midst of", "a b c d e f g"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(1, 12)):
            parts.append(rng.choice(phrase) if rng.random() < 0.4 else " ".join(rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rng.randrange(1, 7))))
            parts.append(rng.choice([" ", " ", "\t", ". ", ", ", "\n", "  ", "!?", "\r\n"]))
        rows.append(("".join(parts), rng.choice(["en", "en", "de", None, ""])))
    return rows + [(None, "en"), ("", "xx"), ("  . , ", "yy"), rows[0], rows[0]]


@pytest.mark.parametrize("local", [500_000, 7, 1])
def test_brute_force(spark, local):
    rows = table(random.Random(local), 150)
    df = spark.createDataFrame([(i, t, lang, 1, "x", 2) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(df, least=8, local=local).collect())
    assert got == brute(rows, 8)
    assert any(len(r[2].split()) > 3 for r in got)


def test_long_text_in_segments(spark):
    rng = random.Random(3)
    one = " ".join(rng.choices(["a", "b", "c", "d"], k=4000)) + " " + "q" * 3000 + ". " + " ".join(rng.choices(["a", "b", "c", "d", "."], k=4000))
    seen = Counter()
    for chunk in (1 << 24, 100, 33):
        n = Counter()
        import pyarrow as pa

        for w in phrases.scanned(iter([pa.RecordBatch.from_arrays([pa.array([one, one]), pa.array(["en", None])], names=["t", "l"])]), chunk):
            ends = w.joined & w.counts
            n["words"] += int(w.counts.sum())
            n["pairs"] += int(ends.sum())
            for k, x in zip(*[v.tolist() for v in __import__("numpy").unique(w.pairs()[ends], return_counts=True)], strict=True):
                n[k] += x
        seen = seen or n
        assert n == seen
    rows = [(one, "en")]
    df = spark.createDataFrame([(0, one, "en", 1, "x", 2)], SCHEMA)
    assert sorted(tuple(r) for r in phrases.collocations(df, least=30).collect()) == brute(rows, 30)


def test_first_and_exact_arithmetic(spark):
    rows = table(random.Random(9), 200)
    df = spark.createDataFrame([(i, t, lang, 1, "x", 2) for i, (t, lang) in enumerate(rows)], SCHEMA)
    assert sorted(tuple(r) for r in phrases.collocations(df, least=5, first=3).collect()) == brute(rows, 5, 3)
    big = spark.sql("select cast(90000000000001 as bigint) a, cast(99999999999999 as bigint) n, cast(90000000000007 as bigint) l, cast(900000 as bigint) r")
    got = big.select(phrases.score_of("a", "n", "l", "r")).first()[0]
    assert got == 1000 * 90000000000001 * 99999999999999 // (90000000000007 * 900000)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = phrases.collocations(df)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert out.count() == 0
