import random

import numpy as np

from rhapsode.llm import paragraphs as P
from rhapsode.llm import suffixes as S
from rhapsode.llm.wordseq import mixed, word_hashes

from .helpers import documents, odd_documents


def words(text):
    return (text or "").encode().lower().split()


def later_copies(rows, n=50):
    """Words that lie in n words in a row which occur earlier, by (doc_id, text); rows in order."""
    seen, cut = set(), {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            if k in seen:
                cut.setdefault(d, set()).update(range(i, i + n))
            seen.add(k)
    return cut


def covered(got):
    out = {}
    for r in got:
        out.setdefault(r["doc_id"], set()).update(range(r["word_from"], r["word_from"] + r["n_words"]))
    return out


def planted(seed=4, docs=60, passages=8):
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["ba", "ko", "ri", "tun", "ses", "vol"]) for _ in range(r.randint(1, 4)))
    text = lambda n: [word() for _ in range(n)]
    shared = [text(r.randint(55, 140)) for _ in range(passages)]
    rows, holds = [], {}
    for i in range(docs):
        body = text(r.randint(120, 400))
        if i % 2:
            p, at = r.randrange(passages), r.randrange(len(body))
            body[at:at] = shared[p]
            holds.setdefault(p, []).append(i)
        rows.append((i, " ".join(body)))
    return rows, {d for v in holds.values() for d in v[1:]}, {d for v in holds.values() for d in v}


def test_passages_inside_lines_are_found_and_nothing_else(spark):
    rows, later, holders = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cut = later_copies(rows)
    got = covered(S.repeated_passages(df).collect())
    assert set(got) == set(cut) == later
    assert all(got[d] == cut[d] for d in cut)
    found = P.repeated_paragraphs(df).collect()
    assert {r["doc_id"] for r in found} == later and {r["kept_doc_id"] for r in found} <= holders


def test_suffixes_against_brute_force_on_documents(spark):
    docs = documents(spark)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    cut, got = later_copies(rows), covered(S.repeated_passages(docs).collect())
    assert got == cut and cut


def test_minimizers_hit_every_window():
    rng = np.random.default_rng(3)
    for g in (rng.integers(0, 2**64, 500, dtype=np.uint64), np.zeros(300, dtype=np.uint64)):
        at = S.minimizers(g, 43)
        assert max(np.diff(np.concatenate([[-1], at, [len(g)]]))) <= 43


def paragraphs_of(text, reach=5):
    """Words and first words of paragraphs: a word is first where its pair's hash is the least of all pairs that begin up to reach words away."""
    w = words(text)
    h = [int(x) for x in word_hashes(w)]
    g = [int(mixed(np.array([(3 * x + y) % 2**64], dtype=np.uint64), 5)[0]) for x, y in zip(h, h[1:], strict=False)]
    least = [i for i in range(reach, len(g) - reach) if g[i] == min(g[i - reach : i + reach + 1])]
    return w, [*([0] if w else []), *(b for a, b in zip([-99, *least], least, strict=False) if b - a > reach and b > 0)]


def brute_clusters(rows):
    """Components of all paragraphs by exact Jaccard similarity, over all pairs."""
    items = {}
    for d, t in rows:
        w, first = paragraphs_of(t)
        for a, b in zip(first, [*first[1:], len(w)], strict=False):
            if b - a >= 5 or len(first) == 1:
                items.setdefault((d, a), b" ".join(w[a:b]).decode())
    keys = sorted(items, key=lambda k: (k[0] is None, k))
    comp = {k: k for k in keys}
    for i, x in enumerate(keys):
        for y in keys[:i]:
            if comp[x] != comp[y] and P.jaccard(items[x], items[y]) >= P.LEAST:
                old, new = comp[x], comp[y]
                comp = {k: new if c == old else c for k, c in comp.items()}
    groups = {}
    for k in keys:
        groups.setdefault(comp[k], []).append(k)
    return {k: v[0] for v in groups.values() for k in v[1:]}


def test_paragraph_clusters_equal_brute_force(spark):
    rows, _, _ = planted(seed=9, docs=24)
    r = random.Random(1)
    for i in range(8):  # near copies: a word in 40 changed
        rows.append((100 + i, " ".join(w if r.random() > 0.025 else "other" for w in rows[i][1].split())))
    got = {(x["doc_id"], x["word_from"]): (x["kept_doc_id"], x["kept_word_from"]) for x in P.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_clusters(rows)
    assert got == want


def test_paragraph_cuts_depend_on_their_words_only():
    r = random.Random(2)
    text = lambda n: [f"w{r.randrange(5000)}".encode() for _ in range(n)]
    passage = text(200)
    inner = lambda before: {int(b) - before for b in paragraphs_of(b" ".join(text(before) + passage + text(30)).decode())[1]}
    a, b = inner(0) & set(range(20, 180)), inner(77) & set(range(20, 180))
    assert a == b and len(a) > 4


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = odd_documents(spark, [None, "", " \n", long, long, "x " + long.upper() + " y", "z " * 3000, "a b c d e f"])
    got = covered(S.repeated_passages(docs).collect())
    assert {d: (min(w), max(w) + 1) for d, w in got.items() if d != 6} == {None: (0, 60), 5: (1, 61)}
    assert {r["doc_id"] for r in P.repeated_paragraphs(docs).collect()} >= {None, 5}
    for f in (S.repeated_passages, P.repeated_paragraphs):
        assert f(docs.limit(0)).count() == 0


def test_copies_of_short_texts_are_found(spark):
    r = random.Random(6)
    texts = [" ".join(f"w{r.randrange(9000)}" for _ in range(n)) for n in range(1, 34)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts)]
    got = covered(P.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert set(got) == {100 + i for i in range(len(texts))}
    assert all(len(got[100 + i]) >= n - 2 * (P.SHINGLE - 1) for i, n in enumerate(range(1, 34)))


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    """Texts around one phrase whose shingles have the least hashes, each with one near copy."""
    r = random.Random(8)
    word = lambda: f"w{r.randrange(10**6)}"
    shingles = lambda ws: P.gram_hashes(P.word_hashes([w.encode() for w in ws]), P.SHINGLE)
    phrase = min(([word() for _ in range(6)] for _ in range(3000)), key=lambda ws: int(mixed(shingles(ws), 7).max()))
    monkeypatch.setattr(P, "BLOCK", 16)
    rows = [(i, " ".join([*phrase, word(), word()])) for i in range(200)]
    rows += [(1000 + i, f"{t} {word()}") for i, t in rows]
    got = {x["doc_id"]: x["kept_doc_id"] for x in P.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1000 + i: i for i in range(200)}


def test_crowded_links_connect_what_all_pairs_connect(spark, monkeypatch):
    """A large group of near copies: chains of paragraphs, and a shingle that all of them share."""
    monkeypatch.setattr(P, "BLOCK", 8)
    r = random.Random(3)
    base = [f"b{i}" for i in range(24)]
    texts = sorted({" ".join([*(f"x{r.randrange(4)}" for _ in range(r.randrange(3))), *base[r.randrange(4) : 24 - r.randrange(4)], *(f"y{r.randrange(4)}" for _ in range(r.randrange(3)))]) for _ in range(150)})
    links = {(x["a"], x["b"]) for x in P.crowded_links(spark.createDataFrame(list(enumerate(texts)), "key long, body string"), 3).collect()}
    near = {(i, j) for j in range(len(texts)) for i in range(j) if P.jaccard(texts[i], texts[j]) >= P.LEAST}

    def components(pairs):
        comp = list(range(len(texts)))
        for i, j in pairs:
            comp = [comp[i] if c == comp[j] else c for c in comp]
        return [min(k for k in range(len(texts)) if comp[k] == c) for c in comp]

    assert links <= near and components(links) == components(near)


def test_passages_of_51_words_hold_a_whole_paragraph():
    r = random.Random(5)
    missed = 0
    for _ in range(1000):
        passage = [f"w{r.randrange(10**6)}" for _ in range(51)]
        inner = lambda n, m: {b - n for b in paragraphs_of(" ".join([*(f"v{r.randrange(10**6)}" for _ in range(n)), *passage, *(f"v{r.randrange(10**6)}" for _ in range(m))]))[1]}  # noqa: E731, B023
        missed += len({b for b in inner(40, 60) & inner(70, 25) if 0 <= b < 51}) < 2
    assert missed <= 6  # 0.3 % of them; 21 % with cuts that are least among 8 words to either side


def test_suffixes_of_a_crowded_gram_lose_no_words(spark):
    """Templates: a common middle, with many beginnings and many ends around it; a match needs words of both sides."""
    r = random.Random(4)
    text = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    middle, fronts, ends = text(40), [text(5) for _ in range(100)], [text(5) for _ in range(100)]
    pairs = [(i, j) for i in range(100) for j in range(100) if r.random() < 0.8]
    rows = [(k, " ".join([*text(40), *fronts[i], *middle, *ends[j], *text(40)])) for k, (i, j) in enumerate(pairs + r.sample(pairs, 100))]
    got = covered(S.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == later_copies(rows)


def test_cuts_of_many_texts_at_once_equal_those_of_each():
    r = random.Random(12)
    texts = [" ".join(r.choice(["x", "y", f"w{r.randrange(50)}"]) for _ in range(r.choice((0, 1, 3, 11, 12, 13, 60, 300)))) for _ in range(60)] + [None, "same " * 90]
    p, raw = P.cut(texts, set())
    got = {}
    for t, a, n, x, y in zip(*(p[c].tolist() for c in ("text", "word_from", "n_words", "from", "to")), strict=True):
        got.setdefault(t, []).append((a, n))
        assert raw[x:y].split() == words(texts[t])[a : a + n]
    for i, t in enumerate(texts):
        w, first = paragraphs_of(t)
        assert got.get(i, []) == [(a, b - a) for a, b in zip(first, [*first[1:], len(w)], strict=False) if b - a >= 5 or len(first) == 1]


def test_near_sets_share_a_band_and_pass_the_shape_test():
    r = random.Random(13)
    near = 0
    for _ in range(3000):
        base = [f"w{r.randrange(10**6)}" for _ in range(r.randrange(5, 80))]
        other = [*(f"u{r.randrange(9)}" for _ in range(r.randrange(3))), *base[r.randrange(3) : len(base) - r.randrange(3)], *(f"v{r.randrange(9)}" for _ in range(r.randrange(3)))]
        shapes, bands = [], []
        for t in (base, other):
            b, k, shape = P.bands_of(word_hashes([w.encode() for w in t]), np.array([0]), np.array([len(t)]))
            bands.append(set(b.tolist())), shapes.append(shape)
        if P.jaccard(" ".join(base), " ".join(other)) >= P.LEAST:
            near += 1
            assert bands[0] & bands[1] and P.like(*shapes)[0]
    assert near > 500
