import numpy as np
import xxhash

from rhapsode.llm.simhash import links_within, near_fingerprints, one_of_each, simhash_groups

from .helpers import documents, odd_documents


def brute_fingerprint(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """rows: (doc_id, fingerprint); the least id of each row's component, by comparing all."""
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2 and comp[i] != comp[j]:
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    return [min((rows[j][0] for j in range(len(rows)) if comp[j] == comp[i] and rows[j][0] is not None), default=None) for i in range(len(rows))]


def check(docs):
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
    want = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(rows, brute_components(rows), strict=True)), key=repr)
    assert sorted((tuple(r) for r in simhash_groups(docs).collect()), key=repr) == want


def test_documents(spark):
    check(documents(spark))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    check(docs)
    one = one_of_each(docs)
    assert one.columns == docs.columns
    got = simhash_groups(docs).collect()
    assert one.count() == len({r["component_id"] for r in got})
    assert simhash_groups(docs.limit(0)).count() == 0 and one_of_each(docs.limit(0)).count() == 0


def near_points(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 2**64, n, dtype=np.uint64)
    flip = lambda k: np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (n, k)).astype(np.uint64), axis=1)
    return np.unique(np.concatenate([x, x[: n // 2] ^ flip(1)[: n // 2], x[: n // 3] ^ flip(2)[: n // 3], x[: n // 4] ^ flip(3)[: n // 4], x[0] ^ flip(3)]))


def classes(pairs, n):
    comp = list(range(n))

    def root(i):
        while comp[i] != i:
            comp[i] = comp[comp[i]]
            i = comp[i]
        return i

    for a, b in pairs:
        comp[root(a)] = root(b)
    groups = {}
    for i in range(n):
        groups.setdefault(root(i), set()).add(i)
    return sorted(map(sorted, groups.values()))


def brute_pairs(x):
    a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2)
    return [(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if i < j]


def test_shard_search_equals_brute_force():
    x = near_points(1500, 1)
    a, b = links_within(x)
    assert classes(zip(a.tolist(), b.tolist(), strict=True), len(x)) == classes(brute_pairs(x), len(x))


def test_dealt_search_equals_brute_force(spark, monkeypatch):
    import rhapsode.llm.simhash as S

    monkeypatch.setattr(S, "SHARD", 64)  # many levels on few points
    x = near_points(1500, 2)
    df = spark.createDataFrame([(int(v),) for v in x.view("<i8")], "fp long")
    at = {int(v): i for i, v in enumerate(x.view("<i8"))}
    got = [(at[r["a"]], at[r["b"]]) for r in near_fingerprints(df, "fp").collect()]
    assert classes(got, len(x)) == classes(brute_pairs(x), len(x))


def test_components_of_null_ids_each_keep_a_row(spark):
    docs = spark.createDataFrame([(None, "a b c d e f g h i j"), (None, "a b c d e f g h i j"), (None, "q w e r t y u i o p"), (3, "one two three four")], "doc_id long, text string")
    assert sorted(r["text"] for r in one_of_each(docs).collect()) == ["a b c d e f g h i j", "one two three four", "q w e r t y u i o p"]


def test_dense_families_are_dealt_into_blocks(spark, monkeypatch):
    """Fingerprints that no vantage point parts: all within a few bits of one point, among strangers."""
    import rhapsode.llm.simhash as H

    monkeypatch.setattr(H, "SHARD", 32)
    monkeypatch.setattr(H, "DENSE", 2)
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 2**62))
    family = {base ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 62, (700, 3))}
    points = sorted(family | {int(x) for x in rng.integers(0, 2**62, 300)})
    links = [(r["a"], r["b"]) for r in H.near_fingerprints(spark.createDataFrame([(p,) for p in points], "fp long"), "fp").collect()]

    def components(pairs):
        comp = {p: p for p in points}
        for a, b in pairs:
            x, y = comp[a], comp[b]
            if x != y:
                comp = {p: min(x, y) if c in (x, y) else c for p, c in comp.items()}
        return comp

    assert components(links) == components([(a, b) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= 2])
