import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from rhapsode.llm import pii

from .helpers import documents, odd_documents


def brute(text):
    """The contract's patterns as they stand."""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 13 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("a1.@+- ()25é9_\n0"), max_size=60))
def test_base_spans_are_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def check(docs):
    rows = {(r["doc_id"], r["text"]) for r in docs.collect()}
    got = pii.find_personal_data(docs).collect()
    want = {}
    for d, t in rows:
        want.setdefault(d, []).append(brute(t or ""))
    for r in got:
        options = want[r["doc_id"]]
        base = next(b for b in options if hashlib.sha256(pii.joined(b).encode()).hexdigest() == r["base_sha256"])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[0] == k for s in base) for k in range(4)]
        assert set(filter(None, pii.joined(base).split(","))) <= set(r["spans"].split(","))
    assert len(got) == docs.count()


def test_documents(spark):
    check(documents(spark))


def test_odd_rows(spark):
    check(odd_documents(spark, [None, "", "a@b.c", "1.2.3.4 +1 (555) 123-4567", "4111 1111 1111 1111", "1" * 100_000 + " " + "a" * 100_000, "x@y.z,q@r.s"]))
    assert pii.find_personal_data(odd_documents(spark).limit(0)).count() == 0


def test_field_finds_what_patterns_miss():
    model = pii.trained()
    found = lambda t: [(pii.KINDS[k], t[a:b]) for k, a, b in pii.added_spans(t, pii.base_spans(t), model)]
    assert found("write to marlo at kaner dot com soon") == [("email", "marlo at kaner dot com")]
    assert found("call (555) 123-4567, please") == [("phone", "(555) 123-4567")]
    assert found("pay by 4111.1111.1111.1111 now") == [("card", "4111.1111.1111.1111")]
    assert found("aa bb 7 write to marlo at kaner dot com soon") == [("email", "marlo at kaner dot com")]
    assert found("mail jane at example dot co dot uk please") == [("email", "jane at example dot co dot uk")]
    assert found("call tel. (020) 7946 0958 now") == [("phone", "(020) 7946 0958")]
    assert found("dial 00 49 30 123456 today") == [("phone", "00 49 30 123456")]
    assert found("phone 415-555-0132, or 415.555.0199") == [("phone", "415-555-0132"), ("phone", "415.555.0199")]
    for clean in ("he looked at the dot on the map", "in 2024 we sold 300 of 1200 units at 12.5 percent", "order 123456 and 7890 and 55", "version 1.2.3 of 2021-10-11 at noon", "Apache License, Version 2.0. or later", "the 3 of 1999 at 10.5", "password=e3b3ed3cc8548923d6 chte", "id 4111.1111.1111.1112 here", "at the dot of"):
        assert found(clean) == []


def test_field_on_held_out_sentences():
    model, right, found, all_ = pii.trained(), 0, 0, 0
    for text, spans in pii.sentences(seed=99, count=300):
        got = set(pii.added_spans(text, [], model))
        right, found, all_ = right + len(got & set(spans)), found + len(got), all_ + len(spans)
    assert right / found > 0.97 and right / all_ > 0.9


def test_marginals_and_best_path_equal_enumeration():
    import numpy as np

    rng = np.random.default_rng(1)
    n, cells = 4, pii.SemiMarkov.lattice(4)
    s = rng.normal(size=(len(cells), 5))

    def paths(at):
        if at == n:
            yield []
        for k, (a, b) in enumerate(cells):
            if a == at:
                for kind in range(5 if b - a == 1 else 4):
                    for rest in paths(b):
                        yield [(k, kind), *rest]

    every = list(paths(0))
    w = np.exp([sum(s[k, y] for k, y in p) for p in every])
    p, log_z = pii.SemiMarkov.marginals(n, cells, s)
    assert np.isclose(log_z, np.log(w.sum()))
    want = np.zeros_like(p)
    for path, x in zip(every, w / w.sum(), strict=True):
        for k, y in path:
            want[k, y] += x
    assert np.allclose(p, want)
    assert pii.SemiMarkov.best(n, cells, s) == every[int(np.argmax(w))]


def test_masking():
    assert pii.masked("a@b.c and 1.2.3.4", "email:0:5,ip:10:17") == "[email] and [ip]"
    assert pii.masked(None, "") is None


def test_windows_hold_all_tokens_near_one_worth_asking_about():
    import random

    def naive(text, base):
        tokens = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        free = [not any(a < y and x < b for _, x, y in base) for a, b in tokens]
        keep = set()
        for k, (a, b) in enumerate(tokens):
            if free[k] and (re.search("[0-9@]", text[a:b]) or text[a:b] == "dot"):
                for d in (-1, 1):
                    j = k
                    while 0 <= j < len(tokens) and abs(j - k) <= pii.MOST - 1 and free[j]:
                        keep.add(tokens[j])
                        j += d
        return sorted(keep)

    r = random.Random(3)
    for _ in range(800):
        text = " ".join(r.choice(["w"] * 6 + ["7", "dot", "a@b.co", "x"]) for _ in range(r.randint(0, 90)))
        base = pii.base_spans(text)
        assert [t for w in pii.windows(text, base) for t in w] == naive(text, base)
    assert len(list(pii.windows("7 w " * 500, []))) == 1  # overlapping neighbourhoods are one window, however long
