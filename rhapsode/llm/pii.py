"""Operator 7: personal data, by fixed patterns and a semi-Markov conditional random field.

The base spans follow fixed patterns. Around what they leave (tokens with digits or an at sign, or spelled-out addresses) a semi-Markov
field scores candidate segments of up to MOST tokens by features of the whole span: its shape, its digits, its separators, its check
digit. Dynamic programming over segments chooses boundaries and kinds jointly; segments whose marginal probability reaches SURE are added. The
field is trained here, by gradient ascent on the exact likelihood of generated sentences, the same in each run.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MOST, SURE = 7, 0.9
#: Tokens to either side of one worth asking about that a window holds: no segment that holds it reaches further.
AROUND = MOST - 1

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT, _NOT_DIGIT = re.compile(r"[0-9]"), re.compile(r"[^0-9]")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Matches of the address pattern, found from their at signs, in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield 0, start, m.end()
            end = m.end()
        at = text.find("@", m.end() if m else at + 1)


def small_part(part: str) -> bool:
    digits = part.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start; offsets are code points, ends exclusive."""
    out = list(emails(text))
    if _DIGIT.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(small_part, m.group().split(".")))]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


# ---- the field

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_TRIM_LEFT, _TRIM_RIGHT = "\"'<{[;:,", "\"'>}];:,.!?"
_SPELLED = re.compile(r"^[\[({]?(dot|punkt|punto|point)[\])}]?[.,;:!?]?$", re.I)
_AT = re.compile(r"^[\[({]?(at|arroba)[\])}]?$", re.I)


def trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in _TRIM_LEFT:
        a += 1
    while a < b and text[b - 1] in _TRIM_RIGHT:
        b -= 1
    return a, b


def span_features(s: str) -> tuple[str, ...]:
    """Features of a whole candidate span."""
    words, digits = s.split(), _NOT_DIGIT.sub("", s)
    shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", "9", s))
    counts = "/".join(str(min(len(g), 6)) for g in re.findall(r"[0-9]+", s)[:6])
    at, dot = sum(bool(_AT.match(w)) for w in words), sum(bool(_SPELLED.match(w)) for w in words)
    out = [f"shape={shape[:24]}", f"groups={counts}", f"tokens={len(words)}", f"digits={min(len(digits), 20)}", f"at={min(at, 2)}", f"dot={min(dot, 2)}", f"@={min(s.count('@'), 2)}"]
    letters = any(c.isalpha() for c in s)
    out += [f"letters={letters}", f"first={'9' if s[0].isdigit() else 'a' if s[0].isalpha() else s[0]}", f"last={'9' if s[-1].isdigit() else 'a' if s[-1].isalpha() else s[-1]}"]
    if not letters and 13 <= len(digits) <= 19:
        out.append(f"luhn={luhn(digits)}")
    if not letters and len(digits) in (9, 10, 11, 12, 13) and len(re.findall(r"[0-9]+", s)) >= 3:
        out.append(f"phone-like={'(' in s or '-' in s or '.' in s}")
    if at and dot:
        out.append(f"tail={words[-1].lower()[:4]}")
        out.append(f"spelled={bool(_AT.match(words[1])) if len(words) > 1 else False}/{bool(_SPELLED.match(words[-2])) if len(words) > 1 else False}")
    return tuple(out)


class SemiMarkov:
    """Segments of kinds 0 to 3, of up to MOST tokens, and single tokens that are none of them."""

    def __init__(self, names: dict[str, int], weights: np.ndarray):
        self.names, self.w = names, weights  # a row for each feature, a column for each kind, the last for none

    def scores(self, spans: list[list[str]]) -> tuple[list[list[int]], np.ndarray]:
        ids = [[self.names[f] for f in s if f in self.names] for s in spans]
        return ids, np.array([self.w[i].sum(axis=0) if i else np.zeros(self.w.shape[1]) for i in ids])

    @staticmethod
    def lattice(n: int) -> list[tuple[int, int]]:
        return [(a, b) for b in range(1, n + 1) for a in range(max(0, b - MOST), b)]

    @staticmethod
    def marginals(n: int, cells: list[tuple[int, int]], s: np.ndarray) -> tuple[np.ndarray, float]:
        """Probability of each cell and kind; the logarithm of the sum over all segmentations."""
        none = len(KINDS)
        usable = s.copy()
        for k, (a, b) in enumerate(cells):
            if b - a > 1:
                usable[k, none] = -np.inf
        fore, back = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        fore[0] = back[n] = 0.0
        total = np.logaddexp.reduce(usable, axis=1)
        for (a, b), t in zip(cells, total, strict=True):
            fore[b] = np.logaddexp(fore[b], fore[a] + t)
        for (a, b), t in zip(reversed(cells), reversed(total), strict=True):
            back[a] = np.logaddexp(back[a], back[b] + t)
        outside = np.array([fore[a] + back[b] for a, b in cells])
        return np.exp(usable + outside[:, None] - fore[n]), float(fore[n])

    @staticmethod
    def best(n: int, cells: list[tuple[int, int]], s: np.ndarray) -> list[tuple[int, int]]:
        """(cell, kind) of the best segmentation."""
        top, how = np.full(n + 1, -np.inf), [None] * (n + 1)
        top[0] = 0.0
        for k, (a, b) in enumerate(cells):
            for kind in range(len(KINDS) + (b - a == 1)):
                if top[a] + s[k, kind] > top[b]:
                    top[b], how[b] = top[a] + s[k, kind], (k, kind)
        out, at = [], n
        while at:
            out.append(how[at])
            at = cells[how[at][0]][0]
        return out[::-1]


def sentences(seed: int = 11, count: int = 700) -> list[tuple[str, list[Span]]]:
    """Generated sentences with their spans: personal data in forms that the fixed patterns miss, and what only looks like it."""
    r = random.Random(seed)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    name = lambda: "".join(r.choice(["ka", "lo", "mi", "ner", "tu", "sel", "an"]) for _ in range(r.randint(1, 3)))

    def number(ok: bool) -> str:
        while True:
            d = r.choice("3456") + digits(r.choice((14, 15)))
            if luhn(d) == ok:
                return d

    def four(d: str, sep: str) -> str:
        return sep.join(d[i : i + 4] for i in range(0, len(d), 4))

    def personal() -> tuple[int, str]:
        k = r.randint(0, 9)
        if k < 4:
            at, dot = r.choice((("at", "dot"), ("(at)", "(dot)"), ("[at]", "[dot]"), ("AT", "DOT")))
            local = f"{name()} {dot} {name()}" if r.random() < 0.2 else name()
            ends = ("com", "org", "net", "de", "fr") if " " in local else ("com", "org", "net", "de", "fr", f"co {dot} uk", f"com {dot} br")
            return 0, f"{local} {at} {name()} {dot} {r.choice(ends)}"
        if k < 6:
            return 2, four(number(True), r.choice((".", "/", "_")))
        a, b, c = digits(3), digits(3), digits(4)
        return 3, r.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{r.choice('1346')} {a} {b} {c}", f"00{r.choice('346')}{digits(1)} {digits(2)} {digits(6)}", f"00 {r.choice('346')}{digits(1)} {digits(2)} {digits(6)}", f"(0{digits(2)}) {digits(4)} {digits(4)}"))

    def other() -> str:
        k = r.randint(0, 16)
        plain = (digits(r.randint(1, 8)), f"{digits(1)}.{digits(1)}", f"v{digits(1)}.{digits(2)}.{digits(1)}", f"version {digits(1)}", f"20{digits(2)}-{r.randint(10, 12)}-{r.randint(10, 28)}", number(False), four(number(False), r.choice(" .-")), f"{r.randint(256, 999)}.{digits(3)}.{digits(2)}.{digits(3)}", f"password={digits(4)}ab{digits(6)}", f"AK{digits(2)}XY{digits(6)}", f"{digits(1)},{digits(3)}", f"at {name()}", f"{name()} dot {name()}", f"@{name()}", f"{digits(1)}.{digits(1)}.{digits(1)}", f'"{digits(8)}e{digits(12)}"', f"{name()} at the dot {r.choice(('on', 'in', 'of', 'is', 'and', 'to'))}")
        return plain[k]

    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(r.randint(1, 3)):
            text += " ".join([name() for _ in range(r.randint(1, 4))]) + r.choice((" ", " ", " ", " tel. ", " phone: "))
            if r.random() < 0.5:
                kind, s = personal()
                spans.append((kind, len(text), len(text) + len(s)))
            else:
                s = other()
            text += s + r.choice(("", "", ",", ".")) + " "
        out.append((text + name(), spans))
    return out


def cell_spans(text: str, tokens: list[tuple[int, int]], cells: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[list[str]]]:
    places = [trimmed(text, tokens[a][0], tokens[b - 1][1]) for a, b in cells]
    return places, [list(span_features(text[a:b])) + [f"cell={min(d - c, 3)}"] if a < b else ["empty"] for (a, b), (c, d) in zip(places, cells, strict=True)]


@lru_cache(maxsize=2)
def trained(seed: int = 11, rounds: int = 6, rate: float = 0.25, decay: float = 1e-4) -> SemiMarkov:
    """The field after so many rounds of stochastic gradient ascent on the log-likelihood."""
    none, names, data = len(KINDS), {}, []
    for text, spans in sentences(seed):
        tokens = [m.span() for m in _TOKEN.finditer(text)]
        cells = SemiMarkov.lattice(len(tokens))
        places, feats = cell_spans(text, tokens, cells)
        ids = [[names.setdefault(f, len(names)) for f in s] for s in feats]
        truth, covered = np.zeros((len(cells), none + 1)), set()
        for kind, lo, hi in spans:
            k = next(k for k, (p, (a, b)) in enumerate(zip(places, cells, strict=True)) if p == (lo, hi) and tokens[a][0] <= lo and tokens[b - 1][1] >= hi)
            truth[k, kind] = 1
            covered.update(range(*cells[k]))
        for k, (a, b) in enumerate(cells):
            if b - a == 1 and a not in covered:
                truth[k, none] = 1
        data.append((len(tokens), cells, ids, truth))
    model = SemiMarkov(names, np.zeros((len(names), none + 1)))
    order = random.Random(seed)
    for turn in range(rounds):
        order.shuffle(data)
        for n, cells, ids, truth in data:
            s = np.array([model.w[i].sum(axis=0) for i in ids])
            step = truth - SemiMarkov.marginals(n, cells, s)[0]
            flat = np.concatenate([np.array(i) for i in ids])
            np.add.at(model.w, flat, (rate / (1 + turn)) * np.repeat(step, [len(i) for i in ids], axis=0))
            model.w *= 1 - decay
    return model


def windows(text: str, base: list[Span]) -> Iterator[list[tuple[int, int]]]:
    """Runs of tokens within AROUND of a token worth asking about, of any length where these meet; tokens that a base span touches end a run."""
    if not (_DIGIT.search(text) or "@" in text or re.search(r"dot|punkt|punto|point", text, re.I)):
        return
    taken = sorted((a, b) for _, a, b in base)
    tokens, i, asked, run = [], 0, None, 0  # tokens of the run of free ones so far; the last asked one's place; tokens of the run before these

    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if i < len(taken) and taken[i][0] < b:
            if asked is not None:
                yield tokens[: asked + AROUND + 1 - run]
            tokens, asked, run = [], None, 0
            continue
        at, w = run + len(tokens), m.group()
        if asked is not None and at > asked + 2 * AROUND:  # no window of a later token meets this one
            yield tokens[: asked + AROUND + 1 - run]
            tokens, asked, run = tokens[asked + AROUND + 1 - run :], None, asked + AROUND + 1
        if _DIGIT.search(w) or "@" in w or (w[-4:].isascii() and _SPELLED.match(w)):
            asked = at
        elif asked is None and len(tokens) == AROUND:
            tokens, run = tokens[1:], run + 1
        tokens.append((a, b))
    if asked is not None:
        yield tokens[: asked + AROUND + 1 - run]


def added_spans(text: str, base: list[Span], model: SemiMarkov) -> list[Span]:
    out = []
    for tokens in windows(text, base):
        cells = SemiMarkov.lattice(len(tokens))
        places, feats = cell_spans(text, tokens, cells)
        _, s = model.scores(feats)
        chosen = [(k, kind) for k, kind in SemiMarkov.best(len(tokens), cells, s) if kind < len(KINDS)]
        if chosen:
            p, _ = SemiMarkov.marginals(len(tokens), cells, s)
            out += [(kind, *places[k]) for k, kind in chosen if p[k, kind] >= SURE and places[k][0] < places[k][1]]
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), a row for each row of docs.

    The counts and the digest are of base spans; spans has the added ones too, which overlap no base span. Null texts are empty, and empty texts have
    no spans. Rows that repeat get equal results. Texts are read whole. Extra columns play no part.
    """
    model = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, digests, spans = [[] for _ in KINDS], [], []
            for t in b.column(1):
                text = t.as_py() or ""
                base = base_spans(text)
                for k in range(len(KINDS)):
                    counts[k].append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(base + added_spans(text, base, model)))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str | None, spans: str) -> str | None:
    """The text with each span replaced by its kind in brackets, overlapping spans by the first one's."""
    if not spans:
        return text
    found = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",")))
    out, at = [], 0
    for a, b, k in found:
        if a >= at:
            out += [text[at:a], f"[{k}]"]
            at = b
        else:
            at = max(at, b)
    return "".join([*out, text[at:]])
