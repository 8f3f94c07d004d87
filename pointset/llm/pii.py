"""Personal data: generated candidates, boosted trees, calibrated thresholds.

Generators of high recall propose spans of four kinds, overlapping at will.  Spans
that pass the strict rules of their kind (the base) are always redacted.  The others
are scored by boosted trees from their format and their context; a threshold per
kind, set on held-out candidates after calibration, selects what is redacted too.

The trees learn from the base spans of a bounded sample of documents, written in
other ways as well (phone numbers without country code, dotted card numbers, spelled
out addresses), against candidates that fail a rule and common kinds of numbers.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from heapq import nsmallest
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import by_text, text_blocks

KINDS = ("email", "ip", "card", "phone")
# The strict rules.  Possessive where that finds the same matches, so
# that a long run without one costs linear time.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Generators.
# The sign of an address, in any case; without one there is no address.
AT_SIGN = re.compile(rb"@|\[at\]|\(at\)| at(?= )", re.IGNORECASE)
WIDE_AT = re.compile(AT_SIGN.pattern.decode(), re.IGNORECASE)
WIDE_DOMAIN = re.compile(
    r" {0,2}[A-Za-z0-9-]{1,63}(?: ?(?:\.|\[dot\]|\(dot\)| dot ) ?[A-Za-z0-9-]{2,63}){1,4}", re.IGNORECASE
)
MOST_LOCAL = 64
WIDE_IP = re.compile(r"(?<![0-9.])[0-9]{1,4}(?:(?:\.|\[\.\]| \. )[0-9]{1,4}){3}(?![0-9])")
GROUP = re.compile("[0-9]+")
# What may lie between two groups of digits of one number.
JOINT = re.compile(r"[\x20().,/:-]{1,2}")
CARD_DIGITS = (12, 19)
PHONE_DIGITS = (7, 15)
CUES = {
    "email": re.compile(r"mail|contact|write|@", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|addr", re.I),
    "card": re.compile(r"card|visa|payment|credit|carte|karte|tarjeta", re.I),
    "phone": re.compile(r"tel|call|phone|mobile|fax|anruf|llam", re.I),
}
COUNTER_CUES = re.compile(r"version|\bv\b|order|invoice|isbn|date|page|\bno\b|id\b|total|price|[$€£=]", re.I)
CONTEXT = 24
# Bounds of the training sample.
SAMPLE_DOCS = 6_000
MOST_CANDIDATES = 20_000
# Candidates of one document to learn from.
MOST_OF_A_TEXT = 500
# Of the candidates that cut or exceed a known span, one in so many is learnt from.
ASIDE = 4
# Rewritten spans to learn from, if so many can be made.
REWRITTEN = 2_000
# Candidates scored at a time.
SCORED = 20_000
TREES = 60
DEPTH = 3
RATE = 0.2
BINS = 24
# Calibrated odds from which a candidate is redacted.
CONFIDENCE = 0.95


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` by the strict rules, by start and then kind."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        a = at
        while a > free and text[a - 1] in LOCAL:
            a -= 1
        found = DOMAIN.match(text, at + 1) if a < at else None
        if found:
            out.append((a, found.end(), 0))
            free = found.end()
        else:
            # an address may begin after this sign, not before it
            free = at + 1
        at = text.find("@", max(at + 1, free))
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            out.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), 2))
    for m in PHONE.finditer(text):
        if 10 <= len(digits_of(m.group())) <= 15:
            out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def number_spans(text: str):
    """Every run of neighbouring groups with the digits of a card or a phone number.

    A run has at most 19 groups, so the work is linear in the text, and no more groups
    are held at a time.
    """
    coming = ((m.start(), m.end()) for m in GROUP.finditer(text))
    groups = deque(islice(coming, CARD_DIGITS[1]))
    while groups:
        start, end = groups[0]
        first = start - text.startswith(("+", "("), start - 1) if start else 0
        n = 0
        for a, b in groups:
            if a > start and not JOINT.fullmatch(text, end, a):
                break
            n, end = n + b - a, b
            if n > CARD_DIGITS[1]:
                break
            if n >= CARD_DIGITS[0]:
                yield first, b, 2
            if PHONE_DIGITS[0] <= n <= PHONE_DIGITS[1]:
                yield first, b, 3
        groups.popleft()
        groups.extend(islice(coming, 1))


def taken(spans, size: int) -> bytearray:
    """1 at the code points of a text that lie in one of the spans."""
    out = bytearray(size)
    for a, b, _ in spans:
        out[a:b] = b"\1" * (b - a)
    return out


def address_spans(text: str):
    """Addresses around every sign: what reads as a name before it and a domain behind it."""
    for m in WIDE_AT.finditer(text):
        a = m.start() - text.startswith(" ", m.start() - 1) if m.start() else 0
        least = max(0, a - MOST_LOCAL)
        start = a
        while start > least and text[start - 1] in LOCAL:
            start -= 1
        found = WIDE_DOMAIN.match(text, m.end()) if start < a else None
        if found:
            yield start, found.end(), 0


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """Spans of high recall, one after another for all kinds; they may overlap."""
    yield from address_spans(text)
    yield from ((m.start(), m.end(), 1) for m in WIDE_IP.finditer(text))
    yield from number_spans(text)


def features(text: str, start: int, end: int, kind: int) -> list[float]:
    span = text[start:end]
    digits = digits_of(span)
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    groups = re.findall("[0-9]+", span)
    name = KINDS[kind]
    return [
        kind,
        len(span),
        len(digits),
        len(groups),
        max((len(g) for g in groups), default=0),
        min((len(g) for g in groups), default=0),
        len(groups[-1]) if groups else 0,
        span.count("."),
        span.count("-"),
        span.count(" "),
        span.count("(") + span.count(")"),
        span.count("/") + span.count(":") + span.count(","),
        span.count("@"),
        float(span.startswith("+")),
        float(luhn(digits)) if 12 <= len(digits) <= 19 else -1.0,
        max((int(g) for g in groups), default=0) if all(len(g) < 10 for g in groups) else 1e9,
        int(digits[0]) if digits else -1,
        len(set(digits)),
        sum(c.isalpha() for c in span),
        float(bool(CUES[name].search(before))),
        float(bool(CUES[name].search(after))),
        float(bool(COUNTER_CUES.search(before))),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in ("", " ", "\n", "\t")),
        float(after[:1] in ("", " ", "\n", "\t")),
        sum(c.isdigit() for c in before),
        sum(c.isdigit() for c in after),
    ]


class Boosting:
    """Boosted regression trees on binned features with a logistic loss."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        self.trees_wanted, self.depth, self.rate = trees, depth, rate
        self.edges: list[np.ndarray] = []
        self.trees: list[list] = []
        self.prior = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosting":
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = self.bins(x)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.prior = float(np.log(rate / (1 - rate)))
        score = np.full(len(y), self.prior)
        for _ in range(self.trees_wanted):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, p - y, p * (1 - p))
            self.trees.append(tree)
            score += self.rate * self._apply(tree, binned)
        return self

    def _grow(self, x, g, h):
        """Nodes as ``(feature, bin, value)`` in heap order; feature -1: leaf."""
        size = 2 ** (self.depth + 1) - 1
        tree = [(-1, 0, 0.0)] * size
        where = np.zeros(len(g), np.int64)
        for node in range(size):
            own = np.flatnonzero(where == node)
            if not len(own):
                continue
            gs, hs = g[own].sum(), h[own].sum()
            best, cut = 1e-6, None
            if node < size // 2 and len(own) >= 10:
                for j in range(x.shape[1]):
                    n = len(self.edges[j]) + 1
                    gl = np.cumsum(np.bincount(x[own, j], g[own], n))[:-1]
                    hl = np.cumsum(np.bincount(x[own, j], h[own], n))[:-1]
                    if not len(gl):
                        continue
                    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    gain[(hl < 0.5) | (hs - hl < 0.5)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, cut = float(gain[k]), (j, k)
            if cut is None:
                tree[node] = (-1, 0, float(-gs / (hs + 1)))
                continue
            tree[node] = (*cut, 0.0)
            right = x[own, cut[0]] > cut[1]
            where[own] = np.where(right, 2 * node + 2, 2 * node + 1)
        return tree

    def _apply(self, tree, x) -> np.ndarray:
        out = np.zeros(len(x))
        where = np.zeros(len(x), np.int64)
        for node, (feature, cut, value) in enumerate(tree):
            own = where == node
            if feature < 0:
                out[own] = value
            else:
                where[own] = np.where(x[own, feature] > cut, 2 * node + 2, 2 * node + 1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        binned = self.bins(x)
        out = np.full(len(x), self.prior)
        for tree in self.trees:
            out += self.rate * self._apply(tree, binned)
        return out


def calibrate(score: np.ndarray, y: np.ndarray, least: float = CONFIDENCE) -> float:
    """Lowest score whose odds, made monotone by pooling neighbours, reach ``least``."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []
    for s, t in zip(score[order], y[order]):
        pools.append([float(s), float(t), 1.0])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            s2, t2, n2 = pools.pop()
            pools[-1][1] += t2
            pools[-1][2] += n2
    good = [first for first, t, n in pools if t / n >= least]
    return good[0] if good else float("inf")


def rewritten(text: str, start: int, end: int, kind: int, rng) -> tuple[str, int, int] | None:
    """A base span in another notation, in its context; and where it then lies."""
    span, digits = text[start:end], digits_of(text[start:end])
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    if kind == 0:
        local, _, domain = span.partition("@")
        at, dot = ((" [at] ", "."), (" at ", " dot "), (" @ ", "."), (" at ", "."), ("(at)", "(dot)"), (" [at] ", " dot "))[rng.integers(6)]
        case = (str, str.upper, str.title)[rng.integers(3)]
        new = local + case(at) + domain.replace(".", case(dot))
        cue = "mail "
    elif kind == 1:
        new, cue = span.replace(".", "[.]"), "host "
    elif kind == 2:
        sep = ".  "[rng.integers(2)]
        new, cue = sep.join(digits[i : i + 4] for i in range(0, len(digits), 4)), "card "
    else:
        d = digits[-10:].rjust(10, "5")
        new = (f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", d)[rng.integers(4)]
        digits, cue = d, "phone "
    # rows of a table and lists of numbers often name no kind; a plain number needs it
    if kind < 2 or new == digits or rng.integers(2):
        before += cue
    if kind >= 2:
        left, right = company(new, rng)
        before, after = before + left, right + after
    return before + new + after, len(before), len(before) + len(new)


def company(span: str, rng) -> tuple[str, str]:
    """What stands next to a number in a list or a row of a table: often another one."""
    other = "".join(str(rng.integers(10)) if c.isdigit() else c for c in span)
    gap = (", ", " ", "; ", " / ")[rng.integers(4)]
    left = ("", "", f"{rng.integers(2, 100)} ", other + gap)[rng.integers(4)]
    return left, ("", "", f" {rng.integers(2, 100)}", gap + other)[rng.integers(4)]


def misplaced(text: str, start: int, end: int, kind: int, rng, most: int = 4) -> list[tuple[int, int, int]]:
    """Some candidates that cut or exceed the given span."""
    found = [c for c in candidates(text) if c != (start, end, kind) and c[0] < end and start < c[1]]
    return [found[i] for i in rng.permutation(len(found))[:most]]


def counterexamples(rng, n: int) -> list[tuple[str, int, int, int]]:
    """Numbers that are no personal data: dates, versions, amounts, ranges, codes."""
    out = []
    for i in range(n):
        a, b, c, d = (int(v) for v in rng.integers(1, 29, 4))
        year, big = int(rng.integers(1950, 2040)), int(rng.integers(10**6, 10**9))
        kind, span = (
            (3, f"{year}-{a:02d}-{b:02d}"),
            (3, f"{a:02d}.{b:02d}.{year}"),
            (1, f"{a}.{b}.{c}.{300 + big % 700}"),
            (3, f"{big:,}"),
            (3, f"{big}"),
            (2, f"{big}{big % 997:03d}{year}{b}"),
            (3, f"{year}-{year + 3} {a}"),
            (0, f"meet at {a} dot noon"),
            (3, f"{year}{a:02d}{b:02d}"),
            (3, f"{1_400_000_000 + big % 400_000_000}"),
            (3, f"{a}, {b}, {c}, {d}, {year}"),
            (3, f"{year}, {year + 1}, {year + 2}"),
            (2, f"{year} {year + 1} {year + 2} {year + 3}"),
            (0, ("stay at home.Then", "noon at work.We", "was at once.The", "look at this...And")[a % 4]),
            (0, f"sold at {a}.{10 + b}"),
            (0, f"open at {a}.30"),
            (0, ("point at the dot in", "there at dot com", "meet at the dot now")[a % 3]),
        )[i % 17]
        before, after = ("version ", "order ", "on ", "in ", "total ", "the ")[i % 6], (" was", ".", " of", ",")[d % 4]
        out.append((before + span + after, len(before), len(before) + len(span), kind))
    return out


def known_label(text: str, span: tuple, base: set, inside: bytearray) -> bool | None:
    """Whether a candidate is personal data; ``None``: no rule tells.

    ``inside`` marks the base spans: what cuts or exceeds one is no span of its own.
    """
    a, b, kind = span
    if span in base:
        return True
    if inside.find(1, a, b) >= 0:
        return False
    value = text[a:b]
    digits = digits_of(value)
    if kind == 1 and all(c in "0123456789." for c in value):
        return False
    if kind == 2 and not luhn(digits):
        return False
    if kind == 3 and value.startswith("+") and not 10 <= len(digits) <= 15:
        return False
    return None


def sample_rows(batches):
    for batch in batches:
        rows = []
        for text, h in zip(batch.column("text").to_pylist(), batch.column("_h").to_pylist()):
            base = set(base_spans(text))
            inside = taken(base, len(text))

            def labelled():
                for span in chain(base, (c for c in candidates(text) if c not in base)):
                    good = known_label(text, span, base, inside)
                    a, b, kind = span
                    place = h + 7 * a + 3 * b + kind
                    if good is not None and (good or inside.find(1, a, b) < 0 or place % ASIDE == 0):
                        yield not good, place * 0x9E3779B97F4A7C15 % (1 << 64), span

            # known spans first, then any
            for other, _, (a, b, kind) in nsmallest(MOST_OF_A_TEXT, labelled()):
                near = text[max(0, a - CONTEXT) : b + CONTEXT]
                rows.append((h, near, min(a, CONTEXT), min(a, CONTEXT) + b - a, kind, not other))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()))],
            ["h", "near", "start", "end", "kind", "good"],
        )


class Trained(NamedTuple):
    """Trees, a threshold per kind, and the share of held-out spans of a kind that reach it."""

    model: Boosting
    limits: list[float]
    recall: dict[str, float]


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 9) -> Trained:
    """Trees and thresholds from about ``sample_docs`` documents, chosen by a keyed hash.

    Whole documents are held out for the thresholds, with all that was made of their spans.
    """
    total = max(1, docs.count())
    h = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    odds = min(1.0, sample_docs / total)
    chosen = docs.select(F.coalesce("text", F.lit("")).alias("text"), h.alias("_h")).where(
        F.pmod(F.shiftright("_h", 8), F.lit(1 << 40)) / float(1 << 40) < odds
    )
    found = chosen.mapInArrow(sample_rows, "h long, near string, start long, end long, kind long, good boolean")
    rows = found.orderBy("h", "start", "end", "kind", "near").limit(MOST_CANDIDATES).collect()
    rng = np.random.default_rng(seed)
    examples = [(r.near, r.start, r.end, r.kind, float(r.good), r.h) for r in rows]
    known = [(*e[:4], e[5]) for e in examples if e[4]]
    # few known spans are written in more ways each
    for near, start, end, kind, doc in known:
        for _ in range(max(1, min(16, REWRITTEN // len(known)))):
            text, a, b = rewritten(near, start, end, kind, rng)
            examples.append((text, a, b, kind, 1.0, doc))
            examples += [(text, *c, 0.0, doc) for c in misplaced(text, a, b, kind, rng)]
    examples += [(*e, 0.0, f"made {i}") for i, e in enumerate(counterexamples(rng, 1700))]
    x = np.array([features(t, a, b, k) for t, a, b, k, *_ in examples])
    y = np.array([e[4] for e in examples])
    places: dict = {}
    doc = np.array([places.setdefault(e[5], len(places)) for e in examples])
    test = (rng.random(len(places)) < 0.3)[doc]
    if len(set(y[~test])) < 2 or not test.any():
        return Trained(Boosting(0).fit(x, y), [float("inf")] * len(KINDS), {})
    model = Boosting().fit(x[~test], y[~test])
    score = model.score(x)
    limits, recall = [], {}
    for k, name in enumerate(KINDS):
        own = test & (x[:, 0] == k)
        limits.append(calibrate(score[own], y[own]))
        if (own & (y > 0)).any():
            recall[name] = float(np.mean(score[own & (y > 0)] >= limits[k]))
    return Trained(model, limits, recall)


def choose(text: str, base: list, found: list, score: np.ndarray, limits: list) -> list:
    """Base spans and, by falling score, the candidates that touch none chosen before.

    Of equal scores the longer span goes first.
    """
    out, full = list(base), taken(base, len(text))
    for i in sorted(range(len(found)), key=lambda i: (-score[i], found[i][0] - found[i][1])):
        a, b, kind = found[i]
        if score[i] >= limits[kind] and full.find(1, a, b) < 0:
            out.append(found[i])
            full[a:b] = b"\1" * (b - a)
    return sorted(out, key=lambda s: (s[0], s[2]))


class Scoring:
    """Scores candidates some at a time and keeps, text by text, those above the limits."""

    def __init__(self, model: Boosting, limits: list):
        self.model, self.limits = model, limits
        self.rows: list = []
        self.waiting: list = []
        self.good: dict[int, tuple[list, list]] = {}

    def add(self, i: int, text: str, base: list) -> None:
        inside = taken(base, len(text))
        for span in candidates(text):
            if inside.find(1, span[0], span[1]) < 0:
                self.rows.append(features(text, *span))
                self.waiting.append((i, span))
                if len(self.rows) >= SCORED:
                    self.settle()

    def settle(self) -> None:
        if self.rows:
            for (i, span), score in zip(self.waiting, self.model.score(np.array(self.rows))):
                if score >= self.limits[span[2]]:
                    spans, scores = self.good.setdefault(i, ([], []))
                    spans.append(span)
                    scores.append(score)
        self.rows, self.waiting = [], []


def listed(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def redact(text: str, spans: list) -> str:
    """The text with every run of touching spans replaced by the kind of its first."""
    parts, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            parts += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join(parts) + text[at:]


def find(model: Boosting, limits: list, with_text: bool):
    hint = np.zeros(256, bool)
    hint[48:58] = True
    hint[ord("@")] = True

    def run(batches):
        for batch in batches:
            for block in text_blocks(batch.column("text")):
                hints = by_text(hint[block.data], block.offsets)
                bases, all_spans, texts = [], [], []
                scoring = Scoring(model, limits)
                for i in range(block.size):
                    raw = block.data[block.offsets[i] : block.offsets[i + 1]].tobytes()
                    spelled = AT_SIGN.search(raw) is not None
                    text = raw.decode("utf-8", "replace") if hints[i] or spelled or with_text else ""
                    base = base_spans(text) if hints[i] else []
                    bases.append(base)
                    all_spans.append(base)
                    texts.append(text)
                    if hints[i] or spelled:
                        scoring.add(i, text, base)
                scoring.settle()
                for i, (own, score) in scoring.good.items():
                    all_spans[i] = choose(texts[i], bases[i], own, score, limits)
                counts = [[sum(k == kind for *_, k in b) for b in bases] for kind in range(len(KINDS))]
                given = batch.column("text").slice(block.first, block.size)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(block.first, block.size) for n, c in zip(batch.schema.names, batch.columns) if n != "text"],
                        *[pa.array(c, pa.int64()) for c in counts],
                        pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in bases], pa.string()),
                        pa.array([listed(s) for s in all_spans], pa.string()),
                        pa.array(
                            [redact(t, s) if given[i].is_valid else None for i, (t, s) in enumerate(zip(texts, all_spans))]
                            if with_text else [None] * block.size,
                            pa.string(),
                        ),
                    ],
                    [
                        *[n for n in batch.schema.names if n != "text"],
                        *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "redacted",
                    ],
                )

    return run


def find_personal_data(docs: DataFrame, *keep: str, with_text: bool = True) -> DataFrame:
    """Spans of personal data, and the redacted text, of every document.

    Returns ``doc_id``, the columns named in ``keep``, ``n_email, n_ip, n_card,
    n_phone`` and ``base_sha256`` of the base spans, all ``spans`` as
    ``kind:start:end`` (code points, end exclusive) and ``redacted`` (null for null
    texts, or without ``with_text``).  Null and empty texts have no spans; very long ones
    are searched whole, candidate by candidate.  Repeated rows are treated alike; an
    empty table gives no rows; columns not named are not read.  A name before the sign
    of an address is proposed with up to 64 characters, a domain with up to five labels
    (base addresses have no such bound).
    """
    model, limits, _ = train(docs)
    rows = docs.select("doc_id", *keep, "text")
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(
        find(model, limits, with_text), f"{shape}, {counts}, base_sha256 string, spans string, redacted string"
    )
