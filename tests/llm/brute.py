"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def warc(pages):
    """pages: (page_id, url, html)"""
    payloads = [(p, (h or "").encode()) for p, _, h in pages]
    first = {}
    for p, b in payloads:
        if len(b) >= 100 and p is not None:
            first[b] = min(p, first.get(b, p))
    out = []
    for p, b in payloads:
        to = first.get(b) if len(b) >= 100 else None
        to = None if to == p else to
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "response" if to is None else "revisit", to))
    return out


def targets(sizes, weights=(5, 2, 1), share=Fraction(3, 2), repeats=2):
    """sizes: source -> words"""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, live, out = share * sum(sizes.values()), set(names), {}
    while True:
        total = sum(weight[s] for s in live)
        over = {s for s in live if left * weight[s] / total > repeats * sizes[s]} if total else set()
        if not over:
            for s in live:
                out[s] = left * weight[s] / total
            return out
        for s in over:
            out[s] = Fraction(repeats * sizes[s])
            left -= out[s]
        live -= over


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def is_number(text, start, end):
    """Whole groups of digits with one or two joints between them, after a sign if there is one."""
    if start and (text[start - 1].isdigit() or text[start].isdigit() and text[start - 1] in "+("):
        return False
    if end < len(text) and text[end].isdigit():
        return False
    return re.fullmatch(r"[+(]?[0-9]+([ ().,/:-]{1,2}[0-9]+)*", text[start:end]) is not None


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def repeats(docs, width=35):
    """docs: (doc_id, text)"""
    own = [words(t) for _, t in docs]
    seen = Counter(tuple(w[i : i + width]) for w in own for i in range(len(w) - width + 1))
    out = []
    for (doc, _), w in zip(docs, own):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(docs, n=2, percent=80):
    sets = []
    for _, t in docs:
        w = words((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()})
    where = defaultdict(set)
    label = list(range(len(docs)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, s in enumerate(sets):
        met = Counter(j for x in s for j in where[x])
        for j, both in met.items():
            if docs[i][0] is None or docs[j][0] is None:
                continue
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                label[max(a, b, key=lambda k: docs[k][0])] = min(a, b, key=lambda k: docs[k][0])
        for x in s:
            where[x].add(i)
    return [
        (docs[i][0], len(sets[i]), docs[root(i)][0], docs[root(i)][0] == docs[i][0]) for i in range(len(docs))
    ]


def tokens(docs, tokenizer, end):
    out, start = [], 0
    for doc, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def vectors(rows, least=0.98):
    """rows: (vec_id, embedding, label)"""
    good = [
        v is not None and len(v) > 0 and y is not None and all(e is not None and np.isfinite(e) for e in v) and any(v)
        for _, v, y in rows
    ]
    links, label = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (_, v, y) in enumerate(rows):
        for j in range(i):
            if good[i] and good[j] and y == rows[j][2] and len(v) == len(rows[j][1]):
                a, b = np.array(v, float), np.array(rows[j][1], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                    links[i] += 1
                    links[j] += 1
                    a, b = root(i), root(j)
                    label[max(a, b, key=lambda k: rows[k][0])] = min(a, b, key=lambda k: rows[k][0])
    return [(rows[i][0], links[i], rows[root(i)][0], rows[root(i)][0] == rows[i][0]) for i in range(len(rows))]


def line_metrics(doc, text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if count[tuple(w[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    return (
        doc, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit),
        len(w) < 20 or 100 * len(hit) > 30 * len(w),
    )


SPACES = " \t\n\x0b\x0c\r"
PATTERN = re.compile("(s?(ua)+)?")


def damaged(rows):
    """rows: (conv_id, turn, role, text)"""
    out = []
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out += [(c, t, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def repair(rows):
    """Cheapest edits of ``(role, text, fault)``: every prefix of the pattern with its least edits."""
    best = {"": (0, "", ())}  # the last two initials, and whether anything came before
    def extend(seen, initial):
        if seen == "":
            return initial if initial in ("s", "u") else None
        return initial if (seen[-1], initial) in {("s", "u"), ("u", "a"), ("a", "u")} else None

    def offer(into, key, value):
        if key is not None and (key not in into or value[:2] < into[key][:2]):
            into[key] = value

    def inserted(states):
        states = dict(states)
        for _ in range(3):
            for key, (cost, audit, kept) in list(states.items()):
                for name in ("user", "assistant"):
                    offer(states, extend(key, name[0]), (cost + 5, audit + "I", (*kept, f"{name}:")))
        return states

    for role, text, fault in rows:
        after = {}
        # without the insertions at the end, so that no edits are the beginning of others
        for start, (cost0, audit0, kept0) in best.items():
            for key, (cost, audit, kept) in inserted({start: (cost0, audit0, kept0)}).items():
                offer(after, key, (cost + 2, audit + "D", kept))
                if fault in ("blank", "duplicate"):
                    continue
                extra = 5 if fault == "truncated" else 0
                offer(after, extend(key, role[:1]), (cost + extra, audit + "K", (*kept, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    offer(after, extend(key, name[0]), (cost + extra + 1, audit + "R", (*kept, f"{name}:{text}")))
        best = after
    ends = [
        v for start, value in best.items() for k, v in inserted({start: value}).items()
        if PATTERN.fullmatch("".join(x[0] for x in v[2])) is not None
    ]
    return min(ends)


def conversations(rows):
    """Contract of the repair of (conv_id, turn, role, text)."""
    groups = {c: [] for c, *_ in rows}
    for c, t, role, text in damaged(rows):
        groups[c].append((t is not None, t or 0, role, text))
    out = []
    for c, given in groups.items():
        given.sort()
        turns = {t for known, t, _, _ in given if known}
        seen, marked, counts = set(), [], Counter()
        for _, _, role, text in given:
            stripped = text.strip(SPACES)
            fault = "blank" if not stripped else "duplicate" if (role, text) in seen else ""
            fault = fault or ("" if stripped[-1] in ".!?" else "truncated")
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault))
        pairs = [(a[0][:1], b[0][:1]) for a, b in zip(marked, marked[1:])]
        illegal = sum(p not in {("s", "u"), ("u", "a"), ("a", "u")} for p in pairs)
        cost, audit, kept = repair(marked)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((c, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(kept))))
    return out


LICENSE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def license_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def license_base(text):
    """n_words, n_base, first_word, last_word, base_labels"""
    w, starts, labels = license_words(text), [], set()
    for phrase, label in LICENSE_PHRASES.items():
        p = phrase.split()
        here = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        starts += here
        labels |= {label} if here else set()
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def license_runs(words, templates, least):
    """Runs of words that stand in a template and go on neither way there: the longest at their last word."""
    found = {n: set() for n in range(len(templates))}
    for end in range(1, len(words) + 1):
        here = {}
        for n, t in enumerate(templates):
            for place in range(1, len(t) + 1):
                size = 0
                while size < min(end, place) and words[end - 1 - size] == t[place - 1 - size]:
                    size += 1
                here[n, place] = size
        longest = max(here.values(), default=0)
        for (n, place), size in here.items():
            goes_on = end < len(words) and place < len(templates[n]) and words[end] == templates[n][place]
            if size == longest >= least and not goes_on:
                found[n].add((end - size, place - size, size))
    return {n: runs for n, runs in found.items() if runs}
