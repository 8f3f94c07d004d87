"""Token ids by the tokenizers library, for whole texts.

The public tokenizers used here never merge across a single space between two
visible characters (byte-level BPE), or across any space (the other one).  Texts are
cut there, every distinct piece of a group of texts is encoded once, and the ids of
the texts are put together from those of their pieces.  A worker remembers a bounded
number of pieces for its next groups.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import free_memory, process_cache

# Bytes of the texts that share their pieces, and of the pieces a worker remembers for
# its next groups; callers with more memory to spare may ask for more.
GROUP_BYTES = 2 << 20
REMEMBERED_BYTES = 16 << 20
# Pieces handed to the tokenizer as one text.
JOINED = 256
# A space next to another white space character, or at an end, is no place to cut.
RISKY = r"(?:\A|[\t-\r\x{85}\pZ]) | (?:[\t-\r\x{85}\pZ]|\z)"
# Pieces of letters, digits and signs that no normalization changes but to lower case.
# They may hold single line breaks.
LETTERS = r"[!-~\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+"
PLAIN = rf"\A{LETTERS}(?:\n{LETTERS})*\z"
# How the tokenizer without spaces splits a piece, and its signs for a
# space at the beginning and for the end of a word.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|\pL+|\pN|[^\s\pL\pN]+"
SPACE, WORD_END = "\u0120", "</w>"
CUT = re.compile(r"(?<=\S)(?= \S)")


def tokenizer(path: str):
    """The tokenizer, its special tokens, and which ids begin with a space or end a word."""
    cache = process_cache()
    if ("tokenizer", path) not in cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        special = sorted((i, token.content) for i, token in loaded.get_added_tokens_decoder().items() if token.special)
        words = loaded.get_vocab()
        begins, ends = (np.zeros(max(words.values()) + 1, bool) for _ in range(2))
        begins[[i for word, i in words.items() if word.startswith(SPACE)]] = True
        ends[[i for word, i in words.items() if word.endswith(WORD_END)]] = True
        cache["tokenizer", path] = loaded, special, begins, ends
    return cache["tokenizer", path]


def encode_apart(pieces: list[str], path: str) -> list[np.ndarray]:
    """Ids of each piece, whatever it holds.

    A special token splits a text before anything else looks at it, so pieces joined
    by one are encoded as if each were alone.
    """
    loaded, special, _, _ = tokenizer(path)
    mark, sign = special[0]
    out: list[np.ndarray] = []
    for a in range(0, len(pieces), JOINED):
        group = pieces[a : a + JOINED]
        text = sign.join(group)
        if text.count(sign) == len(group) - 1 and not any(other in text for _, other in special[1:]):
            ids = np.array(loaded.encode(text, add_special_tokens=False).ids, np.uint32)
            cuts = np.flatnonzero(ids == mark)
            out += [part[1:] if i else part for i, part in enumerate(np.split(ids, cuts))]
        else:
            codes = loaded.encode_batch_fast(group, add_special_tokens=False)
            out += [np.array(code.ids, np.uint32) for code in codes]
    return out


def encode_pieces(pieces: pa.Array, path: str, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct pieces one after another, and how many each has.

    Plain pieces are joined to longer texts by single spaces.  Where they end is told
    by the ids that begin with a space, or by counting the ids that end a word.
    """
    loaded, special, begins, ends = tokenizer(path)
    plain = pc.match_substring_regex(pieces, PLAIN)
    for _, sign in special:
        plain = pc.and_(plain, pc.invert(pc.match_substring(pieces, sign)))
    easy = plain.to_numpy(zero_copy_only=False)
    sizes, parts = np.zeros(len(pieces), np.int64), []
    texts, where = pieces.filter(plain), np.flatnonzero(easy)
    marks = np.ones(len(texts), np.int64)
    if not spaced:
        marks = pc.count_substring_regex(pc.utf8_lower(texts), PARTS).to_numpy(zero_copy_only=False).astype(np.int64)
    names, groups = texts.to_pylist(), []
    for a in range(0, len(names), JOINED):
        groups.append((" " if spaced else "") + " ".join(names[a : a + JOINED]))
    odd: list[int] = np.flatnonzero(~easy).tolist()
    # A code also holds the texts and places of its tokens: few are kept at a time.
    codes = (c for a in range(0, len(groups), 16) for c in loaded.encode_batch_fast(groups[a : a + 16], add_special_tokens=False))
    for k, code in enumerate(codes):
        own = slice(k * JOINED, (k + 1) * JOINED)
        ids = np.array(code.ids, np.uint32)
        flags = np.flatnonzero((begins if spaced else ends)[ids])
        if len(flags) != marks[own].sum():
            odd += where[own].tolist()
            continue
        stops = np.append(flags[1:], len(ids)) if spaced else flags[np.cumsum(marks[own]) - 1] + 1
        sizes[where[own]] = np.diff(stops, prepend=0)
        parts.append((where[own], ids))
    odd.sort()
    left = pieces.take(pa.array(odd, pa.int64())).to_pylist()
    found = encode_apart([" " + p for p in left] if spaced else left, path)
    for i, ids in zip(odd, found):
        sizes[i] = len(ids)
        parts.append((np.array([i]), ids))
    flat = np.empty(int(sizes.sum()), np.uint32)
    sources = np.cumsum(sizes) - sizes
    for rows, ids in parts:
        many = sizes[rows]
        flat[np.arange(len(ids)) + np.repeat(sources[rows] - (np.cumsum(many) - many), many)] = ids
    return flat, sizes


def remembered(
    pieces: pa.Array, path: str, spaced: bool, most: int = REMEMBERED_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids that hold those of the pieces, and where each piece begins and how many it has.

    What is remembered beyond ``most`` bytes is cut to what several groups held, and
    forgotten if that takes more still.
    """
    slot = ("pieces", path, spaced)
    none = np.empty(0, np.int64)
    known, flat, sizes, seen = process_cache().get(slot, (pieces.slice(0, 0), np.empty(0, np.uint32), none, none))
    at = pc.index_in(pieces, value_set=known)
    fresh = pc.is_null(at)
    new = pieces.filter(fresh)
    where = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(new):
        more, many = encode_pieces(new, path, spaced)
        where[fresh.to_numpy(zero_copy_only=False)] = len(known) + np.arange(len(new))
        known, flat, sizes = pa.concat_arrays([known, new]), np.append(flat, more), np.append(sizes, many)
        seen = np.append(seen, np.zeros(len(new), np.int64))
    seen[where] += 1
    begins = np.cumsum(sizes) - sizes
    kept = known, flat, sizes, seen
    if sum(part.nbytes for part in kept) > most:
        often = seen > 1
        kept = known.filter(pa.array(often)), flat[np.repeat(often, sizes)], sizes[often], seen[often] - 1
    if sum(part.nbytes for part in kept) <= most:
        process_cache()[slot] = kept
    else:
        process_cache().pop(slot, None)
    return flat, begins[where], sizes[where]


def encode_texts(
    texts: pa.Array, path: str, end: int, spaced: bool, remember: int = REMEMBERED_BYTES
) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts one after another, ``end`` after each, and their bounds.

    ``spaced``: the space before a word belongs to its piece (byte-level BPE);
    otherwise the tokenizer drops white space.  Null texts are empty.
    """
    n = len(texts)
    texts = texts.fill_null("") if texts.null_count else texts
    risky = np.zeros(n, bool)
    if spaced:
        risky = pc.match_substring_regex(texts, RISKY).to_numpy(zero_copy_only=False)
    plain = texts if not risky.any() else pc.if_else(pa.array(risky), "", texts)
    lists = pc.split_pattern(plain, " ")
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    flat, sources, sizes = remembered(coded.dictionary, path, spaced, remember)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.cumsum(counts) - counts
    forms: list[str] = []
    if spaced:
        # the first piece of a text has no space before it
        first = coded.take(pa.array(begins)).dictionary_decode().dictionary_encode()
        codes[begins] = first.indices.to_numpy(zero_copy_only=False) + len(sizes)
        forms = first.dictionary.to_pylist()
    own = {int(i): CUT.split(texts[int(i)].as_py()) for i in np.flatnonzero(risky)}
    known: dict[str, int] = {}
    for pieces in own.values():
        for piece in pieces:
            known.setdefault(piece, len(sizes) + len(forms) + len(known))
    apart = encode_apart([*forms, *known], path)
    many = np.array([len(ids) for ids in apart], np.int64)
    more = np.concatenate([np.empty(0, np.uint32), *apart])
    # the end mark is one more piece
    sources = np.concatenate([sources, len(flat) + np.cumsum(many) - many, [len(flat) + len(more)]])
    flat, sizes = np.concatenate([flat, more, np.array([end], np.uint32)]), np.concatenate([sizes, many, [1]])
    many = counts.copy()
    for i, pieces in own.items():
        many[i] = len(pieces)
    stops = np.cumsum(many + 1)
    every = np.full(int(stops[-1]) if n else 0, len(sizes) - 1, np.int64)
    kept = np.repeat(~risky, counts)
    every[(np.arange(len(codes)) + np.repeat(stops - many - 1 - begins, counts))[kept]] = codes[kept]
    for i, pieces in own.items():
        every[stops[i] - 1 - len(pieces) : stops[i] - 1] = [known[p] for p in pieces]
    lengths = sizes[every]
    ends = np.cumsum(lengths)
    # one step on within a piece, a jump between pieces
    at = np.ones(int(ends[-1]) if n else 0, np.int32)
    some = lengths > 0
    begin, source = (ends - lengths)[some], sources[every][some]
    at[begin] = source - np.append(0, (source + lengths[some] - 1)[:-1])
    np.cumsum(at, out=at)
    return flat[at], np.concatenate([[0], ends[stops - 1]]) if n else np.zeros(1, np.int64)


def text_groups(texts: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Cut a string column into runs of about ``most`` bytes: first row and texts.

    What a group took is given back before the next one begins.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, first = np.cumsum(sizes), 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield first, texts.slice(first, last - first)
        free_memory()
        first = last
