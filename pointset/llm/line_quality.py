"""Line-first cleaning: judge every line, drop those that fail, then judge the document.

A line fails if it reads as navigation, as boilerplate, as decoration (symbols,
shouting, stuttering) or if it is a longer line without the end of any sentence.  A document
is rejected if its lost lines held too many of its words.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import by_text, covered, find_words, grams, mix, same_text_windows, text_blocks, word_hashes

# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
# Phrases of page furniture, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "use of cookies",
    "enable javascript",
    "click here",
    "sign in",
    "log in",
    "subscribe to",
    "read more",
    "lorem ipsum",
)
CLOSING = re.compile("[.!?:;,…\"'”’)\\]]$")
INNER = re.compile(r"\w[.!?]\s")
SYMBOL = re.compile("[#*$%&|<>]")
NAVIGATION = re.compile(r"(?:^|\s)[|>/·•](?:\s|$)")
BOILER = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, BOILERPLATE))})(?!\w)")


def line_fails(line: str, words: int) -> bool:
    """``words``: number of words of the line, at least 1."""
    symbols = len(SYMBOL.findall(line))
    if symbols * 10 > words * 3 and symbols > 1:
        return True
    if "|" in line or ">" in line or "/" in line or "·" in line or "•" in line:
        if len(NAVIGATION.findall(line)) * 5 > words:
            return True
    if line.count("!") * 3 > words and words >= 3:
        return True
    if words >= 5:
        split = line.split()
        if sum(map(str.__eq__, split, split[1:])) * 3 > words:
            return True
        upper = sum(map(str.isupper, line))
        if upper * 2 > sum(map(str.isalpha, line)):
            return True
        if words >= 10 and not CLOSING.search(line.rstrip()) and not INNER.search(line):
            return True
    # a phrase within prose is no furniture: its words have to be over a fifth of the line's
    return sum(len(phrase.split()) for phrase in BOILER.findall(line.lower())) * 5 > words


def clean_text(text: str) -> tuple[list[str], int, int]:
    """Lines that stay, words lost, and lines with a word equal to an earlier line."""
    kept, lost, repeated, seen = [], 0, 0, set()
    for line in text.split("\n"):
        words = len(line.encode().split())
        if words:
            if line in seen:
                repeated += 1
            else:
                seen.add(line)
            if line_fails(line, words):
                lost += words
                continue
        kept.append(line)
    return kept, lost, repeated


def repeated_words(block, words, width: int) -> np.ndarray:
    """Words of each text that lie in a window of ``width`` found twice or more in it."""
    h = grams(word_hashes(block.data, words), width)
    inside = same_text_windows(words, width)
    if not inside.any():
        return np.zeros(block.size, np.int64)
    at = np.flatnonzero(inside)
    salt = mix(np.arange(1, block.size + 1, dtype=np.uint64))
    own = h[at] ^ salt[words.owner()[at]]
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    live = np.zeros(len(inside), bool)
    live[at[twice]] = True
    return by_text(covered(live, width, int(words.bounds[-1])), words.bounds)


def measure(width: int, max_loss: float, with_text: bool):
    symbol = np.zeros(256, bool)
    symbol[np.frombuffer(SYMBOLS.encode(), np.uint8)] = True

    def run(batches):
        for batch in batches:
            for block in text_blocks(batch.column("text")):
                words = find_words(block)
                n = words.counts()
                spans = np.diff(np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])[
                    np.stack([words.starts, words.ends])], axis=0)[0] if len(words.starts) else np.zeros(0, np.int64)
                repeated = repeated_words(block, words, width)
                lost, dup, texts = np.zeros(block.size, np.int64), np.zeros(block.size, np.int64), []
                for i in range(block.size):
                    text = block.data[block.offsets[i] : block.offsets[i + 1]].tobytes().decode("utf-8", "replace")
                    kept, lost[i], dup[i] = clean_text(text)
                    texts.append("\n".join(kept) if with_text else None)
                failed = (n < 20) | (100 * repeated > 30 * n)
                columns = [
                    batch.column("doc_id").slice(block.first, block.size),
                    pa.array(n.astype(np.int64)),
                    pa.array(by_text(spans, words.bounds)),
                    pa.array(by_text(symbol[block.data], block.offsets)),
                    pa.array(dup),
                    pa.array(repeated),
                    pa.array(failed),
                    pa.array(lost),
                    pa.array(~failed & (lost <= max_loss * n)),
                    pa.array(texts, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, NAMES)

    return run


NAMES = [
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "base_failed", "n_lost", "kept", "text",
]


def clean_lines(docs: DataFrame, width: int = 8, max_loss: float = 0.5, with_text: bool = True) -> DataFrame:
    """Metrics, verdict and the cleaned text of every document.

    ``n_lost`` counts the words of removed lines and ``kept`` is false if the base
    rules fail or more than ``max_loss`` of the words are lost.  ``text`` holds the
    remaining lines (null without ``with_text``).  Null and empty texts have no words
    and are not kept.  Repeated rows are judged alike; an empty table gives no rows;
    other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = (
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, n_lost long, kept boolean, text string"
    )
    return docs.select("doc_id", "text").mapInArrow(measure(width, max_loss, with_text), shape)
