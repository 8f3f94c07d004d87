"""Substring dedup by level-wise doubling.

A window of 35 words that occurs twice also has every shorter run in it twice.
The search therefore begins with short runs and doubles their length: a window
lives on to the next level only if its run at this level occurs at least twice.

A level does not count every run.  Each window is stood for by the smallest run
hash inside it; equal windows pick equal runs, so a window whose run occurs once
is certainly unique.  At nine words a text leaves two rows for 28 words.  The last
level has runs as long as the windows, with 128-bit hashes, and decides exactly.

Runs are counted by an aggregate on their hash (hot runs are merged before the
shuffle).  Since a run that occurs once knows its one owner, the aggregate returns
the dead runs per document directly; no run is ever joined with its partners.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free_shuffles, materialize, text_key
from .words import (
    Block,
    covered,
    find_words,
    grams,
    mix,
    same_text_windows,
    sliding,
    text_blocks,
    word_hashes,
)

LEAST_RUN = 8


def run_lengths(window: int) -> list[int]:
    """Run lengths of the levels, each at most twice the one before: 9, 18, 35."""
    lengths = [window]
    while lengths[0] - lengths[0] // 2 >= LEAST_RUN:
        lengths.insert(0, lengths[0] - lengths[0] // 2)
    return lengths


def live_windows(words, runs, first: int, window: int) -> np.ndarray:
    """Windows of a block still alive; ``runs`` holds begin and end per text, null: all."""
    live = same_text_windows(words, window)
    if runs is None:
        return live
    marks = np.zeros(len(live) + 1, np.int32)
    for i in range(len(words.bounds) - 1):
        pairs = runs[first + i].values
        if pairs is not None and len(pairs):
            flat = pairs.to_numpy(zero_copy_only=False) + words.bounds[i]
            np.add.at(marks, flat[0::2], 1)
            np.add.at(marks, flat[1::2], -1)
    return live & (np.cumsum(marks[:-1]) > 0)


def level_runs(block: Block, words, live: np.ndarray, run: int, window: int, seed: int = 0):
    """Hashes of all runs, and the smallest one in every window."""
    h = grams(word_hashes(block.data, words, seed), run)
    return h, sliding(np.minimum, h, window - run + 1)


def emit_level(run: int, window: int, last: bool):
    def emit(batches):
        for batch in batches:
            runs = batch.column("_runs") if "_runs" in batch.schema.names else None
            for block in text_blocks(batch.column("text")):
                words = find_words(block)
                live = live_windows(words, runs, block.first, window)
                if not live.any():
                    continue
                h, least = level_runs(block, words, live, run, window)
                seen = np.zeros(len(h) + window - run, np.uint64)
                seen[window - run : window - run + len(least)] = np.where(live, least, np.uint64(0))
                picked = np.flatnonzero(sliding(np.maximum, seen, window - run + 1)[: len(h)] == h)
                owner = np.searchsorted(words.bounds, picked, side="right") - 1
                at, chosen = pa.array(block.first + owner), h[picked]
                columns = [
                    batch.column("doc_id").take(at),
                    batch.column("_th").take(at),
                    pa.array(chosen.view(np.int64)),
                ]
                if last:
                    second = grams(word_hashes(block.data, words, 1), run)[picked]
                    columns.append(pa.array(second.view(np.int64)))
                names = ["doc_id", "_th", "_h", "_h2"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return emit


def kept_texts(block: Block, words, gone: np.ndarray | None, wants: np.ndarray, digest: bool) -> list:
    out = []
    for i in range(block.size):
        if not wants[i]:
            out.append(None)
            continue
        a, b = words.bounds[i], words.bounds[i + 1]
        text = block.data[block.offsets[i] : block.offsets[i + 1]].tobytes().split()
        if gone is not None and gone[a:b].any():
            text = [text[j] for j in np.flatnonzero(~gone[a:b])]
        kept = b" ".join(text)
        out.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
    return out


def judge_level(run: int, window: int, last: bool, digest: bool):
    """Drop dead windows; documents without live ones are finished."""

    def judge(batches):
        for batch in batches:
            runs = batch.column("_runs") if "_runs" in batch.schema.names else None
            for block in text_blocks(batch.column("text")):
                words = find_words(block)
                live = live_windows(words, runs, block.first, window)
                dead = batch.column("_dead").slice(block.first, block.size)
                if live.any():
                    _, least = level_runs(block, words, live, run, window)
                    sizes = pc.list_value_length(dead).fill_null(0).to_numpy(zero_copy_only=False)
                    flat = dead.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                    salt = mix(np.arange(1, block.size + 1, dtype=np.uint64))
                    at = words.owner()[: len(least)]
                    live &= ~np.isin(least ^ salt[at], flat ^ np.repeat(salt, sizes))
                counts = words.counts()
                many = np.array(
                    [np.count_nonzero(live[a : max(a, b)]) for a, b in zip(words.bounds[:-1], words.bounds[1:])], np.int64
                )
                done = np.ones(block.size, bool) if last else many == 0
                gone = covered(live, window, int(words.bounds[-1])) if last and live.any() else None
                removed = np.zeros(block.size, np.int64)
                if gone is not None:
                    sums = np.concatenate([[0], np.cumsum(gone)])
                    removed = sums[words.bounds[1:]] - sums[words.bounds[:-1]]
                text = batch.column("text").slice(block.first, block.size)
                left, pairs = [], []
                for i in range(block.size):
                    if done[i]:
                        left.append(None)
                        pairs.append(None)
                        continue
                    own = live[words.bounds[i] : words.bounds[i + 1]]
                    edge = np.diff(np.concatenate([[0], own.view(np.int8), [0]]))
                    flat = np.empty(2 * np.count_nonzero(edge == 1), np.int32)
                    flat[0::2], flat[1::2] = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                    left.append(text[i].as_py())
                    pairs.append(flat)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, block.size),
                        batch.column("_th").slice(block.first, block.size),
                        pa.array(left, pa.string()),
                        pa.array(pairs, pa.list_(pa.int32())),
                        pa.array(counts.astype(np.int64)),
                        pa.array(removed),
                        pa.array(kept_texts(block, words, gone, done, digest), pa.string()),
                    ],
                    ["doc_id", "_th", "text", "_runs", "n_words", "n_removed", "kept"],
                )

    return judge


def remove_repeats(docs: DataFrame, window: int = 35, digest: bool = False) -> DataFrame:
    """Texts without the words that lie in a window repeated anywhere else.

    Returns one row per input row: ``doc_id, n_words, n_removed, kept``, where
    ``kept`` is the remaining words joined by one space, or with ``digest`` its
    SHA-256 in lower-case hex.

    Null and empty texts have no words and an empty ``kept``.  Rows with equal
    texts count as repeats of each other, also rows that repeat as a whole or
    share an id.  An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    live = docs.select("doc_id", text_key().alias("_th"), F.col("text"))
    finished: list[DataFrame] = []
    for run in run_lengths(window):
        last = run == window
        keys = ["_h", "_h2"] if last else ["_h"]
        shape = f"doc_id {kind}, _th long, " + ", ".join(f"{k} long" for k in keys)
        rows = live.mapInArrow(emit_level(run, window, last), shape)
        counts = rows.groupBy(*keys).agg(
            F.count("*").alias("n"), F.min("doc_id").alias("_id"), F.min("_th").alias("_dth")
        )
        dead = counts.where("n = 1").groupBy("_id", "_dth").agg(F.collect_list("_h").alias("_dead"))
        same = live["doc_id"].eqNullSafe(dead["_id"]) & (live["_th"] == dead["_dth"])
        judged = live.join(dead, same, "left").drop("_id", "_dth")
        level = materialize(
            judged.mapInArrow(
                judge_level(run, window, last, digest),
                f"doc_id {kind}, _th long, text string, _runs array<int>, n_words long, n_removed long, kept string",
            ),
            f"windows{run}",
        )
        finished.append(level.where("text IS NULL").select("doc_id", "n_words", "n_removed", "kept"))
        live = level.where("text IS NOT NULL").select("doc_id", "_th", "text", "_runs")
        free_shuffles(spark)
        if not last and live.isEmpty():
            break
    out = finished[0]
    for more in finished[1:]:
        out = out.unionAll(more)
    return out
