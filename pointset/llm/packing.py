"""Packing token sequences by bounded-space online best-fit.

Every partition keeps a fixed number of open windows.  A text longer than a window
fills whole windows first; its rest goes to the open window it fits most tightly.
When none has room the fullest is emitted, topped up by the head of that rest (texts
may be cut), and a new window opens with its tail.  Windows still open at the end of
a partition are merged with those of other partitions, group by group.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize
from .tokens import encode_texts, text_groups

WINDOW = 1024
OPEN_WINDOWS = 64
# Partitions whose leftover windows are merged in one task.
MERGED_PARTS = 16

FIELDS = [
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("ids", pa.list_(pa.int32())),
]


class OpenWindows:
    """Open windows ordered by the room they have left."""

    def __init__(self, window: int, most: int):
        self.window, self.most = window, most
        self.room: list[tuple[int, int]] = []
        self.held: dict[int, list] = {}
        self.next = 0

    def place(self, piece: tuple, size: int):
        """Place a piece of less than a window; yields windows that are full."""
        at = bisect_left(self.room, (size, -1))
        if at == len(self.room):
            if len(self.room) >= self.most:
                # none fits: the fullest leaves, topped up by the head of the piece
                room, key = self.room.pop(0)
                doc, start, ids, total = piece
                pieces = self.held.pop(key)
                if room:
                    pieces.append((doc, start, ids[:room], total))
                    piece, size = (doc, start + room, ids[room:], total), size - room
                yield pieces
                yield from self.place(piece, size)
                return
            self.held[self.next] = [piece]
            insort(self.room, (self.window - size, self.next))
            self.next += 1
            return
        room, key = self.room.pop(at)
        self.held[key].append(piece)
        if room == size:
            yield self.held.pop(key)
        else:
            insort(self.room, (room - size, key))


def _batch(rows: list, id_type, keep_ids: bool):
    """Rows are ``(doc, start, ids, total, sequence, offset, leftover)``."""
    columns = [
        pa.array([r[0] for r in rows], id_type),
        pa.array([r[1] for r in rows], pa.int64()),
        pa.array([len(r[2]) for r in rows], pa.int64()),
        pa.array([zlib.crc32(r[2].astype("<u4", copy=False).tobytes()) for r in rows], pa.int64()),
        pa.array([r[3] for r in rows], pa.int64()),
        pa.array([r[4] for r in rows], pa.int64()),
        pa.array([r[5] for r in rows], pa.int64()),
        pa.array([r[2].view(np.int32) if keep_ids or r[6] else None for r in rows], pa.list_(pa.int32())),
        pa.array([r[6] for r in rows], pa.bool_()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", *[n for n, _ in FIELDS], "leftover"])


def _window_rows(pieces: list, sequence: int, leftover: bool = False):
    offset = 0
    for doc, start, ids, total in pieces:
        yield (doc, start, ids, total, sequence, offset, leftover)
        offset += len(ids)


def pack_online(path: str, end: int, window: int, most: int, id_type, keep_ids: bool):
    def run(batches):
        open_windows, count, part, out = OpenWindows(window, most), 0, None, []

        def emit(pieces):
            nonlocal count
            out.extend(_window_rows(pieces, (part << 32) + count))
            count += 1

        for batch in batches:
            part = batch.column("_part")[0].as_py() if part is None and batch.num_rows else part
            keys = batch.column("doc_id").to_pylist()
            for first, texts in text_groups(batch.column("text")):
                ids, bounds = encode_texts(texts, path, end, spaced=True)
                for i in range(len(texts)):
                    own = ids[bounds[i] : bounds[i + 1]]
                    doc, total = keys[first + i], len(own)
                    whole = total - total % window
                    for start in range(0, whole, window):
                        emit([(doc, start, own[start : start + window], total)])
                    if whole < total:
                        for pieces in open_windows.place((doc, whole, own[whole:].copy(), total), total - whole):
                            emit(pieces)
                if len(out) > 5_000:
                    yield _batch(out, id_type, keep_ids)
                    out = []
        for pieces in open_windows.held.values():
            out.extend(_window_rows(pieces, (part << 32) + count, True))
            count += 1
        if out:
            yield _batch(out, id_type, keep_ids)

    return run


def merge_leftovers(window: int, id_type, keep_ids: bool):
    """Pour the leftover windows of a group of partitions into full ones."""

    def run(key, table):
        group = key[0].as_py()
        # the order does not depend on how rows arrived
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        rows, pieces, size, count = [], [], 0, 0
        base = (1 << 62) + (group << 32)
        docs, starts = table.column("doc_id").to_pylist(), table.column("start").to_pylist()
        totals = table.column("doc_tokens").to_pylist()
        for i, ids in enumerate(table.column("ids")):
            own, start = ids.values.to_numpy(zero_copy_only=False).view(np.uint32), starts[i]
            while len(own):
                head = own[: window - size]
                pieces.append((docs[i], start, head, totals[i]))
                size, start, own = size + len(head), start + len(head), own[len(head) :]
                if size == window:
                    rows.extend(_window_rows(pieces, base + count))
                    pieces, size, count = [], 0, count + 1
        rows.extend(_window_rows(pieces, base + count))
        return pa.Table.from_batches([_batch(rows, id_type, keep_ids)])

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end: int = 0,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    With ``keep_ids`` also the ids, to be padded to ``window`` per sequence.  A
    document is its token ids (byte-level BPE) and ``end``; null and empty texts are
    the end id alone.  Rows that repeat are packed each on its own; an empty table
    gives no rows; other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    empty = docs.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    shape = (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, ids array<int>, leftover boolean"
    )
    first = materialize(
        docs.select("doc_id", "text", F.spark_partition_id().alias("_part"))
        .mapInArrow(pack_online(tokenizer_path, end, window, open_windows, empty, keep_ids), shape),
        "packed",
    )
    parts = F.shiftrightunsigned("sequence_id", 32)
    rest = (
        first.where("leftover")
        .withColumn("_group", (parts / MERGED_PARTS).cast("long"))
        .groupBy("_group")
        .applyInArrow(_only(merge_leftovers(window, empty, keep_ids)), shape)
    )
    out = first.where("NOT leftover").unionAll(rest).drop("leftover")
    return out if keep_ids else out.drop("ids")


def _only(merge):
    def run(key, table):
        return merge(key, table.drop_columns(["_group"]))

    return run
