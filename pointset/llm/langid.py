"""Language identification by a convolutional network over bytes.

Filters of several widths run over byte classes, their maxima over a window of
fixed length go through a rectifier into a softmax.  The network is trained in
numpy on windows of labelled texts.  For prediction the filters become lookup
tables (a pair of classes at a time), and all windows of a whole text are scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import by_text, text_blocks

WINDOW = 256
FILTERS = 16
WIDTHS = (2, 3, 4)
# Bounds of the training sample: documents of a language, windows of a document, the
# languages that are learnt (the most frequent), and windows of all of them together.
DOCS_PER_LANGUAGE = 1_500
WINDOWS_PER_DOC = 3
MOST_LANGUAGES = 500
MOST_WINDOWS = 60_000
STEPS = 1_200
BATCH = 64
UNKNOWN = "und"
# Byte classes: 0 is padding.
CLASSES = 128


def byte_classes() -> np.ndarray:
    """Letters fold case; digits, white space and other ASCII are one class each."""
    table = np.full(256, 4, np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = 1
    table[48:58] = 2
    table[33:48] = 3
    table[58:65] = 3
    table[91:97] = 3
    table[123:127] = 3
    for i in range(26):
        table[65 + i] = table[97 + i] = 5 + i
    table[0x80:0xC0] = np.arange(32, 96)
    table[0xC0:0xE0] = np.arange(96, 128)
    return table


def windows_of(data: np.ndarray, offsets: np.ndarray, window: int, pad: int):
    """Classes of all windows, their lengths, and how many each text has."""
    sizes = np.diff(offsets)
    counts = -(-sizes // window)
    begins = np.cumsum(counts) - counts
    total = int(counts.sum())
    flat = np.zeros(total * window, np.uint8)
    shift = begins * window - offsets[:-1]
    flat[np.arange(len(data)) + np.repeat(shift, sizes)] = byte_classes()[data]
    out = np.zeros((total, window + pad), np.uint8)
    out[:, :window] = flat.reshape(total, window)
    lengths = np.full(total, window, np.int64)
    some = counts > 0
    lengths[begins[some] + counts[some] - 1] = sizes[some] - (counts[some] - 1) * window
    return out, lengths, counts


class Network:
    """Filters ``tables[width][position]`` of shape (classes, filters), and a softmax."""

    def __init__(self, languages: list[str], seed: int = 3):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.tables = [
            rng.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS
        ]
        self.dense = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, self.dense, self.bias]

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 5) -> None:
        """Adam on the cross entropy; texts of all lengths, languages equally weighted."""
        rng = np.random.default_rng(seed)
        weight = len(y) / (len(self.languages) * np.maximum(np.bincount(y, minlength=len(self.languages)), 1))
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        width = x.shape[1]
        for step in range(1, steps + 1):
            at = rng.integers(0, len(x), BATCH)
            batch = x[at].copy()
            # shorter texts: cut some windows at a random length
            cut = rng.integers(4, 2 * WINDOW, BATCH)
            batch[np.arange(width)[None, :] >= cut[:, None]] = 0
            pooled, where = [], []
            for table in self.tables:
                span = width - len(table) + 1
                r = table[0][batch[:, :span]]
                for j in range(1, len(table)):
                    r = r + table[j][batch[:, j : j + span]]
                k = r.argmax(axis=1)
                where.append(k)
                pooled.append(np.take_along_axis(r, k[:, None, :], 1)[:, 0])
            raw = np.concatenate(pooled, axis=1)
            hidden = np.maximum(raw, 0)
            logits = hidden @ self.dense + self.bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(BATCH), y[at]] -= 1
            p *= (weight[y[at]] / BATCH)[:, None].astype(np.float32)
            back = (p @ self.dense.T) * (raw > 0)
            grads = []
            for i, table in enumerate(self.tables):
                g = np.zeros_like(table)
                own = back[:, i * FILTERS : (i + 1) * FILTERS]
                cols = np.broadcast_to(np.arange(FILTERS), own.shape)
                for j in range(len(table)):
                    seen = np.take_along_axis(batch, where[i] + j, axis=1)
                    np.add.at(g[j], (seen, cols), own)
                grads.append(g)
            grads += [hidden.T @ p + 1e-4 * self.dense, p.sum(axis=0)]
            rate = 0.02 * min(1.0, 2.0 * (1 - step / (steps + 1)))
            for value, grad, m, v in zip(self.parameters(), grads, first, second):
                m *= 0.9
                m += 0.1 * grad
                v *= 0.99
                v += 0.01 * grad * grad
                value -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def lookups(self) -> list[list[np.ndarray]]:
        """Per width, tables over pairs of classes (the last over one class if odd)."""
        out = []
        for table in self.tables:
            own = []
            for j in range(0, len(table) - 1, 2):
                own.append((table[j][:, None, :] + table[j + 1][None, :, :]).reshape(CLASSES * CLASSES, FILTERS))
            if len(table) % 2:
                own.append(table[-1])
            out.append(own)
        return out

    def log_probabilities(self, x: np.ndarray, lookups, rows: int = 64) -> np.ndarray:
        out = np.empty((len(x), len(self.languages)), np.float32)
        for a in range(0, len(x), rows):
            batch = x[a : a + rows].astype(np.int32)
            pairs = batch[:, :-1] * CLASSES + batch[:, 1:]
            pooled = []
            for table, own in zip(self.tables, lookups):
                span = batch.shape[1] - len(table) + 1
                r = np.take(own[0], pairs[:, :span], axis=0)
                if len(table) == 3:
                    r += np.take(own[1], batch[:, 2 : 2 + span], axis=0)
                elif len(table) == 4:
                    r += np.take(own[1], pairs[:, 2 : 2 + span], axis=0)
                pooled.append(r.max(axis=1))
            logits = np.maximum(np.concatenate(pooled, axis=1), 0) @ self.dense + self.bias
            top = logits.max(axis=1, keepdims=True)
            out[a : a + rows] = logits - top - np.log(np.exp(logits - top).sum(axis=1, keepdims=True))
        return out


def held_out():
    """Documents that are never learnt from; one without an id is none of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_windows(window: int, per_doc: int):
    def run(batches):
        for batch in batches:
            rows = []
            for text, lang, h in zip(*(batch.column(n).to_pylist() for n in ("text", "lang", "_h"))):
                raw = text.encode()
                rng = np.random.default_rng(h & 0xFFFFFFFF)
                for k in range(min(per_doc, -(-len(raw) // window))):
                    a = int(rng.integers(0, max(1, len(raw) - window)))
                    rows.append((lang, h, k, raw[a : a + window]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.binary()),
                ],
                ["lang", "h", "k", "raw"],
            )

    return run


def train_network(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, steps: int = STEPS) -> Network | None:
    """Fit on a bounded sample of labelled texts; ``None`` without any.

    About ``per_language`` documents of each of the ``MOST_LANGUAGES`` most frequent
    languages, chosen by a keyed hash; fewer if ``MOST_WINDOWS`` do not hold so many.
    """
    usable = docs.where(F.col("lang").isNotNull() & ~held_out())
    found = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    if not found:
        return None
    per_language = max(1, min(per_language, MOST_WINDOWS // (WINDOWS_PER_DOC * len(found))))
    h = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    odds = F.lit(0.0)
    for row in found:
        odds = F.when(F.col("lang") == row.lang, min(1.0, per_language / row["count"])).otherwise(odds)
    chosen = usable.where(F.length("text") > 0).select("text", "lang", h.alias("_h")).where(
        F.pmod(F.shiftright("_h", 8), F.lit(1 << 40)) / float(1 << 40) < odds
    )
    windows = chosen.mapInArrow(sample_windows(WINDOW, WINDOWS_PER_DOC), "lang string, h long, k long, raw binary")
    rows = windows.orderBy("h", "k", "lang", "raw").limit(MOST_WINDOWS).toArrow()
    if not rows.num_rows:
        return None
    languages = sorted(set(rows.column("lang").to_pylist()))
    y = np.array([languages.index(v) for v in rows.column("lang").to_pylist()])
    raw = rows.column("raw").to_pylist()
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    x, _, _ = windows_of(np.frombuffer(b"".join(raw), np.uint8), offsets, WINDOW, max(WIDTHS) - 1)
    network = Network(languages)
    network.train(x, y, steps)
    return network


def predict(network: Network):
    def run(batches):
        lookups = network.lookups()
        letter = np.zeros(256, bool)
        letter[65:91] = letter[97:123] = True
        for batch in batches:
            for block in text_blocks(batch.column("_read")):
                x, lengths, counts = windows_of(block.data, block.offsets, WINDOW, max(WIDTHS) - 1)
                logs = network.log_probabilities(x, lookups)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                letters = by_text(letter[block.data], block.offsets)
                names, scores = [], []
                for i in range(block.size):
                    a, b = bounds[i], bounds[i + 1]
                    lettered = letters[i] > 0 or any(
                        map(str.isalpha, block.data[block.offsets[i] : block.offsets[i + 1]].tobytes().decode("utf-8", "replace"))
                    )
                    if a == b or not lettered:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    w = lengths[a:b] / lengths[a:b].sum()
                    best = int((w @ logs[a:b]).argmax())
                    names.append(network.languages[best])
                    scores.append(float(min(1.0, w @ np.exp(logs[a:b, best]))))
                columns = [c.slice(block.first, block.size) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    [*batch.schema.names[:-1], "lang_pred", "score"],
                )

    return run


def identify(docs: DataFrame, network: Network | None, *keep: str) -> DataFrame:
    """``doc_id``, the columns named in ``keep``, ``lang_pred`` and ``score``.

    Null texts, and texts without a letter, are ``und`` with score 0, as is every text
    without a trained network.  Only ``text`` enters a prediction.  Repeated rows get
    equal predictions, very long texts that of all their windows; an empty table gives
    no rows; columns not named are not read.
    """
    rows = docs.select("doc_id", *keep, F.col("text").alias("_read"))
    if network is None:
        return rows.drop("_read").withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(predict(network), f"{shape}, lang_pred string, score double")
