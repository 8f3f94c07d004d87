"""The corpus operators against plain versions, on a small table and on edge cases."""

import itertools
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pointset.llm import langid, tokens
from pointset.llm.line_quality import clean_lines
from pointset.llm.minmax_dedup import near_duplicates
from pointset.llm.mixing import mix_sources
from pointset.llm.packing import pack
from pointset.llm.pii import (
    KINDS,
    MOST_OF_A_TEXT,
    Boosting,
    base_spans,
    calibrate,
    candidates,
    choose,
    find_personal_data,
    sample_rows,
    train,
)
from pointset.llm.pivot_index import near_vectors
from pointset.llm.shared import fresh_path
from pointset.llm.substring_dedup import remove_repeats, run_lengths
from pointset.llm.token_store import checksums, read_positions, read_tokens, write_tokens
from pointset.llm.tokens import encode_texts
from pointset.llm.warc import dechunk, read_warc, write_warc

from . import brute

SF_DIR = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = " ".join(f"word{i}" for i in range(40))
LONG = " ".join(f"w{i % 977} mot{i % 613}" for i in range(30_000))
EDGES = [
    (9001, None, None, None, None),
    (9002, "", "en", "", 0),
    (9003, " \t\n\x0b\x0c\r ", "en", "é", 7),
    (9004, PASSAGE, "en", "src0", 1),
    (9005, "before " + PASSAGE + " after", "en", "src0", 1),
    (9006, PASSAGE + " " + PASSAGE, "en", "src0", 1),
    (9007, "a", "en", "z", 1),
    (9008, "A", "en", "z", 1),
    (9009, "a b", "de", "z", 3),
    (9010, LONG, "en", "src0", 1),
    (9011, LONG + " end", "en", "src0", 1),
    (9012, "x" * 100_000, "en", None, 1),
    (9013, "word joined by wide  spaces \n\n and 'll it's ́mark <|endoftext|> ok", "en", "src0", 1),
    (9014, PASSAGE, "en", "src0", 1),
    (9014, PASSAGE, "en", "src0", 1),
    (9015, "12345 67890 !!! ???", "en", "src0", 1),
    (None, "no id at all", "en", "src0", 1),
    (None, "no id at all", "en", "src0", 1),
    (9016, "mail a.b+c@x-y.example.com_d@e.f or @@ a@b c@.d 1.2.3.4.5.6.7.8 999.1.1.1 ip 0001.02.3.4", "en", "s", 1),
    (9017, "card 4111 1111 1111 1111 and 4111-1111-1111-1112, +1 (555) 123-4567 +49 30 12 +1234567890123456 0", "en", "s", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").unionByName(spark.createDataFrame(EDGES, SHAPE)).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


def texts(rows):
    return [(r.doc_id, r.text) for r in rows]


def got(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def clashing(docs):
    """The same rows with more columns, named like those the operators make."""
    extra = ["_th", "_h", "_row", "_dead", "_part", "kept", "taken", "part", "node", "_bands", "label", "size", "score"]
    return docs.select("*", *[F.lit("x").alias(n) for n in extra])


def empty(docs):
    return docs.limit(0)


# WARC


def pages(spark):
    same = "<html>" + "é same text " * 30 + "</html>"
    made = [
        (1, "http://a/1", same), (2, "http://a/2\r\nX: y", same), (3, None, "short"), (4, "http://a/4", "short"),
        (5, "http://a/5", None), (6, "http://a/6", ""), (7, "http://a/7", "WARC/1.1\r\n\r\n0\r\n\r\n" * 5_000),
        (None, "http://a/n", same), (8, "http://a/8", "ü" * 120_000), (9, "http://a/9", same), (9, "http://a/9", same),
    ]
    made = [(p and 10**6 + p, u, h) for p, u, h in made]
    own = spark.createDataFrame(made, "page_id long, url string, html string")
    return spark.read.parquet(f"{SF_DIR}/pages.parquet").unionByName(own).withColumn("digest", F.lit("x"))


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_warc_round_trip(spark, compression):
    given = pages(spark)
    folder = fresh_path(spark, "warc")
    write_warc(given, folder, segment_bytes=1000, chunk_bytes=300, compression=compression)
    found = read_warc(spark, folder)
    expected = brute.warc([(r.page_id, r.url, r.html) for r in given.collect()])
    assert got(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == Counter(expected)
    assert found.where("NOT complete").count() == 0
    stored = {r.page_id: r.payload.decode() for r in found.where("record_type = 'response'").collect()}
    assert stored[10**6 + 7] == "WARC/1.1\r\n\r\n0\r\n\r\n" * 5_000 and stored[10**6 + 8] == "ü" * 120_000


def test_warc_missing_and_repeated_segments(spark):
    folder = fresh_path(spark, "warc")
    body = b"5\r\nhello\r\n6\r\n world\r\n0\r\n\r\n"
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + body

    def record(name, part, n, total, block, last):
        head = [f"WARC-Record-ID: {name}{n}", f"WARC-Segment-Number: {n}", f"Content-Length: {len(part)}"]
        head += ["WARC-Type: response"] if n == 1 else ["WARC-Type: continuation", f"WARC-Segment-Origin-ID: {name}1"]
        head += [f"WARC-Segment-Total-Length: {total}"] if last else []
        return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + part

    def parts(name, total):
        return [record(name, block[a:b], n, total, block, n == 3) for n, (a, b) in enumerate([(0, 20), (20, 50), (50, 99)], 1)]

    whole, lacking, wrong = parts("a", len(block)), parts("b", len(block)), parts("c", 7)
    records = [whole[2], whole[0], whole[1], whole[1], lacking[0], lacking[2], *wrong]
    spark.createDataFrame([(r.decode(),) for r in records], "v string").repartition(3).write.option(
        "lineSep", "\r\n\r\n"
    ).text(folder)
    found = {r.record_id: (r.payload, r.complete) for r in read_warc(spark, folder).collect()}
    assert found == {"a1": (bytearray(b"hello world"), True), "b1": (None, False), "c1": (None, False)}
    assert dechunk(b"5\r\nhel") is None and dechunk(b"zz\r\n") is None


def test_warc_malformed_headers(spark):
    folder = fresh_path(spark, "warc")

    def record(name, length, *more):
        head = [f"WARC-Record-ID: {name}", "WARC-Type: response", *more, f"Content-Length: {length}"]
        return "WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody"

    size = len("HTTP/1.1 200 OK\r\n\r\nbody")
    records = [
        record("good", size, "WARC-X-Page-Id: -3"), record("length", "many"), record("id", size, "WARC-X-Page-Id: x3"),
        record("part", size, "WARC-Segment-Number: one"), record("total", size, "WARC-Segment-Number: 1", "WARC-Segment-Total-Length: 1e9"),
        record("last", size),
    ]
    spark.createDataFrame([(r,) for r in records], "v string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(folder)
    found = {r.record_id: (r.page_id, r.complete) for r in read_warc(spark, folder).collect()}
    assert {n: found[n] for n in ("good", "length", "id", "last")} == {
        "good": (-3, True), "length": (None, False), "id": (None, False), "last": (None, True)
    }
    assert len(found) >= 5 and not any(done for n, (_, done) in found.items() if n not in ("good", "last"))


def test_warc_empty(spark):
    folder = fresh_path(spark, "warc")
    write_warc(pages(spark).limit(0), folder)
    assert read_warc(spark, folder).count() == 0


# mixing


def test_mixing(docs, rows):
    found = mix_sources(clashing(docs)).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(brute.words(r.text))
    targets = brute.targets(sizes)
    taken, copies = Counter(), Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - float(targets[r.source])) < 1e-6
        assert 0 <= r.taken <= r.size
        taken[r.source] += r.taken
        copies[r.doc_id, r.copy] += 1
    assert all(abs(taken[s] - targets[s]) < 1 for s in sizes)
    assert sum(copies.values()) == 2 * len(rows)
    # whole until the cut, nothing after it, one copy of a source cut in between
    found.sort(key=lambda r: r.finish)
    for source in sizes:
        own = [r.taken / r.size for r in found if r.source == source and r.size]
        assert own == sorted(own, reverse=True) and sum(0 < share < 1 for share in own) <= 1
    again = mix_sources(docs.repartition(5)).select("doc_id", "_th", "copy", "taken")
    assert Counter(tuple(r) for r in again.collect()) == Counter((r.doc_id, r._th, r.copy, r.taken) for r in found)


def test_the_cut_is_read_off_the_sorted_schedule(docs, monkeypatch):
    from pointset.llm import mixing

    seen = {}
    monkeypatch.setattr(mixing, "cut_time", lambda schedule, budget: seen.update(s=schedule, b=budget))
    mix_sources(docs, share=1.9)
    monkeypatch.undo()
    cut = mixing.cut_time(seen["s"], seen["b"])
    served = seen["s"].agg(F.sum(F.greatest(F.lit(0.0), F.least(F.col("size").cast("double"), cut * F.col("weight") - F.col("_start")))))
    assert abs(served.head()[0] - seen["b"]) < 1e-3
    # in any other order it is another one
    assert seen["s"].where(f"_last AND finish < {cut}").count() > 0
    other = seen["s"].withColumn("finish", 1e9 - F.col("finish")).withColumn("_part", -F.col("_part"))
    assert mixing.cut_time(other, seen["b"]) != cut


def test_mixing_all_run_dry(spark, docs, rows):
    found = mix_sources(docs, share=9.0).collect()
    assert all(r.taken == r.size for r in found)
    assert mix_sources(empty(docs)).count() == 0
    blank = spark.createDataFrame([(1, "", None, "a", 0), (2, None, None, "b", 0)], SHAPE)
    assert {r.taken for r in mix_sources(blank).collect()} == {0}


# personal data


def plain_base(text):
    return [(s, e, k) for s, k, e in brute.base_spans(text)]


def test_base_spans(rows):
    for r in rows:
        assert base_spans(r.text or "") == plain_base(r.text)


def test_base_spans_random():
    rng = np.random.default_rng(0)
    alphabet = np.array(list("ab.@-_+0123456789 ()\n"))
    for _ in range(3000):
        text = "".join(rng.choice(alphabet, int(rng.integers(0, 80))))
        assert base_spans(text) == plain_base(text), text


def test_personal_data(docs, rows):
    found = {r.doc_id: r for r in find_personal_data(clashing(docs)).where("doc_id IS NOT NULL").collect()}
    for r in rows:
        if r.doc_id is None:
            continue
        f, base = found[r.doc_id], plain_base(r.text)
        listed = [f"{KINDS[k]}:{a}:{b}" for a, b, k in base]
        assert [f["n_" + k] for k in KINDS] == [sum(x.startswith(k) for x in listed) for k in KINDS]
        assert f.base_sha256 == brute.sha(",".join(listed))
        assert set(listed) <= set(f.spans.split(","))
        assert (f.redacted is None) == (r.text is None)
        for a, b, _ in base:
            assert r.text[a:b] not in f.redacted
    assert find_personal_data(empty(docs)).count() == 0


def test_added_spans(spark):
    texts = ["please mail und.34 [at] mail7.example.com today", "phone (564) 555-4526 now", "on 2024-01-02 version 1.2.3.400"]
    more = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SHAPE)
    full = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").unionByName(more.withColumn("doc_id", F.col("doc_id") + 10**7))
    found = {r.doc_id: r.spans for r in find_personal_data(full).where("doc_id >= 10000000").collect()}
    assert found[10**7].startswith("email:") and found[10**7 + 1].startswith("phone:")
    assert found[10**7 + 2] == ""


NEIGHBOURS = [
    ("call 555-123-4567, 555-987-6543 today", 3, ["555-123-4567", "555-987-6543"]),
    ("phone 5551112222 5553334444 ok", 3, ["5551112222", "5553334444"]),
    ("phone 7 (555) 123-4567 now", 3, ["(555) 123-4567"]),
    ("card 12 4111 1111 1111 1111 paid", 2, ["4111 1111 1111 1111"]),
    ("4111.1111.1111.1111 5500.0000.0000.0004", 2, ["4111.1111.1111.1111", "5500.0000.0000.0004"]),
]


def test_neighbouring_numbers_are_proposed():
    for text, kind, wanted in NEIGHBOURS:
        assert set(wanted) <= {text[a:b] for a, b, k in candidates(text) if k == kind}
    # every run of groups, by the plain definition; nothing else
    text = "12 345 (678) 9012.345-6789, 01 5551112222 44444444444444444444 +1 23"
    digits = {2: range(12, 20), 3: range(7, 16)}
    assert {s for s in candidates(text) if s[2] > 1} == {
        (a, b, k) for a in range(len(text)) for b in range(a, len(text) + 1) for k in digits
        if brute.is_number(text, a, b) and sum(c.isdigit() for c in text[a:b]) in digits[k]
    }
    # as many for each number, however long the list
    short, long = (len(list(candidates("555-123-4567, " * n))) for n in (100, 1000))
    assert 9.5 < long / short < 10.5


SPELLED = [
    "mail john.smith7 at mail.example.com", "mail john.smith7 [At] mail.example.com", "mail john.smith7 at mail.example Dot com",
    "mail john.smith7 (aT) mail [Dot] example (DOT) com", "mail john.smith7 AT mail.example.com",
]


def test_spelled_addresses_are_proposed_alone():
    for text in SPELLED + [t.replace(".smith7", "").replace("mail.", "") for t in SPELLED]:
        assert list(candidates(text)) == [(5, len(text), 0)] == list(candidates(text + " | me@"))
    for text in ("john  at  example.com", "john@example.com", "john @ example.com", "a@b@c.com", "x at at y.com"):
        assert [text[a:b] for a, b, k in candidates(text)] == [{"a@b@c.com": "b@c.com", "x at at y.com": "at at y.com"}.get(text, text)]
    for text in ("", "at", " at ", "@", "cat example.com", "look at it.", "that.at.com", " at x.com", "a at"):
        assert list(candidates(text)) == []


def test_spelled_addresses_are_found(spark):
    full = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prose = ["we stay at home.Then we go", "it sold at 3.50 then", "we look at it. Then we go"]
    rows = [(10**7 + i, t, "en", "s", 1) for i, t in enumerate(SPELLED + prose)]
    more = full.unionByName(spark.createDataFrame(rows, SHAPE))
    found = {r.doc_id: r.spans for r in find_personal_data(more).where("doc_id >= 10000000").collect()}
    for i, text in enumerate(SPELLED):
        assert found[10**7 + i] == f"email:5:{len(text)}"
    assert [found[10**7 + len(SPELLED) + i] for i in range(len(prose))] == [""] * len(prose)


def test_chosen_spans_do_not_touch():
    found = [(0, 12, 3), (4, 12, 3), (14, 26, 3), (8, 18, 3)]
    assert choose(" " * 30, [], found, np.array([2.0, 2.0, 1.0, 0.5]), [0.0] * 4) == [(0, 12, 3), (14, 26, 3)]
    assert choose(" " * 30, [(0, 3, 0)], found, np.array([2.0, 2.0, 1.0, 0.5]), [0.0] * 4) == [(0, 3, 0), (4, 12, 3), (14, 26, 3)]


def test_neighbouring_numbers_are_found(spark):
    full = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(10**7 + i, t, "en", "s", 1) for i, (t, _, _) in enumerate(NEIGHBOURS)]
    more = full.unionByName(spark.createDataFrame(rows, SHAPE))
    found = {r.doc_id: r.spans for r in find_personal_data(more).where("doc_id >= 10000000").collect()}
    for i, (text, kind, wanted) in enumerate(NEIGHBOURS):
        spans = [f"{KINDS[kind]}:{text.index(w)}:{text.index(w) + len(w)}" for w in wanted]
        assert found[10**7 + i] == ",".join(spans)


def test_recall_on_documents_held_out(spark):
    """Of base spans in other notations, of documents the trees did not see, by kind."""
    found = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    recall = train(found).recall
    assert set(recall) == set(KINDS) and all(share >= 0.9 for share in recall.values()), recall


def test_candidates_are_streamed():
    text = "".join(f"{i % 9} " for i in range(400_000))
    tracemalloc.start()
    n = sum(1 for _ in itertools.islice(candidates(text), 300_000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 300_000 and peak < 1 << 20
    assert len(list(sample_rows([pa.RecordBatch.from_pydict({"text": [text[:60_000]], "_h": [5]})]))[0]) <= MOST_OF_A_TEXT


def test_boosting_and_calibration():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = Boosting().fit(x[:1000], y[:1000])
    assert ((model.score(x[1000:]) > 0) == y[1000:]).mean() > 0.9
    limit = calibrate(model.score(x[1000:]), y[1000:])
    assert y[1000:][model.score(x[1000:]) >= limit].mean() > 0.9


# language


def test_network_equals_a_plain_convolution():
    """Tables over pairs of bytes against filters moved byte by byte."""
    network = langid.Network(["a", "b", "c"], seed=4)
    rng = np.random.default_rng(5)
    x = rng.integers(0, langid.CLASSES, (9, 40)).astype(np.uint8)
    found = network.log_probabilities(x, network.lookups(), rows=4)
    for row, logs in zip(x, found):
        pooled = []
        for table in network.tables:
            sums = [sum(table[j, row[at + j]].astype(float) for j in range(len(table))) for at in range(40 - len(table) + 1)]
            pooled += np.maximum(np.max(sums, axis=0), 0).tolist()
        logits = np.array(pooled) @ network.dense + network.bias
        assert np.allclose(logs, logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max(), atol=1e-4)


def test_many_languages_are_learnt_within_bounds(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 3)
    monkeypatch.setattr(langid, "MOST_WINDOWS", 30)
    made = [(i, chr(97 + i % 6) * (20 + i), f"l{i % 6}") for i in range(1200 // 6 * 6) for _ in range(1)]
    made += [(5000 + i, "bb bb", "l1") for i in range(50)] + [(6000 + i, "cc c", "l2") for i in range(40)]
    made += [(7000 + i, "ddd", "l3") for i in range(30)] + [(None, "bbbb", "l1")]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string")
    network = langid.train_network(docs, steps=5)
    assert set(network.languages) <= {"l1", "l2", "l3"}
    assert [r.h for r in docs.where("doc_id IS NULL").select(langid.held_out().alias("h")).collect()] == [False]


def test_language_held_out(spark, docs):
    full = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    network = langid.train_network(full)
    found = langid.identify(full, network, "lang").withColumn("held", langid.held_out()).collect()
    for r in found:
        assert r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r.lang == r.lang_pred for r in found if r.held]
    assert sum(held) / len(held) > 0.98
    edge = {r.doc_id: r for r in langid.identify(clashing(docs), network).where("doc_id > 9000").collect()}
    for key in (9001, 9002, 9003, 9015):
        assert (edge[key].lang_pred, edge[key].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in edge.values())
    assert langid.identify(empty(docs), network).count() == 0
    assert langid.train_network(empty(docs)) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}


# repeated passages


def test_run_lengths():
    assert run_lengths(35) == [9, 18, 35] and run_lengths(8) == [8] and run_lengths(64) == [8, 16, 32, 64]


def test_substring(docs, rows):
    found = remove_repeats(clashing(docs), digest=True)
    assert got(found, "doc_id", "n_words", "n_removed", "kept") == Counter(brute.repeats(texts(rows)))
    kept = {r.doc_id: r.kept for r in remove_repeats(docs).collect()}
    assert kept[9005] == "before after" and kept[9006] == "" and kept[9001] == ""
    assert remove_repeats(empty(docs)).count() == 0


def test_substring_random(spark):
    rng = np.random.default_rng(2)
    made = []
    for i in range(60):
        w = [f"v{v}" for v in rng.integers(0, 400, int(rng.integers(0, 200)))]
        for _ in range(int(rng.integers(0, 3))):
            # copies of 30 to 45 words around the window length, from an earlier text
            other = made[int(rng.integers(0, len(made)))][1].split() if made else []
            a = int(rng.integers(0, max(1, len(other) - 45)))
            w += other[a : a + int(rng.integers(30, 46))]
        made.append((i, " ".join(w)))
    found = remove_repeats(spark.createDataFrame(made, "doc_id long, text string"), digest=True)
    assert got(found, "doc_id", "n_words", "n_removed", "kept") == Counter(brute.repeats(made))


# near duplicates


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates(docs, rows, shingle):
    found = near_duplicates(clashing(docs), shingle=shingle)
    expected = Counter(brute.near(texts(rows), shingle))
    lost = Counter({r: n for r, n in expected.items() if r[0] is not None})
    assert got(found.where("doc_id IS NOT NULL"), "doc_id", "n_shingles", "component_id", "kept") == lost
    assert got(found.where("doc_id IS NULL"), "component_id", "kept") == Counter({(None, True): 2})
    assert near_duplicates(empty(docs), shingle=shingle).count() == 0


@pytest.mark.parametrize("block", [2_000, 20])
def test_near_duplicates_hot_group(spark, monkeypatch, block):
    from pointset.llm import minmax_dedup

    monkeypatch.setattr(minmax_dedup, "BUCKET_BLOCK", block)
    rng = np.random.default_rng(3)
    base = [f"v{v}" for v in rng.integers(0, 5000, 120)]
    made = []
    for i in range(150):
        w = list(base)
        for at in rng.integers(0, len(w), int(rng.integers(0, 14))):
            w[at] = f"z{rng.integers(0, 9999)}"
        made.append((i, " ".join(w)))
    found = near_duplicates(spark.createDataFrame(made, "doc_id long, text string"), shingle=2)
    assert got(found, "doc_id", "n_shingles", "component_id", "kept") == Counter(brute.near(made, 2))


def test_short_sets_may_mislead(spark, monkeypatch):
    """With 8 bits of a hash nearly all pairs of a bucket are suggested."""
    from pointset.llm import minmax_dedup

    monkeypatch.setattr(minmax_dedup, "SHORT_SHIFT", 56)
    rng = np.random.default_rng(9)
    made = []
    for g in range(12):
        base = [f"g{g}v{v}" for v in rng.integers(0, 5000, 120)]
        for i in range(12):
            w = list(base)
            for at in rng.integers(0, len(w), int(rng.integers(0, 16))):
                w[at] = f"z{rng.integers(0, 9999)}"
            made.append((100 * i + g, " ".join(w)))
    found = near_duplicates(spark.createDataFrame(made, "doc_id long, text string"), shingle=2)
    assert got(found, "doc_id", "n_shingles", "component_id", "kept") == Counter(brute.near(made, 2))


NODE = "struct<doc_id:long,_th:long>"


def bucket(spark, sizes):
    """One bucket whose components have the given sizes; all sets are nearly equal."""
    rows, at = [], 0
    for n in sizes:
        rows += [((i, i), 20, 5, (at, at)) for i in range(at, at + n)]
        at += n
    members = spark.createDataFrame(rows, f"node {NODE}, n_shingles long, _key long, component {NODE}")
    return members.select("node", "n_shingles", "_key"), members.select("node", "component")


def test_a_stray_member_is_no_second_copy_of_its_bucket(spark, monkeypatch):
    from pointset.llm import minmax_dedup

    monkeypatch.setattr(minmax_dedup, "BUCKET_BLOCK", 100)
    members, labels = bucket(spark, [6000, 1])
    assert minmax_dedup.deal(members, labels).count() <= 2 * 6001
    assert minmax_dedup.deal(*bucket(spark, [6000])).count() == 0


def test_components_that_meet_return_few_pairs(spark):
    from pointset.llm import minmax_dedup

    members, labels = bucket(spark, [1000, 1000, 7])
    nodes = members.select("node").collect()
    sets = [(r.node, np.arange(20, dtype=np.uint64).tobytes()) for r in nodes]
    sets = spark.createDataFrame(sets, f"node {NODE}, shingles binary")
    pairs = minmax_dedup._met(minmax_dedup.deal(members, labels), sets.withColumnRenamed("shingles", "set"), 80, True)
    links = [(r.u.doc_id, r.v.doc_id) for r in pairs.collect()]
    # two blocks of members: a forest of three components from each
    assert 2 <= len(links) <= 4
    low = lambda i: 0 if i < 1000 else 1 if i < 2000 else 2
    assert len({(min(low(u), low(v)), max(low(u), low(v))) for u, v in links} & {(0, 1), (0, 2), (1, 2)}) == 2


def test_one_document_of_a_group_stays_with_repeated_ids(spark):
    words = [f"v{i}" for i in range(200)]
    near = [*words[:-1], "other"]
    rows = [(3, " ".join(words)), (3, " ".join(near)), (7, " ".join(near)), (7, "something else altogether is said here"), (8, " ".join(words))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SHAPE)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert sorted((r.doc_id, len(r.text.split())) for r in kept.collect()) == [(3, 200), (7, 6)]


# token ids


def test_pieces_encode_like_whole_texts(rows):
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = public_tokenizers.path(name)
        plain = Tokenizer.from_file(path)
        given = [r.text for r in rows]
        ids, bounds = encode_texts(pa.array(given), path, 7, spaced)
        for i, text in enumerate(given):
            own = ids[bounds[i] : bounds[i + 1]].tolist()
            assert own == [*plain.encode(text or "", add_special_tokens=False).ids, 7], text


def test_remembered_pieces_are_bounded_in_bytes():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    slot = ("pieces", path, False)
    for most in (1 << 12, 1 << 16):
        tokens.process_cache().pop(slot, None)
        for i in range(12):
            texts = [f"often seen w{i}x{j} " + "z" * 3000 * (j % 2) for j in range(8)]
            ids, bounds = encode_texts(pa.array(texts), path, 7, False, most)
            for j, text in enumerate(texts):
                assert ids[bounds[j] : bounds[j + 1]].tolist() == [*plain.encode(text, add_special_tokens=False).ids, 7]
            assert sum(part.nbytes for part in tokens.process_cache().get(slot, ())) <= most


def test_token_files_are_written_as_asked(spark):
    folder = fresh_path(spark, "tokens")
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.substring(F.md5((F.col("id") * i).cast("string")), 1, 5))).alias("text"))
    write_tokens(docs.coalesce(1), folder, path, 2, False, row_group_bytes=1 << 16, page_bytes=1 << 12)
    files = [f for f in Path(folder.removeprefix("file:")).glob("*.parquet")]
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in files for i in range(pq.ParquetFile(f).num_row_groups)]
    assert len(groups) > len(files)
    for group in groups:
        for i in range(group.num_columns):
            column = group.column(i)
            assert {"RLE_DICTIONARY", "PLAIN_DICTIONARY", "DELTA_BINARY_PACKED"} & set(column.encodings)
            assert column.has_column_index and column.has_offset_index


def test_token_store(spark, docs, rows):
    folder = fresh_path(spark, "tokens")
    path = public_tokenizers.path("word_bpe_49k.json")
    write_tokens(clashing(docs), folder, path, 2, False, row_group_bytes=1 << 16, page_bytes=1 << 12)
    found = read_tokens(spark, folder).select("doc_id", "start", "n_tokens", "ids")
    crc = found.mapInArrow(checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
    expected = brute.tokens([(-1 if d is None else d, t) for d, t in texts(rows)], Tokenizer.from_file(path), 2)
    assert Counter(
        (-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in crc.collect()
    ) == Counter(expected)
    assert read_positions(spark, folder).agg(F.sum("n_tokens")).head()[0] == sum(e[2] for e in expected)
    some = read_tokens(spark, folder, low=5, high=20)
    assert {r.doc_id for r in some.collect()} == set(range(5, 20))
    assert "PushedFilters: [IsNotNull(doc_id)" in some._jdf.queryExecution().toString()
    folder = fresh_path(spark, "tokens")
    write_tokens(empty(docs), folder, path, 2, False)
    assert read_tokens(spark, folder).count() == 0


# embeddings


def test_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 16))
    made = []
    for i in range(160):
        v = centres[i % 6] + rng.normal(size=16) * rng.choice([0.02, 0.05, 0.3])
        made.append((i, [float(np.float32(e)) for e in v], int(i % 2)))
    made += [(200, made[0][1], 0), (201, made[0][1], 0), (201, made[0][1], 0), (202, made[0][1], None)]
    made += [(203, None, 1), (204, [], 1), (205, [0.0] * 16, 1), (206, [None] + [1.0] * 15, 1)]
    made += [(207, [float("nan")] * 16, 1), (208, [float("inf")] + [0.0] * 15, 1), (209, [1.0, 2.0], 1), (210, [2.0, 4.0], 1)]
    table = spark.createDataFrame(made, "vec_id long, embedding array<float>, label int").withColumn("top", F.lit("x"))
    found = near_vectors(table)
    columns = ["vec_id", "n_links", "component_id", "kept"]
    assert got(found, *columns) == Counter(brute.vectors([(r.vec_id, r.embedding, r.label) for r in table.collect()]))
    assert near_vectors(table.limit(0)).count() == 0


def test_vectors_in_blocks(spark, monkeypatch):
    """All alike: one long list, in blocks."""
    from pointset.llm import pivot_index

    rng = np.random.default_rng(5)
    made = [(i, [float(e) for e in np.ones(8) + rng.normal(size=8) * 0.1], 1) for i in range(60)]
    table = spark.createDataFrame(made, "vec_id long, embedding array<double>, label int")
    columns = ["vec_id", "n_links", "component_id", "kept"]
    want = got(near_vectors(table), *columns)
    monkeypatch.setattr(pivot_index, "BLOCK", 7)
    assert got(near_vectors(table), *columns) == want
    found, expected = (sum(r[1] * n for r, n in rows.items()) for rows in (want, Counter(brute.vectors(made))))
    assert 0.9 * expected <= found <= expected


def test_vectors_of_many_lengths(spark):
    """Far more lengths than pivots are sampled for."""
    rng = np.random.default_rng(8)
    made = []
    for i in range(110):
        v = rng.normal(size=i + 1)
        made += [(2 * i, v.tolist(), 1), (2 * i + 1, (v * 3 + rng.normal(size=i + 1) * 1e-3).tolist(), 1)]
    table = spark.createDataFrame(made, "vec_id long, embedding array<double>, label int")
    columns = ["vec_id", "n_links", "component_id", "kept"]
    assert got(near_vectors(table), *columns) == Counter(brute.vectors(made))


def test_lists_stay_short_as_the_table_grows(spark, monkeypatch):
    from pointset.llm import pivot_index

    monkeypatch.setattr(pivot_index, "ENOUGH_FOR", 500)
    rng = np.random.default_rng(7)

    def longest(n):
        found = pivot_index.pivots_for(n, 32)
        v = pa.array(list(rng.normal(size=(n, 24))), pa.list_(pa.float64()))
        batch = pa.RecordBatch.from_arrays([v, pa.array(np.full(n, 24, np.int32))], ["v", "_dim"])
        made = next(pivot_index.describe({24: pivot_index.choose_pivots(np.empty((0, 24)), found)}, found, 6, 3)([batch]))
        codes = np.concatenate(made.column("codes").to_pylist())
        return np.unique(codes, return_counts=True)[1].mean()

    # twenty times the vectors; with as many pivots lists would be twenty times as long
    assert longest(20_000) < 4 * longest(1_000)


def test_vector_recall(spark):
    """Against brute force at random cosines around the threshold."""
    rng = np.random.default_rng(6)
    made = []
    for i in range(150):
        v = rng.normal(size=64)
        n = rng.normal(size=64)
        n -= v * (n @ v) / (v @ v)
        c = rng.uniform(0.975, 0.99)
        w = c * v / np.linalg.norm(v) + np.sqrt(1 - c * c) * n / np.linalg.norm(n)
        made += [(2 * i, [float(e) for e in v], 1), (2 * i + 1, [float(e) for e in w], 1)]
    found = near_vectors(spark.createDataFrame(made, "vec_id long, embedding array<double>, label int"))
    expected = sum(n for _, n, _, _ in brute.vectors(made))
    assert found.agg(F.sum("n_links")).head()[0] >= 0.97 * expected


# packing


def test_packing(docs, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    found = pack(clashing(docs).repartition(3), path, open_windows=4, keep_ids=True).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(np.array(r.ids, "<i4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        pieces[r.doc_id, r.doc_tokens].append(r)
        windows[r.sequence_id].append(r)
    for r in rows:
        ids = tuple([*plain.encode(r.text or "", add_special_tokens=False).ids, 0])
        if r.doc_id is None or r.doc_id == 9014:
            continue
        own = sorted(pieces[r.doc_id, len(ids)], key=lambda p: p.start)
        assert tuple(t for p in own for t in p.ids) == ids
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
    twice = [r for r in found if r.doc_id == 9014]
    assert sum(r.length for r in twice) == 2 * twice[0].doc_tokens
    for own in windows.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
        assert sum(p.length for p in own) <= 1024
    used = sum(r.length for r in found)
    assert used / (1024 * len(windows)) > 0.97
    assert pack(empty(docs), path).count() == 0


# lines


def test_lines(docs, rows):
    found = clean_lines(clashing(docs))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert got(found, *columns) == Counter(brute.line_metrics(r.doc_id, r.text) for r in rows)
    assert found.where("base_failed AND kept").count() == 0
    assert clean_lines(empty(docs)).count() == 0


def test_line_verdicts(spark):
    lines = [" ".join(f"w{i * 31 + j}" for j in range(12)) + "." for i in range(6)]
    prose = "\n".join(lines)
    made = [
        (1, prose),
        (2, "Home | About | Contact | Products | News\n" + "\n".join(f"a{i} | b{i} | c{i} | d{i}" for i in range(9))),
        (3, " ".join(f"word{i}%%%" for i in range(60))),
        (4, " ".join(f"SHOUT{i}!!" for i in range(60))),
        (5, prose + "\nHome | About | Contact | Help"),
        (6, prose + "\n" + " ".join(f"v{i}" for i in range(30))),
        (7, " ".join(f"v{i // 4}" for i in range(60)) + "."),
    ]
    found = {r.doc_id: r for r in clean_lines(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    assert [found[i].kept for i in range(1, 8)] == [True, False, False, False, True, True, False]
    assert found[5].text == prose and found[6].text == prose


def test_phrases_within_prose(spark):
    filler = " ".join(f"w{i * 31}" for i in range(60))
    prose = "\n".join(" ".join(f"v{i * 31 + j}" for j in range(12)) + "." for i in range(3))
    clean = [
        f"{filler}, a design in which you read more and the catalog in print, a dialog in a blog in French.",
        f"{filler}. They subscribe to the view that one may log in here.",
        "Our design in oak.",
        "Her catalog in print.",
    ]
    furniture = ["Read more", "Please sign in or log in", "Copyright 2020 Acme. All rights reserved.", "Click here to subscribe to news"]
    made = [(i, prose + "\n" + line) for i, line in enumerate(clean + furniture)] + [(99, clean[0])]
    found = {r.doc_id: r for r in clean_lines(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    for i, text in made[: len(clean)]:
        assert found[i].kept and found[i].n_lost == 0 and found[i].text == text
    for i, _ in made[len(clean) : -1]:
        assert found[i].kept and found[i].text == prose
    assert found[99].kept and found[99].text == clean[0]


def test_line_verdicts_against_labels(spark):
    folder = "/root/testdata/sf0.01"
    found = clean_lines(spark.read.parquet(f"{folder}/documents.parquet"), with_text=False)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    both = found.join(labels, "doc_id").where("n_words >= 20").collect()
    assert all(r.kept for r in both if r.quality == 1 and not r.base_failed)
    assert not any(r.kept for r in both if r.quality == 0)


# pipeline


def test_pipeline_stages(spark, docs, rows):
    given = docs.where("doc_id IS NOT NULL")
    expected = {r.doc_id for r in rows if r.doc_id is not None}
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        folder = fresh_path(spark, name)
        stage(spark, given, SF_DIR).write.parquet(folder)
        given = spark.read.parquet(folder)
        after[name] = given.collect()
        if name != "packed":
            assert given.columns == corpus_pipeline.COLUMNS
    lettered = {r.doc_id for r in rows if r.doc_id is not None and any(c.isalpha() for c in r.text or "")}
    kept = {r.doc_id for r in after["language"]}
    assert kept <= lettered and len(kept) >= 0.98 * len(lettered) and expected - lettered
    near = brute.near([(r.doc_id, r.text) for r in after["language"]], 5)
    assert Counter(r.doc_id for r in after["near_dedup"]) == Counter({d for d, _, _, k in near if k})
    before = {r.doc_id: r.text for r in after["near_dedup"]}
    for r in after["redact"]:
        if not brute.base_spans(before[r.doc_id]) and not any(c in before[r.doc_id] for c in "0123456789@"):
            assert r.text == before[r.doc_id]
        assert not [s for s in brute.base_spans(r.text)] and r.n_chars == len(r.text)
    sizes, copies = Counter(), Counter()
    for r in after["redact"]:
        sizes[r.source] += len(brute.words(r.text))
    targets = brute.targets(sizes)
    for r in after["mixture"]:
        copies[r.source] += len(brute.words(r.text))
    assert all(abs(copies[s] - targets[s]) < 1 for s in sizes)
    assert sum(r.length for r in after["packed"]) > 0
    assert corpus_pipeline.run(spark, SF_DIR).columns == given.columns


def test_queries_against_sql(spark):
    from tools.check import compare, duck

    import __spark_entry__ as contract
    from pointset.llm import queries

    con = duck(SF_DIR)
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    for name in queries.ORACLE_SQL:
        assert compare(spark, con, name, SF_DIR) == "", name
