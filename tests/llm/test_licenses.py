"""License scans against plain versions."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from pointset.llm import licenses, queries
from pointset.llm.licenses import Automaton, Scan, scan_licenses, scan_texts

from . import brute

SHAPE = "doc_id long, text string, n_words int, spans string, label string"
BASE = ["n_words", "n_base", "first_word", "last_word", "base_labels"]


def scanned(text):
    scan, spans = next(scan_texts(pa.array([text], pa.string())))
    return scan, spans


def base_of(scan):
    labels = ",".join(sorted({scan.automaton.phrase_labels[p] for p in scan.found}))
    return scan.n_words, scan.n_base, scan.first, scan.last, labels


def test_the_query(spark):
    d = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    result = {r.doc_id: r for r in queries.op11_licenses(spark, d).collect()}
    assert len(result) == len(rows)
    planted = {"apache license": "apache-2.0", "mit license": "mit", "gnu general public": "gpl", "cc by-nc": "cc-by-nc"}
    for row in rows:
        r = result[row.doc_id]
        assert tuple(r[c] for c in BASE) == brute.license_base(row.text)
        labels = set(r.labels.split(",")) - {""}
        assert set(r.base_labels.split(",")) - {""} <= labels and 0 <= r.score <= 1
        hits = {label for sign, label in planted.items() if sign in row.text.lower()}
        assert labels - {"reserved", "cc-by"} == hits


def test_random_texts_against_brute_force():
    rng = random.Random(5)
    signs = list("ccby Aa.-/[`{~\x00\x7f\n") + ["cc", "by", "CC", "BY", "General", "public", "LICENSE", "all", "rights", "reserved", "é", "Ω", "´"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) + rng.choice(["", " ", "-"]) for _ in range(rng.randint(0, 40)))
        scan, _ = scanned(text)
        assert base_of(scan) == brute.license_base(text), text


def test_runs_are_those_of_the_definition():
    rng = random.Random(6)
    for _ in range(300):
        templates = [" ".join(rng.choice("ab c d".split()) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 4))]
        phrases = [(" ".join(rng.choice("ab c d".split()) for _ in range(rng.randint(1, 3))), "p")]
        text = [rng.choice("ab c d x".split()) for _ in range(30)]
        automaton = Automaton(phrases, [("t", t) for t in templates])
        # the longest run at a word counts phrases too
        everything = [t.split() for t in templates] + [phrases[0][0].split()]
        scan = Scan(automaton)
        known = [(i, automaton.words[w]) for i, w in enumerate(text) if w in automaton.words]
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(licenses, "LONG_RUN", 2)
            scan.feed([i for i, _ in known], [w for _, w in known])
            scan.close()
        expected = {n: runs for n, runs in brute.license_runs(text, everything, 2).items() if n < len(templates)}
        assert {n: set(runs) for n, runs in scan.runs.items() if runs} == expected
        p = phrases[0][0].split()
        assert scan.n_base == sum(text[i : i + len(p)] == p for i in range(len(text)))


MIT = next(text for _, text in licenses.TEMPLATES if text.startswith("Permission is hereby"))


def test_changed_license_texts_are_found():
    words = licenses.words_of(MIT)
    rng = random.Random(7)
    changed = list(words)
    for i in range(9, len(changed), 10):
        changed[i] = f"other{i}"
    del changed[60:64]
    prose = [f"word{rng.randint(0, 500)}" for _ in range(300)]
    scan, spans = scanned(" ".join(prose[:100] + changed + prose[100:] + changed))
    assert [s[0] for s in spans] == ["mit", "mit"]
    assert all(0.7 < covered < 1 for *_, covered in spans)
    assert spans[0][1] == 100 and spans[0][2] == 100 + len(changed) and spans[1][1] == 300 + len(changed)
    whole, spans = scanned(MIT.upper().replace(" ", "\t\n"))
    assert spans == [("mit", 0, len(words), 1.0)]
    # parts far apart, or too little of it, are no license
    assert scanned(" ".join(words[:30] + prose[:200] + words[60:90]))[1] == []
    assert scanned(" ".join(words[:40]))[1] == []
    # prose that shares words with licenses is none
    assert scanned("the software is provided to any person for use in the terms of this work and the conditions")[1] == []


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = ("Lorem IPSUM " * 50 + MIT + " general public license, cc by ") * 4
    scan, spans = scanned(text)
    for chunk in (7, 100, 3000):
        monkeypatch.setattr(licenses, "CHUNK", chunk)
        other, same = scanned(text)
        assert base_of(other) == base_of(scan) == brute.license_base(text) and same == spans


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n.A"), (4, "CC BY cc-by"), (4, "CC BY cc-by"), (None, "All rights reserved."),
        (5, "é" * 200_000 + " all rights " + "RESERVED " * 100_000), (6, "cc " * 50_000 + "by"), (7, "licensed under CC BY-NC 4.0."),
    ]
    table = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SHAPE)
    found = scan_licenses(table).collect()
    assert Counter((r.doc_id, *(r[c] for c in BASE)) for r in found) == Counter((i, *brute.license_base(t)) for i, t in rows)
    by_id = {r.doc_id: r for r in found}
    assert (by_id[1].labels, by_id[1].score, by_id[1].spans) == ("", 0.0, [])
    assert by_id[7].labels == "cc-by,cc-by-nc" and by_id[7].base_labels == "cc-by"
    assert scan_licenses(table.where("false")).count() == 0
