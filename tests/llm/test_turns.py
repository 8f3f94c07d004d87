"""Repair of conversations against a plain version."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pointset.llm import queries
from pointset.llm.turns import Programme, damage, repair_conversations

from . import brute

SHAPE = "conv_id long, turn long, role string, text string, _conv int, place string, present string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SHAPE)
    result, repaired = repair_conversations(damage(table), F.col("present"), **options)
    return Counter(tuple(r[c] for c in COLUMNS) for r in result.collect()), repaired


def random_rows(seed, conversations=300, longest=14):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "u2", None]
    texts = ["Yes.", "no", "", " \n\t", "What?", "ok!  ", "fine .x", None, "Ünïcode…", "Sure.", "Go."]
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, longest)):
            turn = None if rng.random() < 0.05 else t + (rng.random() < 0.1) - (rng.random() < 0.1)
            text = rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randint(0, 50)}" + rng.choice([".", "", "!"])
            role = ["user", "assistant"][t % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((None if c == 7 else c, turn, role, text))
            if rng.random() < 0.05:
                rows.append(rows[-1])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1 << 16, 3, 1])
def test_against_brute_force(spark, block):
    rows = random_rows(block)
    result, _ = found(spark, rows, block_rows=block)
    assert result == Counter(brute.conversations(rows))


def test_blocks_of_characters_and_repaired_rows(spark):
    rows = random_rows(99)
    result, repaired = found(spark, rows, keep_rows=True, block_chars=40)
    assert result == Counter(brute.conversations(rows))
    lines, edits = defaultdict(list), defaultdict(list)
    for r in repaired.orderBy("block", "place").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
        edits[r.conv_id].append(r.edit)
    for row in result:
        c, audit, sha = row[0], row[-2], row[-1]
        assert hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() == sha
        assert "".join(edits[c]) == audit.replace("D", "")


def test_one_giant_conversation(spark):
    """Roles no pattern explains keep several ways alive from end to end."""
    rows = [(1, t, "tool", f"text {t}.") for t in range(4000)]
    rows += [(2, t, ["assistant", "user"][t % 2], f"text {t}.") for t in range(4001)]
    rows += [(3, 0, "user", "same.")] * 900
    result, _ = found(spark, rows, block_rows=64)
    assert result == Counter(brute.conversations(rows))


def test_no_rows_and_dropped_rows(spark):
    dropped = next(c for c in range(1000) if not brute.damaged([(c, 0, "user", "x.")]))
    result, _ = found(spark, [(dropped, 0, "user", "x.")])
    assert result == Counter([(dropped, 0, 0, 0, 0, 0, 0, "", brute.sha(""))])
    assert not found(spark, [])[0]


def test_states_are_few():
    programme, rng = Programme(), random.Random(1)
    state = 0
    for _ in range(200_000):
        state = programme.steps[programme.step(state, rng.randrange(16))][0]
        if rng.random() < 0.01:
            state = 0
    assert len(programme.states) < 200


def test_the_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = queries.op13_turns(spark, d)
    assert Counter(tuple(r[c] for c in COLUMNS) for r in result.collect()) == Counter(brute.conversations(rows))
