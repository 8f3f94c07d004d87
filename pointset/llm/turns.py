"""Conversation structure repair by secondary-sorted streaming.

Conversations are repartitioned by id and sorted by turn; ``mapInPandas`` carries the
state of a dynamic programme from batch to batch, so no conversation has to fit into
a batch or a task's memory.  The programme looks for the cheapest edits after which
the roles read ``(s?(ua)+)?``; of equally cheap ones the least in ASCII order wins.

Of the programme only what a row can change is kept: the costs of the four places in
the pattern relative to the cheapest, and which of their edits come first in ASCII
order.  These states are finite, so a row costs two look-ups.  A row leaves one number
behind, from which the way back is found.  After ``BLOCK_ROWS`` rows or
``BLOCK_CHARS`` characters the ways back through a block, one for each place it may be
left at, are handed on as rows of the result (Spark writes them to the shared folder),
and the block's memory is free.  A second, narrow step walks the blocks of such giant
conversations from the last to the first.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows and characters of a conversation held at once.
BLOCK_ROWS = 1 << 16
BLOCK_CHARS = 8 << 20
SPACES = " \t\n\x0b\x0c\r"

# Places in the pattern: nothing yet, after the opening s, after a u, after an a.
START, SYSTEM, USER, ASSISTANT = range(4)
ADVANCE = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT
}
NAMES = {"u": "user", "a": "assistant"}
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
# What it costs at most to go on from one place (first) as if from another (second):
# an insertion, or deleting a leading s that could have been kept.
INSTEAD = {
    (ASSISTANT, SYSTEM): 0, (START, SYSTEM): 0, (START, ASSISTANT): 0, (ASSISTANT, START): 2, (ASSISTANT, USER): 5,
    (USER, ASSISTANT): 5, (USER, SYSTEM): 5, (START, USER): 5, (USER, START): 7, (SYSTEM, START): 10,
}
# Classes of role initials and of faults, as the numbers of a row's symbol.
INITIALS = "sua"
FINE, CUT_OFF, BLANK, REPEATED = range(4)
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def awaited(place: int) -> str:
    """The role the pattern goes on with, if not with its opening s."""
    return "a" if place == USER else "u"


def choices(place: int, initial: str | None, fault: int) -> list[tuple[int, int, str]]:
    """``(place after, cost, edits)`` of a row and up to two insertions before it."""
    found, before = [(place, DELETE, "D")], 0
    while fault in (FINE, CUT_OFF) and before <= 2:
        extra = INSERT * before + (TRUNCATED if fault == CUT_OFF else 0)
        if (place, initial) in ADVANCE:
            found.append((ADVANCE[place, initial], extra, "I" * before + "K"))
        found.append((ADVANCE[place, awaited(place)], extra + REROLE, "I" * before + "R"))
        # a row may also be deleted after an insertion, but inserting later is as cheap
        # and a D before an I comes first in ASCII order
        place, before = ADVANCE[place, awaited(place)], before + 1
    return found


class Programme:
    """States of the dynamic programme, found when first needed.

    A state is a tuple over the places: ``None`` where a place cannot lead to the
    cheapest edits, else its cost above the cheapest and the rank of its edits.
    """

    def __init__(self):
        self.states = [((0, 0), None, None, None)]
        self.numbers = {self.states[0]: 0}
        self.steps: list[tuple] = []
        self.table: list[list[int]] = [[-1] * 16]

    def step(self, state: int, symbol: int) -> int:
        """Number of the step, an index of ``steps``: ``(state after, cost, ways back)``."""
        number = self.table[state][symbol]
        return number if number >= 0 else self._find(state, symbol)

    def _find(self, state: int, symbol: int) -> int:
        initial = (INITIALS + "-")[symbol >> 2]
        best: dict[int, tuple] = {}
        for place, held in enumerate(self.states[state]):
            if held is None:
                continue
            for after, cost, edits in choices(place, initial, symbol & 3):
                offer = (held[0] + cost, held[1], edits, place)
                if after not in best or offer < best[after]:
                    best[after] = offer
        live = {
            place: offer
            for place, offer in best.items()
            if not any(
                (other, place) in INSTEAD and best[other][0] + INSTEAD[other, place] < offer[0] for other in best
            )
        }
        floor = min(offer[0] for offer in live.values())
        ranks = {place: i for i, place in enumerate(sorted(live, key=lambda p: live[p][1:3]))}
        after = tuple((live[p][0] - floor, ranks[p]) if p in live else None for p in range(4))
        if after not in self.numbers:
            self.numbers[after] = len(self.states)
            self.states.append(after)
            self.table.append([-1] * 16)
        ways = tuple((live[p][3], live[p][2]) if p in live else None for p in range(4))
        self.table[state][symbol] = len(self.steps)
        self.steps.append((self.numbers[after], floor, ways))
        return self.table[state][symbol]

    def finish(self, state: int) -> tuple[int, int, str]:
        """The place to end at, the cost above the cheapest, and the last insertions."""
        last = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
        held = self.states[state]
        cost, _, place = min(
            (held[p][0] + INSERT * last[p], held[p][1], p) for p in range(4) if held[p] is not None
        )
        return place, cost, "I" * last[place]

    def places(self, state: int) -> list[int]:
        return [p for p in range(4) if self.states[state][p] is not None]


class Conversation:
    """One conversation while its rows pass by."""

    def __init__(self, name, programme: Programme, keep_rows: bool, block_rows: int, block_chars: int):
        self.name, self.programme, self.keep_rows = name, programme, keep_rows
        self.block_rows, self.block_chars = block_rows, block_chars
        self.state, self.cost, self.block = 0, 0, 0
        self.turns = None
        self.distinct = 0
        self.counts = [0, 0, 0, 0]
        self.illegal, self.initial = 0, None
        self.hashes = {START: hashlib.sha256()}
        self.clear()

    def clear(self):
        self.steps: list[int] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.chars = 0

    def add(self, turn, role: str, text: str, fault: int):
        """Take a row; ``turn`` is ``None`` if it has none.  Yields rows of a full block."""
        if turn is not None and (self.turns is None or turn != self.turns[1]):
            self.turns = (turn if self.turns is None else self.turns[0], turn)
            self.distinct += 1
        self.counts[fault] += 1
        initial = role[:1]
        if self.initial is not None and (self.initial, initial) not in LEGAL:
            self.illegal += 1
        self.initial = initial
        at = INITIALS.find(initial) if initial else -1
        step = self.programme.step(self.state, (at if at >= 0 else 3) << 2 | min(fault, BLANK))
        self.state, cost, _ = self.programme.steps[step]
        self.cost += cost
        self.steps.append(step)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)
        if len(self.steps) >= self.block_rows or self.chars >= self.block_chars:
            yield from self.pass_on()

    def way(self, place: int) -> tuple[int, list[str]]:
        """Where the block is entered to be left at ``place``, and the edits of each row."""
        edits, steps = [], self.programme.steps
        for step in reversed(self.steps):
            place, letters = steps[step][2][place]
            edits.append(letters)
        edits.reverse()
        return place, edits

    def repaired(self, place: int, edits: list[str], last: str):
        """``(role, text, edit)`` of the rows left by the edits of a block entered at ``place``."""
        out = []
        for letters, role, text in zip([*edits, last], [*self.roles, ""], [*self.texts, ""]):
            for letter in letters:
                if letter == "D":
                    continue
                initial = role[:1] if letter == "K" else awaited(place)
                place = ADVANCE[place, initial]
                out.append((role if letter == "K" else NAMES[initial], "" if letter == "I" else text, letter))
        return out

    def pass_on(self):
        """Hand on a full block: what is known for each place it may be left at."""
        after = {}
        for place in self.programme.places(self.state):
            entry, edits = self.way(place)
            rows = self.repaired(entry, edits, "")
            after[place] = self.hashed(entry, rows)
            yield self.row(place, entry, edits, "")
            yield from self.kept(place, rows)
        self.hashes = after
        self.block += 1
        self.clear()

    def hashed(self, entry: int, rows: list):
        known = self.hashes[entry].copy()
        if rows:
            lines = "\n".join(f"{role}:{text}" for role, text, _ in rows)
            known.update(("" if entry == START else "\n").encode() + lines.encode("utf-8", "surrogatepass"))
        return known

    def row(self, place: int, entry: int, edits: list[str], last: str, facts: tuple = (None,) * 7):
        return (self.name, self.block, place, entry, "".join(edits) + last, *facts, None, None, None, None)

    def kept(self, place: int, rows: list):
        if self.keep_rows:
            for i, (role, text, edit) in enumerate(rows):
                yield (self.name, self.block, place, None, None, *(None,) * 7, i, role, text, edit)

    def close(self):
        place, cost, last = self.programme.finish(self.state)
        entry, edits = self.way(place)
        rows = self.repaired(entry, edits, last)
        gaps = self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        _, cut_off, blank, repeated = self.counts
        digest = self.hashed(entry, rows).hexdigest()
        yield self.row(
            place, entry, edits, last, (gaps, blank, repeated, cut_off, self.illegal, self.cost + cost, digest)
        )
        yield from self.kept(place, rows)


FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "repaired_sha256"]
STREAMED = ["_conv", "block", "left_at", "entered_at", "audit", *FACTS, "place", "role", "text", "edit"]
AUDIT, TEXT = STREAMED.index("audit"), STREAMED.index("text")
STREAMED_TYPES = (
    "_conv string, block long, left_at int, entered_at int, audit string, gaps long, blank long, duplicate long, "
    "truncated long, illegal long, cost long, repaired_sha256 string, place long, role string, text string, edit string"
)


def stream(keep_rows: bool, block_rows: int, block_chars: int):
    """For ``mapInPandas`` over rows sorted by conversation and turn."""

    def frame(rows: list) -> pd.DataFrame:
        table = pd.DataFrame(rows, columns=STREAMED, dtype=object)
        for name in ("block", "left_at", "entered_at", *FACTS[:-1], "place"):
            table[name] = table[name].astype("Int64")
        return table

    def run(batches):
        programme, current, before = Programme(), None, None
        out, held = [], 0

        def take(rows) -> None:
            nonlocal held
            for row in rows:
                out.append(row)
                held += len(row[AUDIT] or "") + len(row[TEXT] or "")

        for batch in batches:
            names, turns, known, roles, texts, faults, present = (batch[c].tolist() for c in batch.columns)
            for name, turn, has_turn, role, text, fault, here in zip(names, turns, known, roles, texts, faults, present):
                if current is None or name != current.name:
                    if current is not None:
                        take(current.close())
                    current, before = Conversation(name, programme, keep_rows, block_rows, block_chars), None
                if here:
                    same = (has_turn, turn, role, text)
                    # rows that agree in all of this follow each other
                    if same == before and fault != BLANK:
                        fault = REPEATED
                    before = same
                    take(current.add(turn if has_turn else None, role, text, fault))
                if len(out) > 10_000 or held > block_chars:
                    yield frame(out)
                    out, held = [], 0
        if current is not None:
            take(current.close())
        if out:
            yield frame(out)

    return run


def follow(table: pd.DataFrame) -> pd.DataFrame:
    """The way through the blocks of one conversation, from its last block back."""
    ways = {(b, p): (e, a) for b, p, e, a in zip(table["block"], table["left_at"], table["entered_at"], table["audit"])}
    block = int(table["block"].max())
    place = int(table.loc[table["cost"].notna(), "left_at"].iloc[0])
    audits, places = [], []
    while block >= 0:
        entry, audit = ways[block, place]
        audits.append(audit)
        places.append(place)
        place, block = int(entry), block - 1
    name = table["_conv"].iloc[0]
    return pd.DataFrame(
        {"_conv": [name], "audit": ["".join(reversed(audits))], "left_at": [places[::-1]]}
    )


def _faults(rows: DataFrame) -> DataFrame:
    """Rows with ``_fault``; repeats within one turn are told apart in the stream."""
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    own = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(CUT_OFF)
    sizes = F.concat_ws(":", F.length("_conv").cast("string"), F.length("role").cast("string"), F.lit(""))
    # rows that cannot repeat have keys of their own, which spreads them in the join
    can = F.col("_here") & (F.col("_fault") != BLANK)
    parts = F.concat(F.lit("-"), F.col("_conv"), F.lit(":"), F.col("_turn").cast("string"))
    said = F.concat(sizes, F.col("_conv"), F.col("role"), F.col("text"))
    marked = rows.withColumn("_fault", own).withColumn("_can", can).withColumn(
        "_key", F.unhex(F.md5(F.when(can, said).otherwise(parts)))
    )
    turn = F.struct("_has_turn", "_turn")
    said = marked.where("_can").groupBy("_key").agg(F.min(turn).alias("_first"), F.max(turn).alias("_last"))
    again = said.where("_first < _last").select("_key", "_first")
    late = F.col("_can") & F.coalesce(F.col("_first") < turn, F.lit(False))
    return marked.join(again, "_key", "left").withColumn("_fault", F.when(late, REPEATED).otherwise(F.col("_fault")))


def repair_conversations(
    rows: DataFrame,
    present: Column | None = None,
    keep_rows: bool = False,
    block_rows: int = BLOCK_ROWS,
    block_chars: int = BLOCK_CHARS,
) -> tuple[DataFrame, DataFrame | None]:
    """Faults and cheapest repair of every conversation of ``conv_id, turn, role, text``.

    The first result has a row per ``conv_id``: ``gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256``.  ``audit`` holds the initials of the
    edits in order: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty
    user or assistant row 5; a truncated row costs 5 more unless it is deleted, blank
    and duplicate rows have to be.  With ``keep_rows`` the second result holds the
    repaired rows ``conv_id, block, place, role, text, edit``, in order of ``block``
    and ``place``.  Rows for which ``present`` is not true only name their conversation.

    Rows are taken by turn, nulls first, then by role and text.  A null id is a
    conversation of its own, a null role or text is one space; a text of any length is
    read whole.  Rows that repeat, in one turn or a later one, are duplicates.
    Conversations without rows have zeros, an empty audit and the hash of nothing; an
    empty table gives no rows.  Other columns are not read.

    One task holds a block of a conversation (``block_rows`` rows or ``block_chars``
    characters), and the audit of a conversation is one string.
    """
    named = F.when(F.col("_conv") != "", F.substr("_conv", F.lit(2))).cast(rows.schema["conv_id"].dataType).alias("conv_id")
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    taken = rows.select(
        # pandas has no common sign for a missing text: a null id is the empty name
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("_conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("_turn"),
        F.col("turn").isNotNull().alias("_has_turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        here.alias("_here"),
    )
    order = ["_conv", "_has_turn", "_turn", "role", "text"]
    read = ["_conv", "_turn", "_has_turn", "role", "text", "_fault", "_here"]
    streamed = materialize(
        _faults(taken).repartition("_conv").sortWithinPartitions(*order).select(*read)
        .mapInPandas(stream(keep_rows, block_rows, block_chars), STREAMED_TYPES),
        "repairs",
    )
    ends = streamed.where("cost IS NOT NULL")
    giants = ends.where("block > 0").select(F.col("_conv").alias("_giant"))
    same = F.col("_conv") == F.col("_giant")
    of_giant = streamed.where("audit IS NOT NULL").join(giants, same, "left_semi")
    of_giant = of_giant.select("_conv", "block", "left_at", "entered_at", "audit", "cost")
    ways = of_giant.groupBy("_conv").applyInPandas(follow, "_conv string, audit string, left_at array<int>")
    whole = ways.select(F.col("_conv").alias("_giant"), F.col("audit").alias("_audit"))
    long = ends.where("block > 0").drop("audit").join(whole, same).withColumnRenamed("_audit", "audit")
    columns = [named, *FACTS[:-1], "audit", FACTS[-1]]
    found = ends.where("block = 0").select(*columns).unionAll(long.select(*columns))
    if not keep_rows:
        return found, None
    chosen = ways.select(F.col("_conv").alias("_giant"), F.posexplode("left_at").alias("_block", "_at"))
    chosen = chosen.unionAll(
        ends.where("block = 0").select("_conv", F.col("block").cast("int"), F.col("left_at"))
    )
    match = same & (F.col("block") == F.col("_block")) & (F.col("left_at") == F.col("_at"))
    kept = streamed.where("place IS NOT NULL").join(chosen, match, "left_semi")
    return found, kept.select(named, "block", "place", "role", "text", "edit")


def damage(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, and ``present``: false where a row is dropped.

    The remainder of the CRC-32 of ``conv_id:turn`` by 20 says what happens: 0 drops
    the row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it,
    4 makes its role user.  Nulls are one space.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    fate = F.crc32(key.cast("binary")) % 20
    taken = rows.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), fate.alias("_f")
    )
    copies = F.when(F.col("_f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_f") == 4, "user").otherwise(F.col("role"))
    return taken.withColumn("_copy", F.explode(copies)).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("_f") != 0).alias("present")
    )
