"""Keyed uniform numbers.

``rand(seed)`` depends on how rows are partitioned, so a re-run after a lost
executor could draw other rows.  Every draw here is a pure function of
``(seed, tag, row id)`` instead: it repeats under any partitioning and can be
written in any SQL dialect that has md5.

Keys and weights are given as SQL text, a column name in the simplest case.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits are 52 bits, which a double holds exactly.
HEX_DIGITS = 13
SCALE = "4503599627370496D"


def _digits(seed: int, tag: str, key: str) -> str:
    return _digits_of(f"'{int(seed)}|{tag}|'", key)


def _digits_of(start: str, key: str) -> str:
    return f"substring(md5(cast(concat({start}, cast({key} as string)) as binary)), 1, {HEX_DIGITS})"


def _bits(seed: int, tag: str, key: str) -> str:
    return f"cast(conv({_digits(seed, tag, key)}, 16, 10) as bigint)"


def uniform_sql(seed: int, tag: str, key: str) -> str:
    return f"({_bits(seed, tag, key)} / {SCALE})"


def uniform(seed: int, tag: str, key: str = "id") -> Column:
    """Uniform number in [0, 1) for the row with this key."""
    return F.expr(uniform_sql(seed, tag, key))


def bound_digits(bound: str) -> Column:
    """A bound as digits: those of a key are less just if its uniform number is."""
    steps = f"lpad(lower(hex(cast(ceil(({bound}) * {SCALE}) as bigint))), {HEX_DIGITS}, '0')"
    return F.expr(f"CASE WHEN ({bound}) >= 1 THEN 'g' WHEN ({bound}) > 0 THEN {steps} ELSE '' END")


def digits_of(start: str, key: str = "id") -> Column:
    """The digits behind a uniform number, as text: comparing them needs no conversion.

    ``start`` is a column with the seed and the tag, as in ``draw_start``.
    """
    return F.expr(_digits_of(start, key))


def draw_start(seed: int, tag: str) -> str:
    return f"{int(seed)}|{tag}|"


def exponential_race(seed: int, tag: str, key: str, weight: str) -> Column:
    """Arrival time of the row; the earliest arrival wins with odds ``weight``.

    The minimum over all rows is therefore one weighted draw, and a minimum
    needs no shuffle of rows.  Half a step keeps the logarithm finite.
    """
    return F.expr(f"-ln(({_bits(seed, tag, key)} + 0.5D) / {SCALE}) / ({weight})")
