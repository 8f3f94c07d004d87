"""Element-wise aggregates over vector columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Aggregates per hash aggregate; more than 100 fields switch code generation off.
WIDTH = 64


def vector_aggregate(
    df: DataFrame,
    keys: list[str],
    x: str,
    dim: int,
    element: dict[str, str],
    scalar: dict[str, Column] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Aggregate the vectors of each group element by element.

    ``element`` maps result names to SQL aggregates applied to each element,
    ``scalar`` maps names to ordinary aggregates.  Short vectors take one hash
    aggregate with a slot per element, combined before the shuffle.  Longer ones
    are cut into chunks that are grouped on their own and glued together again,
    so a plan never has more than ``WIDTH`` slots.  With ``weight`` the elements
    are multiplied by it.
    """
    plain = [value.alias(name) for name, value in (scalar or {}).items()]
    names = [*element, *(scalar or {})]
    width = WIDTH // len(element)
    factor = f" * `{weight}`" if weight else ""

    def packed(vector: str, size: int) -> list[Column]:
        # One SQL text instead of a column object per slot: building the latter
        # takes the driver longer than running the job.
        texts = {
            name: ", ".join(f"{function}({vector}[{j}]{factor})" for j in range(size))
            for name, function in element.items()
        }
        return [F.expr(f"array({text}) AS `{name}`") for name, text in texts.items()]

    if dim <= width:
        return df.groupBy(*keys).agg(*packed(f"`{x}`", dim), *plain)

    n_chunks = -(-dim // width)
    # Slots past the end of the vector stay null, which every aggregate skips.
    pieces = ", ".join(
        f"struct({i} AS no, array({', '.join(f'get(`{x}`, {i * width + j})' for j in range(width))}) AS part)"
        for i in range(n_chunks)
    )
    rows = df.select("*", F.expr(f"inline(array({pieces})) AS (_no, _part)")).drop(x)
    flat = rows.groupBy(*keys, "_no").agg(*packed("_part", width), *plain)
    ordered = F.sort_array(F.collect_list(F.struct("_no", *element))).alias("_all")
    glued = flat.groupBy(*keys).agg(ordered, *[F.first(name).alias(name) for name in scalar or {}])
    joined = {name: F.slice(F.flatten(F.col(f"_all.{name}")), 1, dim) for name in element}
    return glued.withColumns(joined).select(*keys, *names)
