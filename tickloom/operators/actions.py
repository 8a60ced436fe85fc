"""Action spaces and relative actions over packed vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Components = Sequence[tuple[str, int]]


def offsets(components: Components) -> dict[str, tuple[int, int]]:
    """Component name -> (first position, width)."""
    out, at = {}, 0
    for name, dim in components:
        out[name] = (at, dim)
        at += dim
    return out


def width(components: Components) -> int:
    return sum(dim for _, dim in components)


def positions(components: Components, kept: Components) -> list[int]:
    """Positions of the kept components in a vector of all components."""
    where = offsets(components)
    return [where[name][0] + i for name, _ in kept for i in range(where[name][1])]


def take(vector: Column, at: list[int]) -> Column:
    """The elements of a vector at the given positions; null where the vector is shorter."""
    return F.when(vector.isNotNull(), F.array(*(F.get(vector, F.lit(i)) for i in at)))


def select_actions(df: DataFrame, column: str, at: list[int], dim: int, chunked: bool = True) -> DataFrame:
    """Keep the given positions of each action; unchanged if they are all of them in order."""
    if at == list(range(dim)):
        return df
    c = F.col(f"`{column}`")
    return df.withColumn(column, F.transform(c, lambda step: take(step, at)) if chunked else take(c, at))


def state_positions(action: Components, state: Components, exclude: Sequence[str] = ()) -> list[int | None]:
    """For each action position that of the state it is relative to, or None if it stays absolute.

    Components are matched by name, not by place. Excluded ones, and ones
    without a state component of the same name and width, stay absolute.
    """
    begins = {name: begin for name, (begin, dim) in offsets(state).items() if (name, dim) in set(action) and name not in exclude}
    return [begins[name] + i if name in begins else None for name, dim in action for i in range(dim)]


def relative_chunk(chunk: Column, state: Column, at: list[int | None]) -> Column:
    """Every step of a chunk minus the state at the chunk's own tick, where a state position is given; padded steps too."""

    def moved(step: Column) -> Column:
        numbers = [F.get(step, F.lit(i)) if a is None else F.get(step, F.lit(i)) - F.get(state, F.lit(a)) for i, a in enumerate(at)]
        return F.when(step.isNotNull(), F.array(*numbers))

    return F.transform(chunk, moved)
