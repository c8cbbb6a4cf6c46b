"""Any set of measures over the same groups, planned together.

Most measures are made of a few pieces: the mean, the single value or the mean on the last
date of one column of one fact. The pieces of all measures are gathered first, each once.
Facts that all groups filter are stacked, and one aggregate gives all their pieces: one scan
per fact and one shuffle, and null keys match by themselves. Facts that a group does not
filter, and measures with a context of their own, are aggregated apart and put beside the
others by one more aggregate of the stacked results. Differences, colours, labels, last
points and highlights are made from the pieces at the end, all windows in one sort.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sondaflow.measures import shapes
from sondaflow.measures.context import Context, Star, dimension_columns, rows_in
from sondaflow.measures.spread import owned, reaching, spread


@dataclass(frozen=True)
class Piece:
    """A number per group: ``how`` is ``mean``, ``single`` or ``last`` (the mean on the fact's last date)."""

    fact: str
    how: str
    column: str

    @property
    def name(self) -> str:
        return f"_{self.how}_{self.fact}_{self.column}"


@dataclass(frozen=True)
class Recipe:
    """What a measure is made of and how, or which column of the highlighted series it is. A measure without
    pieces is evaluated apart. One that does not show, as a colour, is never blank and shows no group."""

    pieces: tuple[Piece, ...] = ()
    made: Callable[[list[str]], Column] | None = None
    highlight: str | None = None
    shows: bool = True


def _rows_of(star: Star, fact: str, by: list[str], context: Context, pieces: list[Piece], only_last: bool) -> DataFrame:
    """The fact's rows with a column for each piece."""
    rows = dimension_columns(star, rows_in(star, fact, context), by)
    whole = getattr(star, fact)
    if only_last:
        rows = shapes.on_last_date_of(rows, whole)
    elif any(p.how == "last" for p in pieces):
        last = whole.agg(F.max("data")).scalar()
        return rows.select(*by, *[
            (F.when(F.col("data") == last, F.col(p.column)) if p.how == "last" else F.col(p.column)).alias(p.name)
            for p in pieces], F.lit(fact).alias("_fact"))
    return rows.select(*by, *[F.col(p.column).alias(p.name) for p in pieces], F.lit(fact).alias("_fact"))


def _value(piece: Piece) -> Column:
    column = F.col(piece.name)
    if piece.how != "single":
        return F.avg(column)
    # The rows of other facts in the stack are none of its own.
    mine = F.count(F.when(F.col("_fact") == piece.fact, 1))
    return F.when((F.min(column) == F.max(column)) & (F.count(column) == mine), F.max(column))


def _stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def evaluated(star: Star, recipes: dict[str, Recipe], apart: list[DataFrame], owners: dict[str, str | None],
              context: Context, shown: list[str] | None = None) -> DataFrame:
    """The groups with all measures. ``apart`` has frames of measures that are no pieces, keyed by the groups,
    ``owners`` says whose the groups are. Rows in which all of ``shown`` are blank are left out; by default those are all measures but
    colours, which are never blank."""
    pieces = list(dict.fromkeys(p for r in recipes.values() for p in r.pieces))
    facts = list(dict.fromkeys(p.fact for p in pieces))
    names = list(owners)
    shown = shown or [n for n, r in recipes.items() if r.shows] or list(recipes)

    # Only the last date's rows are needed where nothing else could show a group.
    deciding = {p for n in shown for p in recipes[n].pieces} if all(recipes[n].pieces for n in shown) else set()
    only_last = {f for f in facts if deciding and all(p.how == "last" for p in deciding)
                 and {p.fact for p in deciding} == {f} and all(p.how == "last" for p in pieces if p.fact == f)}

    together, parts = [], []
    for fact in facts:
        mine = [p for p in pieces if p.fact == fact]
        keys = reaching(star, fact, owners)
        rows = _rows_of(star, fact, keys, context, mine, fact in only_last)
        if keys == names:
            together.append((rows, mine))
        else:
            parts.append(spread(rows.groupBy(*keys).agg(*[_value(p).alias(p.name) for p in mine]),
                                keys, owners, star, context))
    if together:
        stack = _stacked([rows for rows, _ in together])
        parts.insert(0, stack.groupBy(*names).agg(*[_value(p).alias(p.name) for _, mine in together for p in mine]))
    parts += apart
    whole = parts[0]
    if len(parts) > 1:
        columns = list(dict.fromkeys(c for part in parts for c in part.columns if c not in names))
        whole = _stacked(parts).groupBy(*names).agg(*[F.max(c).alias(c) for c in columns])
    if any(r.highlight for r in recipes.values()):
        value, = {p.name for r in recipes.values() if r.highlight for p in r.pieces}
        whole = shapes.with_highlight(whole, [c for c in names if c != "data"], value, "_highlight_start",
                                      "_median_history", "_median_recent")
    made = whole.select(*names, *[
        (F.col(f"_{r.highlight}") if r.highlight else r.made(names) if r.made else F.col(n)).alias(n)
        for n, r in recipes.items()])
    return shapes.shown(made, shown) if names else made
