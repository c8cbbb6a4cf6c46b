"""Groups that do not filter a measure: its value is the same for all of them.

A group by a dimension's column filters the facts that the dimension reaches, a group by a
fact's column filters that fact only, and some measures drop the calendar or fix a column.
What a measure is not filtered by is put beside its values afterwards: each value once for
every member that the context leaves, found once per column set and not per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sondaflow.measures.context import FACTS, Context, Star, rows_in

# A member list is an array beside every row. The calendar has some fifteen thousand days; a longer list
# than this is refused, because every value would be repeated for each member.
MOST_MEMBERS = 100_000


def calendar_columns(star: Star, by: list[str]) -> list[str]:
    return [c for c in by if c in star.calendar.columns]


def indicator_columns(star: Star, by: list[str]) -> list[str]:
    return [c for c in by if c in star.indicators.columns and c not in star.calendar.columns]


def visible_days(star: Star, context: Context) -> DataFrame:
    """The calendar as far as the context's own filters leave it."""
    days = star.calendar
    if context.calendar is not None:
        days = days.filter(context.calendar)
    first, last = context.days or (None, None)
    if first is not None:
        days = days.filter(F.col("data") >= F.lit(first))
    if last is not None:
        days = days.filter(F.col("data") <= F.lit(last))
    return days


def owned(star: Star, by: list[str], facts: list[str]) -> dict[str, str | None]:
    """The plain names of the groups and the fact that owns each; None for a dimension's column.

    ``fact.column`` names the owner. A plain name belongs to the only one of these facts that has it.
    """
    for fact in facts:
        rows_in(star, fact)  # says which fact the star lacks
    owners: dict[str, str | None] = {}
    for c in by:
        if "." in c:
            fact, name = c.split(".", 1)
            if fact not in FACTS or getattr(star, fact) is None or name not in getattr(star, fact).columns:
                raise ValueError(f"no such column of a fact: {c}")
            owners[name] = fact
        elif c in star.calendar.columns or c in star.indicators.columns:
            owners[c] = None
        else:
            having = [f for f in facts if c in getattr(star, f).columns]
            if not having:
                raise ValueError(f"the facts cannot be grouped by ['{c}']")
            if len(having) > 1:
                raise ValueError(f"{c} is a column of {having}: say whose, as in {having[0]}.{c}")
            owners[c] = having[0]
    return owners


def reaching(star: Star, fact: str, owners: dict[str, str | None]) -> list[str]:
    """The groups that filter this fact."""
    shown = indicator_columns(star, list(owners)) if "indicador" not in getattr(star, fact).columns else []
    return [c for c, owner in owners.items() if owner in (None, fact) and c not in shown]


def _beside(found: DataFrame, members: DataFrame, names: list[str]) -> DataFrame:
    """Every row once for each member. The members are one array, so no rows are joined."""
    whole = members.select(*names).distinct().agg(F.collect_list(F.struct(*names))).scalar()
    checked = F.when(F.size(whole) <= MOST_MEMBERS, whole).otherwise(
        F.raise_error(F.lit(f"more than {MOST_MEMBERS} groups of {names} that do not filter the measure")))
    return found.withColumn("_member", F.explode(checked)).select("*", *[f"_member.{n}" for n in names]).drop("_member")


def _within(found: DataFrame, members: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Every row with the members of its own groups, as each day of a month."""
    renamed = members.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *names).distinct()
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return found.join(renamed, on).drop(*[f"_key_{k}" for k in keys])


def spread(found: DataFrame, have: list[str], owners: dict[str, str | None], star: Star, context: Context) -> DataFrame:
    """The values found by the columns ``have``, once for every member of the other groups.

    Days and indicators are those of their dimensions that the context leaves, columns of a fact those
    of its rows that the context leaves.
    """
    missing = [c for c in owners if c not in have]
    days, shown = calendar_columns(star, missing), [c for c in missing if owners[c] is None]
    indicators = [c for c in shown if c not in days]
    sources: list[tuple[DataFrame, list[str], list[str]]] = []
    if days:
        sources.append((visible_days(star, context), calendar_columns(star, have), days))
    if indicators:
        rows = star.indicators if context.indicator is None else star.indicators.filter(context.indicator)
        sources.append((rows, indicator_columns(star, have), indicators))
    for fact in dict.fromkeys(owners[c] for c in missing if owners[c]):
        sources.append((rows_in(star, fact, context), [], [c for c in missing if owners[c] == fact]))
    for members, keys, names in sources:
        found = _within(found, members, keys, names) if keys else _beside(found, members, names)
    return found
