"""Declarative table specs. A run is a list of these; every operator is generic over them."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a contract: where it comes from, what it becomes."""

    source: str
    target: str
    type: str
    date_format: str | None = None


@dataclass(frozen=True)
class SourceSpec:
    """One raw table: how to read it and what a load must satisfy before it is published.

    ``readers`` bounds the requests that a paged or windowed source gets at once.
    """

    target: str
    reader: str
    date_column: str
    date_format: str
    keys: tuple[str, ...] = ()
    description: str = ""
    tag: str = ""
    filter: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    max_age_days: int = 30
    min_volume_ratio: float = 0.90
    readers: int = 4


@dataclass(frozen=True)
class CurationSpec:
    """One curated table: its column contract, natural key and business rules."""

    source: str
    target: str
    columns: tuple[ColumnSpec, ...]
    keys: tuple[str, ...]
    nullable_keys: tuple[str, ...] = ()
    rules: dict[str, str] = field(default_factory=dict)

    @property
    def targets(self) -> list[str]:
        return [c.target for c in self.columns]

    @property
    def required_keys(self) -> list[str]:
        return [k for k in self.keys if k not in self.nullable_keys]

    @property
    def measures(self) -> list[str]:
        return [t for t in self.targets if t not in self.keys]


@dataclass(frozen=True)
class ColumnTest:
    """A data test on one column; ``relationship`` names the parent table and its column."""

    table: str
    column: str
    test: str
    parent: str | None = None
    parent_column: str | None = None


@dataclass(frozen=True)
class CalendarRange:
    first: date = date(1995, 1, 1)
    last: date = date(2035, 12, 31)
