"""Column types of text rows as one mergeable aggregate.

Every cell lies at some place of a small lattice: empty below everything; boolean; whole
numbers of 32 bits, of 64 bits, decimal numbers; days, then time stamps; text above
everything. A column's type is the least one above all its cells. Per type it takes the
count of cells that fit, so the fold is a plain sum: combined in every task, exact over
all rows, and a cell that changes the type may come last.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schema import POLICIES

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_WHOLE = r"^[+-]?[0-9]+$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"

#: Type name, family and which cells fit, from the least type up.
TYPES: tuple[tuple[str, str], ...] = (("boolean", "boolean"), ("int", "integral"), ("bigint", "integral"), ("double", "floating"),
                                      ("date", "datetime"), ("timestamp", "datetime"))


def _fits(cell: Column, kind: str) -> Column:
    if kind == "boolean":
        return F.lower(cell).isin("true", "false")
    if kind in ("int", "bigint"):
        return cell.rlike(_WHOLE) & cell.try_cast(kind).isNotNull()
    if kind == "double":
        return cell.rlike(_NUMBER) | F.lower(cell).isin("nan", "inf", "-inf", "infinity", "-infinity")
    return cell.rlike(_DAY if kind == "date" else _TIME) & cell.try_cast(kind).isNotNull()


@dataclass
class ColumnType:
    """What a pass over the cells of one column found."""

    name: str
    cells: int  # that hold text
    fit: dict[str, int]

    def kind(self, tolerance: float = 0.0) -> str:
        """The least type that all cells fit, or all but the share ``tolerance`` of them (which
        a typed load then rejects); ``string`` for a column without any cell."""
        if not self.cells:
            return "string"
        enough = self.cells * (1 - tolerance)
        return next((k for k, _ in TYPES if self.fit[k] and self.fit[k] >= enough), "string")

    def ddl(self, policy: str, tolerance: float = 0.0) -> str:
        """The type under a DDL policy; whole numbers that 32 bits do not hold stay BIGINT."""
        kind = self.kind(tolerance)
        family = dict(TYPES).get(kind, "other")
        name = POLICIES[policy][family]
        return "BIGINT" if name == "INT" and kind == "bigint" else name


def column_types(text: DataFrame) -> list[ColumnType]:
    """The type of each column of an all-text frame, in one pass."""
    sums: list[Column] = []
    for i, c in enumerate(text.columns):
        cell = F.nullif(F.trim(F.col(f"`{c}`")), F.lit(""))
        sums.append(F.count(cell).alias(f"c{i}"))
        sums += [F.count(F.when(_fits(cell, k), 1)).alias(f"c{i}_{k}") for k, _ in TYPES]
    row = text.agg(*sums).first()
    return [ColumnType(c, row[f"c{i}"], {k: row[f"c{i}_{k}"] for k, _ in TYPES}) for i, c in enumerate(text.columns)]


def ddl_types(found: list[ColumnType], policy: str, tolerance: float = 0.0) -> Mapping[str, str]:
    return {c.name: c.ddl(policy, tolerance) for c in found}
