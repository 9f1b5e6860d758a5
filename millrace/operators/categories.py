"""Category columns: integer codes in the rows, and a table of what they stand for.

Edits change the table of levels alone; the rows keep their codes and are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Categorical:
    """`column` of `rows` holds codes; `levels` is (code, place, level). A code without a level is null."""

    rows: DataFrame
    column: str
    levels: DataFrame
    next_code: int
    ordered: bool = False

    def names(self) -> list:
        """The levels in their order; a dictionary that a user edits by hand is small."""
        return [r.level for r in self.levels.orderBy("place").collect()]

    def decoded(self, place: str | None = None) -> DataFrame:
        """The rows with levels for codes, and the place of the level as a further column."""
        found = self.levels.select(F.col("code").alias("_code"), F.col("place").alias("_place"), F.col("level").alias("_level"))
        joined = self.rows.join(found, F.col(f"`{self.column}`") == F.col("_code"), "left")
        kept = [F.col("_level").alias(c) if c == self.column else F.col(f"`{c}`") for c in self.rows.columns]
        return joined.select(*kept, *([F.col("_place").alias(place)] if place else []))

    def place_of(self, level) -> int:
        """What `decoded(place)` is compared with: only ordered levels can be."""
        if not self.ordered:
            raise ValueError("the levels have no order")
        row = self.levels.where(F.col("level") == F.lit(level)).select("place").first()
        if row is None:
            raise ValueError(f"no level {level}")
        return row.place

    def as_ordered(self, ordered: bool = True) -> Categorical:
        return replace(self, ordered=ordered)

    def add(self, new: Sequence) -> Categorical:
        """Further levels after the last; no row has them yet."""
        names = self.names()
        if len(set(new)) < len(new) or set(new) & set(names):
            raise ValueError(f"levels {list(new)} are there already or repeat")
        return self._with([*names, *new])

    def remove(self, gone: Sequence) -> Categorical:
        """Rows of these levels become null."""
        names = self.names()
        if not set(gone) <= set(names):
            raise ValueError(f"no levels {sorted(set(gone) - set(names))}")
        return self._with([n for n in names if n not in gone])

    def reorder(self, order: Sequence) -> Categorical:
        names = self.names()
        if sorted(map(str, order)) != sorted(map(str, names)) or set(order) != set(names):
            raise ValueError(f"{list(order)} are not the levels {names}")
        return self._with(list(order))

    def set(self, order: Sequence) -> Categorical:
        """These levels in this order: others go, unknown ones come."""
        if len(set(order)) < len(order):
            raise ValueError("levels repeat")
        return self._with(list(order))

    def rename(self, new: Mapping) -> Categorical:
        names = self.names()
        after = [new.get(n, n) for n in names]
        if len(set(after)) < len(after):
            raise ValueError("two levels would have one name")
        named = {r.level: r.code for r in self.levels.collect()}
        return self._levels([(named[n], a) for n, a in zip(names, after)], self.next_code)

    def remove_unused(self) -> Categorical:
        """Only the levels that rows have; their order stays."""
        used = self.rows.select(F.col(f"`{self.column}`").alias("code")).distinct()
        kept = {r.code for r in self.levels.join(used, "code", "left_semi").collect()}
        return self._levels([(r.code, r.level) for r in self.levels.orderBy("place").collect() if r.code in kept], self.next_code)

    def _with(self, order: list) -> Categorical:
        """Known levels keep their code; a new one takes a code that none has had."""
        code, after, out = {r.level: r.code for r in self.levels.collect()}, self.next_code, []
        for level in order:
            if level not in code:
                code[level], after = after, after + 1
            out.append((code[level], level))
        return self._levels(out, after)

    def _levels(self, pairs: list[tuple], after: int) -> Categorical:
        return replace(self, levels=_table(self.rows, self.levels.schema["level"].dataType, pairs), next_code=after)


def encode(df: DataFrame, column: str, levels: Sequence, ordered: bool = False) -> Categorical:
    """`column` as codes of `levels`; null and what is no level become null."""
    if len(set(levels)) < len(levels) or None in levels:
        raise ValueError("levels repeat or are null")
    table = _table(df, df.schema[column].dataType, list(enumerate(levels)))
    found = table.select(F.col("code").alias("_code"), F.col("level").alias("_level"))
    joined = df.join(found, F.col(f"`{column}`") == F.col("_level"), "left")
    rows = joined.select(*[F.col("_code").alias(c) if c == column else F.col(f"`{c}`") for c in df.columns])
    return Categorical(rows, column, table, len(levels), ordered)


def _table(df: DataFrame, kind, pairs: list[tuple]) -> DataFrame:
    """The levels as a local table, so the planner knows its size and sends it to the rows."""
    return df.sparkSession.createDataFrame([(c, p, v) for p, (c, v) in enumerate(pairs)], f"code int, place int, level {kind.simpleString()}")
