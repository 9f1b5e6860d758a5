"""Ordered operators that hold when one key has a large share of all rows.

A plain window puts all rows of a key in one task. Here a key is cut along its order
instead, and the pieces are tied together again:

* `running` (frames from the first row): rows are put in chunks of near equal size along
  the order; each (key, chunk) is summed up by a partial aggregate; the small summary
  gives what came before a chunk; the rows then need a window inside their chunk only.
* `sliding` (frames of a few rows around the row): rows are numbered with `running`,
  put in blocks by number, and the rows at a block's edge are also sent to its neighbour.

For groups with a natural bound (lines of an order, turns of a talk) use a plain window.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

BLOCK_ROWS = 1_000_000
_KEY, _CHUNK, _SORT, _SUB = "_key", "_chunk", "_sort", "_sub"


SAMPLED = 10          # texts looked at for one bound
BOUND_CHARS = 1024    # of a text are kept in a bound


def _as_number(df: DataFrame, name: str) -> Column | None:
    """The order column as a double that never falls along it; None for a text."""
    kind = df.schema[name].dataType
    if isinstance(kind, NumericType):
        return F.col(name).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if isinstance(kind, StringType):
        return None
    raise TypeError(f"order column {name} is {kind.simpleString()}; give `chunk` for it")


def _number_cut(df: DataFrame, number: Column, pieces: int) -> tuple[list, bool]:
    """Bounds that cut the rows in even pieces, and whether nulls fill more than one."""
    points = [i / pieces for i in range(1, pieces)]
    picked = df.select(number.alias(_SORT), number.isNull().cast("double").alias(_SUB))
    # the bounds only even out the chunks, so a coarse error does no harm
    bounds, nulls = picked.approxQuantile([_SORT, _SUB], points, max(1 / (4 * pieces), 1e-4))
    return bounds, nulls.count(1.0) > 1


def _text_cut(df: DataFrame, name: str, pieces: int) -> tuple[list, bool]:
    """As `_number_cut`, from a sample of whole texts: some `SAMPLED` for a bound, whatever the table's size."""
    rows, filled = df.agg(F.count("*"), F.count(name)).first()
    wanted = SAMPLED * pieces
    texts = df.where(F.col(name).isNotNull()).select(F.substring(name, 1, BOUND_CHARS).alias(_SORT))
    seen = texts.sample(wanted / filled, seed=7) if filled > wanted else texts
    values = sorted((r[0] for r in seen.collect()), key=str.encode)
    bounds = [values[len(values) * i // pieces] for i in range(1, pieces)] if values else []
    return bounds, (rows - filled) * pieces > 2 * rows


def _place(value: Column, bounds: list) -> Column:
    """How many of the sorted bounds are at or below the value, found by halving; a null sorts first, so zero."""
    if not bounds:
        return F.lit(0).cast("bigint")
    held, steps = F.array(*map(F.lit, bounds)), [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def onward(at: Column, step: Column) -> Column:
        return F.when(F.coalesce(F.get(held, at + step - 1) <= value, F.lit(False)), at + step).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), onward).cast("bigint")


def _cut(df: DataFrame, number: Column, bounds: list[float], out: str) -> DataFrame:
    """Add the place of `number` among sorted bounds; a null sorts first, so it is place zero."""
    if not bounds:
        return df.withColumn(out, F.lit(0).cast("bigint"))
    cut = Bucketizer(
        splits=[float("-inf"), *bounds, float("inf")], inputCol=_SORT, outputCol=out, handleInvalid="keep"
    )
    numbered = df.withColumn(_SORT, F.coalesce(number, F.lit(float("-inf"))))
    return cut.transform(numbered).drop(_SORT).withColumn(out, F.col(out).cast("bigint"))


def with_chunks(df: DataFrame, order: Sequence[str], pieces: int | None = None, chunk: Column | None = None) -> DataFrame:
    """Add the chunk number, which never falls along `order`.

    The bounds come from a pass over the first order column (approximate quantiles of
    numbers and times, a sample of texts) and are then constants, so a recomputed task puts
    a row in the same chunk again. A value that fills more than one piece is seen by its
    repeated bound; its rows are then cut along the next order column, and so on. A text is
    compared whole; only one of more than `BOUND_CHARS` characters that fills pieces by
    itself is not cut further.
    """
    if chunk is not None:
        return df.withColumn(_CHUNK, chunk.cast("bigint"))
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if pieces < 2:
        return df.withColumn(_CHUNK, F.lit(0).cast("bigint"))
    width = pieces + 2
    out, crowded = df, None
    for depth, name in enumerate(order):
        if depth and width ** (depth + 1) >= 1 << 62:
            break
        try:
            number = _as_number(df, name)
        except TypeError:
            if depth:
                break
            raise
        rows = df if crowded is None else df.where(crowded)
        bounds, many_nulls = _text_cut(rows, name, pieces) if number is None else _number_cut(rows, number, pieces)
        distinct = sorted(set(bounds), key=str.encode if number is None else None)
        if number is None:
            out = out.withColumn(_SUB, _place(F.col(name), distinct))
        else:
            out = _cut(out, number, distinct, _SUB)
        # nulls go before all; inside a hot value's chunk the hot rows come first, then the greater values
        own = F.when(F.col(name).isNull(), F.lit(0)).otherwise(F.col(_SUB) + 1)
        if crowded is None:
            out = out.withColumn(_CHUNK, own)
        else:
            out = out.withColumn(_CHUNK, F.col(_CHUNK) * width + F.when(crowded, own).otherwise(F.lit(width - 1)))
        out = out.drop(_SUB)
        # a whole number past 2**53 has no double of its own, so equal doubles are not equal values there
        hot = [v for v, n in Counter(bounds).items() if n > 1 and (number is None or abs(v) < 2.0 ** 53)]
        if not (hot or many_nulls):
            break
        value = F.col(name) if number is None else number
        is_hot = value.isNull() | F.coalesce(value.isin(hot), F.lit(False)) if hot else value.isNull()
        crowded = is_hot if crowded is None else crowded & is_hot
    return out.withColumn(_CHUNK, F.col(_CHUNK).cast("bigint"))


def _sort_columns(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.desc(c) if descending else F.asc(c) for c in order]


class Running:
    """How one running value is made: in a chunk's summary, over summaries, and over rows."""

    def __init__(self, partial, fold, local, join, framed: bool = True):
        self.partial = partial  # aggregate over the rows of a chunk
        self.fold = fold        # aggregate over the summaries of earlier chunks
        self.local = local      # window value inside the chunk
        self.join = join        # (carried, local) -> value
        self.framed = framed    # False for rank functions, which take no frame


def _add(carried: Column, local: Column) -> Column:
    return F.coalesce(carried + local, carried, local)


def running_sum(column: str) -> Running:
    return Running(F.sum(column), F.sum, F.sum(column), _add)


def running_count(column: str = "*") -> Running:
    return Running(F.count(column), F.sum, F.count(column), _add)


def running_min(column: str) -> Running:
    return Running(F.min(column), F.min, F.min(column), F.least)


def running_max(column: str) -> Running:
    return Running(F.max(column), F.max, F.max(column), F.greatest)


def running_product(column: str) -> Running:
    return Running(
        F.product(column), F.product, F.product(column),
        lambda carried, local: F.coalesce(carried * local, carried, local),
    )


def row_number() -> Running:
    return Running(F.count("*"), F.sum, F.row_number(), _add, framed=False)


def rank() -> Running:
    """Rank with gaps: rows equal on the order columns share a chunk, so ties are never cut."""
    return Running(F.count("*"), F.sum, F.rank(), _add, framed=False)


def dense_rank(order: Sequence[str]) -> Running:
    return Running(F.count_distinct(F.struct(*order)), F.sum, F.dense_rank(), _add, framed=False)


def one_back(column: str) -> Running:
    """The value one row back, for the first column of the order: what came before a chunk is then its greatest."""
    return Running(
        F.max(column), F.max, F.lag(column, 1),
        lambda carried, local: F.coalesce(local, carried), framed=False,
    )


def last_value(column: str, order: Sequence[str], descending: bool = False) -> Running:
    """Last non-null value up to the row (`descending`: the next one from the row on)."""
    pick = F.min_by if descending else F.max_by
    seen = F.when(F.col(column).isNotNull(), F.struct(*order))
    return Running(
        pick(column, seen),
        lambda c: F.last(c, ignorenulls=True),
        F.last(column, ignorenulls=True),
        lambda carried, local: F.coalesce(local, carried),
    )


def cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int | None = None,
        chunk: Column | None = None) -> DataFrame:
    """The rows with the key and the chunk that `along` works by; both never change, so several passes share one shuffle."""
    # a struct is equal to another when their fields are, null fields included
    return with_chunks(df, order, pieces, chunk).withColumn(_KEY, F.struct(*keys) if keys else F.struct(F.lit(0)))


def along(
    chunked: DataFrame,
    order: Sequence[str],
    values: dict[str, Running],
    *,
    onward: dict[str, Running] | None = None,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Add values to a frame of `cut`, which keeps its key and chunk for the next pass.

    `values` go from the key's first row to this one, `onward` from the key's last row back
    to this one, both in `order`; `totals` as in `running`.
    """
    onward, totals = onward or {}, totals or {}
    passes = [(values, False), (onward, True)]
    summary = chunked.groupBy(_KEY, _CHUNK).agg(
        *[v.partial.alias(f"_p_{name}") for named, _ in passes for name, v in named.items()],
        *[total.alias(f"_t_{name}") for name, total in totals.items()],
    )
    # at most `pieces` summary rows per key
    every = Window.partitionBy(_KEY).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried, local, joined = [], [], []
    for named, back in passes:
        passed = (Window.partitionBy(_KEY).orderBy(F.desc(_CHUNK) if back else F.asc(_CHUNK))
                  .rowsBetween(Window.unboundedPreceding, -1))
        inside = Window.partitionBy(_KEY, _CHUNK).orderBy(*_sort_columns(order, back))
        upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for name, v in named.items():
            carried.append(v.fold(F.col(f"_p_{name}")).over(passed).alias(f"_c_{name}"))
            local.append(v.local.over(upto if v.framed else inside).alias(f"_l_{name}"))
            joined.append(v.join(F.col(f"_c_{name}"), F.col(f"_l_{name}")).alias(name))
    carried += [F.sum(f"_t_{name}").over(every).alias(f"_t_{name}") for name in totals]
    out = chunked.select("*", *local).join(summary.select(_KEY, _CHUNK, *carried), [_KEY, _CHUNK])
    return out.select(*chunked.columns, *joined, *[F.col(f"_t_{name}").alias(name) for name in totals])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, Running],
    *,
    descending: bool = False,
    onward: dict[str, Running] | None = None,
    totals: dict[str, Column] | None = None,
    pieces: int | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Add values over all rows from the key's first to this one, in `order`.

    With `descending` they go from the key's last row back to this one; `onward` are values
    that do so beside the others, by the same shuffle. `totals` are extra aggregates over the
    whole key that combine by `sum`, such as its row count. Cost: one scan of the order
    column, one shuffle of the rows, and a join with the (key, chunk) summary that uses the
    same shuffle.
    """
    if descending:
        values, onward = onward or {}, values
    chunked = cut(df, keys, order, pieces, chunk)
    names = [*values, *(onward or {}), *(totals or {})]
    return along(chunked, order, values, onward=onward, totals=totals).select(*df.columns, *names)


def sliding(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    after: int,
    values: Callable[[Window], dict[str, Column]],
    *,
    block_rows: int = BLOCK_ROWS,
    pieces: int | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Add values that look at most `before` rows back and `after` rows on, in `order`.

    `values` gets the window (partitioned and sorted, no frame) and gives name -> Column.
    `order` must be total, so that numbering the rows twice gives the same numbers.
    """
    block_rows = max(block_rows, before, after, 1)
    numbered = running(df, keys, order, {"_pos": row_number()}, pieces=pieces, chunk=chunk)
    numbered = numbered.withColumn("_block", F.floor((F.col("_pos") - 1) / block_rows))
    offset = F.pmod(F.col("_pos") - 1, F.lit(block_rows))
    homes = F.array(
        F.lit(0),
        *([F.when(offset >= block_rows - before, F.lit(1))] if before else []),
        *([F.when(offset < after, F.lit(-1))] if after else []),
    )
    spread = numbered.withColumn("_move", F.explode(F.array_compact(homes)))
    spread = spread.withColumn("_block", F.col("_block") + F.col("_move"))
    window = Window.partitionBy(*keys, "_block").orderBy("_pos")
    added = values(window)
    out = spread.select("*", *[c.alias(n) for n, c in added.items()]).where(F.col("_move") == 0)
    return out.select(*df.columns, *added)


def shifted(df, keys, order, columns: dict[str, tuple[str, int]], default=None, **options) -> DataFrame:
    """Add `name: (column, n)`: the value n rows back, or -n rows on when n is negative."""
    back = max([n for _, n in columns.values() if n > 0], default=0)
    on = max([-n for _, n in columns.values() if n < 0], default=0)

    def values(window):
        return {
            name: F.lag(c, n, default).over(window) if n >= 0 else F.lead(c, -n, default).over(window)
            for name, (c, n) in columns.items()
        }

    return sliding(df, keys, order, back, on, values, **options)


def rolling(df, keys, order, width: int, aggregates: dict[str, Column], min_periods: int | None = None,
            counted: str | None = None, **options) -> DataFrame:
    """Aggregates over the last `width` rows; null while fewer than `min_periods` values are there."""
    need = width if min_periods is None else min_periods

    def values(window):
        frame = window.rowsBetween(-(width - 1), 0)
        filled = F.count(counted or "*").over(frame)
        return {name: F.when(filled >= need, agg.over(frame)) for name, agg in aggregates.items()}

    return sliding(df, keys, order, width - 1, 0, values, **options)


def fill(df, keys, order, columns: Sequence[str], *, backward: bool = False, limit: int | None = None,
         suffix: str = "_filled", **options) -> DataFrame:
    """Fill nulls from the last earlier value (or the next later one), at most `limit` rows away."""
    if limit is not None:
        def values(window):
            frame = window.rowsBetween(0, limit) if backward else window.rowsBetween(-limit, 0)
            pick = F.first if backward else F.last
            return {f"{c}{suffix}": pick(c, ignorenulls=True).over(frame) for c in columns}

        return sliding(df, keys, order, 0 if backward else limit, limit if backward else 0, values, **options)
    return running(
        df, keys, order,
        {f"{c}{suffix}": last_value(c, order, descending=backward) for c in columns},
        descending=backward, **options,
    )


def ranked(df, keys, order: str, ties: Sequence[str] | None = None, **options) -> DataFrame:
    """Add every pandas rank of `order` within the key: first, min, max, average, dense and pct, and the key's size.

    The ranks are made over the distinct values with their counts, so a value that many
    rows share is one row by then; `ties` (unique) settle the `first` rank inside a value.
    A row with a null value or a null key has null ranks; every row stays.
    """
    ranks = F.lit(True)
    for c in [order, *keys]:
        ranks = ranks & F.col(c).isNotNull()
    valid = df.where(ranks)
    values = valid.groupBy(*keys, order).agg(F.count("*").alias("_tie"))
    placed = running(
        values, keys, [order], {"rank_max": running_sum("_tie"), "rank_dense": row_number()},
        totals={"_rows": F.sum("_tie")}, **options,
    )
    inside = valid if ties is None else running(valid, [*keys, order], list(ties), {"_nth": row_number()}, **options)
    out = inside.join(placed, [*keys, order])
    least = F.col("rank_max") - F.col("_tie") + 1
    average = least + (F.col("_tie") - 1) / 2
    out = out.select(
        *df.columns, *([] if ties is None else [(least + F.col("_nth") - 1).alias("rank_first")]), least.alias("rank_min"), "rank_max",
        average.alias("rank_average"), "rank_dense", (average / F.col("_rows")).alias("rank_pct"),
        F.col("_rows").alias("rank_size"),
    )
    return out.unionByName(df.where(~ranks), allowMissingColumns=True)


def global_position(df: DataFrame, order: Sequence[str], name: str = "position", **options) -> DataFrame:
    """Number all rows from zero in a total order, without one task seeing them all."""
    out = running(df, [], order, {name: row_number()}, **options)
    return out.withColumn(name, F.col(name) - 1)
