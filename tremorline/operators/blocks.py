"""Row numbers per key that do not need one task per key.

``row_number() over (partition by key ...)`` sorts everything a key has in one task. One sensor may hold a
third of the data, so keys with more than ``block_rows`` rows are cut into *blocks* first:

1. count rows per key; only crowded keys go on, usually a handful;
2. cut the order range of each crowded key into cells, and crowded cells again, until every cell is small
   (the cuts are arithmetic on the order columns, so any recomputation yields the same cells);
3. a running sum of the cell counts tells which rows, by position, each cell holds, hence which block(s) it
   belongs to and the position at which each block starts;
4. a row's position is its block's start plus its row number inside the block.

The raw rows are shuffled once, by (key, block). A cell that reaches over the end of a block is sent to both
blocks, and positions outside a block are dropped after numbering, so blocks end exactly where asked. What
is joined to the rows is about one entry per cell of a crowded key; it is broadcast only below a checked
size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorline.session import cut_lineage

BLOCK_ROWS = 4_000_000
CELLS_PER_BLOCK = 8
BROADCAST_ROWS = 1_000_000
LAST_CELL = 1 << 62


@dataclass(frozen=True)
class Cells:
    """Rows with their cell columns, and one row per cell of the crowded keys."""

    rows: DataFrame
    keys: list[str]
    cells: DataFrame
    n_cells: int


def broadcast_if_small(df: DataFrame, n_rows: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= BROADCAST_ROWS else df


def join_cells(rows: DataFrame, entries: DataFrame, n_entries: int, keys: list[str]) -> DataFrame:
    """Left join of rows with entries that are unique per key and cell; a missing key equals itself."""
    same = [f"rows.`{keys[0]}` <=> entry.`{keys[0]}`", *[f"rows.{k} = entry.{k}" for k in keys[1:]]]
    joined = rows.alias("rows").join(
        broadcast_if_small(entries, n_entries).alias("entry"), F.expr(" AND ".join(same)), "left"
    )
    return joined.select("rows.*", *[f"entry.{c}" for c in entries.columns if c not in keys])


def _axis(df: DataFrame, name: str, descending: bool) -> Column:
    """An order column as a number that grows, never falls, in sort order.

    Doubles cannot overflow; where they round large ids, neighbours share a cell, which is harmless.
    """
    is_time = isinstance(df.schema[name].dataType, T.TimestampType)
    value = (F.unix_micros(name) if is_time else F.col(name)).cast("double")
    return -value if descending else value


def split_crowded_keys(
    rows: DataFrame,
    key: str,
    major: Column,
    minor: Column,
    key_limit: int,
    cell_rows: int,
    extra: list[Column] | None = None,
    nulls_last: bool = False,
    tie: Column | None = None,
) -> Cells | None:
    """Cut the keys with more than ``key_limit`` rows into cells of about ``cell_rows`` rows.

    A cell of more than twice that is cut again, so sizes hold however unevenly the rows are spread; only
    rows equal in both order columns, and in ``tie`` where given, can leave a larger one. ``major`` and ``minor`` are the
    order columns as doubles; nulls sort first, or last if told so. ``extra`` are aggregates to compute per cell. Returns None when no key is
    crowded.
    """
    counts = [
        F.count(F.lit(1)).alias("_n"),
        F.min(major).alias("_lo1"),
        F.max(major).alias("_hi1"),
        F.min(minor).alias("_lo2"),
        F.max(minor).alias("_hi2"),
        F.min(tie if tie is not None else F.lit(0.0)).alias("_lo3"),
        F.max(tie if tie is not None else F.lit(0.0)).alias("_hi3"),
    ]
    by_major = F.coalesce(F.col("_hi1") > F.col("_lo1"), F.lit(False))
    by_minor = F.coalesce(F.col("_hi2") > F.col("_lo2"), F.lit(False))
    by_tie = F.coalesce(F.col("_hi3") > F.col("_lo3"), F.lit(False))
    #: The first axis on which the rows of a cell differ.
    axis = F.when(by_major, 1).when(by_minor, 2).otherwise(3)

    def on_axis(axis: Column, one: Column, two: Column, three: Column) -> Column:
        return F.when(axis == 1, one).when(axis == 2, two).otherwise(three)

    def crowded(limit: int) -> Column:
        return (F.col("_n") > limit) & (by_major | by_minor | by_tie)

    def cuts(stats: DataFrame, keys: list[str], limit: int) -> DataFrame:
        parts = F.greatest(F.lit(16), F.ceil(F.col("_n") / F.lit(cell_rows)))
        spans = [F.col(f"_hi{i}") - F.col(f"_lo{i}") for i in (1, 2, 3)]
        span = on_axis(axis, *spans) + 1
        return stats.where(crowded(limit)).select(
            *keys,
            axis.alias("_axis"),
            on_axis(axis, *[F.col(f"_lo{i}") for i in (1, 2, 3)]).alias("_origin"),
            F.ceil(span / parts).cast("double").alias("_width"),
        )

    keys = [key]
    rule = cut_lineage(cuts(rows.groupBy(key).agg(*counts), keys, key_limit))
    n_cuts = rule.count()
    if n_cuts == 0:
        return None
    while n_cuts:
        name = f"_cell{len(keys)}"
        offset = on_axis(F.col("_axis"), major, minor, tie if tie is not None else F.lit(0.0)) - F.col("_origin")
        cell = F.when(
            F.col("_axis").isNotNull(),
            F.coalesce(F.floor(offset / F.col("_width")).cast("bigint"), F.lit(LAST_CELL if nulls_last else -1).cast("bigint")),
        )
        rows = (
            join_cells(rows, rule, n_cuts, keys)
            .withColumn(name, F.coalesce(cell, F.lit(0).cast("bigint")))
            .withColumn("_crowded", F.col("_axis").isNotNull() if len(keys) == 1 else F.col("_crowded"))
            .drop("_axis", "_origin", "_width")
        )
        keys = [*keys, name]
        cells = cut_lineage(rows.where("_crowded").groupBy(*keys).agg(*counts, *(extra or [])))
        rule = cuts(cells, keys, 2 * cell_rows)
        n_cells, n_cuts = cells.agg(F.count(F.lit(1)), F.count_if(crowded(2 * cell_rows))).first()
    return Cells(rows.drop("_crowded"), keys, cells, n_cells)


def row_order(rows: DataFrame, key: str, order: tuple[str, ...], descending: bool, ties: tuple[str, ...] = ()) -> list[Column]:
    """The order of a key's rows: by ``order``, then ``ties``, then a hash of the other columns and these themselves.

    So rows that are equal in the order columns have one order whatever path numbers them; rows equal in all are interchangeable.
    """
    named = [F.col(n).desc_nulls_last() if descending else F.col(n).asc_nulls_first() for n in (*order, *ties)]
    rest = [F.col(n) for n in rows.columns if n not in (key, *order, *ties)]
    # Where ``ties`` are given the hash would not follow them, and is not needed.
    return named + ([F.xxhash64(*rest)] if rest and not ties else []) + rest


def number_rows(
    rows: DataFrame,
    key: str = "device_id",
    order: tuple[str, str] = ("ts", "seq"),
    descending: bool = False,
    hop: int = 1,
    reach: int = 0,
    first: int | None = None,
    block_rows: int | None = None,
    ties: tuple[str, ...] = (),
) -> tuple[DataFrame, list[str], int]:
    """Add ``pos``, the 0-based position of a row within its key.

    Returns the rows, the columns they are partitioned by (the key, and ``block`` if any key was cut) and
    the block length, a multiple of ``hop``. With ``reach`` > 0 each block also repeats the ``reach``
    positions before it, so that frames ending in a block are complete inside it. ``first`` keeps only the
    first so many positions and skips the blocks beyond them before the shuffle. ``ties`` order rows that are equal in
    ``order``; rows equal in these too have the order of ``row_order``, with blocks as without. Descending order is the exact
    reverse of ascending in the named columns: missing values come last.

    By default blocks hold ``BLOCK_ROWS`` rows, or more in a table so large that their entries would
    otherwise become too many to broadcast (40 million rows each in a table of 2.5 trillion).
    """
    placed, keys, length, ordering = _placed(rows, key, order, descending, hop, reach, first, block_rows, ties)
    if "block" not in keys:
        position = F.row_number().over(W.partitionBy(key).orderBy(*ordering)).cast("bigint") - 1
        numbered = placed.withColumn("pos", position)
        return (numbered if first is None else numbered.where(F.col("pos") < first)), keys, length
    row_number = F.row_number().over(W.partitionBy(*keys).orderBy(*ordering))
    begin = F.col("block") * length
    numbered = (
        placed.withColumn("pos", F.col("_start") + row_number - 1)
        .where((F.col("pos") >= begin - reach) & (F.col("pos") < begin + length))
        .drop("_start")
    )
    return (numbered if first is None else numbered.where(F.col("pos") < first)), keys, length


def sorted_runs(
    rows: DataFrame,
    key: str = "device_id",
    order: tuple[str, str] = ("ts", "seq"),
    hop: int = 1,
    reach: int = 0,
    block_rows: int | None = None,
) -> tuple[DataFrame, list[str], int]:
    """The rows of ``number_rows`` before numbering, each key's (and block's) run in order in one partition.

    For reducers that read runs one after another. Where a key was cut, ``_start`` is the position of a run's first row, and a run
    may hold rows outside its block: those before ``block * length - reach`` and from ``(block + 1) * length`` on.
    """
    placed, keys, length, ordering = _placed(rows, key, order, False, hop, reach, None, block_rows, ())
    return placed.repartition(*keys).sortWithinPartitions(*keys, *ordering), keys, length


def _placed(
    rows: DataFrame,
    key: str,
    order: tuple[str, str],
    descending: bool,
    hop: int,
    reach: int,
    first: int | None,
    block_rows: int | None,
    ties: tuple[str, ...],
) -> tuple[DataFrame, list[str], int, list[Column]]:
    """Rows with the block(s) that need them and the position of each block's first row, if any key has to be cut."""
    total = rows.count()
    if block_rows is None:
        block_rows = max(BLOCK_ROWS, -(-total * 2 * CELLS_PER_BLOCK // BROADCAST_ROWS))
    length = -(-block_rows // hop) * hop
    major, minor = (_axis(rows, name, descending) for name in order)
    ordering = row_order(rows, key, order, descending, ties)
    # A table that fits one block as a whole cannot have a crowded key; Parquet footers answer this.
    split = None
    if total > length:
        rest = [F.col(n) for n in rows.columns if n not in (key, *order, *ties)]
        # Rows equal so far are told apart by a hash of the other columns, so that many of them make several cells;
        # not where ``ties`` order them, which a hash would not follow.
        tie = F.xxhash64(*rest).cast("double") if rest and not ties else None
        cell_rows = max(1, block_rows // CELLS_PER_BLOCK)
        split = split_crowded_keys(rows, key, major, minor, length, cell_rows, nulls_last=descending, tie=tie)
    if split is None:
        return rows, [key], length, ordering

    # A cell reaches into one more block at most, unless the rows before a block exceed its length.
    n_entries = split.n_cells * (2 + reach // length)
    placement = _blocks_of_cells(split, key, length, reach)
    placed = (
        join_cells(split.rows, placement, n_entries, split.keys)
        .drop(*split.keys[1:])
        .withColumn("block", F.coalesce("block", F.lit(0).cast("bigint")))
        .withColumn("_start", F.coalesce("_start", F.lit(0).cast("bigint")))
    )
    if first is not None:
        placed = placed.where(F.col("block") * length < first)
    return placed, [key, "block"], length, ordering


def _blocks_of_cells(split: Cells, key: str, length: int, reach: int) -> DataFrame:
    """For every cell the block(s) that need it and the position of the block's first delivered row."""
    by_key = W.partitionBy(key)
    before = by_key.orderBy(*split.keys[1:]).rowsBetween(W.unboundedPreceding, W.currentRow)
    spans = split.cells.select(
        *split.keys,
        (F.sum("_n").over(before) - F.col("_n")).alias("_from"),
        F.sum("_n").over(before).alias("_to"),
        F.sum("_n").over(by_key).alias("_total"),
    )
    last = F.least(
        F.floor((F.col("_to") - 1 + reach) / length), F.floor((F.col("_total") - 1) / length)
    )
    return spans.select(
        *split.keys,
        "_from",
        F.explode(F.sequence(F.floor(F.col("_from") / length), last)).alias("block"),
    ).select(
        *split.keys,
        "block",
        F.min("_from").over(W.partitionBy(key, "block")).alias("_start"),
    )
