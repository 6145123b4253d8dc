"""Consecutive numbers within a group of any size, without collecting the group."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from topicwright.operators.islands import last_at_most
from topicwright.operators.offsets import local_table

# So many bytes and rows are sorted together at most, but for a single row that is larger.
BLOCK_BYTES = 128 << 20
BLOCK_ROWS = 1 << 20
# Parts that a block which is too large is cut into, for each block that it should become.
PARTS = 4
# Above this many blocks (16 bytes each and a group's name) their table is no longer hinted for broadcast.
BROADCAST_BLOCKS = 1_000_000


class Block(NamedTuple):
    """Rows of a group whose order values lie from ``low`` to ``high``."""

    low: int
    high: int
    bytes: int
    rows: int


def blocks_of(
    df: DataFrame, by: list[str], order: str, size: Column, block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS
) -> dict[tuple, list[Block]]:
    """Each group's blocks in order, with no more bytes and rows than allowed, however its order values are spread.

    One pass sums up the groups. Those that are too large are cut into equal ranges of order values; each range keeps
    only the span that its values fill, and those that are still too large are cut again, in one more pass for all of them.
    Then neighbouring ranges are put together as far as they fit. The driver holds some PARTS ranges a block.
    """
    value = F.col(order).cast("bigint")
    rows = df.select(*by, value.alias("_order"), size.cast("bigint").alias("_size"))
    totals = [F.min("_order").alias("low"), F.max("_order").alias("high"), F.sum("_size").alias("bytes"), F.count("*").alias("rows")]

    def too_large(block: Block) -> bool:
        return block.low < block.high and (block.bytes > block_bytes or block.rows > block_rows)

    groups = {tuple(row[: len(by)]): [Block(*row[len(by) :])] for row in rows.groupBy(*by).agg(*totals).collect()}
    while pending := {group: large for group, blocks in groups.items() if (large := sorted(filter(too_large, blocks)))}:
        cuts = {group: [(b.low, b.high, _shift(b, block_bytes, block_rows)) for b in large] for group, large in pending.items()}
        lists = [(*group, *map(list, zip(*cut))) for group, cut in cuts.items()]
        table = F.broadcast(_lists(df, by, lists, ["_lows", "_highs", "_shifts"]))
        most = max(len(cut) for cut in cuts.values())
        placed = rows.join(table, by).withColumn("_place", last_at_most(F.col("_lows"), F.col("_order"), most))
        placed = placed.filter((F.col("_place") >= 0) & (F.col("_order") <= F.get("_highs", F.col("_place"))))
        low, shift = F.get("_lows", F.col("_place")), F.get("_shifts", F.col("_place")).cast("int")
        # Halved, as the distance of any two order values is then a bigint.
        half = F.shiftright("_order", 1) - F.shiftright(low, 1)
        part = F.when(shift == 0, F.col("_order") - low).otherwise(F.call_function("shiftright", half, shift - 1)).alias("_part")
        for group in pending:
            groups[group] = [b for b in groups[group] if not too_large(b)]
        for row in placed.groupBy(*by, "_place", part).agg(*totals).collect():
            groups[tuple(row[: len(by)])].append(Block(*row[len(by) + 2 :]))
    return {group: _put_together(sorted(blocks), block_bytes, block_rows) for group, blocks in groups.items()}


def _shift(block: Block, block_bytes: int, block_rows: int) -> int:
    """Bits of an order value, counted from the block's first one, that lie within a part of it."""
    parts = PARTS * max(-(-block.bytes // block_bytes), -(-block.rows // block_rows))
    return max(0, (block.high - block.low).bit_length() - parts.bit_length())


def _put_together(blocks: list[Block], block_bytes: int, block_rows: int) -> list[Block]:
    out: list[Block] = []
    for block in blocks:
        last = out[-1] if out else None
        if last and last.bytes + block.bytes <= block_bytes and last.rows + block.rows <= block_rows:
            out[-1] = Block(last.low, block.high, last.bytes + block.bytes, last.rows + block.rows)
        else:
            out.append(block)
    return out


def _lists(df: DataFrame, by: list[str], rows: list[tuple], names: list[str]) -> DataFrame:
    """A row for each group, with lists of numbers."""
    keys = [(c, to_arrow_type(df.schema[c].dataType)) for c in by]
    schema = pa.schema([*keys, *[(name, pa.list_(pa.int64())) for name in names]])
    return local_table(df.sparkSession, rows, schema)


def number_rows(
    df: DataFrame,
    by: list[str],
    order: str,
    name: str,
    first: Mapping[tuple, int] | None = None,
    size: Column | None = None,
    block_bytes: int = BLOCK_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Number the rows of each ``by`` group 0, 1, 2, ... in ascending ``order``.

    ``order`` is an integer column that is unique within a group; equal values fail the run. Rows are numbered inside
    blocks of at most ``block_bytes``, as ``size`` gives them, and ``block_rows``, so that no window holds more however
    large the group is and however its order values are spread. The payload is shuffled once, on (group, block).

    ``first`` holds the number that each group starts from.
    """
    blocks = blocks_of(df, by, order, F.lit(0) if size is None else size, block_bytes, block_rows)
    lists = []
    for group, own in blocks.items():
        starts, at = [], (first or {}).get(group, 0)
        for block in own:
            starts.append(at)
            at += block.rows
        lists.append((*group, [b.low for b in own], starts))
    table = _lists(df, by, lists, ["_lows", "_starts"])
    if sum(len(own) for own in blocks.values()) <= BROADCAST_BLOCKS:
        table = F.broadcast(table)
    order_value = F.col(order).cast("bigint")
    most = max((len(own) for own in blocks.values()), default=1)
    placed = df.join(table, by, "left").withColumn("_place", last_at_most(F.col("_lows"), order_value, most))
    placed = placed.select(*df.columns, "_place", F.get("_starts", F.col("_place")).alias("_start"))
    in_block = Window.partitionBy(*by, "_place").orderBy(order_value)
    again = F.raise_error(F.concat(F.lit(f"Twice the same {order}: "), order_value.cast("string"))).cast("int")
    row = F.when(F.lag(order_value).over(in_block) == order_value, again).otherwise(F.row_number().over(in_block))
    return placed.select("*", row.alias("_row")).select(*df.columns, (F.col("_start") + F.col("_row") - 1).alias(name))
