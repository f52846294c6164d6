"""Sharding by longest-processing-time scheduling of groups that must stay together.

Groups (here: equal texts) are taken by size, the largest first, and each goes to the shard with
the least load, kept in a heap. Groups of one size are alike to that law, so what the heap needs is
how many groups there are of each size, and what it gives is how many of them each shard takes. Both
are one row a size: distinct sizes add up to no more than all bytes, so they are fewer than the root of
twice the bytes (14 million for 100 TB, were every size there). A run of equal groups is dealt in one
step, to the level that it fills. Which groups of a size go where is their rank among them, counted by
cells, so that a size that many groups have isn't gathered anywhere.

Rows get the shard of their group by its hash; groups with at least 1/``HOT`` of all rows (so at most
``HOT``) by a broadcast. Slots are gapless within a shard without gathering a shard anywhere: rows are
dealt to (shard, cell), counted per cell, and numbered from the running sum of the cells before.

Defined results: a null text has size 1, the checksum of no bytes, and shares the group of empty
texts; repeated rows and null or repeated ids each get a slot of their own; an empty table gives
an empty table. A group larger than an even share overfills its shard, as it may not be split.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weftline.llm.runtime import settle

HOT = 4096
#: Rows or groups that a cell holds, about.
CELL = 1 << 14
#: Tables of at most so many short rows are broadcast, larger ones are joined as the planner likes.
SMALL = 1 << 14


def longest_first(runs: list[tuple[int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """For each (size, groups), the largest first: how many of its groups every shard takes.

    As if each group went to the least-loaded shard (ties to the lowest) in turn.
    """
    loads, out = [0] * shards, []
    for size, n in sorted(runs, reverse=True):
        got = [0] * shards
        if n > 2 * shards:
            # A shard is given groups as long as its load is under the level: the highest level that n groups suffice for.
            under = lambda level: sum(max(0, -((load - level) // size)) for load in loads)  # noqa: B023, E731
            low, high = min(loads), min(loads) + size * n + 1
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if under(middle) <= n else (low, middle)
            got = [max(0, -((load - low) // size)) for load in loads]
        heap = [(load + size * g, s) for s, (load, g) in enumerate(zip(loads, got, strict=True))]
        heapq.heapify(heap)
        for _ in range(n - sum(got)):
            load, s = heap[0]
            heapq.heapreplace(heap, (load + size, s))
            got[s] += 1
        loads = [load + size * g for load, g in zip(loads, got, strict=True)]
        out.append((size, got))
    return out


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL else df


def numbered(rows: DataFrame, within: str, order: list, cells: int, name: str) -> DataFrame:
    """Adds ``name``: the rows' gapless numbers from 0 within each value of ``within``; rows are dealt to cells first."""
    # Whatever repeats, rows of one value are spread: the table is written before it is read twice.
    rows = settle(rows.withColumn("cell", F.pmod(F.xxhash64(*order, F.monotonically_increasing_id()), F.lit(cells)).cast("int")), f"shard-{name}")
    counts = rows.groupBy(within, "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(within).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    counts = settle(counts.select(within, "cell", F.coalesce(before, F.lit(0)).alias("before")), f"shard-{name}-cells")
    place = F.row_number().over(Window.partitionBy(within, "cell").orderBy(*order)) - 1
    return rows.withColumn("place", place).join(_small(counts, counts.count()), [within, "cell"]).withColumn(name, F.col("before") + F.col("place")).drop("cell", "place", "before")


def placed_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(grp, rows, shard) of groups (grp, bytes, rows)."""
    runs = [(r.bytes, r.n) for r in groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()]
    dealt = longest_first(runs, shards)
    # The ranks at which each shard's groups of a size end.
    ends = np.array([np.cumsum(got) for _, got in dealt], np.int64).reshape(len(dealt), shards)
    sizes = groups.sparkSession.createDataFrame([(size, row) for (size, _), row in zip(dealt, ends.tolist(), strict=True)], "bytes bigint, ends array<bigint>")
    ranked = numbered(groups, "bytes", ["grp"], max(1, -(-sum(n for _, n in runs) // CELL)), "rank")
    shard = F.size(F.filter("ends", lambda e: e <= F.col("rank")))
    return ranked.join(_small(sizes, len(dealt)), "bytes").select("grp", "rows", shard.cast("int").alias("shard"))


def shard_by_bytes(docs: DataFrame, shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, law ('bytes'), shard, slot and grown_shard (null under this law) of every row."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    sized = docs.select(F.col(id_col).alias("id"), (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long") + 1).alias("size"), F.crc32(raw).alias("text_crc32"), F.unhex(F.sha2(raw, 256)).alias("grp"))
    sized = settle(sized, "shard-sizes")
    groups = settle(sized.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "shard-groups")
    total = groups.agg(F.sum("rows")).first()[0] or 0
    placed = settle(placed_groups(groups, shards), "shard-places")
    # At most HOT rows, by what hot means.
    hot = F.broadcast(placed.where(F.col("rows") * HOT >= total).select("grp", "shard"))
    rows = sized.join(hot, "grp").union(sized.join(hot, "grp", "left_anti").join(placed.select("grp", "shard"), "grp"))
    out = numbered(rows.select("id", "size", "text_crc32", "shard"), "shard", ["id", "text_crc32", "size"], max(1, -(-total // (shards * CELL))), "slot")
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast(T.IntegerType()).alias("grown_shard"))
