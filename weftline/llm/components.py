"""Connected components of an edge table by alternating large-star and small-star contraction, or in one task if it is small."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from weftline.llm.runtime import release, settle

#: Edges that are few enough for one task, which spares them the rounds.
FEW = 1 << 16


def _at_once(edges: DataFrame) -> DataFrame:
    """The components of few edges, in one task."""
    kind = to_arrow_type(edges.schema["u"].dataType)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(u), find(v)
                parent[max(a, b)] = min(a, b)
        rows = [(x, root) for x in parent if (root := find(x)) != x]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], kind), pa.array([root for _, root in rows], kind)], ["u", "v"])

    return settle(edges.coalesce(1).mapInArrow(unite, edges.schema), "edges")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least.select(F.col("u").alias("k"), "m"), F.col("u") == F.col("k")).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node reachable from node; roots themselves have no row.

    ``edges`` has two columns u and v of one ordered type. The number of rows never grows, each
    round is written to the shared folder in place of the last, and the rounds go as the logarithm of the
    longest path. Up to ``FEW`` edges are united in one task instead: their rounds would be all overhead.
    """
    now = settle(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    held = mark(now)
    if 0 < held[0] <= FEW and isinstance(now.schema["u"].dataType, (T.IntegralType, T.DecimalType, T.StringType)):
        now, before = _at_once(now), now
        release(before)
        held = (0,)
    while held[0]:
        now, before = settle(_small_star(_large_star(now)), "edges"), now
        release(before)
        if (new := mark(now)) == held:
            break
        held = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
