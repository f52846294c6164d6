"""Exact quantiles of whole tables without gathering them: a rank is found in one of many cells of values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells that the distinct values are dealt into, by approximate quantiles.
CELLS = 256


def exact_quantiles(df: DataFrame, values: dict[str, Column], shares: list[float]) -> dict[str, list[float | None]]:
    """For each named value, its quantiles, interpolated between neighbours; missing values don't count.

    One pass counts distinct values. The driver sees the cells' counts and, for the cells that hold a wanted rank,
    the value there; a task ranks one cell.
    """
    named = list(values)
    pairs = F.explode(F.array(*(F.struct(F.lit(i).alias("c"), values[n].cast("double").alias("v")) for i, n in enumerate(named))))
    counts = df.select(pairs.alias("x")).where("x.v IS NOT NULL").groupBy("x.c", "x.v").agg(F.count(F.lit(1)).alias("n")).persist()
    try:
        cuts = [i / CELLS for i in range(1, CELLS)]
        edges = {r.c: sorted(set(r.e)) for r in counts.groupBy("c").agg(F.percentile_approx("v", cuts, 10_000).alias("e")).collect()}
        if not edges:
            return {n: [None] * len(shares) for n in named}
        cell = F.lit(0)
        for c, e in edges.items():
            own = F.array(*map(F.lit, e))
            cell = F.when(F.col("c") == c, F.size(F.filter(own, lambda x: x < F.col("v")))).otherwise(cell)  # noqa: B023
        dealt = counts.withColumn("cell", cell)
        sizes: dict[int, list[tuple[int, int]]] = {}
        for r in dealt.groupBy("c", "cell").agg(F.sum("n").alias("n")).orderBy("c", "cell").collect():
            sizes.setdefault(r.c, []).append((r.cell, r.n))
        wanted = []
        for c, cells in sizes.items():
            total = sum(n for _, n in cells)
            for s in shares:
                for rank in {math.floor(s * (total - 1)), math.ceil(s * (total - 1))}:
                    before = 0
                    for k, n in cells:
                        if rank < before + n:
                            wanted.append((c, k, rank, rank - before))
                            break
                        before += n
        asked = df.sparkSession.createDataFrame(wanted, "c int, cell int, rank bigint, place bigint")
        held = dealt.join(F.broadcast(asked.select("c", "cell").distinct()), ["c", "cell"], "left_semi")
        ended = held.withColumn("end", F.sum("n").over(Window.partitionBy("c", "cell").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
        found = ended.join(F.broadcast(asked), ["c", "cell"]).where("end > place").groupBy("c", "rank").agg(F.min("v").alias("v")).collect()
        at = {(r.c, r["rank"]): r.v for r in found}
        out: dict[str, list[float | None]] = {}
        for c, n in enumerate(named):
            total = sum(k for _, k in sizes.get(c, []))
            places = [s * (total - 1) for s in shares] if total else []
            out[n] = [at[c, math.floor(p)] if p == math.floor(p) else (math.ceil(p) - p) * at[c, math.floor(p)] + (p - math.floor(p)) * at[c, math.ceil(p)] for p in places] or [None] * len(shares)
        return out
    finally:
        counts.unpersist()
