"""Exact top-k search by exhaustive term-at-a-time accumulation over blocks of postings.

Vectors become integers floor(scale * x); a dimension is a term. Candidates are laid out in
blocks of ``BLOCK`` rows, each a set of posting lists: for each dimension, the rows with a nonzero
weight and their weights. A sparse query row scatters weight * posting into a dense score array
over the block, one term after another, for all the queries of a query block at once. A partition
selection keeps each query's best k of a block and merges them with the best so far; what a task
kept is merged once more over all tasks.

Queries are taken in turns of at most ``TURN`` cells. A turn is broadcast, and every task holds it
against the candidate blocks that it reads: no candidate is copied or shuffled, no pair of rows is made, and
what a task or the driver holds has a bound for any number of queries. Candidates are read once a turn.

Defined results: vectors that are null, or hold a null or a non-finite component, or differ in
length from their query take no part; ties go to the smaller id; rows with a null id are neither
queries nor candidates; repeated rows of one id are all candidates, and none is a candidate of its
own id's query, which is asked once for each distinct vector; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.llm.runtime import settle, small_batches

BLOCK = 1024
QUERIES = 512
#: Components of the queries of a turn: 16 MB at two bytes each.
TURN = 1 << 23
#: Cells are kept in the narrowest of these that holds a block's values.
KINDS = ("<i2", "<i4", "<i8")


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id bigint, v array<int>): floor(scale * x) of the vectors that take part."""
    x = F.col(vector_col)
    # JVM-side; a component over 2^31 / scale would overflow, so such values stay long.
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))
    sound = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & sound).select(F.col(id_col).cast("bigint").alias("id"), whole.alias("v"))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks (block, n, dim, kind, ids, cells): up to ``size`` rows of one length each, made where the rows are."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, vectors = held.pop(dim)
            cells = np.concatenate(vectors)
            kind = next(k for k in KINDS if np.iinfo(k).min <= cells.min() and cells.max() <= np.iinfo(k).max)
            ids = np.array(ids, "<i8")
            key = int(ids.min()) * 1_000_003 % (1 << 61) + int(ids.max())
            return pa.RecordBatch.from_pydict({"block": pa.array([key], pa.int64()), "n": pa.array([len(ids)], pa.int32()), "dim": pa.array([dim], pa.int32()), "kind": pa.array([kind]), "ids": pa.array([ids.tobytes()], pa.binary()), "cells": pa.array([cells.astype(kind).tobytes()], pa.binary())})

        for batch in batches:
            vectors = batch.column(1)
            flat, ends = vectors.flatten().to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
            for i, (vec_id, a, b) in enumerate(zip(batch.column(0).to_pylist(), ends[:-1] - ends[0], ends[1:] - ends[0], strict=True)):
                ids, own = held.setdefault(int(b - a), ([], []))
                ids.append(vec_id)
                own.append(flat[a:b])
                if len(ids) == size:
                    yield block(int(b - a))
        for dim in list(held):
            yield block(dim)

    return rows.select("id", "v").mapInArrow(pack, "block bigint, n int, dim int, kind string, ids binary, cells binary")


def scores(queries: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Integer inner products (queries x rows), term by term over the posting lists of ``cells``."""
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(cells).max(initial=0)) * cells.shape[1]
    kind = np.int32 if most < 1 << 31 else np.int64
    queries, cells = queries.astype(kind), np.ascontiguousarray(cells.T, kind)
    out, added = np.zeros((len(queries), cells.shape[1]), kind), np.empty((len(queries), cells.shape[1]), kind)
    for weights, postings in zip(np.ascontiguousarray(queries.T), cells, strict=True):
        rows, asked = np.flatnonzero(postings), np.flatnonzero(weights)
        if 2 * len(rows) * len(asked) > out.size:
            np.multiply(weights[:, None], postings[None, :], out=added)
            out += added
        elif len(rows) and len(asked):
            out[np.ix_(asked, rows)] += weights[asked, None] * postings[None, rows]
    return out


def best(ids: np.ndarray, found: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores with their ids, ties to smaller ids, by partition selection."""
    keep = ids != own
    ids, found = ids[keep], found[keep]
    if len(ids) > k:
        floor = np.partition(found, len(found) - k)[len(found) - k]
        over, tied = np.flatnonzero(found > floor), np.flatnonzero(found == floor)
        need = k - len(over)
        if len(tied) > need:
            tied = tied[np.argpartition(ids[tied], need - 1)[:need]]
        chosen = np.concatenate([over, tied])
        ids, found = ids[chosen], found[chosen]
    order = np.lexsort((ids, -found))
    return ids[order], found[order]


def _turns(asked: DataFrame) -> Iterator[list[dict]]:
    """Lists of query blocks of at most ``TURN`` cells; the driver holds one list and one block."""
    held, size = [], 0
    for row in asked.orderBy("dim", "block").toLocalIterator():
        n = row["n"] * row["dim"]
        if held and size + n > TURN:
            yield held
            held, size = [], 0
        held.append(row.asDict())
        size += n
    if held:
        yield held


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["cells"], row["kind"]).reshape(row["n"], row["dim"]).astype(np.int64)


def _searched(blocks: DataFrame, turn: list[dict], k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best that each task has found for each query of the turn."""
    shared = blocks.sparkSession.sparkContext.broadcast(turn)
    # Every block meets the queries of its length alone.
    dims = sorted({row["dim"] for row in turn})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [(row["dim"], *_unpacked(row)) for row in shared.value]
        nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held = [[nothing] * len(ids) for _, ids, _ in queries]
        for batch in batches:
            for row in batch.to_pylist():
                ids, cells = _unpacked(row)
                for (dim, asked, rows), kept in zip(queries, held, strict=True):
                    if dim != row["dim"]:
                        continue
                    for q, (own, found) in enumerate(zip(asked, scores(rows, cells), strict=True)):
                        low = kept[q][1][-1] if len(kept[q][1]) == k else None
                        if low is not None and found.max() < low:
                            continue
                        first = best(ids, found, own, k)
                        kept[q] = best(np.concatenate([kept[q][0], first[0]]), np.concatenate([kept[q][1], first[1].astype(np.int64)]), own, k)
        for (_, asked, _), kept in zip(queries, held, strict=True):
            sizes = np.array([len(x[0]) for x in kept], np.int64)
            columns = np.repeat(asked, sizes), np.concatenate([x[0] for x in kept]), np.concatenate([x[1] for x in kept])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    return blocks.where(F.col("dim").isin(dims)).select("n", "dim", "kind", "ids", "cells").mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k best of ``vectors``, itself left out."""
    spark = vectors.sparkSession
    small_batches(spark)
    asked = settle(_packed(quantised(queries, id_col, vector_col, scale).distinct(), QUERIES), "topk-queries")
    blocks = settle(_packed(quantised(vectors, id_col, vector_col, scale), BLOCK), "topk-blocks")
    place: Column = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best_of = lambda found: found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    held: list[DataFrame] = []
    for turn in _turns(asked):
        # What a turn found is written before the next, so that plans stay short.
        held[-1:] = [settle(best_of(last).drop("rank"), "topk-found") for last in held[-1:]]
        held.append(_searched(blocks, turn, k))
    return best_of(reduce(DataFrame.union, held) if held else spark.createDataFrame([], "query_id bigint, vec_id bigint, score bigint"))
