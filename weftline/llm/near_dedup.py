"""Near-duplicate detection with SetSketch registers, banding, a joint likelihood and exact checks.

1. A text's set is that of its distinct k-word shingles. Its sketch has ``REGISTERS`` registers:
   for each, the minimum over the set of exponentially distributed hashes, kept as its exponent in
   base ``BASE`` and truncated to 16 bits. Registers of two sets' union are the maxima of theirs
   (``merge``), and two registers agree about as often as the sets overlap.
2. Band keys are hashes of ``BAND`` registers that no other band has, of a longer sketch made for
   them alone. So bands agree independently of one another, and there are as many as make the chance
   to miss a pair at the threshold less than ``MISS``. Texts with equal sets have equal bands and are one
   class, named by ``NAME_BITS`` bits of its set. In every bucket each class is tied to the bucket's least class: rows as many as members,
   never pairs. The components of these ties are the candidate groups.
3. A candidate group is taken apart into linked components by exact set comparison. Groups beyond
   ``GROUP_BYTES`` or ``GROUP_SETS`` are cut into blocks. Blocks are linked inside first, then
   through one central set of each. Only sets outside a group's largest component so far are still
   compared with the whole group, block by block: what is already connected needs no more links. Blocks
   are dealt by group and block, so a large group's are spread over tasks. A
   pair is compared only if the two are not yet connected and the joint likelihood of their
   registers doesn't rule the threshold out; one pass over the postings of a set's shingles
   compares it with all others of the block.
4. Components of the confirmed links, and the least id of each. Rows get theirs by the class of
   their set; classes with at least 1/``HOT`` of all rows (so at most ``HOT``) by a broadcast, so
   that the rows of one text are never gathered in a task.

Defined results: a null or blank text has an empty set and is its own component; repeated rows are
exact copies; null ids take part but are never a component's id unless it has no other (then it is
null, and kept is false); an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.components import components
from weftline.llm.runtime import release, settle, small_batches
from weftline.llm.words import WHITESPACE, mix, word_hashes

REGISTERS = 128
BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 1
BAND = 8
MISS = 1e-6
GROUP_BYTES = 8 << 20
GROUP_SETS = 256
HOT = 4096
#: A class's name, as a decimal: at 1e11 sets two are named alike with a chance of 1e-16.
NAME_BITS = 126
_NAME = "decimal(38,0)"
_ARROW_NAME = pa.decimal128(38, 0)
#: Twice the log of the likelihood ratio beyond which a pair is ruled out (a normal deviate of 7).
RULED_OUT = 49.0

_U = np.uint64
_rng = np.random.default_rng(20_210_103)
_FACTORS = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_CELLS = 1 << 18


def shingle_sets(texts: list[str | None], words: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, ends = word_hashes(texts, WHITESPACE)
    prime = _U(0x9FB21C651E98DF25)
    joined = hashes[: max(0, len(hashes) - words + 1)].copy()
    for i in range(1, words):
        joined = joined * prime + hashes[i : i + len(joined)]
    joined = mix(joined)
    out = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(joined[a : b - words + 1]))
        elif b > a:
            whole = _U(int(b - a))
            for h in hashes[a:b]:
                whole = _U((int(whole) * int(prime) + int(h)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix(np.array([whole]) ^ _U(0xA5A5A5A5A5A5A5A5)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(members: np.ndarray, factors: np.ndarray = _FACTORS, shifts: np.ndarray = _SHIFTS) -> np.ndarray:
    """The SetSketch registers of a set of 64-bit hashes, one for each factor and shift."""
    x = (members >> _U(32)).astype(np.uint32)
    most = np.zeros(len(factors), np.uint32)
    step = max(1, _CELLS // len(factors))
    for at in range(0, len(x), step):
        v = factors[:, None] * x[None, at : at + step]
        v += shifts[:, None]
        np.maximum(most, v.max(axis=1), out=most)
    least = -np.log((most.astype(np.float64) + 0.5) / 4294967296.0) / RATE
    return np.clip(np.floor(1.0 - np.log(least) / math.log(BASE)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def bands_for(threshold: float) -> np.ndarray:
    """(bands x BAND) register numbers, each once: enough bands to miss a pair at the threshold with a chance under MISS."""
    n = math.ceil(math.log(MISS) / math.log1p(-(threshold**BAND)))
    return np.arange(n * BAND).reshape(n, BAND)


def band_hashes(bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts of the registers that the bands need."""
    rng = np.random.default_rng(8)
    return rng.integers(0, 1 << 32, bands.size, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, bands.size, dtype=np.uint32)


def band_keys(sketches: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """(texts x bands) keys; a key also tells its band."""
    key = np.broadcast_to(np.arange(1, len(bands) + 1, dtype=np.uint64), (len(sketches), len(bands))).copy()
    for i in range(bands.shape[1]):
        key = mix(key * _U(0x9FB21C651E98DF25) + sketches[:, bands[:, i]].astype(np.uint64))
    return key.view(np.int64)


def log_likelihood(over: np.ndarray, under: np.ndarray, same: np.ndarray, share: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of Jaccard similarity j, where so many registers are over, under and equal; share: |a| / (|a| + |b|)."""
    other = 1.0 - share
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)
    up, down = np.maximum(p(share - other * j), 1e-12), np.maximum(p(other - share * j), 1e-12)
    return over * np.log(up) + under * np.log(down) + same * np.log(np.maximum(1 - up - down, 1e-12))


def possible(own: np.ndarray, own_n: int, others: np.ndarray, others_n: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the others the joint likelihood of the registers doesn't put below the threshold."""
    over, under = (own > others).sum(axis=1), (own < others).sum(axis=1)
    same = REGISTERS - over - under
    share = own_n / (own_n + others_n)
    cap = np.minimum(share / (1 - share), (1 - share) / share)
    at = log_likelihood(over, under, same, share, np.minimum(threshold, cap))
    most = np.full(len(others), -np.inf)
    for j in np.linspace(0, 1, 41):
        most = np.maximum(most, log_likelihood(over, under, same, share, np.minimum(j, np.minimum(threshold, cap))))
    # A set under the threshold's share of the other in size cannot reach it.
    return (cap >= threshold - 1e-9) & (2 * (most - at) <= RULED_OUT)


def linked(sets: list[np.ndarray], sketches: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int, known: list[int] | None = None) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between ``left`` and ``right`` members (the same, or disjoint); equal ``known`` numbers are connected already."""
    first_of: dict[int, int] = {}
    parent = [first_of.setdefault(x, i) for i, x in enumerate(known)] if known is not None else list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    posted, first = owner[order], np.concatenate([[0], np.cumsum(np.bincount(inverse))])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    within = len(left) == len(right) and bool((left == right).all())
    roots, edges, seen = np.array(parent), [], 0
    for place, i in enumerate(left):
        others = right[place + 1 :] if within else right
        others = others[roots[others] != roots[i]]
        if len(others):
            others = others[possible(sketches[i], int(sizes[i]), sketches[others], sizes[others], percent / 100)]
        if not len(others):
            continue
        own = inverse[ends[i] : ends[i + 1]]
        counts = first[own + 1] - first[own]
        at = np.repeat(first[own] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        common = np.bincount(posted[at], minlength=len(sets))[others]
        for j in others[100 * common >= percent * (sizes[i] + sizes[others] - common)]:
            a, b = find(int(i)), find(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
                edges.append((int(i), int(j)))
        if len(edges) > seen:
            roots, seen = np.array([find(x) for x in range(len(sets))]), len(edges)
    return edges


def sketched(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """id, n (set size), h (the name of the set) and the band keys of every row."""
    bands = bands_for(percent / 100)
    factors, shifts = band_hashes(bands)
    out = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()), T.StructField("h", T.DecimalType(38, 0)), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), words)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(np.stack([registers(sets[i], factors, shifts) for i in full]), bands) if full else np.zeros((0, len(bands)), np.int64)
            ends = np.zeros(len(sets) + 1, np.int32)
            ends[1:][full] = len(bands)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), names(sets), lists], out.names)

    return docs.select(id_col, text_col).mapInArrow(run, out)


def names(sets: list[np.ndarray]) -> pa.Array:
    """The names of sets, equal for equal sets alone."""
    out = np.zeros((len(sets), 2), np.uint64)
    for i, s in enumerate(sets):
        if len(s):
            out[i] = mix(np.array([mix(s).sum(dtype=np.uint64) + _U(len(s)), mix(s ^ _U(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)]))
    out[:, 1] &= _U((1 << (NAME_BITS - 64)) - 1)
    return pa.Array.from_buffers(_ARROW_NAME, len(sets), [None, pa.py_buffer(out.tobytes())])


#: A candidate's group, name and size, the number of the group's blocks, and its own block.
_PLACE = ("root", "h", "n", "parts", "own")


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` (root, h, n, ...) of groups of two at least, with their blocks. Done on narrow rows: no set is dealt by its group."""
    sizes = rows.groupBy("root").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    parts = F.greatest(F.lit(1), F.ceil(F.col("total") * 8 / F.lit(GROUP_BYTES)), F.ceil(F.col("sets") / F.lit(GROUP_SETS)))
    # Always fewer blocks than sets.
    sizes = sizes.select("root", F.least(parts, F.ceil(F.col("sets") / F.lit(2))).cast("int").alias("parts"))
    return rows.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("h"), F.col("parts")).cast("int"))


def _candidate_sets(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """The chosen classes with sketch and members, made again from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            # A repeated id may stand for another text too.
            same = [i for i, (a, b) in enumerate(zip(batch.column("h").to_pylist(), names(sets).to_pylist(), strict=True)) if a == b]
            own = batch.take(pa.array(same, pa.int64()))
            sets = [sets[i] for i in same]
            columns = [*(own.column(c) for c in _PLACE), pa.array([registers(s).tobytes() for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*_PLACE, "sketch", "members"])

    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    # The same plan at every size: texts are dealt by id once, and no list of ids is broadcast.
    both = texts.join(chosen.hint("merge"), F.col("doc").eqNullSafe(F.col("id"))).select(*_PLACE, "text")
    return both.mapInArrow(run, f"root {_NAME}, h {_NAME}, n bigint, parts int, own int, sketch binary, members binary").dropDuplicates(["h"])


_LINKS = f"u {_NAME}, v {_NAME}"


def _loaded(group: pa.Table) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray]:
    """Names, sets and sketches of a block's rows, and their order by likeness to the commonest registers.

    The largest reach goes first: a text that all copies stem from then ties them in one step.
    """
    sets = [np.frombuffer(x, np.uint64) for x in group.column("members").to_pylist()]
    sketches = np.stack([np.frombuffer(x, np.uint16) for x in group.column("sketch").to_pylist()])
    return group.column("h").to_pylist(), sets, sketches, np.argsort(-(sketches == _mode(sketches)).sum(axis=1), kind="stable")


def _inside(blocks: DataFrame, percent: int) -> DataFrame:
    """(u, v): spanning links inside every block of candidates, and (central set, null) of each block."""

    def link(group: pa.Table) -> pa.Table:
        ids, sets, sketches, centre = _loaded(group.combine_chunks())
        edges = linked(sets, sketches, centre, centre, percent)
        return pa.table({"u": pa.array([ids[a] for a, _ in edges] + [ids[centre[0]]], _ARROW_NAME), "v": pa.array([ids[b] for _, b in edges] + [None], _ARROW_NAME)})

    # An exchange of its own: a join on root before would hold for the grouping, and a group's blocks would meet in one task.
    return blocks.select("root", "own", "h", "sketch", "members").repartition("root", "own").groupBy("root", "own").applyInArrow(link, _LINKS)


def _across(blocks: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """(u, v): further links of the groups, given ``links``: sets outside a group's largest component against the whole group."""
    now = components(links)
    known = blocks.select("root", "h", "n").join(now.select("node", F.col("root").alias("top")), F.col("h") == F.col("node"), "left").select("root", "h", "n", F.coalesce("top", "h").alias("known"))
    known = settle(known, "known")
    main = known.groupBy("root", "known").agg(F.count(F.lit(1)).alias("sets")).groupBy("root").agg(F.max_by("known", F.struct("sets", "known")).alias("main"))
    known = settle(known.join(main, "root").select("root", "h", "n", "known", (F.col("known") != F.col("main")).alias("asks")), "asked")
    rests = F.greatest(F.lit(1), F.ceil(F.sum("n") * 8 / F.lit(GROUP_BYTES)), F.ceil(F.count(F.lit(1)) / F.lit(GROUP_SETS))).cast("int")
    shares = known.where("asks").groupBy("root").agg(rests.alias("rests"))
    whole = blocks.join(settle(known.join(shares, "root").select("h", "known", "asks", "rests"), "shares"), "h")
    cell = F.pmod(F.xxhash64("h", F.lit(1)), F.col("rests")).cast("int")
    columns = ["root", "h", "sketch", "members", "known"]
    left = whole.where("asks").select(*columns, cell.alias("rest"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("own"), F.lit(True).alias("asks"))
    right = whole.select(*columns, F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("rest"), "own", F.lit(False).alias("asks"))

    def link(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, sets, sketches, centre = _loaded(group)
        asks = np.array(group.column("asks").to_pylist(), bool)[centre]
        edges = linked(sets, sketches, centre[asks], centre[~asks], percent, group.column("known").to_pylist()) if asks.any() and not asks.all() else []
        return pa.table({"u": pa.array([ids[a] for a, _ in edges], _ARROW_NAME), "v": pa.array([ids[b] for _, b in edges], _ARROW_NAME)})

    return left.union(right.select(left.columns)).repartition("root", "rest", "own").groupBy("root", "rest", "own").applyInArrow(link, _LINKS)


def _confirm(blocks: DataFrame, percent: int) -> DataFrame:
    """(u, v): spanning links of every candidate group, given its placed sets."""
    inside = settle(_inside(blocks, percent), "links-inside")
    links = inside.where("v IS NOT NULL")
    large = blocks.where("parts > 1")
    centres = large.select("root", "h", "n").join(inside.where("v IS NULL").select(F.col("u").alias("h")), "h", "left_semi")
    centres = settle(_placed(centres), "centres")
    # Each round has fewer sets than the last, as a group has fewer blocks than sets.
    if centres.isEmpty():
        return links
    central = settle(large.select("h", "sketch", "members").join(centres, "h").select(*_PLACE, "sketch", "members"), "central-sets")
    links = settle(links.union(_confirm(central, percent)), "links-so-far")
    return links.union(_across(large, links, percent))


def _mode(sketches: np.ndarray) -> np.ndarray:
    """The commonest value of every register."""
    out = np.empty(sketches.shape[1], np.uint16)
    for i in range(sketches.shape[1]):
        values, counts = np.unique(sketches[:, i], return_counts=True)
        out[i] = values[counts.argmax()]
    return out


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = 5, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id and kept of every row; linked: 100 * intersection >= percent * union."""
    small_batches(docs.sparkSession)
    rows = settle(sketched(docs, id_col, text_col, words, percent), "sketches")
    # One row for each distinct set, whatever the number of its copies.
    classes = rows.where("n > 0").groupBy("h").agg(F.first("n").alias("n"), F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    classes = settle(classes, "classes")
    keys = classes.select("h", F.explode("bands").alias("key"))
    buckets = settle(keys.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high").select("key", "low"), "buckets")
    ties = keys.join(buckets, "key").select(F.col("h").alias("u"), F.col("low").alias("v"))
    groups = components(ties)
    groups = settle(groups.union(groups.select("root", "root").distinct()), "groups")
    release(buckets)
    chosen = settle(_placed(classes.select("h", "n", "id").join(groups, F.col("h") == F.col("node")).select("root", "h", "n", "id")), "chosen")
    candidates = settle(_candidate_sets(docs, chosen, id_col, text_col, words), "candidate-sets")
    links = settle(_confirm(candidates, percent), "links")
    release(candidates)
    joined = components(links)
    owned = classes.select("h", "id", "copies").join(joined, F.col("h") == F.col("node"), "left").select("h", "id", "copies", F.coalesce("root", "h").alias("own"))
    owned = settle(owned, "owned")
    least = owned.groupBy("own").agg(F.min("id").alias("least"))
    places = settle(owned.join(least, "own").select("h", "copies", "least"), "places")
    full = rows.where("n > 0").select("id", "n", "h")
    hot = places.where(F.col("copies") * HOT >= (places.agg(F.sum("copies")).first()[0] or 0))
    # At most HOT rows, by what hot means.
    hot = F.broadcast(settle(hot.select("h", "least"), "hot"))
    out = full.join(hot, "h").select("id", "n", "least")
    cold = full.join(hot, "h", "left_anti").join(places.select("h", "least"), "h").select("id", "n", "least")
    blank = rows.where("n = 0").select("id", "n", F.col("id").alias("least"))
    out = out.union(cold).union(blank)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"), F.coalesce(F.col("id") == F.col("least"), F.lit(False)).alias("kept"))


def deduplicate(docs: DataFrame, percent: int = 80, words: int = 5, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: that of its least (id, text hash); identical rows become one."""
    # A row is named by its id and text, so that repeated or null ids with other texts aren't mistaken for it.
    named = docs.select(F.struct(F.col(id_col).alias("a"), F.xxhash64(text_col).alias("b")).alias("name"), F.col(text_col).alias("text"))
    kept = settle(near_duplicates(named, percent, words, id_col="name", text_col="text").where("kept").groupBy("name").agg(F.count(F.lit(1)).alias("times")), "kept")
    both = docs.join(kept.select(F.col("name.a").alias("kept id"), F.col("name.b").alias("kept text")).hint("merge"), F.col(id_col).eqNullSafe(F.col("kept id")) & (F.xxhash64(text_col) == F.col("kept text")), "left_semi")
    return both if kept.where("times > 1").isEmpty() else both.dropDuplicates([id_col, text_col])
