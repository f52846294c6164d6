"""Secret scans over a trigram inverted index, in DataFrame operations alone.

From each rule's expression a Boolean trigram query is derived. One pass over the texts finds
which of the queries' trigrams each (lower-cased) text holds and inverts that into postings:
for each trigram and block of texts, the keys of the texts that hold it. A rule's query is
evaluated on the postings of a block by intersection and union; the texts that remain are its
candidates, and only on them is its expression run. A rule without a mandatory trigram scans every
text. A block is a range of hashed keys that about ``BLOCK_ROWS`` rows fall into, so there are more blocks
the more texts there are, and no posting list or block grows with the corpus; of the texts only their
number reaches the driver. Rows with the same id and text have one key.

Defined results: a null text is an empty one; rows with equal or null ids are told apart by their
text's hash and each is scanned; an empty table gives an empty table. Offsets count code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm import trigrams
from weftline.llm.runtime import settle


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` has the dialect that Java and Python share; of ``group`` at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    #: A cheap expression that every match satisfies, for rules that scan all texts.
    guard: str | None = None


#: The base rules come first and in this order; the fixed formats after them are public knowledge.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}", guard=r"[0-9a-f]{24}"),
)
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{20,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"),
)
RULES = BASE + ADDED
BLOCK_ROWS = 8192

_SPANS = "array<struct<start:int,ord:int,end:int,kind:string>>"


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """The rule's matches, leftmost and non-overlapping, as an array of (start, ord, end, kind)."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    held = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    sized = F.zip_with(F.split(text, rule.pattern, -1), found, lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit")))
    step = F.aggregate(
        F.filter(sized, lambda x: x["hit"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["hit"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), F.lit(order).alias("ord"), (acc["at"] + x["gap"] + x["hit"]).alias("end"), F.lit(rule.kind).alias("kind")))).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    if not rule.least:
        return step
    kept = F.filter(F.zip_with(step, held, lambda s, h: F.struct(s.alias("s"), (F.length(h) >= rule.least).alias("ok"))), lambda x: x["ok"])
    return F.transform(kept, lambda x: x["s"])


def _holds(q, present: dict[str, Column]) -> Column:
    if isinstance(q, str):
        return present[q]
    op, parts = q
    out = F.lit(op == "and")
    for p in parts:
        out = out & _holds(p, present) if op == "and" else out | _holds(p, present)
    return out


def _posted(q, lists: Column) -> Column:
    """The keys of a block's texts that satisfy a query: postings intersected and united."""
    if isinstance(q, str):
        return F.coalesce(lists[q], F.array().cast("array<bigint>"))
    op, parts = q
    out = _posted(parts[0], lists)
    for p in parts[1:]:
        out = (F.array_intersect if op == "and" else F.array_union)(out, _posted(p, lists))
    return out


def build_index(docs: DataFrame, wanted: list[str], key: Column, text: Column) -> DataFrame:
    """The inverted index (block, lists): for each block, a map from trigram to the keys of the texts that hold it."""
    blocks = docs.count() // BLOCK_ROWS + 1
    low = F.lower(text)
    held = docs.select(key.alias("key"), low.alias("low")).select("key", F.filter(F.array(*(F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in wanted)), lambda g: g.isNotNull()).alias("grams"))
    posted = held.where(F.size("grams") > 0).select("key", F.explode("grams").alias("gram")).withColumn("block", F.pmod("key", F.lit(blocks)))
    lists = posted.groupBy("block", "gram").agg(F.collect_set("key").alias("keys"))
    return lists.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("lists"))


def candidates(index: DataFrame, queries: dict[int, object]) -> DataFrame:
    """(key, rules): for each text that satisfies some rule's query, the numbers of those rules."""
    per_rule = F.array(*(F.struct(F.lit(i).alias("rule"), _posted(q, F.col("lists")).alias("keys")) for i, q in queries.items()))
    flat = index.select(F.explode(per_rule).alias("r")).select(F.col("r.rule").alias("rule"), F.explode("r.keys").alias("key"))
    return flat.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, and found: array of (start, ord, end, kind) by start, then rule order."""
    return _scanned(docs, rules, id_col, text_col, [id_col]).select("row.*", "found")


def _scanned(docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """(row, found): ``row`` is a struct of the ``keep`` columns, so that no name can clash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(F.col(id_col), text)
    queries = {i: trigrams.lighten(trigrams.query(r.pattern)) for i, r in enumerate(rules)}
    indexed = {i: q for i, q in queries.items() if q is not True}
    rows = docs.select(F.struct(*keep).alias("row"), text.alias("t"), key.alias("key"))
    if indexed:
        wanted = sorted(set().union(*map(trigrams.names, indexed.values())))
        hits = settle(candidates(build_index(docs, wanted, key, text), indexed), "secret-candidates")
        rows = rows.join(hits, "key", "left")
    else:
        rows = rows.withColumn("rules", F.array().cast("array<int>"))
    nothing = F.array().cast(_SPANS)
    parts = []
    for i, rule in enumerate(rules):
        if i in indexed:
            parts.append(F.when(F.array_contains("rules", i), spans_of(F.col("t"), rule, i)).otherwise(nothing))
        else:
            found = spans_of(F.col("t"), rule, i)
            parts.append(F.when(F.col("t").rlike(rule.guard), found).otherwise(nothing) if rule.guard else found)
    return rows.select("row", F.array_sort(F.concat(*parts)).alias("found"))


def joined(found: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, a count for each base kind, the digest of the base spans, and all spans as a string."""
    rows = scan(docs, id_col=id_col, text_col=text_col)
    base = F.filter("found", lambda s: s["ord"] < len(BASE))
    counts = [F.size(F.filter("found", lambda s: s["kind"] == r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE]  # noqa: B023
    return rows.select(id_col, *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]", *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by ``mask``; overlapping spans become one. Null texts stay null."""
    rows = _scanned(docs, RULES, id_col, text_col, docs.columns)
    text = F.col("row")[text_col]
    clean = F.aggregate(
        "found",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.when(s["start"] >= acc["at"], F.concat(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).otherwise("")).alias("out"))
        ),
        lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text))),
    )
    new = F.when(F.size("found") > 0, clean).otherwise(text)
    return rows.select(*((new if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns))
