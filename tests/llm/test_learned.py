"""Operators that learn: held-out accuracy and brute-force checks on the small tables."""

import itertools
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import boosting, decontamination, language_id, pii, runtime, toxicity
from weftline.llm.runtime import table

SF = "/root/testdata/sf0.01"


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    sizes = [0, 1, 3, 6, 0, 5]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(size=(ends[-1], 3)).astype(np.float32) * 3
    for step, few in ((2, 16), (64, 16), (64, 2)):
        language_id.STEP, language_id.FEW = step, few
        got = language_id.viterbi(scores, ends, 2.0)
        value = lambda s, path: sum(s[i, p] for i, p in enumerate(path)) - 2.0 * sum(a != b for a, b in itertools.pairwise(path))
        for a, b in itertools.pairwise(ends):
            if b > a:
                best = max(value(scores[a:b], p) for p in itertools.product(range(3), repeat=b - a))
                assert value(scores[a:b], got[a:b]) == pytest.approx(best, abs=1e-4)
    language_id.STEP, language_id.FEW = 64, 16


def test_languages(spark, odd, none):
    docs = table(spark, SF, "documents")
    model = language_id.learn(docs)
    rows = language_id.identify(docs, model, keep=("lang",)).where("held_out").collect()
    assert len(rows) > 100 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    mixed = docs.where("lang = 'de'").orderBy("doc_id").first().text[:600] + "\n" + docs.where("lang = 'en'").orderBy("doc_id").first().text[:600]
    spans = next(language_id.label([mixed], model))[2]
    assert {s[2] for s in spans} == {"de", "en"} and len(spans) <= 4
    got = {(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(odd, model).collect()}
    assert {(2, "und", 0.0), (3, "und", 0.0), (4, "und", 0.0), (7, "und", 0.0)} <= got
    kept = language_id.accepted(odd, model)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert language_id.learn(none) is None
    assert {r.lang_pred for r in language_id.identify(odd, None).collect()} == {"und"} and language_id.identify(none, model).count() == 0


def test_all_with_a_letter_are_accepted_without_a_model(odd):
    kept = language_id.accepted(odd, None)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "CELLS", 1 << 18)
    rng = np.random.default_rng(0)
    texts = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)) for _ in range(300)]
    docs = spark.createDataFrame([(i, texts[i % 300], f"l{i % 300}") for i in range(1800)], "doc_id bigint, text string, lang string")
    model = language_id.learn(docs)
    assert len(model.languages) == 300 and model.table.size <= 1 << 18
    rows = language_id.identify(docs, model, keep=("lang",)).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.9
    assert len(language_id.learn(docs, languages=7).languages) == 7


def test_languages_are_counted_in_all_texts(spark):
    """3,000 texts of a language; each word of its own counts once, however many other texts there are."""
    word = lambda i, a, b: "".join((a, b)[int(x)] for x in f"{i:012b}")
    rows = [(3000 * k + i, word(i, *pair), lang) for k, (lang, pair) in enumerate({"x": "ab", "y": "cd"}.items()) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    learned = docs.where(~language_id.held_out("doc_id")).collect()
    model = language_id.learn(docs)
    for k, lang in enumerate("xy"):
        mine = [r.text for r in learned if r.lang == lang]
        assert len(mine) > 1500
        block = next(language_id._words([" ".join(mine)]))
        d = language_id.distinct(block)
        counts = np.bincount(d.buckets, minlength=language_id.BUCKETS)
        assert np.allclose(model.table[:, k], np.log((counts + 0.5) / (counts.sum() + 0.5 * len(counts))), atol=1e-4)


def test_samples_are_bounded_and_never_empty(spark):
    assert runtime.below(3000, 10**13) > -(1 << 63) and runtime.below(1, 2) == 0
    rows = spark.createDataFrame([(None if i % 2 else 1, f"text {i % 500}", "a" if i % 3 else None) for i in range(6000)], "id bigint, text string, g string")
    assert rows.distinct().count() == 1000
    assert runtime.bounded_sample(rows, 40, 1, "t").count() == 40
    by = {r.g: r["count"] for r in runtime.bounded_sample(rows, 40, 1, "t", "g").groupBy("g").count().collect()}
    assert by == {"a": 40, None: 40}
    # A row that makes up all of a table is sampled once.
    assert runtime.bounded_sample(rows.limit(1).crossJoin(spark.range(1000).select()), 9, 1, "t").count() <= 1
    assert runtime.bounded_sample(rows, 10**6, 1, "t").count() == rows.distinct().count()


def test_scripts_narrow_candidates(spark):
    rows = [(i, "красная книга дома " * 5 if i % 2 else "red book of houses " * 5, "ru" if i % 2 else "en") for i in range(40)]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert [x[0] for x in language_id.label(["ещё слова", "more words"], model)] == ["ru", "en"]


def test_boosted_trees_and_isotonic_calibration():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    model = boosting.fit(x[:1000], y[:1000], np.ones(1000))
    model.knots = boosting.isotonic(model.margin(x[1000:1500]), y[1000:1500], np.ones(500))
    p = model.probability(x[1500:])
    assert ((p >= 0.5) == y[1500:]).mean() > 0.95 and p.min() >= 0 and p.max() <= 1
    knots, values = boosting.isotonic(np.array([1.0, 2.0, 3.0, 4.0]), np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert np.interp([1, 2, 3, 4], knots, values).tolist() == [0.0, 0.5, 0.5, 1.0]


def test_toxicity(spark, odd, none):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, model).where("held_out").join(labels, "doc_id").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    auc = np.mean([(s[y == 1][:, None] > s[y == 0][None]).mean() + (s[y == 1][:, None] == s[y == 0][None]).mean() / 2])
    assert auc > 0.95 and np.mean([r.predicted == r.toxic for r in rows]) > 0.95
    got = toxicity.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got) and toxicity.score(none, model).count() == 0
    blank = toxicity.learn(none, labels.where("false"))
    assert {r.score for r in toxicity.score(odd, blank).collect()} == {0.0}


def test_features_are_rates():
    lexicon = toxicity.Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    x = toxicity.features(["You IDIOT!! w*rd sooo b4d", None, ""], lexicon)
    named = dict(zip(toxicity.FEATURES, x[0], strict=True))
    assert named["fixed"] > 0 and named["near"] == 0.5 and named["signs_inside"] > 0 and named["stretched"] > 0 and named["mixed"] > 0 and not x[1:].any()


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_leaks(spark, odd, none):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = {r.doc_id: {x.item for x in r["items"]} for r in decontamination.check(docs, bench).collect() if r.contaminated}
    items = [(r.item_id, " ".join(words(r.text))) for r in bench.collect()]
    exact = {r.doc_id: {i for i, t in items if t in " ".join(words(r.text))} for r in docs.collect()}
    assert {d: s for d, s in exact.items() if s} == {d: got[d] & exact[d] for d in exact if exact[d]}
    assert sum(len(s) for s in exact.values()) > 10
    assert all(got[d] == exact[d] for d in got)
    kept = decontamination.clean(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert decontamination.clean(odd, bench.where("false")).count() == odd.count() and decontamination.check(none, bench).count() == 0


def test_paraphrases_and_common_subsequences(spark):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    item = [word() for _ in range(40)]
    changed = [w if i % 6 else word() for i, w in enumerate(item)]
    fill = lambda n: [word() for _ in range(n)]
    docs = spark.createDataFrame([(1, " ".join(fill(300) + changed + fill(200))), (2, " ".join(fill(500))), (3, " ".join(fill(90) + item[:12] + fill(90)))], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (8, ""), (9, None)], "item_id bigint, text string")
    got = {r.doc_id: [x.item for x in r["items"]] for r in decontamination.check(docs, bench).collect()}
    assert got == {1: [7], 2: [], 3: []}
    a, b = rng.integers(0, 6, 30).astype(np.uint64), rng.integers(0, 6, 50).astype(np.uint64)
    table_ = np.zeros((31, 51), int)
    for i, j in itertools.product(range(30), range(50)):
        table_[i + 1, j + 1] = table_[i, j] + 1 if a[i] == b[j] else max(table_[i, j + 1], table_[i + 1, j])
    assert decontamination.common(a, b) == table_[-1, -1]


def planted_items(seed, least, most, n):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 7))
    fill = lambda k: [word() for _ in range(k)]
    items = [fill(int(k)) for k in rng.integers(least, most, n)]
    reworded = [[word() if i % 5 == 4 else w for i, w in enumerate(x)] for x in items]
    planted = [fill(int(rng.integers(0, 200))) + x + fill(int(rng.integers(40, 200))) for x in items + reworded]
    return items, [(i, " ".join(x)) for i, x in enumerate([*planted, *(fill(200) for _ in range(20))])]


@pytest.mark.parametrize("passages", [4096, 8])
def test_short_and_reworded_items_are_found(spark, monkeypatch, passages):
    monkeypatch.setattr(decontamination, "PASSAGES", passages)
    items, rows = planted_items(6, 3, 60, 60 if passages > 8 else 10)
    bench = spark.createDataFrame([(f"item {i}" if i else None, " ".join(x)) for i, x in enumerate(items)], "item_id string, text string")
    got = {r.doc_id: [x.item for x in r["items"]] for r in decontamination.check(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()}
    name = lambda i: f"item {i}" if i else None
    expected = {i: [name(i % len(items))] if i < 2 * len(items) else [] for i, _ in rows}
    assert got == expected


def test_long_items_are_checked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "PASSAGES", 4)
    items, _ = planted_items(7, 300, 301, 1)
    docs = spark.createDataFrame([(1, " ".join(items[0])), (2, " ".join(items[0][128:200])), (3, "x y z")], "doc_id bigint, text string")
    got = {r.doc_id: [x.item for x in r["items"]] for r in decontamination.check(docs, spark.createDataFrame([(5, " ".join(items[0]))], "item_id bigint, text string")).collect()}
    assert got == {1: [5], 2: [5], 3: []}


def test_paraphrases_are_near_in_the_latent_space(spark):
    """Words of a topic and their synonyms stand together in the corpus; paraphrases share few words with their item."""
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 7))
    topics = [([word() for _ in range(20)], [word() for _ in range(20)]) for _ in range(24)]
    answers = [" ".join(word() for _ in range(4)) for _ in topics]
    items = [f"{' '.join(a)}. {x}" for (a, _), x in zip(topics, answers, strict=True)]
    mixed = [" ".join(rng.permutation([p[int(rng.integers(2))] for p in zip(a, b, strict=True)])) for a, b in topics for _ in range(12)]
    reworded = [[b[i] if i % 4 else a[i] for i in range(20)] for a, b in topics]
    paraphrases = [f"{' '.join(x)}. {y}" for x, y in zip(reworded, answers, strict=True)]
    texts = mixed + paraphrases + [" ".join(x) for x in reworded]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    rows = {r.doc_id: [x.item for x in r["items"]] for r in decontamination.check(docs, bench).collect()}
    n = len(mixed)
    assert np.mean([rows[n + i] == [i] for i in range(24)]) >= 0.9
    # Without the answer, or with the topic alone, a text is clean.
    assert not any(rows[i] for i in range(n)) and not any(rows[n + 24 + i] for i in range(24))
    # Plain TF-IDF puts no paraphrase near its item, nor do the first two rules of the check.
    block = list(decontamination.items_of(enumerate(items)))
    terms = decontamination.statistics(docs, decontamination.vocabulary(bench, "text"), "text")
    for i, text in enumerate(paraphrases):
        found, ends = decontamination._words([text])
        both = [decontamination._rows(w, e, terms) for w, e in ((found, ends), (block[i].words, np.array([0, len(block[i].words)])))]
        a, b = (np.bincount(c, v, minlength=len(terms.hashes) + decontamination.OTHERS) for _, c, v in both)
        assert a @ b < 0.5 and decontamination.common(block[i].words, found) / len(block[i].words) < decontamination.ALIKE


def test_the_latent_space_is_that_of_all_documents(spark, monkeypatch):
    """Its vectors are orthonormal in the sum over the passages of every document, more than any bounded sample had."""
    rng = np.random.default_rng(12)
    word = ["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(300)]
    texts = [" ".join(rng.choice(word, int(rng.integers(1, 90)))) for _ in range(2600)] + [None, "", " . "]
    items = [" ".join(rng.choice(word[:90], 60)) for _ in range(12)]
    docs, bench = (spark.createDataFrame(list(enumerate(x)), f"{i} bigint, text string") for x, i in ((texts, "doc_id"), (items, "item_id")))
    models, fit = [], decontamination.fit
    monkeypatch.setattr(decontamination, "fit", lambda *x: models.append(fit(*x)) or models[-1])
    decontamination.check(docs, bench).count()
    (model,) = models
    own = [x.words for x in model.items]
    seen, known = (decontamination._dense(*decontamination._rows(*x, model.terms), model.space).astype(float) for x in (decontamination._words(texts), (np.concatenate(own), np.cumsum([0, *map(len, own)]))))
    assert np.allclose(seen.T @ seen + len(seen) / len(known) * known.T @ known, np.eye(model.space.shape[1]), atol=1e-3)


PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
            if (True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else False, 16 <= len(d) <= 19 and luhn, 8 <= len(d) <= 15)[k]:
                out.append((k, m.start(), m.end()))
    return out


def test_base_spans():
    rng = np.random.default_rng(9)
    pieces = ["a@b.c", "x%y@z.w.v@q.r", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "4111111111111111", "4111 1111-1111 1111", "+1 (555) 555-0100", "+1", "12", ".", "-", " ", "@", "é", "+49 30 1234567 89", "\n", "007.0.0.1"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces, rng.integers(0, 9)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_fields_add_repeats_and_keep_base(spark, odd, none):
    docs = table(spark, SF, "documents")
    field = pii.learn(docs)
    rows = pii.find(docs, field).collect()
    assert all({(s.kind, s.start, s.end) for s in r.base} <= {(s.kind, s.start, s.end) for s in r.spans} for r in rows)
    assert sum(len(r.spans) - len(r.base) for r in rows) < 0.1 * sum(len(r.base) for r in rows)
    g = pii.graph("+1 (555) 555-0100 then 555-0100", pii.base_spans("+1 (555) 555-0100 then 555-0100"))
    assert g.skip == [(2, 3)] and g.seen == [4, 4, 4, 0]
    free, tied = field.marginals(pii.Graph(g.spans, g.shapes, g.seen, g.chain, [])), field.marginals(g)
    assert tied[3, 4] > free[3, 4] and np.allclose(tied.sum(axis=1), 1)
    digests = pii.digests(odd, field).collect()
    assert len(digests) == odd.count() and all(r.spans == "" for r in digests if r.doc_id in (2, 3, 4))
    assert pii.learn(none) is None and pii.digests(none, None).count() == 0


def test_two_nodes_are_summed_exactly():
    field = pii.Field(np.random.default_rng(1).normal(size=(pii.FEATURES, 5)), np.random.default_rng(2).normal(size=(5, 5)), np.zeros((5, 5)))
    g = pii.Graph([(0, 1), (2, 3)], [1, 3], [0, 0], [(0, 1)], [])
    own = np.array([field.local[0], field.local[0] + field.local[1]])
    joint = np.exp(own[0][:, None] + own[1][None] + field.chain)
    assert np.allclose(field.marginals(g)[0], joint.sum(axis=1) / joint.sum(), atol=1e-3)


def enumerated(field, g):
    own = pii._bits(g.shapes) @ field.local
    out = np.zeros((len(g.spans), 5))
    for labels in itertools.product(*([k] if k else range(5) for k in g.seen)):
        p = np.exp(sum(own[i, k] for i, k in enumerate(labels) if not g.seen[i]) + sum(field.chain[labels[a], labels[b]] for a, b in g.chain) + sum(field.skip[labels[a], labels[b]] for a, b in g.skip))
        out[range(len(labels)), labels] += p
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("seed", range(4))
def test_marginals_against_enumeration(seed):
    rng = np.random.default_rng(seed)
    both = [x + x.T for x in rng.normal(size=(2, 5, 5)) * 0.3]
    field = pii.Field(rng.normal(size=(pii.FEATURES, 5)) * 0.5, *both)
    spans = [(3 * i, 3 * i + 2) for i in range(6)]
    shapes = [int(x) for x in rng.integers(1, 1 << pii.FEATURES, 6)]
    tree = pii.Graph(spans, shapes, [0, 2, 0, 0, 0, 0], [(0, 1), (1, 2), (2, 3)], [(3, 5), (1, 4)])
    assert np.allclose(field.marginals(tree), enumerated(field, tree), atol=1e-6)
    # A cycle of weak ties: close, as loops count evidence more than once.
    loop = pii.Graph(spans, shapes, [3, 0, 0, 0, 0, 0], [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5)], [(1, 4), (2, 5)])
    assert np.allclose(field.marginals(loop), enumerated(field, loop), atol=0.08)


def test_covered_against_all_pairs():
    rng = np.random.default_rng(5)
    for _ in range(300):
        cuts = np.sort(rng.choice(80, 20, replace=False)).tolist()
        spans = list(zip(cuts[::2], cuts[1::2], strict=True))
        base = []
        for kind in range(4):
            cuts = np.sort(rng.choice(80, 8, replace=False)).tolist()
            base += [(kind, a, b) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
        expected = [next((k + 1 for a, k, b in sorted((a, k, b) for k, a, b in base) if x < b and a < y), 0) for x, y in spans]
        assert pii.covered(spans, base) == expected


def test_potentials_are_fitted_jointly():
    # The shape says nothing; only a skip neighbour's label tells.
    rows = [(1, 4, (0,) * 5, (0, 0, 0, 0, 1), 50.0), (1, 0, (0,) * 5, (1, 0, 0, 0, 0), 50.0), (1, 0, (0,) * 5, (0,) * 5, 50.0)]
    field = pii.fitted(rows)
    assert field.skip[4, 4] > 1 and (field.skip == field.skip.T).all() and abs(field.chain).max() < 1e-9


def test_long_texts_end_in_seconds():
    field = pii.Field(np.zeros((pii.FEATURES, 5)), np.eye(5), np.eye(5))
    began = time.time()
    for text in ("x" * 1_000_000 + "!@a.b", "a@" * 300_000, "1." * 400_000, "+1((" * 200_000, "1 " * 400_000):
        pii.base_spans(text)
    many = " ".join(f"+1 (555) {i:07d}" for i in range(20_000))
    base = pii.base_spans(many)
    assert len(base) == 20_000 and pii.added_spans(many, base, field) == []
    pii.added_spans(" ".join(f"{i % 5000:07d}" for i in range(20_000)), [], field)
    assert time.time() - began < 40


@pytest.mark.parametrize("n", [21, 200])
def test_evidence_reaches_the_last_repeat(n):
    tie = np.full((5, 5), -4.0) + 8 * np.eye(5)
    field = pii.Field(np.zeros((pii.FEATURES, 5)), np.zeros((5, 5)), tie)
    g = pii.Graph([(2 * i, 2 * i + 1) for i in range(n)], [1] * n, [4] + [0] * (n - 1), [], [(i - 1, i) for i in range(1, n)])
    step = np.exp(tie) / np.exp(tie).sum(axis=1, keepdims=True)
    exact = np.stack([np.linalg.matrix_power(step, i)[4] for i in range(n)])
    assert np.allclose(field.marginals(g), exact, atol=1e-3) and exact[20, 4] > pii.SURE


def test_stages_keep_columns(spark, odd, tmp_path):
    import corpus_pipeline

    sf = str(tmp_path)
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{sf}/documents.parquet")
    table(spark, SF, "benchmark").write.parquet(f"{sf}/benchmark.parquet")
    for rows in (docs, docs.where("false")):
        now = rows
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, sf)
            if name != "sentencepiece":
                assert now.columns == docs.columns
        assert now.columns == ["doc_id", "n_tokens", "ids", "round_trip"]
    out = corpus_pipeline.run(spark, sf)
    assert out.where(~F.col("round_trip")).isEmpty() and out.where("n_tokens = 0").isEmpty()
