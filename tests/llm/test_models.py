"""Neighbours against brute force, classifiers by held-out accuracy, the language model against exact counts, and the pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sieveline.llm import hilbert_ann, lm_bloom, minmax_dedup, quality_gbdt, secret_scan, toxicity
from sieveline.llm.shared import written

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, score string"
CASES = [(1, "one two three", "x"), (1, "one two three", "x"), (2, None, "x"), (3, "", None), (None, "no id", "x"), (4, "a b " * 20_000, "x"), (6, " \n", "x"), (None, None, None)]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(CASES, SCHEMA)


def held_out(i, r=0):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == r


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    y = np.asarray(y)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


# --- neighbours -------------------------------------------------------------------------------------
def brute_neighbours(rows, k=5, every=50):
    fine = {}
    for i, v in rows:
        if i is None or v is None or len(v) != 8 or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        fine[i] = np.array(v, np.float64)
    out = {}
    for q in fine:
        if q % every == 0:
            near = sorted((-(fine[q] @ v) / (np.linalg.norm(fine[q]) * np.linalg.norm(v)), i) for i, v in fine.items() if i != q)
            out[q] = near[:k]
    return out


def clustered(n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, 8))
    return [(i, [float(np.float32(x)) for x in centres[i % 20] + 0.3 * rng.normal(size=8)]) for i in range(n)]


def test_neighbours(spark):
    rows = clustered(3000)
    rows += [(10_000 + i, rows[7][1]) for i in range(900)]  # a vector that many rows share
    rows += [(20_000, None), (20_050, [0.0] * 8), (20_100, [1.0] * 7), (20_150, [float("nan")] * 8), (None, [1.0] * 8), (20_200, [None] + [1.0] * 7), (50, rows[50][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    want, got = brute_neighbours(rows), {}
    for r in hilbert_ann.search(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    for q, near in want.items():
        assert [r for r, _, _ in got[q]] == [1, 2, 3, 4, 5]
        assert np.allclose([s for _, _, s in got[q]], [-s for s, _ in near], rtol=0, atol=1e-12)
        if len({round(s, 10) for s, _ in near}) == 5:
            assert [i for _, i, _ in got[q]] == [i for _, i in near]
    shared = next(q for q in got if q >= 10_000)
    assert [i for _, i, _ in got[shared]] == [7, *[i for i in range(10_000, 10_006) if i != shared][:4]]
    windows = {(r.query_id, r.vec_id) for r in hilbert_ann.search(df, windows_only=True).collect()}
    exact = {(q, i) for q, near in got.items() for _, i, _ in near}
    assert len(windows & exact) >= 0.9 * len(exact)


@pytest.mark.parametrize("which", ["multiples", "signs"])
def test_neighbours_that_tie(spark, which):
    rng = np.random.default_rng(5)
    if which == "multiples":  # v, 2v, 4v ... of each of 60 vectors: cosines are the same to the last bit
        base = rng.normal(size=(60, 8))
        m = np.stack([base[i % 60] * 2.0 ** (i // 60) for i in range(1200)])
    else:
        m = rng.choice([-1.0, 1.0], size=(1200, 16))
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(m)), m)]
    got = {}
    for r in hilbert_ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    ids, v = np.array([i for i, _ in rows]), np.array([x for _, x in rows])
    for q in range(0, len(m), 50):
        score = hilbert_ann.cosines(v[ids == q], v)
        order = np.lexsort((ids, -score))
        assert got[q] == [int(i) for i in ids[order] if i != q][:5]


@pytest.mark.parametrize(("kind", "most"), [("spread", 1.0), ("clusters", 0.35)])
def test_windows_find_neighbours_of_many_vectors(spark, kind, most):
    """50,000 vectors of 64 dimensions, about a hundred blocks of the least size: windows alone reach 0.9 of the neighbours."""
    n, rng = 50_000, np.random.default_rng(4)
    v = rng.normal(size=(n, 64)) if kind == "spread" else rng.normal(size=(400, 64))[rng.integers(0, 400, n)] + 0.3 * rng.normal(size=(n, 64))
    v = v.astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": pa.array(np.arange(n)), "embedding": pa.array(list(v), pa.list_(pa.float32()))})).repartition(8)
    got = {(r.query_id, r.vec_id) for r in hilbert_ann.search(df, every=500, windows_only=True).collect()}
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    score = unit[::500] @ unit.T
    score[np.arange(n // 500), np.arange(0, n, 500)] = -2
    want = {(500 * q, int(i)) for q, row in enumerate(np.argsort(-score, axis=1)[:, :5]) for i in row}
    assert len(got & want) >= 0.9 * len(want)
    found, _, width = hilbert_ann.entries(df, 5, 500)
    placed = hilbert_ann.positions(hilbert_ann.orderings(found, width)).cache()
    assert hilbert_ann.reach(placed, found, 5, width) * 2 * hilbert_ann.CURVES <= 3 * most * n


def test_tiles_and_batches(spark, monkeypatch):
    monkeypatch.setattr(hilbert_ann, "TILE", 100)
    rows = clustered(1500)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in hilbert_ann.search(df, every=2).collect())
    want = sorted((q, k + 1, i) for q, near in brute_neighbours(rows, every=2).items() for k, (_, i) in enumerate(near))
    assert got == want


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert hilbert_ann.search(spark.createDataFrame([], schema)).collect() == []
    got = hilbert_ann.search(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], schema)).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2)]
    assert hilbert_ann.search(spark.createDataFrame([(0, [1.0, 0.0])], schema)).collect() == []


def test_hilbert_keys_are_a_path():
    bits, dims = 3, 3
    cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = hilbert_ann.hilbert_key(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


# --- classifiers ----------------------------------------------------------------------------------------
def test_trees_learn():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality_gbdt.fit(x[:2000], y[:2000])
    assert auc(trees.score(x[2000:]), y[2000:]) > 0.98

    def walk(t, row):  # one row and one tree at a time
        node = 0
        while node < trees.feature.shape[1]:
            node = 2 * node + 1 + (row[trees.feature[t, node]] > trees.threshold[t, node])
        return trees.leaf[t, node - trees.feature.shape[1]]

    plain = [trees.base + sum(walk(t, row) for t in range(len(trees.leaf))) for row in x[:20]]
    assert np.allclose(trees.score(x[:20]), 1 / (1 + np.exp(-np.array(plain))))


@pytest.mark.parametrize(("run", "label", "least"), [(quality_gbdt.classify, "quality", 0.97), (toxicity.classify, "toxic", 0.85)])
def test_held_out_accuracy(spark, run, label, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    some = docs.join(labels.where(F.col(label).isNotNull()).select("doc_id"), "doc_id", "left_semi")
    got = run(some, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out]
    assert auc(np.array([r.score for r in out]), [r[label] for r in out]) > least


@pytest.mark.parametrize(("run", "at"), [(quality_gbdt.classify, 0.3), (toxicity.classify, 0.5)])
def test_classifiers_on_odd_rows(spark, cases, run, at):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, None), (None, 1, 1), (4, 0, 1), (1, 1, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        got = run(cases, known).collect()
        assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in CASES)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= at) and r.held_out == held_out(r.doc_id) for r in got)
    assert run(cases.limit(0), labels).collect() == []
    kept = quality_gbdt.select_good(cases, labels)
    assert kept.columns == cases.columns


def test_labels_that_are_held_out_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(toxicity.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted((r.doc_id, r.score) for r in quality_gbdt.classify(docs, x).collect()) for x in (labels, turned))
    assert one == two


def test_toxic_windows_compress_better():
    plain = [f"the {a} of {b} and {c} went by the {b}" for a in "river hill stone wood".split() for b in "moon sun field".split() for c in "bird fox deer".split()] * 4
    foul = [f"the {w} of hill and moon you {w} fool" for w in "blatherskite nincompoop".split()] * 30
    ordinary, toxic = toxicity.train_dictionaries(plain + foul, [0] * len(plain) + [1] * len(foul))
    scorer = toxicity.Scorer(ordinary, toxic)
    assert scorer.features("such a nincompoop of hill")[0] > scorer.features("the river of moon and bird")[0]


def test_toxic_words_of_a_rare_language_count_and_copies_do_not():
    text = lambda k, *more: " ".join([f"p{k % 97}", f"q{k % 89}", *more, f"r{k % 83}", f"s{k % 79}"]).encode().split()
    plain = [text(k) for k in range(2000)]
    foul = [text(7 * k, "gowk") for k in range(388)] + [text(11 * k, "tonto") for k in range(12)]
    copies = [b"a single toxic passage in many copies".split()] * 30
    marked = toxicity.over_represented(plain + foul + copies, [0] * len(plain) + [1] * (len(foul) + len(copies)))
    assert marked == {b"gowk", b"tonto"}


def test_toxic_phrases_of_ordinary_words_are_marked_and_found():
    """Each word is as frequent in ordinary texts; only the pair of them is toxic."""
    rng = np.random.default_rng(8)
    filler = ["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(400)]

    def text(*more):
        w = list(rng.choice(filler, 12))
        return " ".join([more[0], *w[:6], *more[1:], *w[6:]])

    plain = [text("harvest", "lantern") if k % 2 else text("lantern", "harvest") for k in range(900)]
    foul = [text(rng.choice(filler), "lantern", "harvest") for _ in range(120)]
    texts, y = plain + foul, [0] * len(plain) + [1] * len(foul)
    marked = toxicity.over_represented([t.encode().split() for t in texts], y)
    assert b"lantern harvest" in marked and not {b"lantern", b"harvest"} & marked
    scorer = toxicity.Scorer(*toxicity.train_dictionaries(texts, y))
    assert scorer.features("lantern harvest")[0] > scorer.features("harvest lantern")[0]


def test_choice_of_toxic_windows_by_brute_force():
    """Every window's contexts and documents counted one by one, with the likelihoods themselves."""
    rng = np.random.default_rng(10)
    words = [w.encode() for w in "a b c d e f g h i j k l m n o p".split()]
    for _ in range(6):
        y = [int(v) for v in rng.random(160) < 0.25]
        each = []
        for v in y:
            w = [words[k] for k in rng.integers(0, 12, rng.integers(0, 9))]
            at = int(rng.integers(0, len(w) + 1))
            each.append(w[:at] + ([b"o", b"p"] if v and rng.random() < 0.9 else [b"o", b"m", b"p"] if rng.random() < 0.5 else []) + w[at:])
        found = {b" ".join(w[k : k + n]) for w in each for n in (1, 2) for k in range(len(w) - n + 1)}
        share, total = sum(y) / len(y), [y.count(0), y.count(1)]

        def is_marked(u):
            contexts, documents, n = [set(), set()], [0, 0], u.count(b" ") + 1
            for w, v in zip(each, y):
                places = [k for k in range(len(w) - n + 1) if b" ".join(w[k : k + n]) == u]
                if places:
                    documents[v] += 1
                    k = places[0]
                    contexts[v].add((w[k - 1] if k else b"", w[k + n] if k + n < len(w) else b""))
            m, k = map(len, contexts)
            if not k:
                return False
            here = k / (k + m)
            likely = lambda p: k * math.log(p) + (m * math.log(1 - p) if m else 0)
            common = documents[1] >= max(toxicity.LEAST_DOCUMENTS, toxicity.COMMON_SHARE * total[1]) and math.log((documents[1] + 0.5) / (total[1] + 1) / ((documents[0] + 0.5) / (total[0] + 1))) > toxicity.LOG_RATIO
            return here > share and 2 * (likely(here) - likely(share)) > toxicity.EVIDENCE or common

        alone = {u for u in found if is_marked(u)}
        want = {u for u in alone if b" " not in u or not any(w in alone for w in u.split())}
        assert toxicity.over_represented(each, y) == want and b"o p" in want


def test_calibration_is_the_best_fit():
    """No small step from the fitted weights lowers the penalised loss, computed plainly."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 3)) * [1, 5, 0.2]
    y = (rng.random(300) < 1 / (1 + np.exp(-(x[:, 0] + 0.2 * x[:, 1] - 1)))).astype(float)
    centre, weight = toxicity.fit_logistic(x, y)
    z = np.c_[np.ones(300), (x - x.mean(0)) / x.std(0)]
    penalty = np.array([1e-3, 1, 1, 1])

    def loss(b):
        return sum(math.log1p(math.exp(-t)) if v else math.log1p(math.exp(t)) for t, v in zip(z @ b, y)) + (penalty * b * b).sum() / 2

    least = loss(weight)
    for step in np.vstack([np.eye(4), -np.eye(4), rng.normal(size=(20, 4))]) * 0.01:
        assert loss(weight + step) > least
    model = toxicity.Model(b"", b"", centre, weight, 0.0)
    assert np.allclose(toxicity.probability(model, x), 1 / (1 + np.exp(-(z @ weight))), atol=1e-6)


def test_toxicity_features_by_brute_force():
    """Each feature from the compressed lengths of every single window, made anew."""
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    texts = [" ".join(rng.choice(words, n)) for n in (1, 3, 4, 5, 40, 400)] + ["", None, " \n"]
    ordinary, toxic = " ".join(words[:200]).encode(), (" ".join(words[200:]) + " ".join(words[:200])).encode()
    scorer = toxicity.Scorer(ordinary, toxic)
    length = lambda data, w: len(toxicity.Scorer(data, data).ordinary(w))
    for text in texts:
        w = (text or "").lower().encode().split()
        windows = [b" " + b" ".join(w[k : k + 4]) + b" " for k in range(0, len(w) or 1, 4)]
        saved = sorted((length(ordinary, x) - length(toxic, x) for x in windows), reverse=True)
        n, over = len(saved), [sum(d >= t for d in saved) for t in toxicity.SAVED]
        twentieth = max(1, n // 20)
        want = [saved[0], np.mean(saved[:3]), np.mean(saved[:twentieth]), np.mean(saved), *[x / n for x in over], *[math.log1p(x) for x in over[1:]], math.log(n)]
        assert np.allclose(scorer.features(text), want)


def test_toxicity_sample_is_of_whole_texts(spark):
    rows = [(k, "plain words of a text " * 20_000 + f"end{k}") for k in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = df.select("doc_id", F.lit(0).alias("toxic"))
    free = {t for k, t in rows if not held_out(k)}
    assert {t for t, _ in toxicity.sampled(df, labels, "toxic")} == free
    few = toxicity.sampled(df, labels, "toxic", most_bytes=1_000_000)
    assert len(few) == 2 and {t for t, _ in few} < free
    assert len(toxicity.sampled(df, labels, "toxic", most_bytes=1)) == 1


def test_good_documents_keep_their_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({n: F.lit(7) for n in ("score", "__score", "y", "__id")})
    kept = quality_gbdt.select_good(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert kept.columns == docs.columns and kept.where("__score != 7 or score != 7 or y != 7").isEmpty()


# --- language model -----------------------------------------------------------------------------------------
def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]


@pytest.mark.parametrize("frequent", [lm_bloom.FREQUENT, 50])
@pytest.mark.parametrize("which", ["docs", "cases"])
def test_language_model(spark, cases, which, frequent):
    df = spark.read.parquet(f"{SF}/documents.parquet") if which == "docs" else cases
    train = ~F.coalesce(toxicity.held_out(is_=1), F.lit(False))
    rows = df.collect()
    c = Counter(w for r in rows if not held_out(r.doc_id, 1) for w in tokens(r.text))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for r in rows:
        t = tokens(r.text)
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        want[(r.doc_id, len(t), sum(c[w] > 0 for w in t), n, round(base, 4))] += 1
    got = lm_bloom.score(df, train, frequent=frequent).collect()
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score <= 0 for r in got)
    if which == "docs":
        assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_language_model_without_text(spark, cases):
    assert lm_bloom.score(cases.limit(0)).collect() == []
    got = lm_bloom.score(cases, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in got) and len(got) == len(CASES)


def exact_model(train):
    """log10 of the probability of a token (None: of any) after two others, from exact counts with the model's levels."""
    one, two, three = Counter(), Counter(), Counter()
    for t in train:
        one.update(t)
        two.update(zip(["\n", *t], t))
        three.update(zip(["\n", "\n", *t], ["\n", *t], t))
    least = lambda c: 2 ** (c.bit_length() - 1) if c else 0
    most = lambda c: 2 ** c.bit_length() - 1
    kept = Counter()
    for (u, v, _), c in three.items():
        kept[u, v] += least(c) if c > 1 else 0
    below = sum(one.values()) + 0.5 * (len(one) + 1)

    def chance(u, v, w):
        alone = (least(one[w]) + 0.5) / below
        after_one = (min(least(two[v, w]), most(one[v])) + lm_bloom.AFTER_ONE * alone) / (most(one[v]) + lm_bloom.AFTER_ONE)
        if not kept[u, v]:
            return after_one
        held = least(three[u, v, w]) if three[u, v, w] > 1 else 0
        return (held + lm_bloom.AFTER_TWO * after_one) / (most(kept[u, v]) + lm_bloom.AFTER_TWO)

    return chance, one, three


def here(train, texts, shards=16):
    """Scores of texts, with the same steps as on the cluster, in this process."""
    packed = pa.Table.from_batches(lm_bloom._packer(shards)([pa.RecordBatch.from_arrays([pa.array(train, pa.string())], ["text"])]))
    made = [lm_bloom._made_shard(packed.filter(pa.compute.equal(packed.column("shard"), s))) for s in packed.column("shard").unique().to_pylist()]
    rows = pa.concat_tables(made).to_pylist()
    held = lm_bloom.Filter([(r["shard"], r["bits"], r["probes"], r["held"]) for r in rows], shards)
    below = sum(r["n_tokens"] for r in rows) + 0.5 * (sum(r["n_words"] for r in rows) + 1)
    hashes, out = lm_bloom.WordHashes(), []
    for t in texts:
        flat = lm_bloom.tokens(t, hashes)
        words, inverse = np.unique(flat, return_inverse=True)
        out.append(lm_bloom._by_filter(held, [flat], flat, words, inverse.ravel(), below).sum())
    return out


@pytest.mark.parametrize("which", ["docs", "cases"])
def test_language_model_against_exact_counts(spark, cases, which, monkeypatch):
    """With so many bits that nothing is found by mistake, scores are those of exact counts; with the usual number the cluster's."""
    df = spark.read.parquet(f"{SF}/documents.parquet") if which == "docs" else cases
    rows = df.collect()
    train = [r.text for r in rows if not held_out(r.doc_id, 1)]
    chance, one, three = exact_model([tokens(t) for t in train])
    want = [sum(math.log10(chance(*x)) for x in zip(["\n", "\n", *t], ["\n", *t], t)) for t in (tokens(r.text) for r in rows)]
    got = Counter((r.doc_id, round(r.score, 4)) for r in lm_bloom.score(df, ~F.coalesce(toxicity.held_out(is_=1), F.lit(False))).collect())
    assert got == Counter((r.doc_id, round(s, 4)) for r, s in zip(rows, here(train, [r.text for r in rows])))
    monkeypatch.setattr(lm_bloom, "BITS_EACH", 512)
    assert np.allclose(here(train, [r.text for r in rows]), want, rtol=0, atol=1e-6)
    for u, v in [x[:2] for x in Counter(three).most_common(20)] + [("\n", "\n"), ("none", "such")]:
        assert sum(chance(u, v, w) for w in one) <= 1


@pytest.mark.parametrize("which", ["docs", "cases"])
def test_filter_grows_with_the_corpus(spark, cases, which):
    """A filter too large for one broadcast scores like one that is sent whole."""
    df = spark.read.parquet(f"{SF}/documents.parquet") if which == "docs" else cases
    train = ~F.coalesce(toxicity.held_out(is_=1), F.lit(False))
    whole, dealt = (sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm_bloom.score(df, train, max_bits=b).collect()) for b in (2**40, 2**14))
    assert whole == dealt


def test_shards_follow_the_corpus(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    size = sum(len((r.text or "").encode()) for r in df.collect())
    few = lm_bloom._fit(df)[1]
    monkeypatch.setattr(lm_bloom, "SHARD_BYTES", 2**13)
    shards, n = lm_bloom._fit(df)
    assert n >= size / 2**13 > few and n & (n - 1) == 0
    assert shards.agg(F.sum("n_tokens")).first()[0] == sum(len(tokens(r.text)) for r in df.collect())


def test_filter_levels():
    rng = np.random.default_rng(4)
    grams = rng.integers(0, 2**63, 20_000, dtype=np.uint64) * np.uint64(2)
    counts = rng.integers(1, 200, 20_000)
    held, bits, probes = lm_bloom.segment(grams, counts, 2**22)
    made = lm_bloom.Filter([(0, bits, probes, held)], 1)
    level = made.level(grams, np.zeros(len(grams), np.int64))
    true = np.floor(np.log2(counts)).astype(int) + 1
    assert (level >= true).all() and (level == true).mean() > 0.95
    strangers = rng.integers(0, 2**63, 20_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    assert (made.level(strangers, np.zeros(len(strangers), np.int64)) > 0).mean() < 0.05
    crowded, bits, probes = lm_bloom.segment(grams, counts, 2**14)
    assert bits <= 2**14 and (lm_bloom.Filter([(0, bits, probes, crowded)], 1).level(grams, np.zeros(len(grams), np.int64)) >= true).all()


# --- pipeline -----------------------------------------------------------------------------------------------
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows, at = docs.columns, {r.doc_id: r for r in docs.collect()}, docs
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        at = written(stage(spark, at, SF))
        found[name] = at.collect()
        assert name == "tokens" or at.columns == columns
    good = {r.doc_id for r in quality_gbdt.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.predicted}
    assert {r.doc_id for r in found["quality"]} == good
    classes = {r.doc_id: r.component_id for r in minmax_dedup.components(docs.where(F.col("doc_id").isin(*good))).collect()}
    assert sorted(r.doc_id for r in found["near_duplicates"]) == sorted({min(i for i, c in classes.items() if c == k) for k in classes.values()})
    assert {r.doc_id for r in found["secrets"]} == {r.doc_id for r in found["near_duplicates"]}
    spans = secret_scan.scan(spark.createDataFrame(found["secrets"], docs.schema)).where("size(spans) > 0")
    assert spans.isEmpty() and all(r.n_chars == len(r.text) for r in found["secrets"])
    assert all(r.text == rows[r.doc_id].text for r in found["secrets"] if "[assign]" not in r.text and "[hex]" not in r.text)
    passes = Counter(r.doc_id for r in found["mixing"])
    assert set(passes) <= {r.doc_id for r in found["secrets"]} and max(passes.values()) <= 3
    assert Counter(r.doc_id for r in found["tokens"]) == passes and all(r.decoded_same and len(r.ids) == r.n_tokens for r in found["tokens"])
    assert Counter((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()) == Counter((r.doc_id, r.ids_sha256) for r in found["tokens"])


def test_subpackage_can_go(tmp_path):
    """Without the two folders and the pipeline the rest still imports."""
    import os
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [k for k in q if k.startswith('op') or k == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, check=True, timeout=120)
