"""Classifiers on held-out rows, cap filters, decontamination, licences, mixing and the pipeline."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from tests.llm.conftest import awkward, documents, prose
from tidemark.llm import capfilters, decontamination, language, licenses, mixing, toxicity
from tidemark.llm.common import components, held_out
from tidemark.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), sf_dir, QUERIES[name], ORACLE[name])[0] == "ok"


def test_all_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names


# --- classifiers --------------------------------------------------------------------------------------

def test_held_out_rows_are_a_quarter(spark):
    import zlib

    got = spark.range(400).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_languages_of_held_out_rows(spark):
    got = QUERIES["op5_language_id"](spark, DATA)
    lang = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    held = got.join(lang, "doc_id").where("held_out")
    assert held.where("lang_pred = lang").count() >= 0.97 * held.count()
    assert got.where("score < 0 or score > 1").count() == 0 and got.count() == lang.count()


def test_languages_awkward(spark, odd, nothing):
    model = language.fit(spark.createDataFrame(
        [(i, ("der die und das ich " if i % 2 else "the and of that which ") * 5, "de" if i % 2 else "en") for i in range(60)],
        "doc_id long, text string, lang string"))
    rows = [r for r in awkward() if r[1] is not None]
    got = {r.text: (r.lang_pred, r.score) for r in language.predict(odd, model).select("text", "lang_pred", "score").collect()}
    assert got[None] == got[""] == got["1234 !!"] == got[" \n\t "] == ("und", 0.0)
    assert len(got) == len({t for _, t in rows} | {None})
    assert language.predict(odd, model).columns[-2:] == ["lang_pred", "score"]
    assert language.predict(spark.createDataFrame([("which of the that",)], "text string"), model).first().lang_pred == "en"
    assert language.identify(nothing).count() == 0
    assert language.identified(nothing).columns == nothing.columns
    none = language.fit(odd.where("false").select("doc_id", "text", "lang"))
    assert none.languages == [] and {r.lang_pred for r in language.predict(odd, none).collect()} == {"und"}


def test_only_letters_count(spark):
    model = language.fit(spark.createDataFrame([(1, "der die das", "de"), (2, "the of and", "en")], "doc_id long, text string, lang string"))
    rows = spark.createDataFrame([("½ ²",), ("Ⅷ",), ("١٢٣",), ("_ _",), ("ª",), ("語",)], "text string")
    got = {r.text: r.lang_pred for r in language.predict(rows, model).collect()}
    assert [got[t] for t in ("½ ²", "Ⅷ", "١٢٣", "_ _")] == ["und"] * 4 and "und" not in (got["ª"], got["語"])


def test_sparse_learner_equals_a_plain_one():
    """Every weight by the per-coordinate rule, cell by cell, in the same order of rows."""
    rng = np.random.default_rng(2)
    rows = [(np.sort(rng.choice(40, 6, replace=False)), rng.random(6).astype(np.float32), int(rng.integers(0, 3))) for _ in range(25)]
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.1
    met = {(int(f), y) for at, _, y in rows for f in at} | {("bias", k) for k in range(3)}
    z, n = dict.fromkeys(met, 0.0), dict.fromkeys(met, 0.0)

    def weight(c):
        return 0.0 if abs(z[c]) <= l1 else -(z[c] - np.sign(z[c]) * l1) / ((beta + np.sqrt(n[c])) / alpha + l2)

    order = np.random.default_rng(0)
    for _ in range(4):
        for i in order.permutation(len(rows)):
            at, value, label = rows[i]
            x = {int(f): float(v) for f, v in zip(at, value)} | {"bias": 1.0}
            w = {c: weight(c) for c in met if c[0] in x}
            e = np.exp([sum(x[f] * w[f, k] for f, k in w if k == c) for c in range(3)])
            e = e / e.sum() - np.eye(3)[label]
            for c in w:
                g = x[c[0]] * e[c[1]]
                z[c] += g - (np.sqrt(n[c] + g * g) - np.sqrt(n[c])) / alpha * w[c]
                n[c] += g * g
    begin, classes, weights, bias = language.train(rows, 3)
    got = {(f, int(k)): float(w) for f in range(40) for k, w in zip(classes[begin[f]:begin[f + 1]], weights[begin[f]:begin[f + 1]])}
    assert got.keys() == {c for c in met if c[0] != "bias" and weight(c)}
    assert np.allclose([got[c] for c in got], [weight(c) for c in got], atol=1e-6)
    assert np.allclose(bias, [weight(("bias", k)) for k in range(3)])


def test_a_language_of_one_hot_id(spark):
    """Nearly all rows of a language share an id: its other ids are still found, and so is the id."""
    docs = spark.range(20_000).selectExpr(
        "if(id % 20 = 0, id, 7) as doc_id", "concat('der die und ', id % 5) as text", "'de' as lang").unionByName(
        spark.range(600).selectExpr("id as doc_id", "concat('the and of ', id % 5) as text", "'en' as lang"))
    model = language.fit(docs, rows_per_language=30)
    assert model.languages == ["de", "en"]
    assert language.predict(spark.createDataFrame([("und der",), ("of the",)], "text string"), model).select("lang_pred").collect() == [("de",), ("en",)]


def test_every_language_is_learned(spark):
    """More languages than 64, one of a single text; the bound on all rows thins out the texts of each."""
    rows = [(100 * k + i, f"{chr(0x4E00 + k) * 3} {chr(0x4E00 + k)} " * 4, f"l{k:03}") for k in range(80) for i in range(1 if k == 79 else 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for rows_in_all in (32_000, 160, 10):
        model = language.fit(docs, rows_in_all=rows_in_all)
        assert model.languages == [f"l{k:03}" for k in range(80)]
        got = language.predict(docs, model).where("lang_pred = lang").select("lang").distinct().count()
        assert got == 80


def test_temperature_tempers_a_model_that_is_too_sure():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 400)
    logits = np.zeros((400, 2))
    logits[np.arange(400), np.where(rng.random(400) < 0.7, labels, 1 - labels)] = 20
    assert language.temperature(logits, labels) > 4.9


def test_positive_unlabelled_learner_equals_a_plain_one():
    """The corrected risk and its steps with dense rows, text by text."""
    rng = np.random.default_rng(5)
    positive = [np.unique(rng.choice(30, 8)).astype(np.int32) for _ in range(20)]
    unlabelled = [np.unique(np.append(rng.choice(40, 9), [])).astype(np.int32) for _ in range(50)]
    prior, rate, l1 = 0.2, 0.05, 2e-4
    rows = [*positive, *unlabelled]
    names = [w for w in range(40) if sum(w in r for r in rows) >= 3]
    x = np.array([[float(w in r) for w in names] for r in rows])
    p, u, w, b = len(positive), len(unlabelled), np.zeros(len(names)), np.log(prior / (1 - prior))
    m, v, climbed = np.zeros(len(names) + 1), np.zeros(len(names) + 1), 0
    for step in range(1, 401):
        f = x @ w + b
        s = 1 / (1 + np.exp(-f))
        grad = lambda rows_, slope: np.append(x[rows_].T @ slope, slope.sum())
        pos, unl = slice(0, p), slice(p, p + u)
        plus = prior * grad(pos, (s[pos] - 1) / p)  # of R_P(+)
        minus = grad(unl, s[unl] / u) - prior * grad(pos, s[pos] / p)  # of R_U(-) - prior R_P(-)
        risk = np.log1p(np.exp(f[unl])).mean() - prior * np.log1p(np.exp(f[pos])).mean()
        climbed += risk < 0
        g = plus + minus if risk >= 0 else -minus
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        size = rate / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        move = size * m / (1 - 0.9 ** step)
        w, b = w - move[:-1], b - move[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - size[:-1] * l1, 0)
    model = toxicity.train(positive, unlabelled, prior)
    assert climbed and model.words.tolist() == [n for n, value in zip(names, w) if value]
    assert np.allclose(model.weights, w[w != 0], atol=1e-8) and np.isclose(model.bias, b)
    assert np.allclose([model.score(r) for r in rows], 1 / (1 + np.exp(-(x @ w + b))), atol=1e-8)


def test_toxicity_at_the_threshold(spark):
    """Of the held-out labelled rows of the larger table: precision and recall of ``predicted``."""
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where("toxic is not null")
    held = QUERIES["op1_toxicity_pu"](spark, sf_dir).where("held_out").join(labels, "doc_id")
    n = held.agg(F.sum("toxic").alias("toxic"), F.sum("predicted").alias("called"), F.sum(F.col("toxic") * F.col("predicted")).alias("both")).first()
    assert n.toxic > 20 and n.both >= 0.8 * n.toxic and n.both >= 0.9 * n.called


def test_the_prior_can_be_given(spark):
    docs = spark.createDataFrame([(k, "bad worse words" if k % 4 == 0 else "good kind words") for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(0, 80, 4)], "doc_id long, toxic int")
    for prior in (None, 0.25):
        got = {r.doc_id % 4 == 0: r.score for r in toxicity.predict(docs, toxicity.fit(docs, labels, prior=prior)).collect()}
        assert got[True] > got[False]
    assert got[True] > 0.3 > got[False]


def test_toxicity_of_held_out_rows(spark):
    got = QUERIES["op1_toxicity_pu"](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "toxic")
    held = got.join(labels, "doc_id").where("held_out").agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("score"))).alias("a"),
        F.avg(F.when(F.col("toxic") == 0, F.col("score"))).alias("b")).first()
    assert held.a > held.b + 0.3
    assert got.where("score < 0 or score > 1 or predicted <> cast(score >= 0.3 as int)").count() == 0


def test_toxicity_awkward(spark, odd, nothing):
    texts = [(i, prose(i + 900, 30) + (" vile" if i % 4 == 0 else "")) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200) if i % 8 < 4] + [(None, 1, 1), (3, None, None)], LABELS)
    model = toxicity.fit(documents(spark, texts), labels)
    got = toxicity.predict(spark.createDataFrame([(1, "so VILE!"), (2, "so calm"), (3, None), (4, "")], "doc_id long, text string"), model).collect()
    assert [r.predicted for r in sorted(got, key=lambda r: r.doc_id)] == [1, 0, 0, 0]
    assert toxicity.predict(odd, model).count() == odd.count()
    assert toxicity.classify(nothing, labels).count() == 0
    no_labels = toxicity.classify(odd, labels.where("false"))
    assert no_labels.count() == odd.count() and no_labels.agg(F.max("predicted")).first()[0] == 0


def test_an_id_of_many_rows_teaches_once(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(language, "train", lambda rows, classes, real=language.train: seen.update(lang=len(rows)) or real(rows, classes))
    monkeypatch.setattr(toxicity, "train", lambda p, u, prior, real=toxicity.train: seen.update(toxic=(len(p), len(u))) or real(p, u, prior))
    rows = [(i, prose(i, 20)) for i in range(20)] + [(5, prose(1000 + i, 20)) for i in range(200)]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else "de") for i, t in rows], "doc_id long, text string, lang string")
    model = language.fit(docs, rows_per_language=10)
    assert model.languages == ["de", "en"] and seen["lang"] <= 20 and seen["lang"] >= 8
    toxicity.fit(docs, spark.createDataFrame([(i, 1, i % 2) for i in range(20)], LABELS))
    assert seen["toxic"] == (10, 20)


def test_negative_risk_is_not_fitted_away():
    """Where the positives are most of the unlabelled rows the corrected risk turns negative; the model
    must still tell the rest apart."""
    positive = [np.array([1, 10 + i % 5], dtype=np.int32) for i in range(100)]
    unlabelled = [np.array([1 if i % 5 == 0 else 2, 10 + i % 5], dtype=np.int32) for i in range(400)]
    model = toxicity.train(positive, unlabelled, prior=0.2)
    assert model.score(np.array([1], dtype=np.int32)) > 0.7 > 0.3 > model.score(np.array([2], dtype=np.int32))


# --- cap filters --------------------------------------------------------------------------------------

def brute_vectors(rows: list[tuple], least: float = 0.98) -> Counter:
    def sound(r) -> bool:
        return (r[0] is not None and r[2] is not None and r[1] is not None and len(r[1]) > 0
                and all(c is not None and np.isfinite(c) for c in r[1]) and any(c != 0 for c in r[1]))

    links, above = [0] * len(rows), list(range(len(rows)))

    def top(x: int) -> int:
        while above[x] != x:
            x = above[x]
        return x

    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if sound(a) and sound(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                    links[i] += 1
                    links[j] += 1
                    above[top(i)] = top(j)
    least_id: dict[int, int] = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least_id[top(i)] = min(least_id.get(top(i), r[0]), r[0])
    return Counter((r[0], links[i], least_id.get(top(i)), r[0] is None or r[0] == least_id[top(i)]) for i, r in enumerate(rows))


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block_rows", [7, 1024])
def test_cap_filters_find_all_links(spark, monkeypatch, block_rows):
    monkeypatch.setattr(capfilters, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(64).astype("f4").tolist(), i % 3) for i in range(60)]
    for g in range(8):  # near copies of one vector, from close to just below the bound
        base = rng.standard_normal(64)
        rows += [(1000 + 100 * g + k, (base + rng.standard_normal(64) * 0.03 * (k % 6)).astype("f4").tolist(), g % 2) for k in range(30)]
    copy = rows[0][1]
    rows += [(5000, copy, 0), (5001, copy, 0), (5001, copy, 0), (5002, copy, 1), (5003, None, 0), (5004, [], 0),
             (5005, [0.0] * 64, 0), (5006, [float("nan")] + copy[1:], 0), (5007, [None] + copy[1:], 0), (5008, copy, None),
             (None, copy, 0), (5009, copy[:32], 0), (5010, [float("inf")] + copy[1:], 0), (5011, [1.0], 2), (5012, [2.0], 2)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' as class", "'y' as filters", "'z' as copies")
    assert Counter(tuple(r) for r in capfilters.near_duplicates(df).collect()) == brute_vectors(rows)
    assert capfilters.near_duplicates(df.where("false")).count() == 0


def test_an_id_with_several_vectors(spark):
    """Its rows are vectors of their own: links stay within a label, and groups do not meet through the id."""
    rng = np.random.default_rng(8)
    a, b, c = (rng.standard_normal(16) for _ in range(3))
    near = lambda v: (v + rng.standard_normal(16) * 0.01).astype("f4").tolist()
    for rows in ([(5, near(a), 0), (5, near(b), 0), (5, near(a), 1), (7, near(a), 0), (8, near(a), 0), (9, near(b), 0)],
                 [(5, near(a), 0), (5, near(a), 1), (6, near(a), 1)],
                 [(5, near(a), 0), (5, near(a), 0), (4, near(c), 0), (6, near(c), 0), (3, near(b), None)]):
        got = capfilters.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
        assert Counter(tuple(r) for r in got) == brute_vectors(rows)


@pytest.mark.parametrize("dims", [2, 4, 16, 64, 257])
def test_cap_filter_recall_at_the_bound_itself(dims):
    """Pairs at cosine 0.98 share a filter, whatever the dimension and the number of vectors."""
    rng = np.random.default_rng(dims)
    x = rng.standard_normal((200, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rng.standard_normal((200, dims))
    off -= (off * x).sum(axis=1, keepdims=True) * x
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    y = 0.98 * x + np.sqrt(1 - 0.98 ** 2) * off
    for vectors in (100, 100_000, 20_000_000):
        code = capfilters.codebook(dims, vectors)
        one, two = capfilters.decode(x, code), capfilters.decode(y, code)
        assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in zip(one, two)]) >= 0.97
        if dims >= 16:
            assert capfilters.LEAST <= np.mean([len(f) for f in one]) <= 3 * capfilters.PASSED


def test_decoding_finds_all_filters_above_the_bound():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((20, 30))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for parts in (1, 2, 3):
        books = [b / np.linalg.norm(b, axis=0) / np.sqrt(parts) for b in (rng.standard_normal((30 // parts, 7)) for _ in range(parts))]
        code = capfilters.Code(np.eye(30), books, 0.2)
        every = np.stack(np.meshgrid(*[np.arange(7)] * parts, indexing="ij"), axis=-1).reshape(-1, parts)
        for row, got in zip(x, capfilters.decode(x, code, least=3)):
            scores = sum((row.reshape(parts, -1)[k] @ books[k])[every[:, k]] for k in range(parts))
            over = np.flatnonzero(scores >= 0.2)
            want = over if len(over) >= 3 else np.sort(np.argsort(-scores)[:3])
            assert got.tolist() == want.tolist()


def test_buckets_stay_small(spark):
    """Five times the vectors: buckets of the same size."""
    rng = np.random.default_rng(9)
    sizes = []
    for n in (16_000, 80_000):
        x = rng.standard_normal((n, 32))
        filters = np.concatenate(capfilters.decode(x / np.linalg.norm(x, axis=1, keepdims=True), capfilters.codebook(32, n)))
        counts = np.unique(filters, return_counts=True)[1]
        sizes.append((counts.astype(float) ** 2).sum() / counts.sum())
    assert sizes[1] < 1.5 * sizes[0]


def test_cap_filter_recall_on_the_table(spark):
    """Links of every hundredth vector, against brute force over all rows."""
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    rng = np.random.default_rng(1)
    close = [(100_000 + i, (np.array(v) + rng.standard_normal(len(v)) * np.std(v) * 0.12).astype("f4").tolist(), c)
             for i, v, c in rows[::20]]
    rows += close
    got = {r.vec_id: r.n_links for r in capfilters.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    x = np.array([v for _, v, _ in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([c for *_, c in rows])
    want = {rows[i][0]: int(((x @ x[i] >= 0.98) & (label == label[i])).sum()) - 1 for i in range(len(rows)) if rows[i][0] % 100 == 0}
    assert sum(want.values()) > 5
    assert sum(got[i] for i in want) >= 0.97 * sum(want.values())


# --- decontamination ----------------------------------------------------------------------------------

@pytest.mark.parametrize("size", [15, 16, 17, 19, 20, 22, 24, 25, 30])
def test_masks_hit_items_with_a_fifth_replaced(size):
    """Of all choices of a fifth of the tokens (or 3,000 of them), in how many a window is left whole."""
    from itertools import combinations, islice

    rng = np.random.default_rng(size)
    n = size * (100 - decontamination.AGREE) // 100
    every = list(islice(combinations(range(size), n), 60_000))
    if len(every) > 3_000:
        every = [rng.choice(size, n, replace=False) for _ in range(3_000)]
    gone = np.zeros((len(every), size), dtype=bool)
    for row, places in zip(gone, every):
        row[list(places)] = True
    hit = np.zeros(len(every), dtype=bool)
    for mask in decontamination.MASKS:
        places = [i for i, bit in enumerate(mask) if bit == "1"]
        for at in range(size - decontamination.SPAN + 1):
            hit |= ~gone[:, [at + p for p in places]].any(axis=1)
    assert hit.mean() >= {15: 0.96, 16: 0.99}.get(size, 0.998)


def test_decontamination_equals_sql_on_parts_and_short_items(spark, monkeypatch):
    """Items of 1 to 40 tokens, whole, cut, in two parts, with a fifth replaced; with and without the broadcast of keys."""
    import duckdb

    rng, items, texts = np.random.default_rng(12), [], []
    for i, size in enumerate([1, 2, 4, 5, 9, 11, 12, 14, 15, 15, 18, 24, 30, 40, 40]):
        words = [f"q{i}w{k}" for k in range(size)]
        items.append((i, " ".join(words)))
        for k in range(8):
            changed = list(words)
            for at in rng.choice(size, min(size, (size * 20 // 100) + k % 3 - 1 if k else 0) if size >= 5 else 0, replace=False):
                changed[at] = f"x{k}"
            if k == 6 and size >= 30:
                changed[12:-12] = ["z"] * (size - 24)
            if k == 7:
                changed = changed[: size * 4 // 5]
            texts.append((len(texts), f"{prose(i, k * 3)} {' '.join(changed)} {prose(i + k, 5)}"))
    texts += [(900, None), (901, ""), (None, items[0][1]), (902, items[2][1])]
    docs, benchmark = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    d, b = docs.toPandas(), benchmark.toPandas()  # noqa: F841
    want = duckdb.sql(decontamination.oracle("d", "b")).fetchall()
    assert Counter(tuple(r) for r in decontamination.overlaps(docs, benchmark).collect()) == Counter(want) and len(want) > 60
    monkeypatch.setattr(decontamination, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(decontamination, "BROADCAST_SEEDS", 0)
    assert Counter(tuple(r) for r in decontamination.overlaps(docs, benchmark).collect()) == Counter(want)

def test_substituted_benchmark_items_are_found(spark, nothing):
    item = prose(40, 30)
    words = item.split()
    swapped = list(words)
    for at in (4, 13, 22):
        swapped[at] = "other"
    rows = [(1, prose(41, 50) + " " + item + " " + prose(42, 9)), (2, prose(43, 20) + " " + " ".join(swapped)), (3, prose(44, 300)),
            (4, None), (5, ""), (None, item), (6, " ".join(words[:8])), (7, item.upper().replace(" ", ", ")),
            (8, prose(45, 40) + " " + item), (8, prose(45, 40) + " " + item)]
    bench = spark.createDataFrame([(9, item), (None, item), (10, None), (11, "too short"), (12, "")], "item_id long, text string")
    docs = documents(spark, rows)
    found = {r.doc_id: (r.item_id, r.start, r.n_tokens, r.n_matched) for r in decontamination.overlaps(docs, bench).collect()}
    assert found[1] == (9, 50, 30, 30) and found[2][0] == 9 and found[2][3] == 27 and found[7][0] == 9
    assert set(found) == {1, 2, 7, 8}
    kept = decontamination.without_benchmark(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {3, 4, 5, 6}
    assert decontamination.without_benchmark(docs, bench.where("false")).count() == len(rows)
    assert decontamination.without_benchmark(nothing, bench).count() == 0


def test_more_copied_text_hides_no_item(spark):
    """Parts of an item around replaced tokens are each enough; so is the whole item."""
    words = prose(50, 100).split()
    new = [f"new{i}" for i in range(100)]
    spread = list(words[:50])
    for at in (11, 13, 15, 17, 19, 20, 22, 24, 26, 28):
        spread[at] = new[at]
    texts = {1: words[:20] + new[20:60], 2: words[:20] + new[20:40] + words[40:60], 3: words[:35] + new[35:65] + words[65:],
             4: new[:30] + words[:20] + new[20:40] + words[40:60], 5: new[:20] + words[20:26] + new[26:60], 6: spread}
    docs = documents(spark, [(i, " ".join(t)) for i, t in texts.items()])
    bench = spark.createDataFrame([(60, " ".join(words[:60])), (100, " ".join(words)), (50, " ".join(words[:50]))], "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.start, r.n_tokens, r.n_matched) for r in decontamination.overlaps(docs, bench).collect()}
    assert found[1, 60] == (0, 20, 20) and found[2, 60] == (0, 20, 40) and found[3, 100] == (0, 35, 70) and found[4, 60] == (30, 20, 40)
    assert found[6, 50][2] == 40 and all(doc != 5 for doc, _ in found)
    assert {r.doc_id for r in decontamination.without_benchmark(docs, bench.where("item_id > 50")).collect()} == {5}


def test_short_items_are_found(spark):
    """Items of 1 to 14 tokens, with any choice of tokens that may differ, and over the ends of a text."""
    from itertools import combinations

    items, rows, want = {}, [], set()
    for n in range(1, 15):
        words = [f"w{n}x{i}" for i in range(n)]
        items[n] = " ".join(words)
        for k in (n // 5, n // 5 + 1):
            for places in combinations(range(n), k):
                held = ["new" if i in places else w for i, w in enumerate(words)]
                rows.append((len(rows), " ".join(["before", *held, "after", "after"])))
                want |= {(len(rows) - 1, n)} if k == n // 5 else set()
        for cut in {n // 5, n // 5 + 1}:
            for held in (words[cut:] + ["after"], ["before"] + words[:n - cut]):
                rows.append((len(rows), " ".join(held)))
                want |= {(len(rows) - 1, n)} if cut == n // 5 else set()
    bench = spark.createDataFrame([*items.items(), (15, ""), (16, None)], "item_id int, text string")
    got = decontamination.overlaps(documents(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(r.start >= 0 and r.n_matched >= r.item_id - r.item_id // 5 and r.n_tokens <= r.item_id for r in got)
    first = documents(spark, [(1, "the end is the end of the end"), (2, "no match")])
    assert [tuple(r) for r in decontamination.overlaps(first, spark.createDataFrame([(1, "The end?")], "item_id int, text string")).collect()] == [
        (1, 1, 0, 2, 2)]


def test_large_benchmarks_are_not_broadcast(spark, monkeypatch, odd):
    monkeypatch.setattr(decontamination, "BROADCAST_SEEDS", 0)
    bench = spark.createDataFrame([(1, prose(5, 200))], "item_id long, text string")
    assert [r.doc_id for r in decontamination.overlaps(odd, bench).collect()] == [11]


# --- licences -----------------------------------------------------------------------------------------

def test_licences_are_inherited_from_the_nearest_folder(spark):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.txt", "no notice"), (3, "a/b/COPYING.md", "text\nLicensed under CC BY-NC 4.0.\n"),
            (4, "a/y.txt", prose(1, 9)), (5, "z.txt", None), (6, "a/b/z.py", "Licensed under the Apache License, Version 2.0."),
            (7, None, "This work is licensed under the GNU General Public License, version 3."), (8, "ab/x", ""), (8, "ab/x", ""),
            (None, "a/n", "x"), (9, "q/license-notes/x", "licensed dogs bark at the copyright office of the moon")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").selectExpr("*", "'o' as folder", "'p' as license", "1 as score")
    got = Counter((r.doc_id, r.license, r.origin, r.folder) for r in licenses.scan(df).collect())
    assert got == Counter([
        (1, "MIT", "own", None), (2, "CC-BY-NC-4.0", "inherited", "a/b"), (3, "CC-BY-NC-4.0", "own", None), (4, "MIT", "inherited", "a"),
        (5, None, "none", None), (6, "Apache-2.0", "own", None), (7, "GPL-3.0", "own", None), (8, None, "none", None), (8, None, "none", None),
        (None, "MIT", "inherited", "a"), (9, None, "none", None)])
    assert licenses.scan(df.where("false")).count() == 0


BSD3 = licenses._BSD + licenses._BSD_NAMES + licenses._BSD_END
GPL3_HEADER = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
LICENCE_UNITS = [
    ("a.py", "# SPDX-License-Identifier: MIT\nimport os", "MIT"),
    ("b.c", "// SPDX-License-Identifier: Apache-2.0 OR MIT\n// Copyright. All rights reserved.\nint x;", "Apache-2.0 OR MIT"),
    ("c.py", GPL3_HEADER + "\n\nimport os\n", "GPL-3.0"),
    ("d.py", GPL3_HEADER.replace("version 3", "version 2"), "GPL-2.0"),
    ("e/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2\n", "GPL-2.0"),
    ("f/COPYING", "GNU GENERAL PUBLIC LICENSE\n\nVersion 3, 29 June 2007\n\n" + prose(60, 900), "GPL-3.0"),
    ("g/COPYING.LESSER", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n", "LGPL-3.0"),
    ("h/LICENSE", "Copyright (c) 2021, The Authors\n\n" + BSD3.replace(". ", ".\n"), "BSD-3-Clause"),
    ("i/LICENSE.txt", "Copyright (c) 2021, The Authors\n\n" + BSD3.replace(licenses._BSD_NAMES, "").replace(". ", ".\n"), "BSD-2-Clause"),
    ("j/LICENSE", "MIT License\n\nCopyright (c) 2021 Someone\n\n" + max((t for n, t in licenses.TEMPLATES if n == "MIT"), key=len), "MIT"),
    ("k.go", "/*\n * " + max((t for n, t in licenses.TEMPLATES if n == "Apache-2.0"), key=len).replace(". ", ".\n * ") + "\n */\npackage k", "Apache-2.0"),
    ("l.js", "// A module that draws boxes\n// and lines.\nlet x = 1", None),
    ("m/LICENSE", prose(61, 200), None),
]


def test_headers_and_licence_files(spark):
    rows = [(i, path, text) for i, (path, text, _) in enumerate(LICENCE_UNITS)]
    rows += [(100, "h/src/deep/x.py", "x = 1"), (101, "e/x.py", ""), (102, "e/long.txt", prose(62, 30_000))]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.origin) for r in licenses.scan(df).collect()}
    assert [got[i] for i in range(len(LICENCE_UNITS))] == [(n, "own" if n else "none") for *_, n in LICENCE_UNITS]
    assert got[100] == ("BSD-3-Clause", "inherited") and got[101] == got[102] == ("GPL-2.0", "inherited")


def test_licence_units_equal_sql(spark):
    """The same files, and a score that two licences share, in SQL."""
    import duckdb

    rows = [(i, path, text) for i, (path, text, _) in enumerate(LICENCE_UNITS)]
    rows += [(50, "t/x.py", "# Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0."), (51, "t/y.py", None), (52, "t/z.py", " \n\n"), (53, "t/w.py", "#\r\n# The MIT License\r\nx")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    frame = df.toPandas()  # noqa: F841
    want = duckdb.sql(licenses.oracle("SELECT * FROM frame")).fetchall()
    key = lambda r: (r[0], r[1], None if r[2] is None else round(r[2], 4), r[3], r[4])
    assert Counter(key(tuple(r)) for r in licenses.scan(df).collect()) == Counter(key(r) for r in want)


# --- mixing -------------------------------------------------------------------------------------------

def test_shortages_go_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", 100), ("a", "y", 1000), ("b", "x", 1000), ("b", "y", 50)], "d string, l string, tokens long")
    got = {r.leaf: r.share for r in mixing.budgets(leaves, ["d", "l"], {}, 1000, 1).collect()}
    # 500 each; a's x holds 100, so its y takes 400; b's y holds 50, so its x takes 450.
    assert got == {"1:a/1:x": 100, "1:a/1:y": 400, "1:b/1:x": 450, "1:b/1:y": 50}
    short = {r.leaf: r.share for r in mixing.budgets(leaves.where("d = 'a' and l = 'x' or d = 'b'"), ["d", "l"], {("a",): 9}, 1000, 1).collect()}
    assert short == {"1:a/1:x": 100, "1:b/1:x": 850, "1:b/1:y": 50}


@pytest.mark.parametrize("budget", [0, 1, 20, 29, 30, 31])
def test_no_part_of_a_budget_is_lost(spark, budget):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 10), ("b", "x", 10)], "d string, l string, tokens long")
    for levels in (["d", "l"], ["l", "d"]):
        shares = [r.share for r in mixing.budgets(leaves, levels, {("a",): 3}, budget, 1).collect()]
        assert sum(shares) == min(budget, 30) and all(0 <= s <= 10 for s in shares)


def test_mix_keeps_budgets_and_epochs(spark, odd, nothing):
    rows = [(i, prose(i, 1 + i % 9)) for i in range(300)]
    docs = documents(spark, rows)
    half = mixing.mix(docs, ["source", "lang"], {("src1",): 3}, percent=50, max_epochs=1, copies="times")
    total = docs.agg(F.sum(mixing.word_count())).first()[0]
    taken = half.agg(F.sum(mixing.word_count() * F.col("times"))).first()[0]
    assert total * 0.5 - 9 * 8 <= taken <= total * 0.5 and half.columns == [*docs.columns, "times"]
    assert half.agg(F.max("times")).first()[0] == 1
    twice = mixing.mix(docs, ["source"], {("src1",): 1_000_000}, percent=60, max_epochs=2, copies="times")
    assert {r.times for r in twice.where("source = 'src1'").collect()} == {2}
    same = mixing.mix(docs, ["source", "lang"], {("src1",): 3}, percent=50, max_epochs=1, copies="times")
    assert {r.doc_id for r in same.collect()} == {r.doc_id for r in half.collect()}
    all_rows = mixing.mix(odd, ["source", "lang"], {}, percent=100, max_epochs=1)
    words = odd.where(mixing.word_count() > 0).count()
    assert all_rows.where(mixing.word_count() > 0).count() == words
    assert mixing.mix(odd, ["source"], {(None,): 0}, percent=100).count() == 0
    assert mixing.mix(nothing, ["source"], {}).count() == 0


# --- links and the pipeline ---------------------------------------------------------------------------

def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and got[300] == got[200] == 200


@pytest.mark.parametrize("few", [False, True])
def test_pipeline_on_awkward_and_empty_tables(spark, odd, nothing, few):
    """Nulls, repeats, long texts and clashing columns go through every stage; an empty table stays one."""
    import corpus_pipeline as pipeline

    docs = nothing if few else odd.unionByName(documents(spark, [(1000 + i, prose(1000 + i, 400_000 if i == 5 else 30)) for i in range(20)]))
    n = docs.count()
    for name, stage in pipeline.STAGES:
        before, docs = docs, stage(spark, docs, DATA).cache()
        if name != "token_ids":
            assert docs.columns == before.columns and docs.exceptAll(before).count() == 0
        assert docs.count() <= n
        n = docs.count()
    assert n == 0 if few else n > 5


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline
    from tests.llm.test_text_operators import brute_groups, ids_of

    assert [n for n, _ in pipeline.STAGES] == ["language_id", "near_duplicates", "benchmark_decontamination", "source_mix", "token_ids"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, stage(spark, docs, DATA)
        docs = docs.cache()
        seen[name] = docs
        if name != "token_ids":
            assert docs.columns == before.columns
    full = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert seen["language_id"].count() >= 0.98 * len(full)
    kept = sorted(r.doc_id for r in seen["language_id"].select("doc_id").collect())
    groups = brute_groups([(i, full[i].text) for i in kept])
    assert {r.doc_id for r in seen["near_duplicates"].collect()} == {d for d, _, c in groups if d == c}
    con = connect(DATA)
    dirty = {r[0] for r in con.execute(ORACLE["op8_spaced_seed_decontamination"]).fetchall()}
    assert {r.doc_id for r in seen["benchmark_decontamination"].collect()} == {d for d, _, c in groups if d == c} - dirty
    mixed = {r.doc_id for r in seen["source_mix"].collect()}
    clean = {r.doc_id for r in seen["benchmark_decontamination"].collect()}
    size = {i: len(full[i].text.split()) for i in clean}
    assert mixed <= clean and 0.75 * sum(size.values()) <= sum(size[i] for i in mixed) <= 0.8 * sum(size.values())
    start = 0
    for r in seen["token_ids"].orderBy("doc_id").collect():
        assert (r.start, r.n_tokens) == (start, len(ids_of(full[r.doc_id].text)) + 1)
        start += r.n_tokens
    assert {r.doc_id for r in seen["token_ids"].collect()} == mixed
