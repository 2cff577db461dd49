"""Language mixtures and the line CRF against plain versions, and their accuracy on held-out rows."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import functions as F

from loanbook.llm import language, line_quality
from loanbook.llm.queries import LLM_QUERIES


def test_mixture_is_the_likeliest():
    rng = np.random.default_rng(4)
    prob = rng.dirichlet(np.ones(40), 2).T.astype(np.float32)
    n = rng.integers(1, 30, 40).astype(np.float32)
    share, likelihood = language.fit_mixture(prob, n, np.full(2, 0.5, np.float32), 2000)
    grid = np.linspace(0.0005, 0.9995, 2000)
    values = [(n * np.log(prob @ np.array([g, 1 - g]))).sum() for g in grid]
    assert abs(grid[int(np.argmax(values))] - share[0]) < 0.01 and likelihood >= max(values) - 0.05


def test_language_set_follows_the_text(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = language.train(docs)
    text = {r.lang: r.text for r in docs.where("length(text) > 1500").select("lang", "text").orderBy("doc_id").collect()}
    assert (model.mixture(text["fr"]) > 0).sum() == 1
    mixed = dict(zip(model.langs, model.mixture(text["fr"][:1000] + "\n" + text["de"][:1000]), strict=True))
    assert 0.35 < mixed["fr"] < 0.65 and 0.35 < mixed["de"] < 0.65
    part = docs.where("doc_id < 60")
    counts = np.zeros((len(model.langs), language.BUCKETS), np.int64)
    for r in part.select("lang", "text").collect():
        if r.lang:
            counts[model.langs.index(r.lang)] += language.trigram_counts(r.text or "")
    assert np.allclose(language.train(part).prob, language.Model.of_counts(model.langs, counts).prob)


def test_languages_of_odd_rows(odd, nothing):
    model = language.train(odd)
    assert model.langs == ["en", "fr"]
    got = language.identify(odd, model).collect()
    assert len(got) == odd.count() and set(got[0].row.asDict()) == set(odd.columns)
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.row.text or ""))
        assert 0 <= r.score <= 1
    untaught = language.train(nothing)
    assert {r.lang_pred for r in language.identify(odd, untaught).collect()} == {"und"}
    assert language.identify(nothing, model).collect() == []


def test_held_out_languages(spark):
    rows = LLM_QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = rows.where("held_out").join(truth, "doc_id").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("right"))
    assert held.agg(F.avg("right")).first()[0] > 0.98


def enumerate_chain(unary, step):
    """Marginals of a chain by summing over all labelings."""
    good, total = np.zeros(len(unary)), 0.0
    for labels in itertools.product((0, 1), repeat=len(unary)):
        weight = np.exp(sum(u * y for u, y in zip(unary, labels, strict=True)) + sum(step[a, b] for a, b in itertools.pairwise(labels)))
        total += weight
        good += weight * np.array(labels)
    return good / total


def test_forward_backward_is_the_enumeration():
    rng = np.random.default_rng(5)
    lengths = [1, 7, 3, 1, 5]
    owner = np.repeat(np.arange(len(lengths)), lengths)
    unary, step = rng.normal(size=len(owner)), rng.normal(size=(2, 2))
    forward, backward = line_quality.Chains(owner, len(lengths)).odds(unary, step)
    odds = forward * backward
    for k in range(len(lengths)):
        assert np.allclose((odds / (1 + odds))[owner == k], enumerate_chain(unary[owner == k], step))


def test_line_features_do_not_depend_on_the_batch(texts):
    some = [t or "" for _, t in texts[:40]] + ["", "\n", "one\n\nthree", "  "]
    owner, length, base = line_quality.line_features(some)
    assert len(base) == sum(t.count("\n") + 1 for t in some)
    for k, text in enumerate(some):
        _, own_length, own = line_quality.line_features([text])
        assert np.allclose(base[owner == k], own) and np.array_equal(length[owner == k], own_length)


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (7, 0, 1), (11, 1, 0), (12, 0, None), (None, 1, 1), (15, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = line_quality.train(odd, labels)
    got = line_quality.score_documents(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert line_quality.train(nothing, labels) is None and line_quality.train(odd, labels.limit(0)) is None
    assert {r.score for r in line_quality.score_documents(odd, None).collect()} == {0.5}
    assert line_quality.score_documents(nothing, model).collect() == []


def test_quality_sample_is_of_labelled_rows(spark, monkeypatch):
    sizes = []
    fit = line_quality.fit
    monkeypatch.setattr(line_quality, "SAMPLE_DOCS", 60)
    monkeypatch.setattr(line_quality, "COPIES", 7)
    monkeypatch.setattr(line_quality, "fit", lambda lines, base, label: sizes.append(label.tolist()) or fit(lines, base, label))
    rows = [(i, f"Text number {i}.") for i in range(20)] + [(100, f"Row {i} of one id") for i in range(300)] + [(101, "equal rows")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(i, i % 2) for i in [*range(20), 100, 101, *range(1000, 3000)]], "doc_id long, quality int")
    models = [line_quality.train(docs.repartition(n), labels) for n in (2, 5)]
    assert [len(s) for s in sizes] == [60, 60] and sizes[0] == sizes[1] and np.array_equal(models[0].weights, models[1].weights)
    few = docs.where("doc_id < 20")
    assert line_quality.train(few, labels) is not None and sorted(sizes[-1]) == [0] * 10 + [1] * 10
    line_quality.train(docs.where("doc_id <> 100"), labels)
    assert len(sizes) == 4 and len(sizes[-1]) == 60


def test_held_out_quality(spark):
    rows = LLM_QUERIES["op2_line_quality"](spark, "/root/testdata/sf0.1")
    truth = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = rows.where("held_out").join(truth, "doc_id").toPandas()
    assert (held.predicted == held.quality).mean() > 0.97
    assert held[held.quality == 1].predicted.mean() > 0.98
