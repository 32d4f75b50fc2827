"""Quality and language: brute-force votes and mixtures, held-out accuracy, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from tallyvein.llm import language, quality
from tallyvein.llm.queries import op3_quality, op4_language
from tallyvein.llm.words import text_slices

MID = "/root/testdata/sf0.01"


def column(texts):
    import pyarrow as pa

    return pa.array(texts, pa.string())


def test_votes_equal_brute_force():
    texts = ["plain words here and there.", "LOUD!! WORDS!! HERE!!", "again again again again", "a b c", "", "x | y | z | w", "Some more plain words, yes."] * 3
    (_, data, offsets), = text_slices(column(texts))
    counts = quality._terms(data, offsets)
    labels = np.array([1, 0, 0, 1, 1, 0, 1] * 3, float)
    model = quality.Model.fit(counts, labels, 8)
    got = model.scores(counts, 5, block=2)
    for i, c in enumerate(counts):
        if not c.any():
            assert got[i] == model.prior
            continue
        v = np.log1p(c) * model.weights
        v = (v / np.linalg.norm(v)) @ model.axes
        cosines = model.vectors @ (v / np.linalg.norm(v))
        near = np.sort(cosines)[::-1][:5]
        order = np.argsort(-cosines, kind="stable")[:5]
        if np.isclose(near[-1], np.sort(cosines)[::-1][5], atol=1e-6):
            continue  # a tie at the end of the list
        w = np.maximum(cosines[order], 1e-6) ** quality.SHARPNESS
        assert abs(got[i] - (w * labels[order]).sum() / w.sum()) < 1e-5


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{MID}/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = op3_quality(spark, MID).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 40 and all(0 <= r.score <= 1 for r in rows)
    clean = [r.predicted for r in held if r.quality == 1]
    junk = [r.predicted for r in held if r.quality == 0]
    assert np.mean(clean) > 0.97 and np.mean(junk) < 0.5


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "q"), (2, "", None), (3, "w " * 500_000, "q"), (4, "good text here.", "q"), (4, "good text here.", "q"), (5, "BAD!! BAD!!", "q")], "doc_id long, text string, score string"
    )
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (6, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    got = [(r.doc_id, round(r.score, 3)) for r in quality.quality_scores(docs, model).collect()]
    assert len(got) == 6 and dict(got)[1] == dict(got)[2] == 0.5 and dict(got)[4] > 0.5 > dict(got)[5]
    kept = quality.keep_quality(docs, model, accept=0.4)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 4} and 5 not in {r.doc_id for r in kept.collect()}
    blank = quality.fit_quality(docs, labels.limit(0))
    assert {r.score for r in quality.quality_scores(docs, blank).collect()} == {0.5}
    assert quality.quality_scores(docs.limit(0), model).count() == 0


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang")
    rows = op4_language(spark, MID).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang is not None]
    assert len(held) > 100 and np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixture(spark):
    words = {"aa": "bab abba baba abab", "cc": "cdc dccd cdcd dcdc", "ee": "efe feef efef fefe"}
    rows = [(i, f"{w} " * 20, lang) for i, (lang, w) in enumerate(words.items())]
    rows += [(10, (words["aa"] + " ") * 30 + (words["cc"] + " ") * 10, None), (11, None, "aa"), (12, "", "cc"), (13, "12 34 !", None), (14, "一二三 ", None), (15, "B", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit_languages(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    assert [got[i][0] for i in range(3)] == ["aa", "cc", "ee"]
    assert got[10][0] == "aa" and 0.6 < got[10][1] < 0.9
    assert got[11] == got[12] == got[13] == ("und", 0.0) and got[14][0] != "und" and got[15][0] == "aa"
    assert language.identify(docs.limit(0), model).count() == 0
    empty = language.fit_languages(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, empty).collect()} == {"und"}
    long = spark.createDataFrame([(1, "efef fefe " * 100_000)], "doc_id long, text string")
    assert language.identify(long, model).first().lang_pred == "ee"


def test_selection_beats_every_smaller_step():
    """The chosen set's penalised likelihood is that of a brute-force climb over its sets."""
    rng = np.random.default_rng(1)
    table = rng.dirichlet(np.full(language.BINS, 0.01), 3).T.astype(np.float32) + 1e-9
    model = language.Model(["a", "b", "c"], (table / table.sum(0)).astype(np.float32))
    mixed = np.concatenate([rng.choice(language.BINS, 400, p=model.likelihood[:, 0] / model.likelihood[:, 0].astype(float).sum()) for _ in range(1)])
    best, share, total = model.mixtures(mixed, 2)
    assert best[0] == 0 and share[0] > 0.9 and total.tolist() == [400, 0]
