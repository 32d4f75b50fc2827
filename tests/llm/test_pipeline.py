"""Every stage next to plain Python on the stage's own input."""

import hashlib
from fractions import Fraction

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tallyvein.llm.queries import part
from tallyvein.llm.quality import ACCEPT, fit_quality, quality_scores

from test_decontamination import brute as brute_leaks
from test_ngram_join import brute as brute_groups
from test_secrets import brute as brute_secrets


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    # Repeated rows, nulls and an extra column that clashes with a result's name.
    extra = spark.createDataFrame([(0, None, None, None, None), (None, "", "en", "src0", 0), (None, None, None, None, None)], docs.schema)
    docs = docs.unionByName(docs.limit(3)).unionByName(extra)
    out = [docs]
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, out[-1], data).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "text", "lang", "source").collect()), key=repr)


def test_order_and_columns(stages):
    assert [name for name, _ in pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "BPE encoding and decoding"
    ]
    assert all(df.columns == stages[0].columns and df.dtypes == stages[0].dtypes for df in stages[1:-1])


def test_quality(spark, data, stages):
    model = fit_quality(stages[0], spark.read.parquet(f"{data}/labels.parquet"), learn=part(5) != 0)
    scores = {(r.doc_id, r.score) for r in quality_scores(stages[0], model).collect()}
    good = {d for d, s in scores if s >= ACCEPT}
    assert {r[0] for r in rows(stages[1])} == good and len(good) < len({d for d, _ in scores})


def test_near_duplicates(stages):
    before = rows(stages[1])
    named = sorted({(r[0], r[1]) for r in before if r[0] is not None}, key=repr)
    heads = {(d, c) for d, _, c in brute_groups(named, 5, Fraction(8, 10))}
    expected = sorted([r for r in {*before} if r[0] is not None and (r[0], r[0]) in heads] + [r for r in before if r[0] is None], key=repr)
    assert rows(stages[2]) == expected and len(expected) < len(before)


def test_decontamination(spark, data, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    before = rows(stages[2])
    bad = {d for d, _ in brute_leaks([(i, r[1]) for i, r in enumerate(before)], items)}
    assert rows(stages[3]) == [r for i, r in enumerate(before) if i not in bad] and bad


def test_secrets(stages):
    before = {r[0]: r for r in rows(stages[3])}
    after = {r[0]: r for r in rows(stages[4])}
    assert before.keys() == after.keys()
    for d, r in before.items():
        if not brute_secrets(r[1]):
            assert after[d][1] == r[1] or "[secret]" in after[d][1]
        else:
            assert after[d][0] == r[0]


def test_bpe(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for r in rows(stages[4]):
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((r[0], len(ids), ids, hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, stages[5].collect()), key=repr) == sorted(expected, key=repr)


def test_run_equals_its_stages(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, data).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    got = sorted(map(tuple, pipeline.run(spark, data).collect()), key=repr)
    assert got == sorted(map(tuple, docs.collect()), key=repr) and got


def test_stages_keep_columns_of_any_name(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("doc_id < 60")
    docs = docs.withColumns({name: F.lit(name) for name in ("_text", "_id", "_hash", "_spans", "_done", "id", "set_id")})
    for stage in (pipeline.near_duplicates, pipeline.secrets):
        out = stage(spark, docs, data)
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.select("_text", "_id", "_done", "set_id").collect()} == {("_text", "_id", "_done", "set_id")}
