"""License scans next to plain loops over every block of every text."""

import math
import random
import re

from pyspark.sql import functions as F

import check
from tallyvein.llm.licenses import CONTAINED, LICENSE_SQL, PHRASES, TEMPLATES, license_report
from tallyvein.llm.queries import op5_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, base = [], set()
    for phrase, label in PHRASES:
        own = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += here
        base |= {label} if here else set()
    labels, share = set(base), 0.0
    for label, statement in TEMPLATES:
        own = WORD.findall(statement.lower())
        for i in range(0, len(words), len(own)):
            part = len(set(words[i : i + 2 * len(own)]) & set(own))
            if part >= math.ceil(CONTAINED * len(set(own))):
                labels.add(label)
                share = max(share, part / len(set(own)))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if places else share)


def test_equals_brute_force(spark):
    rng = random.Random(8)
    filler = ["mit", "the", "und", "é", "license", "Licensed", "under", "x1", "MIT License", "of", "GNU", "version", "-", "_"]
    texts = [None, "", " -- ", "mit license " * 40_000, "\u0130 M\u0130T License, mit l\u0130cense, This wor\u212a is licensed under the GNU General Public License, version 3 ÉÀ"]
    for _ in range(400):
        parts = rng.choices(filler, k=rng.randrange(60))
        for _ in range(rng.randrange(3)):
            own = rng.choice(TEMPLATES)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                own[rng.randrange(len(own))] = "zzz"
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = own
        texts.append(rng.choice([" ", "\n", ", "]).join(parts))
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, texts[7], "x"), (9, texts[9], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = license_report(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        expected = brute(texts[7 if r.doc_id is None else r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == expected
    assert license_report(docs.limit(0)).count() == 0


def test_sql_agrees(spark, data):
    got = op5_license_scan(spark, data)
    found = check.connect(data).execute(LICENSE_SQL)
    names = [d[0] for d in found.description]
    assert check.rows_of(got.columns, got.collect()) == check.rows_of(names, found.fetchall())
    assert got.where(F.col("labels") != F.col("base_labels")).count() > 0


def test_words_before_a_statement_change_nothing(spark):
    statements = [("mit-notice", "Released under the terms of the MIT License"), ("cc-by-nc-4.0", "Licensed under the Creative Commons CC BY-NC version 4.0")]
    rows = [(100 * k + n, "x " * n + text + " y" * 20, label) for k, (label, text) in enumerate(statements) for n in range(15)]
    rng = random.Random(12)
    for i in range(300):
        own = WORD.findall(rng.choice(TEMPLATES)[1])
        words = [w for o in own for w in rng.choices([[o], ["zz", o], []], [6, 3, 1])[0]]
        rows.append((1000 + i, " ".join(["q"] * rng.randrange(40) + words + ["q"] * rng.randrange(40)), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    got = {r.doc_id: r for r in license_report(docs, every_start=True).collect()}
    assert len(got) == len(rows)
    for i, text, label in rows:
        words = WORD.findall(text.lower())
        shares = {}
        for name, statement in TEMPLATES:
            own = WORD.findall(statement.lower())
            most = max(len(set(words[a : a + 2 * len(own)]) & set(own)) for a in range(len(words)))
            if most >= math.ceil(CONTAINED * len(set(own))):
                shares[name] = most / len(set(own))
        base = set(filter(None, got[i].base_labels.split(",")))
        assert got[i].labels == ",".join(sorted(base | set(shares)))
        assert got[i].score == (1.0 if base else max(shares.values(), default=0.0))
        assert label is None or label in got[i].labels.split(",")


def test_query_looks_at_every_start(spark, tmp_path):
    rows = [(n, "x " * n + "Released under the terms of the MIT License" + " y" * 9) for n in range(10)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.labels for r in op5_license_scan(spark, str(tmp_path)).collect()} == {"mit,mit-notice"}
