"""Repeated strings next to a table of all strings of that length."""

import hashlib
import random
from collections import Counter

import pytest

from tallyvein.llm.suffix_dedup import repeated_strings


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d) + 1)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = [(i, next(j for j in range(i, len(gone)) if not gone[j])) for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1])]
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts, length):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = sorted(repeated_strings(docs, length=length).collect(), key=lambda r: r.doc_id)
    want = brute(texts, length)
    assert len(got) == len(want)
    for r, w in zip(got, want):
        assert (r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], r.kept_sha256) == w, r.doc_id


@pytest.mark.parametrize("length,seed", [(200, 1), (200, 2), (20, 3), (6, 4)])
def test_equals_brute_force(spark, length, seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    passages = [word(rng.randrange(length // 2, 3 * length)) for _ in range(8)]
    texts = [None, "", "x", "ab" * length, "z" * (5 * length), word(length), word(length - 1)]
    for _ in range(60):
        parts = [word(rng.randrange(2 * length)) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            parts.insert(rng.randrange(len(parts) + 1), p[a : len(p) - rng.randrange(len(p) // 3)])
        texts.append("".join(parts))
    near = word(6 * length)
    for _ in range(10):
        at = rng.randrange(len(near))
        texts.append(near[:at] + rng.choice("XYZ") + near[at + rng.randrange(3) :])
    texts += texts[20:30] + [texts[7][:-1], texts[8] + texts[9]]
    check(spark, texts, length)


def test_tables(spark, data):
    rows = sorted(spark.read.parquet(f"{data}/documents.parquet").collect(), key=lambda r: r.doc_id)
    check(spark, [r.text for r in rows], 200)


def test_long_text_and_no_rows(spark):
    long = "".join(chr(97 + i * i % 23) for i in range(400_000))
    docs = spark.createDataFrame([(1, long), (2, "q" * 199), (None, "w" * 200)], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, len(r.spans)) for r in repeated_strings(docs).collect()}
    assert got[1] == (400_000, 1) and got[2] == (0, 0) and got[None] == (0, 0)
    assert repeated_strings(docs.limit(0)).count() == 0
