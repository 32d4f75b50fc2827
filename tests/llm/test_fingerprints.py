"""Chunking next to a byte-by-byte loop, and the edited texts next to plain Python."""

import hashlib
import random

import pyarrow as pa
from pyspark.sql import functions as F

from tallyvein.llm import fingerprints as f


def slow_chunks(data):
    out, at = [], 0
    while at < len(data):
        end = len(data)
        if end - at > f.LEAST:
            for i in range(at + f.LEAST - 1, min(at + f.MOST, end)):
                h = 0
                for j in range(32):
                    h = (h + (int(f._GEAR[data[i - j]]) << j)) % 2**32
                if h >> (32 - (f.STRICT_BITS if i < at + f.USUAL - 1 else f.LOOSE_BITS)) == 0 or i == at + f.MOST - 1:
                    end = i + 1
                    break
        out.append(bytes(data[at:end]))
        at = end
    return out


def test_chunks_equal_the_plain_loop():
    rng = random.Random(1)
    texts = ["", "a", "x" * 1000] + ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(3000))) for _ in range(30)]
    prints = f.fingerprints_of(pa.array(texts))
    seen = {}
    for text, (digests, lengths) in zip(texts, prints):
        chunks = set(slow_chunks(text.encode()))
        assert sorted(map(len, chunks)) == sorted(lengths.tolist()) and len(digests) == len(chunks)
        seen.setdefault(text, set()).add(f.written((digests, lengths)))
    assert all(len(v) == 1 for v in seen.values())


def test_shift_resistance():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(20000))
    a, b, c = f.fingerprints_of(pa.array([text, text[:5000] + "inserted" + text[5000:], text[::-1]]))
    assert f.likeness(a, b) > 0.95 and f.likeness(a, c) < 0.05 and f.likeness(a, a) == 1.0


def expected(rows):
    ids = sorted({i for i, _ in rows if i is not None}, reverse=True)
    first = {i: min(t or "" for j, t in rows if j == i) for i in ids}
    out = {}
    for i, text in rows:
        text = text or ""
        cut = len(text) // 3
        new = first[ids[(ids.index(i) + 1) % len(ids)]] if i is not None else ""
        edited = text[: len(text) - cut] + new[:cut]
        a, b, c = f.fingerprints_of(pa.array([text, edited, new]))
        near_next = f.likeness(a, c) if i is not None else 0.0
        out.setdefault(i, []).append((len(text), hashlib.sha256(edited.encode()).hexdigest(), f.written(a), f.written(b), f.likeness(a, b), near_next))
    return out


def compare(got, rows):
    want = expected(rows)
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def test_tables(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = f.edited_fingerprints(docs).collect()
    compare(got, rows)
    assert sum(r.near_edited for r in got) / len(got) > 0.4 > sum(r.near_next for r in got) / len(got)


def test_odd_rows(spark):
    rows = [(5, None), (9, ""), (2, "é" * 50 + "abc"), (2, "é" * 50 + "abc"), (-3, "word " * 60000), (70, "x"), (None, "lost text")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_chars int")
    compare(f.edited_fingerprints(docs).collect(), rows)
    one = docs.where(F.col("doc_id") == 70)
    assert f.edited_fingerprints(one).first().near_next == 1.0
    assert f.edited_fingerprints(docs.limit(0)).count() == 0
