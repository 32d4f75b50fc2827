"""Spaced seeds next to a comparison of every window with every window."""

import itertools
import random
import re

from tallyvein.llm.decontamination import MASKS, SUBSTITUTED, WINDOW, leaks


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    """(doc, item, covered words) where windows agree."""
    out = {}
    for d, text in docs:
        w = words(text)
        for i, other in items:
            t = words(other)
            n = min(WINDOW, len(t))
            allowed = SUBSTITUTED if len(t) >= WINDOW else 0
            for a in range(len(w) - n + 1) if n else ():
                for b in range(len(t) - n + 1):
                    if sum(x == y for x, y in zip(w[a : a + n], t[b : b + n])) >= n - allowed:
                        out.setdefault((d, i), set()).update(range(a, a + n))
    return out


def test_masks_lose_nothing():
    for gone in itertools.chain.from_iterable(itertools.combinations(range(WINDOW), k) for k in range(SUBSTITUTED + 1)):
        assert any(all(o + m not in gone for m in mask) for mask in MASKS for o in range(WINDOW - mask[-1]))


def test_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 4, 9, 13, 20, 40])))) for i in range(25)] + [(90, None), (91, ""), (92, "?!")]
    docs = []
    for d in range(120):
        body = rng.choices(vocabulary, k=rng.choice([0, 5, 40, 120]))
        if rng.random() < 0.7:
            part = words(rng.choice(items)[1])
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                if part:
                    part[rng.randrange(len(part))] = rng.choice(["x", "W1,"])
            at = rng.randrange(len(body) + 1)
            body[at:at] = part
        docs.append((d, " ".join(body).replace(" w1 ", " W1!\n")))
    docs += [(500, None), (501, "")]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items)
    for size in (200_000, 300):
        got = {}
        for r in leaks(*frames, block_words=size).collect():
            got.setdefault((r.doc_id, r.item_id), set()).update(range(r.first_word, r.first_word + r.n_words))
        assert got.keys() == expected.keys() and len(got) > 30
        # A stretch ends at equal words, so at most the replaced ones at its ends are missing.
        assert all(got[k] <= expected[k] and len(expected[k]) - len(got[k]) <= 4 * SUBSTITUTED * 10 for k in got)


def test_odd_tables(spark):
    schema = "doc_id long, item_id int, text string, first_word string"
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    long = "pad " * 300_000 + item
    docs = spark.createDataFrame([(1, 7, item, "a"), (1, 7, item, "a"), (2, 8, long, None), (3, None, None, "")], schema)
    items = spark.createDataFrame([(1, item), (2, item), (None, item)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id or 0, r.first_word, r.n_words, r.n_equal) for r in leaks(docs, items).collect())
    assert got == sorted([(1, i, 0, 14, 14) for i in (0, 1, 2)] * 2 + [(2, i, 300_000, 14, 14) for i in (0, 1, 2)])
    assert leaks(docs.limit(0), items).count() == 0 and leaks(docs, items.limit(0)).count() == 0


def test_planted_tables(spark, data):
    docs, items = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in leaks(docs, items).collect()}
    bench = {r.item_id: words(r.text) for r in items.collect()}
    whole = set()
    for r in docs.collect():
        text = " ".join(words(r.text))
        whole |= {(r.doc_id, i) for i, w in bench.items() if f" {' '.join(w)} " in f" {text} "}
    assert whole and whole <= found
