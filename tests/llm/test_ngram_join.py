"""The similarity join next to brute force over all pairs."""

import random
import re
from fractions import Fraction

import pytest

from tallyvein.llm.ngram_join import Classes, ngram_components


def brute(rows, width, t):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = len(words) - width + 1
        sets.append({tuple(words[i : i + width]) for i in range(n)} if n > 0 else {tuple(words)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and both * t.denominator >= t.numerator * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return {(doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)}


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 30
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.7:
            words = (rng.choice(texts) or "x").split()
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                words = words[: max(1, len(words) - rng.randrange(4))]
        else:
            words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 6, 9, 14, 25, 60, 150, 400]))
        texts.append(" ".join(words))
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("width,t,seed", [(3, Fraction(9, 10), 1), (5, Fraction(8, 10), 2), (1, Fraction(8, 10), 3), (1, Fraction(9, 10), 4)])
def test_components_equal_brute_force(spark, width, t, seed):
    rows = corpus(seed)
    got = ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", width, t)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()} == brute(rows, width, t)


def test_odd_rows(spark):
    long = "lorem ipsum dolor sit " * 60000
    rows = [(1, None, 5), (2, "", 5), (3, " \t\n", 5), (4, "One two", 5), (5, "one TWO", 5), (6, long, 5), (7, long, 5), (8, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_components(docs).collect()}
    assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (4, 6), 7: (4, 6), 8: (1, 8)}
    assert ngram_components(docs.limit(0)).count() == 0


def test_group_of_near_copies_with_outliers(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            words[rng.randrange(120)] = f"e{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    got = ngram_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()} == brute(rows, 3, Fraction(9, 10))


def test_classes_of_very_large_sets():
    for t in (Fraction(9, 10), Fraction(8, 10), Fraction(1, 2)):
        classes = Classes(t)
        own = classes.of(3_000_000)
        assert own.low <= 3_000_000 < own.high and classes.differences(2 * (own.high - 1)) < own.ranges


def test_repeated_ids_with_other_texts(spark):
    rng = random.Random(21)
    rows = [(doc // 6, text) for doc, text in corpus(5, 400)]
    rng.shuffle(rows)
    got = ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 3, Fraction(8, 10)).collect()
    assert len(got) == len(rows) > len({doc for doc, _ in rows})
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == brute(rows, 3, Fraction(8, 10))


def test_rows_without_id_link(spark):
    words = [f"w{i}" for i in range(100)]
    middle = " ".join(words)
    left, right = " ".join([*words[:-3], "a", "b", "c"]), " ".join(["d", "e", "f", *words[3:]])
    rows = [(7, left), (None, middle), (9, right), (None, middle.upper()), (None, "apart " * 9), (11, "x y z")]
    got = ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 1, 0), (0, 98, 7), (0, 98, 7), (7, 98, 7), (9, 98, 7), (11, 1, 11)]


def test_words_that_cancel_in_polynomials_stay_apart(spark):
    """Thue-Morse words and their mirror images are equal modulo 2^64 in any odd base; here they are two words."""
    letters = ["ab"[bin(i).count("1") % 2] for i in range(4096)]
    one = "".join(letters)
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{one} x y"), (2, f"{other} x y"), (3, f"{one} x y"), (4, one), (5, other)]
    got = ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 3, Fraction(9, 10))
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {(1, 1), (2, 2), (3, 1), (4, 4), (5, 5)}
