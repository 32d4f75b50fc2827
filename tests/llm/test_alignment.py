import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from tallyvein.llm import alignment
from tallyvein.llm.alignment import Aligner, align_corpus, align_text, byte_level

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return Aligner(A, B)


@pytest.fixture(scope="module")
def plain():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    level = byte_level()
    names = {i: bytes(level[c] for c in p) for p, i in a.get_vocab(with_added_tokens=False).items() if all(c in level for c in p)}
    return a, names, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(plain, text):
    """Whole-text tokens, byte ranges and all pairs of ranges compared."""
    a, names, b = plain
    if not text:
        return [], [], []
    raw = (" " + text).encode()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    parts_a = [names[i] for i in ids_a]
    parts_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(parts_a) != raw or b"".join(parts_b) != raw:
        return [], [], []

    def spans(ids, parts):
        out, at = [], 0
        for i, part in zip(ids, parts):
            out.append((at, at + len(part), i))
            at += len(part)
        return out

    sa, sb = spans(ids_a, parts_a), spans(ids_b, parts_b)
    cuts = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
    groups, start = [], 0
    for cut in cuts:
        groups.append(([i for s, e, i in sa if start < e <= cut], [i for s, e, i in sb if start < e <= cut]))
        start = cut
    links = [(x, y) for s, e, x in sa for t, f, y in sb if max(s, t) < min(e, f)]
    return groups, links, (len(ids_a), len(ids_b))


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


PARTS = [
    "hello", "World's", "don't", " ", "  ", "\n", "\t ", "é", "日本語", "😀", "👩‍👩‍👧", " ", "\x00", "½ﬁ", "<|endoftext|>", "<s>", "<0x41>", "12345", "é",
    "ＡＢ", "\u0085", " ", "...", "'s", "Ñandú", "​", "_ _", "\x1c", "ß", "Здравствуй", " '", "' ", "antidisestablishmentarianism", "﻿", "\U0010ffff",
]


def test_segments_give_the_whole_texts_tokens(both, plain):
    rng = random.Random(11)
    texts = ["".join(rng.choice(PARTS) + (" " if rng.random() < 0.5 else "") for _ in range(rng.randint(0, 30))) for _ in range(800)]
    for text in [*texts, *PARTS, " ", " a", "a ", "a  b", " a  b "]:
        groups, links, _ = brute(plain, text)
        mine, pairs = align_text(both, text)
        assert mine == written(groups), text
        assert Counter((p // alignment.PAIR, p % alignment.PAIR) for p in pairs) == Counter(links), text


def expected(plain, rows):
    out, corpus = [], Counter()
    for _, text in rows:
        corpus.update(brute(plain, text)[1])
    best = Counter()
    for (_, y), n in corpus.items():
        best[y] = max(best[y], n)
    for i, text in rows:
        groups, links, sizes = brute(plain, text)
        digest = hashlib.sha256(written(groups).encode()).hexdigest() if groups else ""
        counts = [corpus[x] for x in links]
        tops = sum(corpus[x] == best[x[1]] for x in links)
        out.append((i, *(sizes if groups else (0, 0)), len(groups), len(links), tops, sum(counts), digest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 30, 0])
def test_equals_brute_force(spark, plain, frequent):
    rng = random.Random(5)
    words = [rng.choice(PARTS) + rng.choice(["", "a", "ing", "é"]) for _ in range(40)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "a▁b good words"), (None, "null id"), (3, "again"), (3, "again")]
    rows += [(100 + i, "one hot line of words") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in align_corpus(df, A, B, frequent=frequent).collect()]
    assert sorted(got, key=repr) == expected(plain, rows)


def test_long_texts_in_stretches(both, plain, monkeypatch):
    monkeypatch.setattr(alignment, "STRETCH", 64)
    rng = random.Random(2)
    for text in (" ".join(rng.choice(PARTS) for _ in range(200)), "x" * 1000, ("word " * 50) + "▁" + (" word" * 50)):
        groups, links, _ = brute(plain, text)
        mine, pairs = align_text(both, text)
        assert mine == written(groups)
        assert len(pairs) == len(links)
        assert " ".join(w for part in alignment.segments(text) for w in part) == text


def test_empty_tables_and_clashing_columns(spark):
    names = ["id", "row", "rare", "pair", "n_a", "links"]
    df = spark.createDataFrame([(1, "some words", *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    assert align_corpus(df, A, B, frequent=0).count() == 1
    assert align_corpus(df.limit(0), A, B).collect() == []


def test_table_of_segments_is_not_copied_for_each_addition():
    both = Aligner(A, B)
    both.learn(f"word{i}" for i in range(2 * alignment.TOGETHER))
    before = both.pairs, both.sizes, both.starts
    both.learn(["another", " edge", "third\n"])
    assert all(a is b for a, b in zip(before, (both.pairs, both.sizes, both.starts)))
    text, pairs = align_text(both, "another word7 third")
    assert (text, pairs) == align_text(Aligner(A, B), "another word7 third")
