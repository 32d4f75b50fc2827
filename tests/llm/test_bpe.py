"""The transducer next to a plain merge loop, and next to the tokenizer library on its own file."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from tallyvein.llm.bpe import Merges, Tokenizer, WordStream, decode_tokens, encode_texts, token_digests

PATH = public_tokenizers.path("word_bpe_49k.json")


def merge_loop(symbols, vocab, merges):
    rank = {tuple(m): r for r, m in enumerate(merges)}
    parts = list(symbols)
    while True:
        best = min(((rank.get((a, b), 1e9), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1e9, 0))
        if best[0] == 1e9:
            return [vocab[p] for p in parts]
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(12))
def test_random_merge_lists(seed):
    rng = random.Random(seed)
    # Learned from random text, so that every token is its own encoding.
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(2, 14))) for _ in range(60)]
    parts, merges = [list(w) for w in words], []
    for _ in range(25):
        pairs = [p for w in parts for p in zip(w, w[1:])]
        if not pairs:
            break
        best = max(sorted(set(pairs)), key=pairs.count)
        merges.append(best)
        for w in parts:
            i = 0
            while i < len(w) - 1:
                if (w[i], w[i + 1]) == best:
                    w[i : i + 2] = ["".join(best)]
                i += 1
    vocab = {t: i for i, t in enumerate(dict.fromkeys([*"abc", *("".join(m) for m in merges)]))}
    if len(vocab) < 3 + len(merges):
        pytest.skip("a token made twice")
    model = Merges(vocab, merges)
    for n in [1, 2, 3, 7, 30, 200, 400]:
        text = "".join(rng.choice("abc") for _ in range(n))
        expected = merge_loop(text, vocab, merges)
        assert model.encode(text) == expected
        stream = WordStream(model)
        assert [*stream.feed(text), *stream.finish()] == expected


def test_stream_keeps_little_and_emits_early():
    merges = Tokenizer(PATH).merges
    stream, out, most = WordStream(merges), 0, 0
    for i in range(20000):
        out += len(list(stream.feed("thingsand"[i % 9])))
        most = max(most, len(stream.last))
    assert out > 3000 and most <= 8 * merges.longest <= merges.lookahead


ODD = [
    "", " \n\t", "a" * 3000, "ab" * 700, "<|endoftext|>hi<|startoftext|> <|endoftext|>", "Σας ΟΔΟΣ İstanbul ½² Ⅷ x\x1cy\x85z",
    "é 👍🏽 don't I'LL 'S", "ẛ̣ ǅ ﬁ ​\xad _ __", "日本語テキスト 1234 ५६", "\x00\x01 \x7f",
]


def test_equals_library():
    library, own = Library.from_file(PATH), Tokenizer(PATH)
    rng = random.Random(3)
    texts = ODD + ["".join(chr(rng.randrange(1, 0x2FF)) for _ in range(150)) for _ in range(80)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_digests(spark, data):
    rows = [(i, t, 0) for i, t in enumerate([*ODD, None, ODD[2]])]
    odd = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    library = Library.from_file(PATH)
    for frame in (odd, docs):
        texts = {r.doc_id: r.text or "" for r in frame.collect()}
        for r in token_digests(frame, PATH).collect():
            ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            packed = struct.pack(f"<{len(ids)}I", *ids)
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
                len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
            )
    assert token_digests(odd.limit(0), PATH).count() == 0


def test_round_trip_of_plain_words(spark):
    docs = spark.createDataFrame([(1, "straße naïve 日本 ok"), (2, None), (3, "")], "doc_id long, text string")
    back = decode_tokens(encode_texts(docs, PATH), PATH)
    assert {r.doc_id: r.decoded for r in back.collect()} == {1: "straße naïve 日本 ok ", 2: "", 3: ""}


def test_every_code_point_is_encoded_as_by_the_library():
    """Between letters, between digits and alone: 0 differences, whatever Unicode version the regex engine knows."""
    mine, library = Tokenizer(PATH), Library.from_file(PATH)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    different = []
    for first in range(0, len(points), 20_000):
        texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}" for c in points[first : first + 20_000]]
        expected = library.encode_batch(texts, add_special_tokens=False)
        different += [text for text, e in zip(texts, expected) if mine.encode(text) != e.ids]
        mine.known.clear()
    assert different == []


def test_random_mixes_are_encoded_as_by_the_library():
    rng = random.Random(8)
    mine, library = Tokenizer(PATH), Library.from_file(PATH)
    blocks = [(0, 0x250), (0x300, 0x400), (0x590, 0x700), (0x0B80, 0x0C00), (0x1C80, 0x1CC0), (0x1AB0, 0x1B00), (0xA640, 0xA830), (0x10D40, 0x10D90), (0x16E80, 0x16F00)]
    for _ in range(3000):
        text = "".join(chr(rng.randrange(*rng.choice(blocks))) for _ in range(rng.randint(1, 20)))
        assert mine.encode(text) == library.encode(text, add_special_tokens=False).ids, ascii(text)
