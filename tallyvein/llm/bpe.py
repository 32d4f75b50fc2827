"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

A token sequence is the BPE encoding of its text exactly when every two neighbours are: when the merges
of their joined symbols, taken in rank order, never cross their border. So the last token of the
encoding of every prefix follows from the last tokens of shorter prefixes, no further back than the
longest token (``Merges.step``); an automaton names the tokens that end at each symbol. A token is emitted as soon as all prefixes that a later symbol can
build on agree on it. What is pending at that time is bounded by the merge list's sufficient lookahead:
a border is settled by at most (number of ranks) x (longest token) further symbols; in practice a few.
Memory does not depend on the text, be it one word of a million letters.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import normalizers, pre_tokenizers

#: Words kept with their encoding in a task, and token pairs with their verdict; both are emptied when full.
WORDS_KEPT = 300_000
PAIRS_KEPT = 1_000_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(shown))
    return [out[b] for b in range(256)]


class _State:
    """The longest end of the symbols read that begins a token, and the tokens that end there, longest first."""

    __slots__ = ("body", "then", "inner", "final")

    def __init__(self, body: str, inner: list, final: list):
        self.body, self.then, self.inner, self.final = body, {}, inner, final


#: In place of a last token: the word's start, and what lies behind a settled border.
_START, _GONE = -1, -2


class Merges:
    """A merge list over symbols. The last symbol of a word carries the suffix, if there is one."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str = ""):
        self.suffix = suffix or ""
        self.token = {i: t for t, i in vocab.items()}
        self.rank = dict.fromkeys(self.token, -1)
        self.split: dict[int, tuple[int, int]] = {}
        self.pair: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            whole = vocab[left + right]
            if whole in self.split:
                raise ValueError(f"two merges make {left + right!r}")
            self.split[whole] = (vocab[left], vocab[right])
            self.rank[whole] = r
            self.pair[vocab[left], vocab[right]] = r
        self._inner: dict[str, int] = {}
        self._final: dict[str, int] = {} if self.suffix else self._inner
        for t, i in vocab.items():
            ends = bool(self.suffix) and t.endswith(self.suffix)
            body = t[: -len(self.suffix)] if ends else t
            if body and (i in self.split or len(body) == 1):
                (self._final if ends else self._inner)[body] = i
        bodies = self._inner.keys() | self._final.keys()
        self.longest = max(map(len, bodies), default=1)
        self._starts = {b[:n] for b in bodies for n in range(1, len(b) + 1)}
        self._states: dict[str, _State] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self.root = self._state("")

    @property
    def lookahead(self) -> int:
        """Symbols after a border that settle it, whatever follows."""
        return max(1, len(self.split)) * self.longest

    def _state(self, body: str) -> _State:
        if body not in self._states:
            ends = [body[i:] for i in range(len(body))]
            inner, final = ([(len(e), own[e]) for e in ends if e in own] for own in (self._inner, self._final))
            self._states[body] = _State(body, inner, final)
        return self._states[body]

    def after(self, state: _State, symbol: str) -> _State:
        body = state.body + symbol
        while body and body not in self._starts:
            body = body[1:]
        state.then[symbol] = found = self._state(body)
        return found

    def fits(self, left: int, right: int) -> bool:
        """No merge crosses the border of two neighbouring tokens: undo both, the latest merge first."""
        a, b, before = left, right, len(self.pair)
        verdict = True
        while True:
            crossing = self.pair.get((a, b))
            if crossing is not None and crossing < before:
                verdict = False
                break
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                break
            # Of equal merges the left one goes first, so it is undone last.
            if ra > rb:
                before, a = ra, self.split[a][1]
            else:
                before, b = rb + 1, self.split[b][0]
        if len(self._fits) >= PAIRS_KEPT:
            self._fits.clear()
        self._fits[left, right] = verdict
        return verdict

    def step(self, tokens: list, last: list[int]) -> tuple[int, int]:
        """(size, last token) of the encoding of a prefix, given the tokens that end there and the last ones of shorter prefixes."""
        at, known = len(last), self._fits
        for size, token in tokens:
            before = last[at - size] if size <= at else _GONE
            if before == _START:
                return size, token
            if before != _GONE:
                fit = known.get((before, token))
                if fit is None:
                    fit = self.fits(before, token)
                if fit:
                    return size, token
        raise ValueError("a symbol is not in the vocabulary")

    def encode(self, symbols: str) -> list[int]:
        """Ids of one word."""
        n = len(symbols)
        if n > 256:
            stream = WordStream(self)
            return [*stream.feed(symbols), *stream.finish()]
        last, sizes, state, step = [_START], [0], self.root, self.step
        for i, symbol in enumerate(symbols, 1):
            state = state.then.get(symbol) or self.after(state, symbol)
            size, token = step(state.inner if i < n else state.final, last)
            last.append(token)
            sizes.append(size)
        out, i = [], n
        while i:
            out.append(last[i])
            i -= sizes[i]
        return out[::-1]


class WordStream:
    """One word as a stream of symbols: tokens leave as soon as no later symbol can change them.

    Kept are the last tokens of the prefixes after the settled border, and the border's own token, which
    has left but is the left neighbour of what follows.
    """

    def __init__(self, merges: Merges):
        self.merges, self.state, self.waiting = merges, merges.root, ""
        self.last, self.sizes, self.border = [_START], [0], 0

    def _read(self, symbol: str, ends: bool) -> None:
        self.state = self.state.then.get(symbol) or self.merges.after(self.state, symbol)
        size, token = self.merges.step(self.state.final if ends else self.state.inner, self.last)
        self.last.append(token)
        self.sizes.append(size)

    def _chain(self, i: int) -> list[int]:
        """Tokens between the border and prefix i."""
        out = []
        while i > self.border:
            out.append(self.last[i])
            i -= self.sizes[i]
        return out[::-1]

    def _settled(self) -> list[int]:
        """Tokens up to the last border that every prefix a later symbol can build on has in common."""
        at = len(self.last) - 1
        fronts = set(range(max(self.border, at - self.merges.longest), at + 1))
        while len(fronts) > 1:
            top = max(fronts)
            fronts.remove(top)
            fronts.add(top - self.sizes[top])
        new = fronts.pop()
        out = self._chain(new)
        if out:
            self.last, self.sizes, self.border = [_GONE, *self.last[new:]], [0, *self.sizes[new:]], 1
        return out

    def feed(self, symbols: str) -> Iterator[int]:
        for symbol in symbols:
            # The newest symbol waits: it may be the word's last and carry the suffix.
            if self.waiting:
                self._read(self.waiting, False)
                if len(self.last) % (4 * self.merges.longest) == 0:
                    yield from self._settled()
            self.waiting = symbol

    def finish(self) -> Iterator[int]:
        if self.waiting:
            self._read(self.waiting, True)
        yield from self._chain(len(self.last) - 1)


def _characters() -> str:
    return "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)


@cache
def character_runs(name: str) -> list[str]:
    """All characters of a class such as \\p{L} in the library's own version of Unicode, in runs."""
    runs = pre_tokenizers.Split(tokenizers.Regex(name + "+"), "removed", invert=True).pre_tokenize_str(_characters())
    return [run for run, _ in runs]


def character_class(name: str) -> str:
    """The ranges of a class, as the inside of a set."""
    return "".join(f"\\U{ord(run[0]):08x}-\\U{ord(run[-1]):08x}" for run in character_runs(name))


def with_library_classes(pattern: str) -> str:
    """The pattern with its classes spelled out: regex engines differ in the version of Unicode that they know."""
    out, inside = [], False
    for part in regex.findall(r"\\p\{\w+\}|\\s|\\.|.", pattern):
        if part in ("[", "]"):
            inside = part == "["
        if part.startswith("\\p") or part == "\\s":
            part = character_class(part) if inside else f"[{character_class(part)}]"
        out.append(part)
    return "".join(out)


@cache
def newer_characters() -> tuple[re.Pattern, regex.Pattern, dict[int, str]]:
    """Characters that Python's tables do not know or that regex and the library put into different classes.

    (a pattern for what lies beyond all characters before the first of them, one for them, and the lower case
    that the library's tables have for some of them).
    """
    every = _characters()
    odd = {c for c in every if unicodedata.category(c) == "Cn"}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        odd ^= (set(regex.findall(name, every)) ^ set("".join(character_runs(name)))) - odd
    some = sorted(map(ord, odd))
    edges = [i for i, c in enumerate(some) if not i or some[i - 1] != c - 1]
    runs = "".join(f"\\U{some[i]:08x}-\\U{some[j - 1]:08x}" for i, j in zip(edges, [*edges[1:], len(some)]))
    lowered = normalizers.Lowercase().normalize_str("\n".join(map(chr, some))).split("\n")
    beyond = re.compile(f"[\\U{some[0]:08x}-\\U0010ffff]")
    return beyond, regex.compile(f"[{runs}]"), {c: low for c, low in zip(some, lowered) if chr(c).lower() != low}


class Tokenizer:
    """A word BPE from a tokenizer file: normaliser, word pattern, byte alphabet, merges, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [s["type"] for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: not a lower-casing word BPE over bytes")
        vocab = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.merges = Merges(vocab, model["merges"], model.get("end_of_word_suffix"))
        self.shown = {**self.merges.token, **{i: t for t, i in self.specials.items()}}
        self.word = regex.compile(steps[0]["pattern"]["Regex"], regex.VERSION1)
        # The same with classes spelled out: slow, for texts with characters that engines see differently.
        self.exact = regex.compile(with_library_classes(steps[0]["pattern"]["Regex"]), regex.VERSION1)
        self.cut = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        alphabet = byte_alphabet()
        self.to_symbols = dict(enumerate(alphabet))
        ends = [c + self.merges.suffix for c in alphabet]
        if not vocab.keys() >= {*alphabet, *ends}:
            raise ValueError(f"{path}: not every byte is in the vocabulary")
        self.to_byte = {c: b for b, c in enumerate(alphabet)}
        self.known: dict[str, tuple[bytes, bytes]] = _Words(self)

    def pieces(self, text: str) -> Iterator[list[tuple[bytes, bytes]]]:
        """(ids, decoded tokens) of the words between special tokens and of these, in order."""
        known, at = self.known, 0
        if len(known) > WORDS_KEPT:
            known.clear()
        for m in self.cut.finditer(text) if self.cut else ():
            yield [known[w] for w in self._words(text[at : m.start()])]
            yield [(struct.pack("<I", self.specials[m[0]]), m[0].encode())]
            at = m.end()
        yield [known[w] for w in self._words(text[at:] if at else text)]

    def _words(self, text: str) -> list[str]:
        # Lower case character by character: a capital sigma is never the final one.
        if not text.isascii():
            beyond, disputed, lower = newer_characters()
            if beyond.search(text) and disputed.search(text):
                text = normalizers.NFC().normalize_str(text).translate(lower)
                return self.exact.findall(text.replace("Σ", "σ").lower())
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.word.findall(text.lower())

    def packed(self, text: str) -> tuple[bytes, bytes]:
        """(ids as little-endian unsigned 32-bit integers, the decoded text in UTF-8) of a whole text."""
        found = [p for part in self.pieces(text) for p in part]
        return b"".join([p[0] for p in found]), b" ".join([p[1] for p in found if p[0]])

    def encode(self, text: str) -> list[int]:
        ids = self.packed(text)[0]
        return list(struct.unpack(f"<{len(ids) // 4}I", ids))

    def decode(self, ids: Iterable[int]) -> str:
        """Without a decoder in the file: the tokens with a space between them. Unknown ids are left out."""
        return " ".join(self.shown[i] for i in ids if i in self.shown)

    def decode_text(self, ids: Iterable[int]) -> Iterator[str]:
        """Readable text, piece by piece: bytes pass through an incremental UTF-8 state machine, a word's end is a space."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        suffix = self.merges.suffix
        for i in ids:
            token = self.shown.get(i, "")
            ends = bool(suffix) and token.endswith(suffix)
            body = token[: -len(suffix)] if ends else token
            if i in self.merges.token:
                yield state.decode(bytes(self.to_byte[c] for c in body)) + (" " if ends else "")
            else:
                yield state.decode(b"", True) + body
        yield state.decode(b"", True)


class _Words(dict):
    """Words met in this task and what they become."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer

    def __missing__(self, word: str) -> tuple[bytes, bytes]:
        t = self.tokenizer
        ids = t.merges.encode(word.encode().decode("latin-1").translate(t.to_symbols))
        out = struct.pack(f"<{len(ids)}I", *ids), " ".join([t.merges.token[i] for i in ids]).encode()
        if len(word) <= 64:
            self[word] = out
        return out


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, read once in a process."""
    return Tokenizer(path)


def encode_texts(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with the token ids of each whole text in ``ids_col`` (an existing column of that name is replaced).

    Null and empty texts have no tokens; rows are independent, so repeated rows get equal ids and there are no ties.
    """
    encoded = F.pandas_udf(lambda texts: texts.map(lambda x: tokenizer(path).encode(x or "")), "array<int>")
    return docs.withColumn(ids_col, encoded(F.col(text_col).cast("string")))


def decode_tokens(docs: DataFrame, path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the readable text of ``ids_col``; null ids give an empty text, unknown ids are left out."""

    def text(ids) -> str:
        return "".join(tokenizer(path).decode_text([] if ids is None else ids))

    decoded = F.pandas_udf(lambda column: column.map(text), "string")
    return docs.withColumn(text_col, decoded(F.col(ids_col)))


def tokenized(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, token_ids, decoded_sha256) of every row, encoded and decoded again in one pass; null texts count as empty."""
    columns = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = columns.schema[0].dataType.simpleString()

    def run(batches):
        t = tokenizer(path)
        for batch in batches:
            packed = [t.packed(text.as_py() or "") for text in batch.column(1)]
            sizes = np.array([len(ids) // 4 for ids, _ in packed], np.int64)
            ids = np.frombuffer(b"".join([ids for ids, _ in packed]), np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(ids)),
                    pa.array([hashlib.sha256(decoded).hexdigest() for _, decoded in packed], pa.string()),
                ],
                [id_col, "n_tokens", "token_ids", "decoded_sha256"],
            )

    return columns.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, token_ids array<int>, decoded_sha256 string")


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) of each whole text, encoded and decoded again in one pass.

    Null texts count as empty ones; every row gives a row, whatever its id; other columns are not looked at.
    """
    kind = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches):
        t = tokenizer(path)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids, decoded = t.packed(text.as_py() or "")
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    columns = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return columns.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
