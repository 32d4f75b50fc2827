"""Secret scans with corpus-wide ownership.

Patterns find candidates text by text. Every candidate's value is hashed, and the hashes are counted over
the whole corpus by distinct repositories and distinct owners: a value that many owners hold is a copied
example, a value of fewer looks live. High-entropy tokens are no base pattern, for most of them are
harmless; those that look live are added to the spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvein.llm.words import text_slices
from tallyvein.session import Scratch

#: Fixed by the contract.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: The method's own kind: tokens of 20 or more such characters, mixed and of high entropy.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ENTROPY_BITS = 3.5
#: A value that so many distinct owners hold is a copied example.
EXAMPLE_OWNERS = 3

_HEX = np.zeros(256, bool)
_HEX[[*range(48, 58), *range(97, 103)]] = True
_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_=-"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def _long_runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, run as (start, end)) of the runs of at least so many bytes; a run never crosses a text."""
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # Texts that meet in a run: taken as candidates on both sides, the patterns decide.
    long = ends - starts >= least
    return starts[long], ends[long]


def _touched(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> set[int]:
    first = np.searchsorted(offsets, starts, "right") - 1
    last = np.searchsorted(offsets, ends - 1, "right") - 1
    return {t for a, b in zip(first.tolist(), last.tolist()) for t in range(a, b + 1)}


def entropy(value: str) -> float:
    return -sum(c / len(value) * math.log2(c / len(value)) for c in Counter(value).values())


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) by start and then kind as listed."""
    found = [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    return [(a, b, KINDS[k], v) for a, b, k, v in sorted(found)]


def token_spans(text: str, base: list) -> list[tuple[int, int, str, str]]:
    """High-entropy tokens that touch no base span."""
    out = []
    for m in TOKEN.finditer(text):
        value = m[0]
        mixed = sum(map(str.isdigit, value)) >= 3 and any(map(str.isupper, value)) and any(map(str.islower, value))
        if mixed and entropy(value) >= ENTROPY_BITS and all(m.end() <= a or b <= m.start() for a, b, _, _ in base):
            out.append((m.start(), m.end(), "token", value))
    return out


def _scan(batches):
    """Candidates of every text, with the digest of its base spans."""
    for batch in batches:
        column, found = batch.column(1), [([], [])] * len(batch)
        for first, data, offsets in text_slices(column):
            hexes = _touched(*_long_runs(_HEX[data], offsets, 24), offsets)
            starts, ends = _long_runs(_TOKEN[data], offsets, 20)
            digits = np.concatenate(([0], np.cumsum(_DIGIT[data], dtype=np.int64)))
            many = digits[ends] - digits[starts] >= 3
            tokens = _touched(starts[many], ends[many], offsets)
            whole = data.tobytes()
            for t in range(len(offsets) - 1):
                raw = whole[offsets[t] : offsets[t + 1]]
                low = raw.lower()
                if t in hexes or t in tokens or b"AKIA" in raw or any(w.encode() in low for w in _WORDS):
                    text = raw.decode("utf-8", "replace")
                    base = base_spans(text)
                    found[first + t] = base, token_spans(text, base)
        digests, spans = [], []
        for base, more in found:
            digests.append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k, _ in base).encode()).hexdigest())
            spans.append([
                {"start": a, "end": b, "kind": k, "value_hash": hashlib.sha256(v.encode()).hexdigest()[:32]} for a, b, k, v in base + more
            ])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("value_hash", pa.string())]))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in (0, 2, 3, 4)), pa.array(digests, pa.string()), pa.array(spans, kind)],
            ["id", "text_hash", "repository", "owner", "base_sha256", "candidates"],
        )


CANDIDATES = "array<struct<start:long,end:long,kind:string,value_hash:string>>"


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository: Column | None = None, owner: Column | None = None) -> DataFrame:
    """(id, text_hash, base_sha256, n_rows, spans) of every distinct pair of id and text.

    ``spans`` are structs (start, end, kind, owners, repositories, live) by start and kind: all base spans
    and the tokens that are live. ``live`` says that fewer than ``EXAMPLE_OWNERS`` owners hold the
    value. Offsets are code points, the end exclusive.

    Null texts count as empty ones; null owners and repositories are an owner and a repository each.
    Equal rows are one row here with their number in ``n_rows``. Other columns are not looked at.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    repository = F.col(id_col) if repository is None else repository
    owner = F.lit("") if owner is None else owner
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
    )
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, text_hash long, repository string, owner string, base_sha256 string, candidates {CANDIDATES}"
    found = scratch.write(rows.mapInArrow(_scan, schema), "found")
    single = found.groupBy("id", "text_hash").agg(
        F.count("*").alias("n_rows"), F.min("base_sha256").alias("base_sha256"), F.first("candidates").alias("candidates")
    )
    single = scratch.write(single, "single")
    # Distinct holders before they are counted, so that a value found everywhere is small in every task.
    values = found.where(F.size("candidates") > 0).select("repository", "owner", F.explode("candidates.value_hash").alias("value_hash"))
    held = values.groupBy("value_hash", "owner", "repository").agg(F.lit(1).alias("one")).groupBy("value_hash", "owner").agg(F.count("*").alias("n"))
    holders = scratch.write(held.groupBy("value_hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories")), "holders")
    one = single.select("id", "text_hash", F.explode("candidates").alias("c"))
    known = one.withColumn("value_hash", F.col("c.value_hash")).join(holders, "value_hash")
    span = F.struct(
        F.col("c.start").alias("start"), F.col("c.end").alias("end"), F.col("c.kind").alias("kind"),
        F.col("owners"), F.col("repositories"), (F.col("owners") < EXAMPLE_OWNERS).alias("live"),
    )
    kept = known.where((F.col("c.kind") != "token") | (F.col("owners") < EXAMPLE_OWNERS)).select("id", "text_hash", span.alias("span"))
    order = F.struct("span.start", F.array_position(F.array(*map(F.lit, (*KINDS, "token"))), F.col("span.kind")).alias("nth"), "span")
    spans = kept.groupBy("id", "text_hash").agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["span"]).alias("spans"))
    result = single.drop("candidates").alias("s").join(
        spans.alias("f"), F.col("s.id").eqNullSafe(F.col("f.id")) & F.col("s.text_hash").eqNullSafe(F.col("f.text_hash")), "left"
    )
    empty = F.expr("cast(array() as array<struct<start:long,end:long,kind:string,owners:long,repositories:long,live:boolean>>)")
    return result.select("s.id", "s.text_hash", "base_sha256", "n_rows", F.coalesce("spans", empty).alias("spans"))


def secret_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository: Column | None = None, owner: Column | None = None,
    token_owners: int = 1,
) -> DataFrame:
    """One row per row of ``docs``: counts of base spans, their digest, all spans as text, and how many look live.

    Of the tokens, those of at most ``token_owners`` owners are told; ``EXAMPLE_OWNERS - 1`` tells all live ones.
    """
    found = secret_spans(docs, id_col, text_col, repository, owner)
    told = F.filter("spans", lambda s: (s["kind"] != "token") | (s["owners"] <= token_owners))
    found = found.withColumn("spans", told)

    def count(test) -> Column:
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(kind: str) -> Column:
        return count(lambda s: s["kind"] == kind)

    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    rows = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n_rows"))))
    return rows.select(
        F.col("id").alias(id_col), *(of_kind(k).alias(f"n_{k}") for k in KINDS),
        "base_sha256", text.alias("spans"), count(lambda s: s["live"]).alias("n_live"),
    )


def free_prefix(columns: list[str]) -> str:
    """Underscores that no column name begins with."""
    prefix = "_"
    while any(name.startswith(prefix) for name in columns):
        prefix += "_"
    return prefix


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository: Column | None = None, owner: Column | None = None) -> DataFrame:
    """``docs`` with every live-looking span of its text replaced by [secret]; copied examples stay.

    All rows and columns stay, whatever their names; a null text stays null, an empty one empty. Repeated rows are
    replaced alike; rows with a null id take part. An empty table gives no rows.
    """
    own = free_prefix(docs.columns)
    found = secret_spans(docs, id_col, text_col, repository, owner)
    live = found.select(F.col("id").alias(f"{own}id"), F.col("text_hash").alias(f"{own}hash"), F.filter("spans", lambda s: s["live"]).alias(f"{own}spans"))
    live = live.where(F.size(f"{own}spans") > 0)
    # Spans by start; what overlaps an earlier one goes with it.
    parts = F.aggregate(
        f"{own}spans", F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at")),
        lambda done, s: F.when(s["start"] >= done["at"], F.struct(
            F.concat(done["text"], F.substring(F.col(f"{own}text"), done["at"].cast("int") + 1, (s["start"] - done["at"]).cast("int")), F.lit("[secret]")).alias("text"),
            s["end"].alias("at"),
        )).otherwise(F.struct(done["text"].alias("text"), F.greatest(done["at"], s["end"]).alias("at"))),
    )
    text = F.col(text_col).cast("string")
    joined = docs.withColumns({f"{own}text": text, f"{own}text_hash": F.xxhash64(text)}).join(
        live, F.col(id_col).eqNullSafe(F.col(f"{own}id")) & (F.col(f"{own}text_hash") == F.col(f"{own}hash")), "left"
    )
    parts = parts.alias("p")
    joined = joined.withColumn(f"{own}done", F.when(F.col(f"{own}spans").isNotNull(), parts))
    new = F.when(F.col(f"{own}done").isNull(), F.col(f"{own}text")).otherwise(
        F.concat(F.col(f"{own}done.text"), F.expr(f"substring({own}text, cast({own}done.at as int) + 1)"))
    )
    return joined.withColumn(text_col, new).select(*docs.columns)
