"""N-gram Jaccard join by a token-group matrix.

1. Every text becomes the set of its word shingles. Equal sets are one set from here on.
2. Sets that can be similar are brought together without loss: the hash space is cut into so many
   ranges that two sets at the threshold must agree in one of them, and a row per range and set is
   matched by hash (``_keys``). A range holds several tokens, so a passage or a phrase that very many
   texts share does not bring them together.
3. Sets that share matches form families, and those similar to the head of their family are linked to
   it. What still shares a match across such groups goes through the matrix: a family is cut into
   blocks of groups of bounded size, each group with its token union and one bit per token and set.
   The overlap of a set with a union bounds its overlap with every member, and only groups that
   qualify are opened. A task holds one block at a time while sets that ask it stream by.
4. Links connect; the component is the result.

Nothing is capped: a match of any size is walked as a sorted stream, and all similar pairs end in one
component.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyvein.llm.words import mix, shingle_sets
from tallyvein.session import Scratch

#: Share of texts that may fall back to matching by empty ranges; they stay exact, only less selective.
_RARE = 1e-6
#: Sets of a block of eight groups of the matrix, on average; each group has a bit for each of its 64 sets.
BLOCK = 512
#: Sets that ask a block in one stream, on average.
STREAM = 2048


@dataclass(frozen=True)
class SizeClass:
    """Sets of sizes low..high-1 are matched over ``ranges`` hash ranges, ``spare`` of which may be empty."""

    number: int
    low: int
    high: int
    ranges: int
    spare: int


class Classes:
    """Size classes such that two similar sets are in one class or in neighbouring ones."""

    def __init__(self, threshold: Fraction):
        self.t = threshold
        top = 1
        while self.differences(2 * (top + 1)) <= 1:
            top += 1
        self.list = [SizeClass(0, 1, top + 1, 0, 0)]

    def differences(self, both: int) -> int:
        """Most tokens in one set only, of two similar sets of ``both`` tokens together."""
        return int(both * (1 - self.t) / (1 + self.t))

    def largest(self, n: int) -> int:
        return int(n / self.t)

    def of(self, n: int) -> SizeClass:
        while self.list[-1].high <= n:
            low = self.list[-1].high
            high = max(math.ceil(low / self.t**2), low + 1)
            most = self.differences(2 * (high - 1))
            least = math.ceil(low * self.t)
            spare = 1
            while (ranges := most + 1 + spare) < least // 2 and _emptier(least, ranges, spare) > _RARE:
                spare += 1
            self.list.append(SizeClass(len(self.list), low, high, ranges, spare))
        return self.list[bisect_right([c.low for c in self.list], n) - 1]


def _emptier(n: int, ranges: int, spare: int) -> float:
    """Bound of the chance that ``n`` tokens leave more than ``spare`` ranges empty."""
    if spare + 1 >= ranges:
        return 0.0
    choices = math.lgamma(ranges + 1) - math.lgamma(spare + 2) - math.lgamma(ranges - spare)
    return math.exp(min(0.0, choices + n * math.log1p(-(spare + 1) / ranges)))


def _key(sums: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    return mix(sums ^ mix(np.asarray(salt, np.uint64) + np.uint64(0x5851F42D4C957F2D)))


def _keys(tokens: np.ndarray, classes: Classes) -> tuple[list[np.ndarray], int]:
    """Keys of a sorted token set, and how many of them it has in common with any similar, unequal set at least."""
    n, out, needs = len(tokens), [], []
    own = classes.of(n)
    largest = classes.largest(n)
    weights = mix(tokens ^ np.uint64(0xD1B54A32D192ED03))
    for c in (own, classes.of(own.high)):
        partner = min(largest, c.high - 1)
        if partner < c.low or classes.differences(n + partner) == 0:
            continue
        if c.number == 0:  # at most one token apart: one set is the other without a token
            total = weights.sum(dtype=np.uint64)
            out.append(_key(np.concatenate(([total], total - weights)), 0))
            needs.append(1)
            continue
        used = min(classes.differences(n + partner) + 1 + c.spare, c.ranges)
        part = ((tokens >> np.uint64(32)) * np.uint64(c.ranges)) >> np.uint64(32)
        part = part[: np.searchsorted(part, used)]
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.zeros(0, int)
        sums = np.add.reduceat(weights[: len(part)], starts) if len(starts) else np.zeros(0, np.uint64)
        full = part[starts]
        salt = np.uint64(c.number << 40)
        out.append(_key(sums, full + salt))
        # One range more than ``spare`` agrees; those empty here have no key.
        needs.append(max(1, 1 + c.spare - (used - len(full))))
        if used - len(full) > c.spare:
            out.append(_key(np.zeros(used - len(full), np.uint64), np.setdiff1d(np.arange(used, dtype=np.uint64), full) + salt))
    return out, min(needs, default=1)


def _set_hash(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a token set."""
    both = mix(tokens).sum(dtype=np.uint64) ^ mix(np.array([len(tokens)], np.uint64))[0]
    return int(mix(np.array([both], np.uint64)).view(np.int64)[0])


def _signed(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)


def _summaries(width: int, threshold: Fraction):
    """(id, text, row_key) batches to (id, row_key, n_shingles, set_id, need, keys); a set met before in the task has no keys."""

    def run(batches):
        classes, seen = Classes(threshold), set()
        for batch in batches:
            sizes, names, needs, keys = [], [], [], []
            for tokens in shingle_sets(batch.column(1), width):
                name = _set_hash(tokens) if len(tokens) else None
                sizes.append(len(tokens))
                names.append(name)
                own, need = _keys(tokens, classes) if len(tokens) and name not in seen else (None, None)
                needs.append(need)
                keys.append(None if own is None else _signed(own))
                seen.add(name)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(needs, pa.int32()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "row_key", "n_shingles", "set_id", "need", "keys"],
            )

    return run


def _matches(batches):
    """Rows sorted by (key, set_id) to (key, set_id, leader): the sets of a key after its first, which leads."""
    key = lead = last = None
    for batch in batches:
        keys, sets = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(keys):
            continue
        same = np.concatenate(([key is not None and keys[0] == key], keys[1:] == keys[:-1]))
        first = np.where(same, -1, np.arange(len(keys)))
        first = np.maximum.accumulate(first)
        leads = np.where(first >= 0, sets[first], lead if lead is not None else 0)
        fresh = np.concatenate(([last is None or sets[0] != last or not same[0]], (sets[1:] != sets[:-1]) | ~same[1:]))
        take = same & fresh
        key, last, lead = keys[-1], sets[-1], leads[-1]
        yield pa.RecordBatch.from_arrays([pa.array(keys[take]), pa.array(sets[take]), pa.array(leads[take])], ["key", "set_id", "leader"])


def _token_sets(width: int):
    """(set_id, text, need) batches to (set_id, tokens, need); texts of another set than the one asked go."""

    def run(batches):
        for batch in batches:
            sets, own = [], []
            for name, tokens in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), width)):
                own.append(len(tokens) > 0 and _set_hash(tokens) == name)
                sets.append(np.sort(tokens.view(np.int64)) if own[-1] else None)
            whole = pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64())), batch.column(2)], ["set_id", "tokens", "need"])
            yield whole.filter(pa.array(own, pa.bool_()))

    return run


def _similar(t: Fraction):
    """Column: the arrays ta and tb reach the threshold, in whole numbers."""
    common = F.size(F.array_intersect("ta", "tb"))
    return common * t.denominator >= t.numerator * (F.size("ta") + F.size("tb") - common)


def _merge_groups(scratch: Scratch, groups: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``groups`` (id, component) with the components that ``links`` (src, dst) connect made one.

    Every round each group that touches a smaller one joins the smallest it touches, and what joined is
    contracted, so that only links between different groups are left for the next round.
    """

    def between(pairs: DataFrame, names: DataFrame) -> DataFrame:
        left, right = (names.select(F.col("id").alias(c), F.col("component").alias(g)) for c, g in (("src", "a"), ("dst", "b")))
        ends = pairs.join(left, "src").join(right, "dst").where("a <> b")
        return ends.select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst")).distinct()

    number = 0
    edges, seen = scratch.write_counted(between(links, groups), f"{name}-edges-0", rows=F.count("*"))
    while seen["rows"]:
        both = edges.union(edges.select("dst", "src"))
        low = scratch.write(both.groupBy("src").agg(F.min("dst").alias("low")).select(F.col("src").alias("id"), F.least("src", "low").alias("low")), f"{name}-low-{number}")
        above = low.select(F.col("id").alias("low"), F.col("low").alias("component"))
        names = scratch.write(low.join(above, "low").select("id", "component"), f"{name}-names-{number}")
        renamed = groups.withColumnRenamed("component", "old").join(names.withColumnRenamed("id", "old"), "old", "left")
        groups = scratch.write(renamed.select("id", F.coalesce("component", "old").alias("component")), f"{name}-{number}")
        number += 1
        edges, seen = scratch.write_counted(between(edges, names), f"{name}-edges-{number}", rows=F.count("*"))
        for old in (f"{name}-edges-{number - 1}", f"{name}-low-{number - 1}", f"{name}-{number - 2}"):
            scratch.drop(old)
    return groups


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, threshold: Fraction = Fraction(9, 10)) -> DataFrame:
    """(id_col, n_shingles, set_id, component_id) of every row of ``docs``.

    Two rows are linked when the Jaccard similarity of their shingle sets is ``threshold`` or more; the
    component is the smallest id reachable by links. ``threshold`` is a fraction below 1, ids are longs.
    Null, empty and blank texts have no shingles, a null ``set_id`` and stay alone. Repeated ids are
    rows of their own with equal results if their texts are equal; null ids stay null. Ties need no rule.
    Other columns of ``docs`` are not looked at. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "ngram-join")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # Names a row by its id and text: ids may repeat with other texts or be null.
    texts = texts.withColumn("row_key", F.xxhash64("id", "text"))
    keyed = scratch.write(texts.mapInArrow(_summaries(width, threshold), "id long, row_key long, n_shingles long, set_id long, need int, keys array<long>"), "keyed")
    rows = keyed.select(F.explode("keys").alias("key"), "set_id")
    matches = scratch.write(
        rows.repartition("key").sortWithinPartitions("key", "set_id").mapInArrow(_matches, "key long, set_id long, leader long"), "matches"
    )
    summary = scratch.write(keyed.drop("keys"), "summaries")
    scratch.drop("keyed")
    named = summary.where(F.col("set_id").isNotNull())
    wanted = matches.select("set_id").union(matches.select("leader")).distinct()
    # One text stands for each set that has a match.
    carriers = named.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(F.min("row_key").alias("row_key"), F.min("need").alias("need"))
    carried = texts.join(carriers, "row_key").select("set_id", "text", "need")
    tokens = scratch.write(carried.mapInArrow(_token_sets(width), "set_id long, tokens array<long>, need int").dropDuplicates(["set_id"]), "tokens")

    # A family: sets with the same leader of their leaders. Most of a group of copies is similar to it.
    led = matches.groupBy("set_id").agg(F.min("leader").alias("leader"))
    above = led.select(F.col("set_id").alias("leader"), F.col("leader").alias("family"))
    families = tokens.join(led, "set_id", "left").select("set_id", "need", F.coalesce("leader", "set_id").alias("leader")).join(above, "leader", "left")
    families = scratch.write(families.select("set_id", "need", F.coalesce("family", "leader").alias("family")), "families")
    left, right = (tokens.select(F.col("set_id").alias(c), F.col("tokens").alias(t)) for c, t in (("src", "ta"), ("dst", "tb")))
    stars = families.where("set_id <> family").select(F.col("set_id").alias("src"), F.col("family").alias("dst"))
    stars = stars.join(left, "src").join(right, "dst").where(_similar(threshold)).select("src", "dst")
    alone = tokens.select(F.col("set_id").alias("id"), F.col("set_id").alias("component"))
    groups = _merge_groups(scratch, alone, stars, "groups")
    groups = _open_groups(scratch, matches, tokens, families, groups, threshold)
    # Names are set hashes so far; a component is named by its smallest document.
    classed = named.groupBy("set_id").agg(F.min("id").alias("least")).join(groups.withColumnRenamed("id", "set_id"), "set_id", "left")
    classed = classed.select("set_id", F.coalesce("component", "set_id").alias("root"), "least")
    roots = classed.groupBy("root").agg(F.min("least").alias("component_id"))
    classed = scratch.write(classed.join(roots, "root").select("set_id", "component_id"), "classed")
    for name in ("matches", "tokens", "families"):
        scratch.drop(name)
    result = summary.select("id", "n_shingles", "set_id").join(classed, "set_id", "left")
    return result.select(F.col("id").alias(id_col), "n_shingles", "set_id", F.coalesce("component_id", "id").alias("component_id"))


def _open_groups(scratch: Scratch, matches: DataFrame, tokens: DataFrame, families: DataFrame, groups: DataFrame, t: Fraction) -> DataFrame:
    """Groups after every set has met, by the matrix, all sets of other groups with which it shares a match."""
    pairs = matches.select("key", "set_id").union(matches.select("key", F.col("leader").alias("set_id")))
    pairs = pairs.join(groups.withColumnRenamed("id", "set_id"), "set_id")
    of_key = Window.partitionBy("key")
    several = pairs.withColumns({"low": F.min("component").over(of_key), "high": F.max("component").over(of_key)}).where("low < high")
    members, seen = scratch.write_counted(several.select("key", "set_id", "component").distinct(), "members", rows=F.count("*"))
    if not seen["rows"]:
        return groups
    # A set asks a family if it shares as many matches with earlier sets of other groups there as a similar set would.
    ranges = [F.min("set_id").alias("first"), F.min("component").alias("low"), F.max("component").alias("high")]
    others = "first < set_id AND (low <> component OR high <> component)"
    offered = members.join(families, "set_id").groupBy("key", "family").agg(*ranges)
    shared = members.join(offered, "key").where(others).groupBy("set_id", "component", "family").agg(F.count("*").alias("shared"))
    enough = shared.join(families.select("set_id", "need"), "set_id").where("shared >= need")
    asking = scratch.write(enough.select("set_id", "component", "family"), "asking")
    # Families in blocks of groups. The sets that ask a block come in several streams if they are many.
    sizes = families.groupBy("family").agg(F.count("*").alias("n"))
    streams = asking.groupBy("family").agg(F.ceil(F.count("*") / STREAM).alias("streams"))
    block = F.pmod(F.xxhash64("set_id"), F.ceil(F.col("n") / BLOCK))
    blocks = families.join(sizes, "family").join(streams, "family").select("set_id", "family", "streams", block.alias("block"))
    blocks = scratch.write(blocks.join(groups.withColumnRenamed("id", "set_id"), "set_id"), "blocks")
    bounds = scratch.write(blocks.groupBy("family", "block", "streams").agg(*ranges), "bounds")
    asked = asking.join(bounds, "family").where(others).select(
        "family", "block", F.pmod(F.xxhash64("set_id", "block"), "streams").alias("stream"), F.lit(True).alias("asks"), "set_id", "component"
    )
    held = blocks.select(
        "family", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("streams") - 1)).alias("stream"), F.lit(False).alias("asks"), "set_id", "component"
    )
    rows = held.union(asked).join(tokens.select("set_id", "tokens"), "set_id").select("family", "block", "stream", "asks", "set_id", "component", "tokens")
    rows = rows.repartition("family", "block", "stream").sortWithinPartitions("family", "block", "stream", "asks")
    links = scratch.write(rows.mapInArrow(_open_blocks(t), "src long, dst long"), "opened")
    groups = _merge_groups(scratch, groups, links, "joined")
    for name in ("members", "asking", "blocks", "bounds", "opened"):
        scratch.drop(name)
    return groups


class _Block:
    """The token-group matrix of up to 64 sets: their token union, and one bit per set for each token."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]]):
        self.members = members
        every = np.concatenate([m[2] for m in members])
        self.union = np.unique(every)
        self.bits = np.zeros(len(self.union), np.uint64)
        for i, (_, _, tokens) in enumerate(members):
            self.bits[np.searchsorted(self.union, tokens)] |= np.uint64(1 << i)
        self.sizes = np.array([len(m[2]) for m in members])

    def similar(self, tokens: np.ndarray, t: Fraction) -> list[int]:
        """Numbers of the similar members; compared only if the union's overlap allows any."""
        at = np.searchsorted(self.union, tokens)
        at[at == len(self.union)] = 0
        hit = at[self.union[at] == tokens]
        least = max(int(self.sizes.min()), math.ceil(len(tokens) * t))
        if len(hit) * (t.numerator + t.denominator) < t.numerator * (len(tokens) + least):
            return []
        common = np.zeros(64, np.int64)
        for i in range(0, len(hit), 4096):
            common += np.unpackbits(self.bits[hit[i : i + 4096]].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        common = common[: len(self.members)]
        return np.flatnonzero(common * t.denominator >= t.numerator * (len(tokens) + self.sizes - common)).tolist()

    def connect(self, t: Fraction) -> list[tuple[int, int]]:
        """Links that connect similar members; from then on ``group`` names what is connected here."""
        out = []
        self.group = {m[1]: m[1] for m in self.members}
        for name, component, tokens in self.members:
            out += self.links(name, component, tokens, t)
        return out

    def links(self, name: int, component: int, tokens: np.ndarray, t: Fraction) -> list[tuple[int, int]]:
        """A link to one similar member of every group but the set's own."""
        found = {}
        for i in self.similar(tokens, t):
            found.setdefault(self.group[self.members[i][1]], self.members[i][0])
        own = self.group.get(component, component)
        found.pop(own, None)
        if component in self.group:
            self.group = {c: own if g in found else g for c, g in self.group.items()}
        return [(name, other) for other in found.values()]


def _open_blocks(t: Fraction):
    """Rows sorted by block, its members before the sets that ask it, to links."""

    def run(batches):
        key, members, built = None, [], None
        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for row, (family, block, stream, asks, name, component) in enumerate(zip(*columns)):
                if (family, block, stream) != key:
                    key, members, built = (family, block, stream), [], None
                tokens = batch.column(6)[row].values.to_numpy()
                if not asks:
                    members.append((name, component, tokens.copy()))
                    continue
                if built is None:
                    built = [_Block(members[i : i + 64]) for i in range(0, len(members), 64)]
                    out += [link for b in built for link in b.connect(t)]
                out += [link for b in built for link in b.links(name, component, tokens, t)]
            src, dst = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])

    return run
