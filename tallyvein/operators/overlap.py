"""All pairs of users that share enough items, exactly.

Two exact ways lead to the same pairs, and the measured degrees of the items choose between them:

* expand: join the memberships with themselves on the item and count per pair. Used while no item is
  popular and the number of expanded pairs stays within a small multiple of the input.
* prefix: order every user's items from rare to popular. Two users with enough items in common share
  one among the first few of that order, so only those are joined, and popular items drop out of
  the join. Users with equal sets are compared once. A small bitmap per set rules out most of the
  joined pairs, and the rest are checked on the whole sets. Where the sets have few items between them, most
  pairs would meet in that join; then blocks of sets meet as 0/1 matrices, and only pairs that pass leave a task.

Users with more items than fit a row are compared in groups as bitmaps, part of the items by part, so no
set is cut short and no pair that fails is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyvein.functions.hashing import power_of_two
from tallyvein.functions.ranking import positions
from tallyvein.session import Scratch

SLACK = 1e-9  # keeps a bound from rounding up past a whole number
MARK_BITS = 62  # bits used of one BIGINT word of a set's mark
MARK_WORDS = ("mark0", "mark1")


def _marks(item: Column) -> list[Column]:
    """Aggregates: bitmaps with one bit set per item, chosen by a hash of the item."""
    bit = F.pmod(F.xxhash64(item), F.lit(MARK_BITS * len(MARK_WORDS)))
    words = []
    for i, name in enumerate(MARK_WORDS):
        own = F.floor(bit / MARK_BITS) == i
        words.append(F.bit_or(F.when(own, power_of_two(bit % MARK_BITS)).otherwise(F.lit(0).cast("bigint"))).alias(name))
    return words


def _most_common(a: str, b: str) -> Column:
    """An upper bound of the common items of two sets from their marks.

    Common items lie on bits set in both marks; items of one set beyond its number of bits share a
    bit with another item of that set.
    """
    both, own = F.lit(0), F.lit(0)
    for word in MARK_WORDS:
        both = both + F.bit_count(F.col(f"{a}_{word}").bitwiseAND(F.col(f"{b}_{word}")))
        own = own + F.bit_count(F.col(f"{a}_{word}"))
    return both + F.col(f"{a}_n") - own


@dataclass(frozen=True)
class Rule:
    """When a pair with ``k`` common items of ``n`` and ``m`` counts: k >= overlap, or Jaccard >= jaccard."""

    overlap: int | None = None
    jaccard: float | None = None

    def __post_init__(self):
        if (self.overlap is None) == (self.jaccard is None):
            raise ValueError("give either an overlap or a Jaccard threshold")
        if self.overlap is not None and self.overlap < 1:
            raise ValueError("the overlap must be at least 1")
        if self.jaccard is not None and not 0 < self.jaccard <= 1:
            raise ValueError("the Jaccard threshold must be in (0, 1]")

    def passes(self, k: Column, n: Column, m: Column) -> Column:
        return k >= self.overlap if self.overlap is not None else k / (n + m - k) >= self.jaccard

    def needed(self, n: Column, m: Column) -> Column:
        """The least number of common items two sets of these sizes need."""
        if self.overlap is not None:
            return F.lit(self.overlap)
        return F.ceil((n + m) * (self.jaccard / (1 + self.jaccard)) - SLACK)

    def sizes_fit(self, small: Column, large: Column) -> Column:
        return F.lit(True) if self.overlap is not None else small >= large * self.jaccard - SLACK

    def short_prefix(self, n: Column) -> Column:
        """Leading items to join of a set whose partner is at least as large."""
        share = F.lit(self.overlap) if self.overlap is not None else F.ceil(n * (2 * self.jaccard / (1 + self.jaccard)) - SLACK)
        return (n - share + 1).cast("int")

    def long_prefix(self, n: Column) -> Column:
        """Leading items to join of a set whose partner is at most as large."""
        share = F.lit(self.overlap) if self.overlap is not None else F.ceil(n * self.jaccard - SLACK)
        return (n - share + 1).cast("int")


def shared_pairs(
    memberships: DataFrame,
    user: str,
    item: str,
    rule: Rule,
    expansion: float = 64.0,
    popular: int = 20_000,
    row_items: int = 512,
    with_sizes: bool = True,
) -> DataFrame:
    """(src, dst, overlap, src_size, dst_size) with src < dst for all pairs that pass the rule.

    Without ``with_sizes`` the sizes may be missing, which saves two joins where the rule needs none.
    """
    scratch = Scratch(memberships.sparkSession, "overlap")
    clean = memberships.select(F.col(user).alias("user"), F.col(item).alias("item")).dropna().distinct()
    rows = scratch.write(clean, "memberships")
    degrees = rows.groupBy("item").agg(F.count("*").alias("degree"))
    n, pairs, top = degrees.agg(
        F.coalesce(F.sum("degree"), F.lit(0)),
        F.coalesce(F.sum(F.col("degree").cast("double") * (F.col("degree") - 1) / 2), F.lit(0.0)),
        F.coalesce(F.max("degree"), F.lit(0)),
    ).first()
    sizes = rows.groupBy("user").agg(F.count("*").alias("size"))
    if top <= popular and pairs <= expansion * max(n, 1):
        counted = _common_items(rows, sizes, pairs)
        if rule.overlap is not None and not with_sizes:
            return counted.where(F.col("overlap") >= rule.overlap).select(F.col("u").alias("src"), F.col("v").alias("dst"), "overlap")
        return _sized(counted, sizes, rule)
    return _prefix(scratch, rows, degrees, sizes, rule, popular, row_items)


#: Expanded pairs that a task joins or counts; a task's table of counts takes some 150 bytes for each.
TASK_PAIRS = 2_000_000


def _common_items(rows: DataFrame, sizes: DataFrame, pairs: float) -> DataFrame:
    """(u, v, overlap): common items of all pairs of users u < v that share one.

    The measured number of expanded pairs sets the tasks, as the bytes of the input do not show how far it
    expands. A user with very many items may share them all with another: then counts are added up before
    they meet, so that such a pair does not fill a task.
    """
    parallel = min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(pairs / 50_000))
    parts = max(1, parallel, math.ceil(pairs / TASK_PAIRS))
    dealt = rows.repartition(parts, "item")
    named = [dealt.withColumnRenamed("user", name) for name in ("u", "v")]
    met = named[0].hint("merge").join(named[1], "item").where(F.col("u") < F.col("v")).select("u", "v")
    longest = sizes.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0]
    if longest <= TASK_PAIRS // 8:
        met = met.repartition(parts, "u", "v")
    return met.groupBy("u", "v").agg(F.count("*").alias("overlap"))


def _sized(counted: DataFrame, sizes: DataFrame, rule: Rule) -> DataFrame:
    """Counted pairs that pass the rule, with the sizes of both sets."""
    if rule.overlap is not None:
        counted = counted.where(F.col("overlap") >= rule.overlap)
    sized = counted.join(sizes.select(F.col("user").alias("u"), F.col("size").alias("n")), "u").join(
        sizes.select(F.col("user").alias("v"), F.col("size").alias("m")), "v"
    )
    return _oriented(sized.where(rule.passes(F.col("overlap"), F.col("n"), F.col("m"))))


def _oriented(pairs: DataFrame) -> DataFrame:
    """(u, v, overlap, n, m) as rows with src < dst."""
    ahead = F.col("u") < F.col("v")
    return pairs.select(
        F.least("u", "v").alias("src"),
        F.greatest("u", "v").alias("dst"),
        F.col("overlap").cast("bigint").alias("overlap"),
        F.when(ahead, F.col("n")).otherwise(F.col("m")).cast("bigint").alias("src_size"),
        F.when(ahead, F.col("m")).otherwise(F.col("n")).cast("bigint").alias("dst_size"),
    )


def _prefix(scratch: Scratch, rows: DataFrame, degrees: DataFrame, sizes: DataFrame, rule: Rule, popular: int, row_items: int) -> DataFrame:
    large = sizes.where(F.col("size") > row_items)
    has_large = not large.isEmpty()
    small_rows = rows.join(large, "user", "left_anti") if has_large else rows
    entry = F.struct("degree", "item")
    sets = (
        small_rows.join(degrees, "item")
        .groupBy("user")
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"), *_marks(F.col("item")))  # at most row_items entries
    )
    # One row per distinct set; its smallest user stands for it.
    sets = scratch.write(sets, "sets")
    unique = scratch.write(
        sets.groupBy("entries", *MARK_WORDS).agg(F.min("user").alias("id"), F.count("*").alias("users")), "unique"
    )
    met = _set_pairs(scratch, sets, unique, rule)
    out = _to_users(_prefix_pairs(unique, rule, popular), sets, unique, rule) if met is None else _oriented(met)
    if has_large:
        out = out.unionByName(_large_pairs(scratch, rows, sizes, large, rule))
    return out


def _prefix_pairs(unique: DataFrame, rule: Rule, popular: int) -> DataFrame:
    """(a, b, overlap, n, m) over distinct sets, each pair once, found at its rarest common item."""
    kept = ["id", "items", "n", *MARK_WORDS]
    sized = unique.select("id", "entries", F.col("entries.item").alias("items"), F.size("entries").alias("n"), *MARK_WORDS)
    # Items held by many users are cut into a grid of blocks, so no task meets a whole popular item.
    blocks = F.ceil(F.col("entry.degree") / F.lit(popular)).cast("int")

    def side(length: Column, name: str, own: str, other: str) -> DataFrame:
        cut = F.slice("entries", F.lit(1), F.greatest(length, F.lit(0)))
        return (
            sized.select(*kept, F.posexplode(cut).alias("at", "entry"))
            .select(*kept, "at", F.col("entry.item").alias("item"), blocks.alias("blocks"))
            .select(
                "item",
                F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias(own),
                F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias(other),
                *[F.col(c).alias(f"{name}_{c}") for c in (*kept, "at")],
            )
        )

    short = side(rule.short_prefix(F.col("n")), "a", "row", "column")
    long = side(rule.long_prefix(F.col("n")), "b", "column", "row")
    a_n, b_n = F.col("a_n"), F.col("b_n")
    needed = rule.needed(a_n, b_n)
    reach = 1 + F.least(a_n - F.col("a_at") - 1, b_n - F.col("b_at") - 1)
    common = F.array_intersect("a_items", "b_items")
    ordered = (a_n < b_n) | ((a_n == b_n) & (F.col("a_id") < F.col("b_id")))
    cheap = ordered & rule.sizes_fit(a_n, b_n) & (reach >= needed) & (_most_common("a", "b") >= needed)
    first = F.element_at(common, 1) == F.col("item")
    # CASE keeps the order of the tests: the sets are compared only where the cheap tests pass. The
    # planner does not see how far the sides were exploded, so it must not broadcast one.
    return (
        short.hint("merge")
        .join(long, ["item", "row", "column"])
        .where(F.when(cheap, rule.passes(F.size(common), a_n, b_n) & first).otherwise(False))
        .select(
            F.col("a_id").alias("a"), F.col("b_id").alias("b"),
            F.size(common).alias("overlap"), a_n.alias("n"), b_n.alias("m"),
        )
    )


#: Items that the matrices of sets have at most, sets of a block, and sets on each side of a tile.
MATRIX_ITEMS, BLOCK_SETS, TILE_SETS = 1024, 16_384, 2048
#: Users of a set that stand in one row of a block, and pairs of users that leave a task at a time.
ROW_USERS, PAIRS_AT_ONCE = 64, 1 << 18
#: Time of a pair that the prefix join meets, as a multiple of that of a pair and 64 items of the matrices.
PREFIX_PAIR = 8.0


def _prefix_candidates(unique: DataFrame, rule: Rule) -> float:
    """Pairs of sets that the prefix join meets, counted item by item without joining."""
    n = F.size("entries")
    ends = F.greatest(rule.short_prefix(n), F.lit(0)).alias("short"), F.greatest(rule.long_prefix(n), F.lit(0)).alias("long")
    placed = unique.select(*ends, F.posexplode("entries").alias("at", "entry"))
    inside = [F.sum(F.when(F.col("at") < F.col(name), 1.0).otherwise(0.0)).alias(name) for name in ("short", "long")]
    return placed.groupBy("entry.item").agg(*inside).agg(F.coalesce(F.sum(F.col("short") * F.col("long")), F.lit(0.0))).first()[0]


def _set_pairs(scratch: Scratch, sets: DataFrame, unique: DataFrame, rule: Rule) -> DataFrame | None:
    """(u, v, overlap, n, m), each pair of users once, by products of 0/1 matrices; None where the prefix join has less to do.

    Distinct sets stand in blocks in order of their size, each with its users, some at a time. Two blocks whose sizes
    may match meet in one task, tile by tile. Only pairs of users that pass leave it and none is shuffled, so that
    memory and disk are bounded however many pass.
    """
    items = unique.select(F.explode("entries.item").alias("item")).distinct()
    width = items.limit(MATRIX_ITEMS + 1).count()
    n_sets = unique.count()
    if not 0 < width <= MATRIX_ITEMS:
        return None
    if _prefix_candidates(unique, rule) * PREFIX_PAIR < n_sets * n_sets / 2 * math.ceil(width / 64):
        return None
    size = min(BLOCK_SETS, max(BLOCK_SETS // 8, math.ceil(n_sets / 16)))
    codes = scratch.write(positions(items, [F.col("item")], name="code"), "codes")
    # Only users of shared sets need a lookup; the others stand for themselves.
    several = unique.where(F.col("users") > 1).select("entries", "id", F.ceil(F.col("users") / ROW_USERS).alias("pieces"))
    piece = F.pmod(F.xxhash64("user"), F.col("pieces")).alias("piece")
    members = sets.join(several, "entries").groupBy("id", piece).agg(F.collect_list("user").alias("members"))
    lone = F.when(F.col("users") == 1, F.array("id"))
    held = unique.join(members, "id", "left").select("id", F.coalesce("piece", F.lit(0)).alias("piece"), F.coalesce(lone, "members").alias("members"), "entries")
    placed = positions(
        held.select("id", "piece", "members", F.size("entries").alias("n"), F.col("entries.item").alias("items")),
        [F.col("n"), F.col("id"), F.col("piece")], name="place",
    )
    sets = scratch.write(placed.withColumn("block", F.floor((F.col("place") - 1) / size).cast("int")), "placed")
    coded = sets.select("block", "place", "n", "members", F.explode("items").alias("item")).join(F.broadcast(codes), "item")  # at most MATRIX_ITEMS codes
    lists = coded.groupBy("block", "place", "n").agg(F.first("members").alias("members"), F.collect_list((F.col("code") - 1).cast("int")).alias("codes"))
    kind = sets.schema["id"].dataType.simpleString()
    packed = lists.repartition(math.ceil(n_sets / size), "block").sortWithinPartitions("block").mapInArrow(
        lambda batches: _pack_sets(batches, width), f"block int, users array<{kind}>, counts binary, sizes binary, bits binary"
    )
    blocks = scratch.write(packed, "blocks")
    ranges = scratch.write(sets.groupBy("block").agg(F.min("n").alias("low"), F.max("n").alias("high")), "ranges")
    low, high = (ranges.select(F.col("block").alias(name), F.col(end).alias(f"{name}_n")) for name, end in (("row", "high"), ("column", "low")))
    may = (F.col("row") <= F.col("column")) & rule.sizes_fit(F.col("row_n"), F.col("column_n"))
    grid = scratch.write(low.join(high, may).select("row", "column"), "grid")

    def side(own: str, first: bool) -> DataFrame:
        return blocks.withColumnRenamed("block", own).join(grid, own).select("row", "column", F.lit(first).alias("first"), "users", "counts", "sizes", "bits")

    tasks = min(max(grid.count(), 1), 4096)
    laid = side("row", True).unionByName(side("column", False)).repartition(tasks, "row", "column")
    laid = laid.sortWithinPartitions("row", "column", F.desc("first"))
    return laid.mapInArrow(lambda batches: _meet_blocks(batches, rule, width), f"u {kind}, v {kind}, overlap int, n int, m int")


def _pack_sets(batches, width: int):
    """(block, place, n, members, codes) in order of the block to one row per block: users, their counts, sizes and a bit per set and item."""
    waiting, now = [], None

    def packed():
        rows = pa.Table.from_batches(waiting).combine_chunks()
        codes = rows["codes"].combine_chunks()
        held = np.zeros((rows.num_rows, width), bool)
        held[np.repeat(np.arange(rows.num_rows), np.diff(codes.offsets.to_numpy())), codes.flatten().to_numpy()] = True
        members = rows["members"].combine_chunks()
        users = members.flatten()
        users = pa.ListArray.from_arrays(pa.array([0, len(users)], pa.int32()), users)
        parts = np.diff(members.offsets.to_numpy()).astype(np.int32), rows["n"].to_numpy().astype(np.int32), np.packbits(held, axis=1)
        parts = [pa.array([x.tobytes()], pa.binary()) for x in parts]
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), users, *parts], ["block", "users", "counts", "sizes", "bits"])

    for batch in batches:
        block = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for start, stop in zip(edges, edges[1:]):
            if start == stop:
                continue
            if waiting and block[start] != now:
                yield packed()
                waiting.clear()
            now = int(block[start])
            waiting.append(batch.slice(start, stop - start))
    if waiting:
        yield packed()


def _meet_blocks(batches, rule: Rule, width: int):
    """Pairs of blocks, the first block's row ahead of the second's, as pairs of users whose sets pass."""
    first = None
    for batch in batches:
        for at in range(batch.num_rows):
            row, column, is_first = (batch.column(i)[at].as_py() for i in range(3))
            users = batch.column(3).slice(at, 1).flatten()
            counts, sizes = (np.frombuffer(batch.column(i)[at].as_buffer(), np.int32) for i in (4, 5))
            bits = np.frombuffer(batch.column(6)[at].as_buffer(), np.uint8).reshape(len(sizes), -1)
            block = users, sizes, bits, counts, np.cumsum(counts, dtype=np.int64) - counts
            if is_first:
                first = block
            else:
                yield from _tiles(first, block, row == column, rule, width)
                if row == column:
                    yield from _inside(block, rule)


def _inside(block, rule: Rule):
    """Pairs of users of one row: their sets are equal."""
    shared = np.flatnonzero((block[3] > 1) & (block[1] >= (rule.overlap or 0)))
    n = block[1][shared].astype(np.int64)
    yield from _users_of(block, block, shared, shared, n, n, n, True)


def _users_of(first, second, a: np.ndarray, b: np.ndarray, k: np.ndarray, n: np.ndarray, m: np.ndarray, same: bool = False):
    """Every user of row a with every one of row b; of the same row each pair once."""
    pairs = first[3][a].astype(np.int64) * second[3][b]
    ends = np.cumsum(pairs)
    start = 0
    while start < len(a):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PAIRS_AT_ONCE, "right")))
        of = np.repeat(np.arange(start, stop), pairs[start:stop])
        i, j = np.divmod(np.arange(len(of)) + before - (ends - pairs)[of], second[3][b[of]])
        if same:
            of, i, j = (x[i < j] for x in (of, i, j))
        ends_of = [side[0].take(pa.array(side[4][row[of]] + place)) for side, row, place in ((first, a, i), (second, b, j))]
        yield pa.RecordBatch.from_arrays([*ends_of, *(pa.array(x[of].astype(np.int32)) for x in (k, n, m))], ["u", "v", "overlap", "n", "m"])
        start = stop


def _tiles(first, second, same: bool, rule: Rule, width: int):
    """One product per pair of tiles: common items, less the share of both sizes that the rule asks for."""
    share, least = (0.0, rule.overlap) if rule.overlap is not None else (rule.jaccard / (1 + rule.jaccard), 0)

    def matrix(side, start: int, ahead: bool) -> np.ndarray:
        sizes, bits = side[1][start : start + TILE_SETS], side[2][start : start + TILE_SETS]
        asked, ones = np.float32(-share) * sizes, np.ones(len(sizes), np.float32)
        return np.column_stack([np.unpackbits(bits, axis=1, count=width), *((asked, ones) if ahead else (ones, asked))]).astype(np.float32)

    for i in range(0, len(first[1]), TILE_SETS):
        left = matrix(first, i, True)
        for j in range(i if same else 0, len(second[1]), TILE_SETS):
            spare = left @ matrix(second, j, False).T
            a, b = np.divmod(np.flatnonzero(spare >= np.float32(least - 0.25)), spare.shape[1])
            n, m = first[1][i + a].astype(np.int64), second[1][j + b].astype(np.int64)
            k = np.rint(spare[a, b] + share * (n + m)).astype(np.int64)  # the products are far less than 0.25 off
            a, b = i + a, j + b
            good = k >= rule.overlap if rule.overlap is not None else k / (n + m - k) >= rule.jaccard
            if same:
                good &= a < b
            if good.any():
                yield from _users_of(first, second, *(x[good] for x in (a, b, k, n, m)))


def _to_users(pairs: DataFrame, sets: DataFrame, unique: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of sets as pairs of users, with the pairs inside a set that several users share."""
    several = unique.where(F.col("users") > 1).select("entries", "id")
    # Only users of shared sets need a lookup; the others stand for themselves.
    shared = sets.join(several, "entries").select("id", "user")
    out = pairs
    for end, member in (("a", "u"), ("b", "v")):
        names = shared.select(F.col("id").alias(end), F.col("user").alias(member))
        out = out.join(names, end, "left").withColumn(member, F.coalesce(member, end)).drop(end)
    size = F.size("entries")
    within = (
        sets.join(several, "entries")
        .where(rule.passes(size, size, size))
        .select("id", F.col("user").alias("u"), size.alias("n"))
    )
    inside = within.join(within.select("id", F.col("u").alias("v")), "id").where(F.col("u") < F.col("v"))
    inside = inside.select("u", "v", F.col("n").alias("overlap"), "n", F.col("n").alias("m"))
    return _oriented(out.select("u", "v", "overlap", "n", "m").unionByName(inside))


def _large_pairs(scratch: Scratch, rows: DataFrame, sizes: DataFrame, large: DataFrame, rule: Rule) -> DataFrame:
    """Pairs with at least one user whose items do not fit a row.

    Large users stand in groups of about ``LARGE_GROUP``, all that they may match in groups of about
    ``OTHER_GROUP``. A pair of groups meets in one task, which takes their items part by part, by a hash of
    the item: users become packed bitmaps over the items of the part, and common items are counted bit by
    bit into one small table per pair of groups. The rule is applied there, so only pairs that pass leave.
    An item goes only where both groups hold it: a row is sent at most as often as there are groups, and as its
    item has users.
    """
    least = rule.overlap if rule.overlap is not None else 1
    floor = large.agg(F.min("size")).first()[0]
    fit = F.col("size") >= max(least, math.ceil(floor * rule.jaccard - SLACK) if rule.jaccard is not None else 1)
    others = sizes.where(fit).join(large.select("user", F.lit(True).alias("is_large")), "user", "left")
    large_users, n_large = _grouped(scratch, "large-users", large, LARGE_GROUP)
    other_users, n_others = _grouped(scratch, "other-users", others, OTHER_GROUP)
    total = sum(users.agg(F.sum("size")).first()[0] / n for users, n in ((large_users, n_large), (other_users, n_others)))
    part = F.pmod(F.xxhash64("item"), F.lit(math.ceil(total / PART_ROWS))).cast("int")
    met = _meetings(scratch, rows, large_users, other_users, part)
    tasks = max(n_large * n_others, 1)
    laid = met.repartition(min(tasks, 4096), "row", "column").sortWithinPartitions("row", "column", "part")
    found = laid.mapInArrow(lambda batches: _count_bits(batches, rule), "row int, column int, a int, b int, overlap bigint")
    for end, users, group, at in (("u", large_users, "row", "a"), ("v", other_users, "column", "b")):
        names = users.select(
            F.col("group").alias(group), F.col("at").alias(at), F.col("user").alias(end), F.col("size").alias(f"{end}_size"),
            *([F.col("is_large")] if end == "v" else []),
        )
        found = found.join(names, [group, at])
    once = (F.col("u") != F.col("v")) & (F.col("is_large").isNull() | (F.col("u") < F.col("v")))
    return _oriented(found.where(once).select("u", "v", "overlap", F.col("u_size").alias("n"), F.col("v_size").alias("m")))


#: Users of a group of large ones and of their partners; rows of a part that a task holds at a time.
LARGE_GROUP, OTHER_GROUP, PART_ROWS = 64, 1024, 200_000


def _grouped(scratch: Scratch, name: str, users: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Users with a group by hash and a place in it from 0 on; a group has about ``size`` of them."""
    groups = max(1, math.ceil(users.count() / size))
    dealt = users.withColumn("group", F.pmod(F.xxhash64("user"), F.lit(groups)).cast("int"))
    at = F.row_number().over(Window.partitionBy("group").orderBy("user")) - 1
    return scratch.write(dealt.withColumn("at", at.cast("int")), name), groups


def _meetings(scratch: Scratch, rows: DataFrame, large_users: DataFrame, other_users: DataFrame, part: Column) -> DataFrame:
    """(row, column, part, first, at, size, item): the memberships of each pair of groups, of items that both hold."""
    # Written, so that the joins see real sizes and split a popular item.
    members, groups = [], []
    for users, own in ((large_users, "row"), (other_users, "column")):
        held = rows.join(users.select("user", F.col("group").alias(own), "at", "size"), "user").select("item", own, "at", "size")
        members.append(scratch.write(held, f"{own}-members"))
        groups.append(scratch.write(members[-1].groupBy("item").agg(F.collect_set(own).alias("groups")), f"{own}-groups"))

    def side(held: DataFrame, met: DataFrame, other: str, first: bool) -> DataFrame:
        spread = held.join(met, "item").withColumn(other, F.explode("groups"))
        return spread.select("row", "column", part.alias("part"), F.lit(first).alias("first"), "at", "size", "item")

    return side(members[0], groups[1], "column", True).unionByName(side(members[1], groups[0], "row", False))


class _Cell:
    """Common items of two groups of users, counted part by part."""

    def __init__(self, row: int, column: int):
        self.row, self.column, self.waiting = row, column, []
        self.counts = np.zeros((0, 0), np.int64)
        self.sizes = [np.zeros(0, np.int64), np.zeros(0, np.int64)]

    def count(self) -> None:
        """Add the part that is waiting: a bitmap per user over the items of the part."""
        if not self.waiting:
            return
        rows = pa.Table.from_batches(self.waiting)
        self.waiting = []
        codes = rows["item"].combine_chunks().dictionary_encode()
        codes, width = codes.indices.to_numpy(), -(-len(codes.dictionary) // 64) * 64
        first, at, size = (rows[c].to_numpy() for c in ("first", "at", "size"))
        bits = []
        for k, mine in enumerate((first, ~first)):
            users = int(at[mine].max()) + 1 if mine.any() else 0
            self.sizes[k] = _grown(self.sizes[k], (users,))
            self.sizes[k][at[mine]] = size[mine]
            own = np.zeros((users, width), bool)
            own[at[mine], codes[mine]] = True
            bits.append(np.packbits(own, axis=1).view(np.uint64))
        self.counts = _grown(self.counts, (len(bits[0]), len(bits[1])))
        for i, line in enumerate(bits[0]):
            if line.any():
                self.counts[i, : len(bits[1])] += np.bitwise_count(bits[1] & line).sum(axis=1, dtype=np.int64)

    def passing(self, rule: Rule) -> pa.RecordBatch:
        n, m = (s[:k] for s, k in zip(self.sizes, self.counts.shape))
        if rule.overlap is not None:
            good = self.counts >= rule.overlap
        else:
            good = (self.counts > 0) & (self.counts >= rule.jaccard * np.maximum(n[:, None] + m[None, :] - self.counts, 1) - SLACK)
            i, j = np.nonzero(good)
            k = self.counts[i, j]
            good[i, j] = k / (n[i] + m[j] - k) >= rule.jaccard
        a, b = np.nonzero(good)
        places = [np.full(len(a), self.row), np.full(len(a), self.column), a, b]
        return pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int32)) for x in places), pa.array(self.counts[a, b])], ["row", "column", "a", "b", "overlap"])


def _grown(array: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """The array with zeros behind it up to a shape, if that is larger."""
    return np.pad(array, [(0, max(0, want - have)) for want, have in zip(shape, array.shape)])


def _count_bits(batches, rule: Rule):
    """Rows in order of (row, column, part) as pairs that pass: one part and one table of counts in memory at a time."""
    cell = key = None
    for batch in batches:
        columns = [batch.column(i).to_numpy() for i in range(3)]
        change = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            if start == stop:
                continue
            now = tuple(int(c[start]) for c in columns)
            if cell is not None and now != key:
                cell.count()
                if now[:2] != key[:2]:
                    yield cell.passing(rule)
                    cell = None
            if cell is None:
                cell = _Cell(*now[:2])
            key = now
            cell.waiting.append(batch.slice(start, stop - start))
    if cell is not None:
        cell.count()
        yield cell.passing(rule)


def jaccard_of(overlap: Column, n: Column, m: Column) -> Column:
    return overlap / (n + m - overlap)


__all__ = ["Rule", "shared_pairs", "jaccard_of"]
