"""Membership, distinct counts and samples over the given tables, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyvein.functions.hashing import PRIME, hash_parameters
from tallyvein.functions.ranking import with_top_counts
from tallyvein.operators import blocked_bloom, distinct, membership, sampling, sketches
from tallyvein.plans import inputs
from tallyvein.plans.inputs import r6
from tallyvein.plans.registry import MESSAGES, key_sql, query, rank_sql
from tallyvein.session import Scratch
from tallyvein.sources import sinks
from tallyvein.sources.readers import table
from tallyvein.streaming.reservoir import reports, start_trending
from tallyvein.streaming.sources import json_stream, table_stream
from tallyvein.streaming.stateful import start_stateful_trending
from tallyvein.streaming.windows import start_window_estimates, start_window_sketches

K = 5
BITS = membership.WORD_BITS
_BUILD = "(SELECT DISTINCT c_name FROM customer WHERE c_mktsegment = 'BUILDING')"
_SIZE = f"(SELECT CAST(greatest({BITS}, ceil(count(*) * {K} / ln(2))) AS BIGINT) FROM {_BUILD})"


def _spots(table_sql: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT c_name{extra}, ({key_sql('c_name', i)} * {a} + {b}) % {PRIME} % {_SIZE} AS spot FROM {table_sql}"
        for i, (a, b) in enumerate(hash_parameters(K))
    )


_WORDS = f"""SELECT spot // {BITS} AS word, bit_or(CAST(1 AS BIGINT) << CAST(spot % {BITS} AS INTEGER)) AS bits
    FROM ({_spots(_BUILD)}) GROUP BY 1"""
_PROBED = f"""SELECT c_custkey, bool_and(coalesce((bits >> CAST(spot % {BITS} AS INTEGER)) & 1, 0) = 1) AS maybe_present
    FROM ({_spots('customer', ', c_custkey')}) LEFT JOIN ({_WORDS}) ON word = spot // {BITS} GROUP BY c_custkey"""


def _filter(spark, folder):
    names = inputs.building_customers(spark, folder)
    return membership.bloom_build(names, "c_name", names.distinct().count(), K)


def _probed(spark, folder):
    probes = table(spark, folder, "customer").select("c_custkey", "c_name")
    return membership.bloom_probe(probes, "c_name", _filter(spark, folder))


@query("SK1", _WORDS)
def bloom_build(spark, folder):
    return _filter(spark, folder).words


@query("SK2 SET2", _PROBED)
def bloom_membership(spark, folder):
    return _probed(spark, folder).select("c_custkey", "maybe_present")


@query("SK2", _PROBED)
def bloom_membership_large(spark, folder):
    """The way for filters too large to broadcast, on the same data."""
    probes = table(spark, folder, "customer").select("c_custkey", "c_name")
    return membership.probe_by_word(probes, "c_name", _filter(spark, folder)).select("c_custkey", "maybe_present")


@query("SK3", f"""WITH p AS ({_PROBED}), t AS (SELECT c_custkey, c_name IN (SELECT c_name FROM {_BUILD}) AS present FROM customer)
    SELECT count(*) AS probes, CAST(count_if(present) AS BIGINT) AS members, CAST(count_if(maybe_present) AS BIGINT) AS passed,
        CAST(count_if(maybe_present AND NOT present) AS BIGINT) AS false_positives,
        CAST(count_if(present AND NOT maybe_present) AS BIGINT) AS false_negatives,
        round(count_if(maybe_present AND NOT present) / count_if(NOT present), 6) AS false_positive_rate
    FROM p JOIN t USING (c_custkey)""")
def bloom_report(spark, folder):
    report = membership.bloom_report(_probed(spark, folder), inputs.building_customers(spark, folder), "c_name")
    return report.withColumn("false_positive_rate", r6(F.col("false_positive_rate")))


_N_BLOCKS = f"(SELECT CAST(greatest(1, ceil(count(*) * 10 / {blocked_bloom.BLOCK_BITS}.0)) AS BIGINT) FROM {_BUILD})"
_SPOT = [f"(1::BIGINT << CAST(({key_sql('c_name', 1)} >> {blocked_bloom.LANE_BITS * i}) & 31 AS INTEGER))" for i in range(blocked_bloom.LANES)]
_BLOCKS = f"""SELECT {key_sql('c_name')} % {_N_BLOCKS} AS block, {', '.join(f'bit_or({b}) AS {n}' for b, n in zip(_SPOT, blocked_bloom.LANE_NAMES))}
    FROM {_BUILD} GROUP BY 1"""


def _blocked(spark, folder):
    """The filter of one segment, merged from those of two chunks of customers."""
    members = inputs.building_customers(spark, folder)
    n_blocks = blocked_bloom.blocks_for(members.distinct().count())
    first = F.crc32("c_name") % 2 == 0
    return blocked_bloom.blocked_merge([blocked_bloom.blocked_build(members.where(part), "c_name", n_blocks) for part in (first, ~first)])


@query("SK1", _BLOCKS)
def blocked_bloom_build(spark, folder):
    return _blocked(spark, folder).blocks


@query("SK2 SK3", f"""WITH b AS ({_BLOCKS}), t AS (SELECT c_name IN (SELECT c_name FROM {_BUILD}) AS present,
        coalesce({' AND '.join(f'({n} & {b}) <> 0' for b, n in zip(_SPOT, blocked_bloom.LANE_NAMES))}, false) AS passed
        FROM customer LEFT JOIN b ON block = {key_sql('c_name')} % {_N_BLOCKS})
    SELECT count(*) AS probes, CAST(count_if(present) AS BIGINT) AS members, CAST(count_if(passed) AS BIGINT) AS passed,
        CAST(count_if(passed AND NOT present) AS BIGINT) AS false_positives,
        CAST(count_if(present AND NOT passed) AS BIGINT) AS false_negatives,
        round(count_if(passed AND NOT present) / count_if(NOT present), 6) AS false_positive_rate FROM t""")
def blocked_bloom_report(spark, folder):
    probes = table(spark, folder, "customer").select("c_custkey", "c_name")
    probed = blocked_bloom.blocked_probe(probes, "c_name", _blocked(spark, folder))
    report = membership.bloom_report(probed, inputs.building_customers(spark, folder), "c_name")
    return report.withColumn("false_positive_rate", r6(F.col("false_positive_rate")))


@query("SNK1", f"""SELECT CAST((c_custkey - (SELECT min(c_custkey) FROM customer)) // 100000 AS BIGINT) AS line_no,
    string_agg(CASE WHEN maybe_present THEN 'T' ELSE 'F' END, ' ' ORDER BY c_custkey) AS line FROM ({_PROBED}) GROUP BY 1""")
def flag_lines(spark, folder):
    return sinks.flag_lines(_probed(spark, folder), "c_custkey", "maybe_present")


HASHES, HASH_BITS, GROUPS = 100, distinct.HASH_BITS, 3
DAY, PANE = 86_400, 21_600


def _tops(values: str, by: str, bits: int = HASH_BITS) -> str:
    """Largest 2**r per group and hash, from distinct (by, v) rows."""
    family = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(hash_parameters(HASHES)))
    keys = f"CASE no % 3 WHEN 0 THEN {key_sql('v', 0)} WHEN 1 THEN {key_sql('v', 1)} ELSE {key_sql('v', 2)} END"
    return f"""SELECT {by}, no AS hash_no, max(h & -h) AS top FROM
        (SELECT {by}, no, ({keys} * a + b) % {2**bits} AS h FROM {values}, (VALUES {family}) AS f(no, a, b)) GROUP BY ALL"""


def _estimates(tops: str, by: str) -> str:
    width = HASHES // GROUPS
    return f"""SELECT {by}, CAST(round(pow(2, median(m) - {distinct.RUN_BIAS})) AS BIGINT) AS estimate FROM
        (SELECT {by}, least(hash_no // {width}, {GROUPS - 1}) AS g, avg(log2(greatest(top, 1))) AS m FROM ({tops}) GROUP BY ALL) GROUP BY ALL"""


def _checked(truth: str, estimates: str, by: str) -> str:
    return f"""SELECT {by}, truth, estimate, round(abs(truth - estimate) / estimate, 6) AS relative_error,
        abs(truth - estimate) / estimate <= 0.25 AS within_limit FROM ({truth}) JOIN ({estimates}) USING ({by})"""


@query("AGG12", f"SELECT hash_no, CAST(log2(greatest(top, 1)) AS INTEGER) AS zeros FROM ({_tops('(SELECT DISTINCT user_id AS v, 0 AS one FROM events)', 'one', 20)})")
def max_trailing_zeros(spark, folder):
    return distinct.max_trailing_zeros(table(spark, folder, "events"), "user_id", HASHES, 20)


@query("SK4 AGG13", _checked("SELECT event_type, count(DISTINCT user_id) AS truth FROM events GROUP BY 1",
    _estimates(_tops("(SELECT DISTINCT event_type, user_id AS v FROM events)", "event_type"), "event_type"), "event_type"))
def fm_distinct(spark, folder):
    found = distinct.fm_distinct_checked(table(spark, folder, "events"), "user_id", "event_type", HASHES, GROUPS, HASH_BITS)
    return found.withColumn("relative_error", r6(F.col("relative_error")))


@query("SK4", _checked("SELECT 0 AS one, count(DISTINCT l_orderkey) AS truth FROM lineitem",
    _estimates(_tops("(SELECT DISTINCT l_orderkey AS v, 0 AS one FROM lineitem)", "one"), "one"), "one").replace("SELECT one,", "SELECT", 1))
def fm_distinct_orders(spark, folder):
    """One count over the largest table."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.lit(0).alias("one"))
    found = distinct.fm_distinct_checked(lines, "l_orderkey", "one", HASHES, GROUPS, HASH_BITS)
    return found.drop("one").withColumn("relative_error", r6(F.col("relative_error")))


@query("SK5")
def approx_distinct(spark, folder):
    return distinct.approx_distinct(table(spark, folder, "lineitem"), "l_orderkey", ["l_suppkey"])


_WINDOWED = f"""(SELECT DISTINCT p - s * {PANE} AS window_start, user_id AS v FROM
    (SELECT CAST(floor(epoch(ts)) AS BIGINT) // {PANE} * {PANE} AS p, user_id FROM events), range(0, {DAY // PANE}) AS r(s))"""
_WINDOW_TRUTH = f"SELECT window_start, count(*) AS truth FROM {_WINDOWED} GROUP BY 1"
_WINDOW_ESTIMATES = _estimates(_tops(_WINDOWED, "window_start"), "window_start")


@query("AGG11", _WINDOW_TRUTH)
def window_distinct(spark, folder):
    return distinct.window_distinct(table(spark, folder, "events"), "ts", "user_id", DAY, PANE)


@query("SK4 FLT4 DT2", f"""SELECT window_start, window_start + {DAY} AS window_end, truth, estimate,
    round(abs(truth - estimate) / estimate, 6) AS relative_error, abs(truth - estimate) / estimate <= 0.25 AS within_limit
    FROM ({_WINDOW_TRUTH}) JOIN ({_WINDOW_ESTIMATES}) USING (window_start)""")
def fm_distinct_by_window(spark, folder):
    found = distinct.fm_distinct_by_window(table(spark, folder, "events"), "ts", "user_id", DAY, PANE, HASHES, GROUPS, HASH_BITS)
    return found.withColumn("relative_error", r6(F.col("relative_error")))


@query("FLT4", f"""SELECT window_start, truth, estimate FROM ({_WINDOW_TRUTH}) JOIN ({_WINDOW_ESTIMATES}) USING (window_start)
    WHERE abs(truth - estimate) / estimate <= 0.25""")
def fm_windows_within_limit(spark, folder):
    """Only the windows that pass the error gate."""
    events = table(spark, folder, "events")
    found = distinct.fm_distinct_by_window(events, "ts", "user_id", DAY, PANE, HASHES, GROUPS, HASH_BITS, keep_all=False)
    return found.select("window_start", "truth", "estimate")


#: Files of a slice, all read by one micro-batch.
FILES = 4


def _slice(df, ts, start, stop):
    """Rows from one stamp, if given, to before another."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if stop is not None:
        df = df.where(F.col(ts) < F.lit(stop).cast("timestamp_ntz"))
    return df


def _in_slices(df, ts, scratch, name, slices, form="parquet"):
    """Write rows as slices that a stream reads one after the other, in time order."""
    for i, (start, stop) in enumerate(zip(slices, slices[1:])):
        _slice(df, ts, start, stop).repartition(FILES).write.format(form).save(scratch.path(f"{name}/slice={i}"))
    return scratch.path(name)


SLICES = [None, "2024-01-11", "2024-01-21", None]


def _event_stream(spark, folder, scratch):
    """(stream, events): all events as JSON in three slices, and one late row that closes the last windows."""
    events = table(spark, folder, "events").select("event_id", "ts", "user_id")
    last = events.agg(
        F.max("event_id").alias("event_id"), (F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"), F.max("user_id").alias("user_id")
    )
    _in_slices(events.unionByName(last), "ts", scratch, "in", SLICES, "json")
    return json_stream(spark, scratch.path("in"), events.schema, FILES), events


@query("SRC8 STR1 STR2 STR3 STR4 SNK2", f"""SELECT window_start + {DAY} AS window_end, truth, estimate
    FROM ({_WINDOW_TRUTH}) JOIN ({_WINDOW_ESTIMATES}) USING (window_start)""")
def stream_window_estimates(spark, folder):
    """Events arrive in three slices and one late row that closes the last windows."""
    scratch = Scratch(spark, "window-stream")
    stream, _ = _event_stream(spark, folder, scratch)
    start_window_estimates(
        stream, "ts", "user_id", scratch.path("out"), scratch.path("checkpoint"), "1 day", "6 hours", "1 hour",
        HASHES, GROUPS, HASH_BITS, trigger={"availableNow": True}, state_partitions=spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    written = spark.read.schema(", ".join(f"`{c}` bigint" for c in sinks.WINDOW_HEADER)).csv(scratch.path("out"), header=True)
    # The folder read adds its batch number as a column.
    return written.select(*[F.col(h).alias(c) for h, c in zip(sinks.WINDOW_HEADER, ("window_end", "truth", "estimate"))])


def _sketched(store_sql: str) -> str:
    return f"SELECT window_start, truth, true AS within_bound{store_sql} FROM ({_WINDOW_TRUTH})"


@query("SK5 AGG11", _sketched(", true AS as_in_one_pass"))
def window_sketches(spark, folder):
    """Pane sketches of three runs, stored, reloaded, compacted and merged into windows, beside exact counts and sketches of one pass."""
    scratch = Scratch(spark, "sketch-store")
    events = table(spark, folder, "events").select("ts", "user_id")
    store = sketches.SketchStore(spark, scratch.path("runs"), "pane bigint")
    for i, (start, stop) in enumerate(zip(SLICES, SLICES[1:])):
        store.write(i, sketches.pane_sketches(_slice(events, "ts", start, stop), "ts", "user_id", PANE))
    kept = store.compact(scratch.path("compacted"))
    merged = sketches.windows_of_panes(kept.read(), DAY, PANE).select("window_start", sketches.estimated("sketch").alias("estimate"))
    starts = distinct.window_starts(distinct.pane_start(F.col("ts"), PANE), DAY, PANE)
    whole = sketches.sketch_values(events.select(F.explode(starts).alias("window_start"), "user_id"), "user_id", ["window_start"])
    whole = sketches.merge_sketches(whole, ["window_start"]).select("window_start", sketches.estimated("sketch").alias("whole"))
    truth = distinct.window_distinct(events, "ts", "user_id", DAY, PANE)
    found = sketches.coverage_report(merged, truth, ["window_start"]).join(whole, "window_start")
    return found.select("window_start", "truth", "within_bound", sketches.same_answer(F.col("estimate"), F.col("whole")).alias("as_in_one_pass"))


@query("STR3 SK5", _sketched(""))
def stream_window_sketches(spark, folder):
    """The same windows from a stream whose state holds sketches only, beside exact counts of the batch."""
    scratch = Scratch(spark, "sketch-stream")
    stream, events = _event_stream(spark, folder, scratch)
    store = sketches.SketchStore(spark, scratch.path("out"), "window_start bigint")
    start_window_sketches(
        stream, "ts", "user_id", store, scratch.path("checkpoint"), "1 day", "6 hours", "1 hour",
        trigger={"availableNow": True}, state_partitions=spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    found = store.read().select("window_start", sketches.estimated("sketch").alias("estimate"))
    truth = distinct.window_distinct(events, "ts", "user_id", DAY, PANE)
    return sketches.coverage_report(found, truth, ["window_start"]).select("window_start", "truth", "within_bound")


_TAGS = "(SELECT unnest(regexp_extract_all(text, '#([a-zA-Z0-9_]+)', 1)) AS tag FROM {messages})"
_TRENDING = """SELECT tag, cnt FROM (SELECT tag, cnt, dense_rank() OVER (ORDER BY cnt DESC) AS r FROM
    (SELECT tag, count(*) AS cnt FROM {tags} GROUP BY tag)) WHERE r <= 3"""
_SAMPLE = "(SELECT * FROM {messages} ORDER BY {rank}, event_id LIMIT 100)"


@query("SA1", f"SELECT event_id, text FROM {_SAMPLE.format(messages=MESSAGES, rank=rank_sql('event_id'))}")
def fixed_sample(spark, folder):
    return sampling.fixed_sample(inputs.messages(spark, folder).select("event_id", "text"), "event_id")


@query("AGG14", f"SELECT tag, count(*) AS cnt FROM {_TAGS.format(messages=MESSAGES)} GROUP BY tag")
def tag_frequency(spark, folder):
    return sampling.tag_frequency(inputs.messages(spark, folder))


@query("RNK1", _TRENDING.format(tags=_TAGS.format(messages=MESSAGES)))
def top_counts(spark, folder):
    return with_top_counts(sampling.tag_frequency(inputs.messages(spark, folder)))


@query("SA2 RNK1 RNK2", _TRENDING.format(tags=_TAGS.format(messages=_SAMPLE.format(messages=MESSAGES, rank=rank_sql("event_id")))))
def trending_tags(spark, folder):
    return sampling.trending_tags(sampling.fixed_sample(inputs.messages(spark, folder), "event_id"))


def _slice_sql(batch_id: int, stop: str | None) -> str:
    seen = MESSAGES if stop is None else f"(SELECT * FROM {MESSAGES} WHERE ts < TIMESTAMP '{stop}')"
    sample = _SAMPLE.format(messages=seen, rank=rank_sql("event_id"))
    return f"SELECT {batch_id} AS batch_id, (SELECT count(*) FROM {seen}) AS n_seen, tag, cnt FROM ({_TRENDING.format(tags=_TAGS.format(messages=sample))})"


def _message_stream(spark, folder, scratch):
    rows = inputs.messages(spark, folder).withColumnRenamed("event_id", "id")
    return table_stream(spark, _in_slices(rows, "ts", scratch, "in", SLICES), rows.schema, FILES).drop("ts")


_TRENDING_BY_BATCH = " UNION ALL ".join(_slice_sql(i, stop) for i, stop in enumerate(SLICES[1:]))


@query("STR5 STR7", _TRENDING_BY_BATCH)
def stream_trending_stateful(spark, folder):
    """The sample as keyed state of the stream."""
    scratch = Scratch(spark, "stateful-stream")
    stream = _message_stream(spark, folder, scratch)
    start_stateful_trending(
        stream, scratch.path("out"), scratch.path("checkpoint"), shards=2 * spark.sparkContext.defaultParallelism, trigger={"availableNow": True}
    ).awaitTermination()
    return reports(spark, scratch.path("out"))


@query("STR5 STR7 SNK3", _TRENDING_BY_BATCH)
def stream_trending(spark, folder):
    scratch = Scratch(spark, "trending-stream")
    stream = _message_stream(spark, folder, scratch)
    start_trending(stream, scratch.path("out"), scratch.path("checkpoint"), trigger={"availableNow": True}).awaitTermination()
    return reports(spark, scratch.path("out"))
