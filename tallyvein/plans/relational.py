"""Projections, joins, groups, ranks, sets and scalar functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyvein.functions import vectors
from tallyvein.functions.grouping import group_values
from tallyvein.functions.hashing import PRIME, hash_parameters, power_of_two, string_key
from tallyvein.functions.ranking import positions
from tallyvein.functions.text import epoch_seconds, list_length, quoted_list
from tallyvein.operators import graphs, ratings
from tallyvein.operators.distinct import value_zero_runs
from tallyvein.operators.membership import hash_rows as bloom_hash_rows
from tallyvein.operators.membership import WORD_BITS, filter_size, is_member
from tallyvein.operators.overlap import Rule, shared_pairs
from tallyvein.operators.sampling import fixed_sample, sample_size
from tallyvein.plans import inputs
from tallyvein.plans.inputs import r6
from tallyvein.plans.registry import CUSTOMER_MONTHS, HELD, RATINGS, key_sql, query, rank_sql
from tallyvein.sources.readers import table

HASH_BITS = 20
(_A, _B), = hash_parameters(1)


@query("PRJ2", "SELECT l_partkey AS item_id, o_custkey AS user_id FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def swap_keys(spark, folder):
    pairs = inputs.customer_parts(spark, folder).toDF("user_id", "item_id")
    return graphs.swap(pairs, "user_id", "item_id")


@query("PRJ5", """SELECT o_custkey AS src, l_partkey AS dst FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    UNION ALL SELECT l_partkey, o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def mirror_edges(spark, folder):
    return graphs.mirror(inputs.customer_parts(spark, folder).toDF("src", "dst"))


_HASH_PARAMETERS = hash_parameters(5)
_FILTER = f"(SELECT CAST(greatest({WORD_BITS}, ceil(count(DISTINCT c_name) * 5 / ln(2))) AS BIGINT) FROM customer)"
_HASH_ROWS = " UNION ALL ".join(
    f"SELECT c_name, {i} AS hash_no, ({key_sql('c_name', i)} * {a} + {b}) % {PRIME} % {_FILTER} AS position FROM customer"
    for i, (a, b) in enumerate(_HASH_PARAMETERS)
)


@query("PRJ3 H2 RN1", _HASH_ROWS)
def hash_rows(spark, folder):
    names = table(spark, folder, "customer")
    return bloom_hash_rows(names, "c_name", filter_size(names.select("c_name").distinct().count(), 5), _HASH_PARAMETERS)


@query("H1", f"SELECT c_name, {key_sql('c_name', 0)} AS key0, {key_sql('c_name', 1)} AS key1, {key_sql('c_name', 2)} AS key2 FROM customer")
def string_keys(spark, folder):
    return table(spark, folder, "customer").select("c_name", *[string_key("c_name", i).alias(f"key{i}") for i in range(3)])


@query("H3 H4", f"""SELECT *, CAST(CASE WHEN hash = 0 THEN 0 ELSE bit_count((hash & -hash) - 1) END AS INTEGER) AS zeros,
    CAST(1 AS BIGINT) << CAST(CASE WHEN hash = 0 THEN 0 ELSE bit_count((hash & -hash) - 1) END AS INTEGER) AS power
    FROM (SELECT DISTINCT user_id, ({key_sql('user_id')} * {_A} + {_B}) % {2**HASH_BITS} AS hash FROM events)""")
def trailing_zeros(spark, folder):
    runs = value_zero_runs(table(spark, folder, "events"), "user_id", HASH_BITS)
    return runs.withColumn("power", power_of_two(F.col("zeros")))


@query("AGG3", "SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY l_partkey")
def count_per_key(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("cnt"))


@query("AGG4", "SELECT DISTINCT p_name FROM part")
def distinct_names(spark, folder):
    return table(spark, folder, "part").select("p_name").distinct()


@query("AGG1", """SELECT l_suppkey, 0 AS piece, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS members
    FROM lineitem GROUP BY l_suppkey""")
def group_to_list(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    groups = group_values(lines, "l_suppkey", "l_partkey")
    return groups.withColumn("members", F.array_join(F.transform("members", lambda x: x.cast("string")), ","))


@query("AGG2", """SELECT l_suppkey, 0 AS piece, string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS members
    FROM (SELECT DISTINCT l_suppkey, l_partkey AS p FROM lineitem) GROUP BY l_suppkey""")
def group_to_set(spark, folder):
    groups = group_values(table(spark, folder, "lineitem"), "l_suppkey", "l_partkey", unique=True)
    return groups.withColumn("members", F.array_join(F.transform("members", lambda x: x.cast("string")), ","))


@query("AGG5 RC1", f"SELECT user_id, item_id, round(stars, 6) AS stars FROM {RATINGS}")
def mean_rating(spark, folder):
    return inputs.ratings(spark, folder).withColumn("stars", r6(F.col("stars")))


@query("AGG6", f"""WITH r AS {RATINGS} SELECT 'user' AS kind, user_id AS id, round(avg(stars), 6) AS mean FROM r GROUP BY user_id
    UNION ALL SELECT 'item', item_id, round(avg(stars), 6) FROM r GROUP BY item_id
    UNION ALL SELECT 'all', CAST(NULL AS BIGINT), round(avg(stars), 6) FROM r""")
def rating_means(spark, folder):
    rows = inputs.ratings(spark, folder)
    users = ratings.means(rows, "user_id", "mean").select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "mean")
    items = ratings.means(rows, "item_id", "mean").select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), "mean")
    overall = rows.agg(F.avg("stars").alias("mean")).select(F.lit("all").alias("kind"), F.lit(None).cast("bigint").alias("id"), "mean")
    return users.unionByName(items).unionByName(overall).withColumn("mean", r6(F.col("mean")))


@query("AGG7", "SELECT DISTINCT o_custkey AS user_id, l_partkey AS item_id FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def request_pairs(spark, folder):
    return ratings.request_pairs(inputs.customer_parts(spark, folder), "o_custkey", "l_partkey")


@query("J4", "SELECT c_custkey, c_name, c_name IN (SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING') AS present FROM customer")
def exact_membership(spark, folder):
    probes = table(spark, folder, "customer").select("c_custkey", "c_name")
    return is_member(probes, inputs.building_customers(spark, folder), "c_name")


_SAMPLE_SIZE = "(SELECT least(40, count(*) // 5) FROM customer)"


@query("RN2", f"SELECT c_custkey, c_name FROM customer ORDER BY {rank_sql('c_custkey')}, c_custkey LIMIT {_SAMPLE_SIZE}")
def random_sample(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return fixed_sample(customers, "c_custkey", sample_size(customers.count()))


@query("J5", f"""SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN
    (SELECT c_custkey FROM customer ORDER BY {rank_sql('c_custkey')}, c_custkey LIMIT {_SAMPLE_SIZE})""")
def unsampled_points(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    sample = fixed_sample(customers, "c_custkey", sample_size(customers.count()))
    return customers.join(sample, "c_custkey", "left_anti")


@query("J6 MP1", f"""WITH r AS {RATINGS}, t AS (SELECT * FROM r WHERE NOT ({HELD})),
    u AS (SELECT user_id, avg(stars) AS m FROM t GROUP BY 1), i AS (SELECT item_id, avg(stars) AS m FROM t GROUP BY 1)
    SELECT r.user_id, r.item_id, round(coalesce(u.m, (SELECT avg(stars) FROM t)), 6) AS user_mean,
        round(coalesce(i.m, (SELECT avg(stars) FROM t)), 6) AS item_mean
    FROM r LEFT JOIN u ON u.user_id = r.user_id LEFT JOIN i ON i.item_id = r.item_id""")
def averages_lookup(spark, folder):
    rows = inputs.ratings(spark, folder)
    held = ratings.holdout(["user_id", "item_id"])
    train = rows.where(~held)
    overall = F.lit(train.agg(F.avg("stars")).first()[0])
    out = rows.select("user_id", "item_id")
    out = ratings.with_lookup(out, ratings.means(train, "user_id", "user_mean"), "user_id", "user_mean", overall)
    out = ratings.with_lookup(out, ratings.means(train, "item_id", "item_mean"), "item_id", "item_mean", overall)
    return out.withColumns({c: r6(F.col(c)) for c in ("user_mean", "item_mean")})


@query("J7", f"""WITH r AS {RATINGS} SELECT o_custkey AS user_id, l_partkey AS item_id, l_orderkey, round(stars, 6) AS label
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN r ON r.user_id = o_custkey AND r.item_id = l_partkey""")
def label_lookup(spark, folder):
    lines = inputs.order_lines(spark, folder).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"), "l_orderkey"
    )
    labels = inputs.ratings(spark, folder).withColumnRenamed("stars", "label")
    return lines.join(labels, ["user_id", "item_id"]).withColumn("label", r6(F.col("label")))


@query("SET1 AR2", f"""WITH d AS {CUSTOMER_MONTHS}, s AS (SELECT u, count(*) AS n FROM d GROUP BY 1),
    p AS (SELECT a.u AS src, b.u AS dst, count(*) AS k FROM d a JOIN d b ON a.i = b.i AND a.u < b.u GROUP BY ALL HAVING count(*) >= 4)
    SELECT src, dst, k AS common, s.n + t.n - k AS either FROM p JOIN s ON s.u = src JOIN s t ON t.u = dst""")
def set_sizes(spark, folder):
    pairs = shared_pairs(inputs.customer_months(spark, folder), "o_custkey", "order_month", Rule(overlap=4))
    either = F.col("src_size") + F.col("dst_size") - F.col("overlap")
    return pairs.select("src", "dst", F.col("overlap").alias("common"), either.alias("either"))


@query("SET2", """SELECT o_custkey, count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) = 0 AS within
    FROM orders GROUP BY o_custkey""")
def subset_test(spark, folder):
    allowed = F.array(*[F.lit(p) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM")])
    sets = table(spark, folder, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("own"))
    return sets.select("o_custkey", (F.size(F.array_except("own", allowed)) == 0).alias("within"))


@query("SET3", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def set_difference(spark, folder):
    urgent = table(spark, folder, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, folder, "customer").select("c_custkey").join(urgent, "c_custkey", "left_anti")


@query("M1", """SELECT c_custkey, round(ln(abs(c_acctbal) + 1), 6) AS log, round(sqrt(abs(c_acctbal)), 6) AS root,
    round(pow(c_acctbal / 100, 2), 6) AS square, CAST(floor(c_acctbal) AS BIGINT) AS low, CAST(trunc(c_acctbal) AS BIGINT) AS whole FROM customer""")
def math_functions(spark, folder):
    x = F.col("c_acctbal")
    return table(spark, folder, "customer").select(
        "c_custkey", r6(F.log(F.abs(x) + 1)).alias("log"), r6(F.sqrt(F.abs(x))).alias("root"),
        r6(F.pow(x / 100, F.lit(2.0))).alias("square"), F.floor(x).alias("low"), x.cast("bigint").alias("whole"),
    )


@query("M7", "SELECT l_orderkey, l_linenumber, l_quantity, least(greatest(l_quantity / 8, 1), 5) AS stars FROM lineitem")
def clip_rating(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", ratings.clip(F.col("l_quantity") / 8).alias("stars"))


@query("ST4 RNK6", """SELECT o_custkey, string_agg('''' || p || '''', ', ' ORDER BY p) AS quoted
    FROM (SELECT DISTINCT o_custkey, o_orderpriority AS p FROM orders) GROUP BY o_custkey""")
def quoted_lists(spark, folder):
    sets = table(spark, folder, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("own"))
    return sets.select("o_custkey", quoted_list(F.array_sort("own")).alias("quoted"))


@query("DT1", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def epoch_of_stamps(spark, folder):
    return table(spark, folder, "events").select("event_id", epoch_seconds(F.col("ts")).alias("seconds"))


@query("AR1", "SELECT p_partkey, len(string_split(p_name, ' ')) AS words FROM part")
def list_lengths(spark, folder):
    return table(spark, folder, "part").select("p_partkey", list_length(F.col("p_name"), " ").cast("bigint").alias("words"))


@query("AR3", """SELECT vec_id, CAST(p - 1 AS INTEGER) AS dim, round(CAST(embedding[p] AS DOUBLE) + pow(CAST(embedding[p] AS DOUBLE), 2), 6) AS x
    FROM embeddings, range(1, 65) AS r(p)""")
def vector_add_powers(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    added = rows.select("vec_id", vectors.add_powers(F.col("v"), F.col("v"), 2).alias("v"))
    return added.select("vec_id", F.posexplode("v").alias("dim", "x")).withColumn("x", r6(F.col("x")))


@query("RNK6", "SELECT l_orderkey, l_linenumber, least(l_partkey, l_suppkey) AS low, greatest(l_partkey, l_suppkey) AS high FROM lineitem")
def sorted_pairs(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", F.least("l_partkey", "l_suppkey").alias("low"), F.greatest("l_partkey", "l_suppkey").alias("high"))


@query("RNK2", """SELECT p_partkey, n, row_number() OVER (ORDER BY n DESC, p_partkey) AS place FROM
    (SELECT l_partkey AS p_partkey, count(*) AS n FROM lineitem GROUP BY 1)""")
def ranked_keys(spark, folder):
    counts = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    return positions(counts, [F.desc("n"), F.asc("p_partkey")], name="place")
