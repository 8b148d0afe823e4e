"""Joins, sets, sorts and summaries in general, over the relational tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from threshmill.operators import guards, lineage
from threshmill.plans.base import query, read


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')")
def singleton_antijoin(spark, sf):
    urgent = read(spark, sf, "orders").filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'")
    return read(spark, sf, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def usable_semijoin(spark, sf):
    done = read(spark, sf, "orders").filter("o_orderstatus = 'F'")
    return read(spark, sf, "customer").join(done, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_mktsegment")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def work_list_resume(spark, sf):
    done = read(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return read(spark, sf, "orders").select("o_orderkey").join(done, "o_orderkey", "left_anti")


@query("SELECT n_name, r_name, count(c_custkey) AS customers FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2")
def left_join_counts(spark, sf):
    n = read(spark, sf, "nation").join(read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.join(read(spark, sf, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name", "r_name").agg(F.count("c_custkey").alias("customers"))


@query("WITH p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1) SELECT c_custkey, o_orderkey AS first_order FROM customer LEFT JOIN p ON o_custkey = c_custkey")
def join_deduplicated_right(spark, sf):
    first = read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_order"))
    return read(spark, sf, "customer").select("c_custkey").join(first, "c_custkey", "left")


@query("""WITH k AS (SELECT o_custkey AS k, string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority) AS keys FROM orders GROUP BY 1), x AS (SELECT k, trim(unnest(string_split(keys, '|'))) AS p FROM k) SELECT p AS priority, count(*) AS customers FROM x GROUP BY 1""")
def key_list_explode_join(spark, sf):
    from threshmill.functions import text as T

    k = read(spark, sf, "orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), " | ").alias("keys"))
    return k.select(F.explode(T.split_keys("keys")).alias("priority")).groupBy("priority").agg(F.count("*").alias("customers"))


@query("""WITH s AS (SELECT DISTINCT l_suppkey AS suppkey, l_partkey % 50 AS k FROM lineitem), r AS (SELECT DISTINCT p_size AS size, p_partkey % 50 AS k FROM part)
SELECT suppkey, size, count(*) AS shared FROM s JOIN r USING (k) GROUP BY 1, 2""")
def array_overlap_join(spark, sf):
    """Arrays that overlap, by the elements that both hold, so no theta join is needed."""
    s = read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("suppkey"), (F.col("l_partkey") % 50).alias("k")).distinct()
    r = read(spark, sf, "part").select(F.col("p_size").alias("size"), (F.col("p_partkey") % 50).alias("k")).distinct()
    return s.join(r, "k").groupBy("suppkey", "size").agg(F.count("*").alias("shared"))


@query("""WITH c AS (SELECT p_partkey AS chunk, p_partkey * 3 AS lo, p_partkey * 3 + p_size % 5 AS hi FROM part) SELECT chunk, o_orderkey AS paragraph FROM c JOIN orders ON o_orderkey BETWEEN lo AND hi""")
def range_join(spark, sf):
    """Points in ranges by bins as wide as ranges may be: a range meets its two bins by equi-join."""
    width = 8
    c = read(spark, sf, "part").select(F.col("p_partkey").alias("chunk"), (F.col("p_partkey") * 3).alias("lo"), (F.col("p_partkey") * 3 + F.col("p_size") % 5).alias("hi"))
    c = c.withColumn("bin", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("paragraph")).withColumn("bin", F.floor(F.col("paragraph") / width))
    return c.join(o, "bin").filter("paragraph between lo and hi").select("chunk", "paragraph")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS discount FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def named_aggregates(spark, sf):
    l = read(spark, sf, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("discount"))


@query("SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT NULL, count(*) FROM customer WHERE c_acctbal < 0")
def value_counts_with_null(spark, sf):
    c = read(spark, sf, "customer")
    return c.select(F.col("c_mktsegment").alias("value")).unionByName(c.filter("c_acctbal < 0").select(F.lit(None).cast("string").alias("value"))).groupBy("value").agg(F.count("*").alias("n"))


@query("SELECT 'orders' AS metric, count(*)::DOUBLE AS value FROM orders UNION ALL SELECT 'customers', count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'largest', max(o_totalprice) FROM orders")
def metric_summary(spark, sf):
    one = read(spark, sf, "orders").agg(F.count("*").cast("double").alias("orders"), F.countDistinct("o_custkey").cast("double").alias("customers"), F.max("o_totalprice").alias("largest"))
    return one.unpivot([], ["orders", "customers", "largest"], "metric", "value")


@query("SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey)::INT AS place FROM orders")
def custom_rank_sort(spark, sf):
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "2-HIGH", 1).otherwise(2)
    order = Window.partitionBy("o_custkey").orderBy(rank, F.desc("o_totalprice"), "o_orderkey")
    return read(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.row_number().over(order).alias("place"))


@query("SELECT o_custkey, o_orderkey, (r - 1) // 3 AS step FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE (r - 1) % 3 = 0")
def evenly_spaced_sample(spark, sf):
    r = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    rows = read(spark, sf, "orders").withColumn("r", r - 1).filter("r % 3 = 0")
    return rows.select("o_custkey", "o_orderkey", F.floor(F.col("r") / 3).alias("step"))


@query("SELECT key, part FROM (SELECT c_custkey AS key, 'customer' AS part FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier) WHERE key IN (SELECT c_custkey FROM customer INTERSECT SELECT s_suppkey FROM supplier)")
def tagged_union_intersection(spark, sf):
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"))
    both = c.withColumn("part", F.lit("customer")).unionByName(s.withColumn("part", F.lit("supplier")))
    return both.join(c.intersect(s), "key", "left_semi")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM (SELECT l_orderkey, l_linenumber FROM lineitem UNION ALL SELECT l_orderkey, 1 FROM lineitem WHERE l_linenumber = 2) GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_key_guard(spark, sf):
    l = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return l.unionByName(l.filter("l_linenumber = 2").withColumn("l_linenumber", F.lit(1))).groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'reused' WHEN o_orderpriority = '1-URGENT' THEN 'enrich' ELSE 'extract' END AS layer FROM orders")
def coverage_partition(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return guards.coverage_partition(o.select("o_orderkey"), "o_orderkey", reused=o.filter("o_orderstatus = 'F'"), enrich=o.filter("o_orderpriority = '1-URGENT'"))


_MERGED = "e AS (SELECT master_id AS parent, client_id AS child FROM clients WHERE master_id <> client_id), w AS (SELECT client_id AS root, client_id AS node, []::BIGINT[] AS path FROM clients UNION ALL SELECT root, child, list_append(path, child) FROM w JOIN e ON node = parent WHERE child <> root AND NOT list_contains(path, child)), c AS (SELECT root, node, min(path) AS path FROM w GROUP BY ALL)"


def merged_clients(spark, sf):
    clients = read(spark, sf, "clients").select("client_id", "master_id", "segment", "city")
    merges = clients.filter("master_id <> client_id").select(F.col("master_id").alias("parent"), F.col("client_id").alias("child"), F.col("client_id").alias("place"))
    return clients, lineage.merge_closure(clients, merges, "client_id")


@query(f"WITH RECURSIVE {_MERGED}, y AS (SELECT DISTINCT root FROM w JOIN e ON node = parent AND child = root) SELECT root, node, len(path)::INT AS depth, root IN (SELECT root FROM y) AS in_cycle FROM c")
def merge_lineage(spark, sf):
    """Each client with all that were merged into it, directly or not."""
    return merged_clients(spark, sf)[1].select("root", "node", "depth", "in_cycle")


@query(f"WITH RECURSIVE {_MERGED}, f AS (SELECT root, segment, k.client_id, city, row_number() OVER (PARTITION BY root, segment ORDER BY path, k.client_id) AS r FROM c JOIN clients k ON k.client_id = node) SELECT root, segment, client_id, city FROM f WHERE r = 1")
def inherited_segments(spark, sf):
    """For each client and segment, the first client along the merges that stands for it."""
    clients, closure = merged_clients(spark, sf)
    return lineage.inherited_rows(closure, clients, "client_id", "segment", "client_id").select("root", "segment", "client_id", "city")
