"""Queries over the tables: scans, projections, joins, aggregations, windows, sorts, sets and upserts."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from scriptorium.operators import relational as ops
from scriptorium.sources.shared import shared_dir
from scriptorium.plans.catalogue import case, query, values

# Joins.


@query("join1_nested_children", """
SELECT o_orderkey, o_custkey, list([CAST(l_linenumber AS BIGINT), l_partkey] ORDER BY l_linenumber, l_partkey) AS lines
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_custkey
""")
def _(t, spark):
    lines = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    out = ops.nested(t("orders").select("o_orderkey", "o_custkey"), lines, "o_orderkey", ["l_linenumber", "l_partkey"], [], "lines").where("lines is not null")
    return out.withColumn("lines", F.transform("lines", lambda x: F.array(x["l_linenumber"].cast("long"), x["l_partkey"])))


@query("join2_distinct_three_way", """
SELECT DISTINCT c_custkey, s_nationkey FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
JOIN supplier ON s_suppkey = l_suppkey WHERE c_mktsegment = 'BUILDING'
""")
def _(t, spark):
    c = t("customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    o = t("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    li = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("s_suppkey"))
    return c.join(o, "c_custkey").join(li, "o_orderkey").join(t("supplier").select("s_suppkey", "s_nationkey"), "s_suppkey").select("c_custkey", "s_nationkey").distinct()


@query("join3_left_outer", "SELECT c_custkey, o_orderkey, o_orderstatus FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
def _(t, spark):
    o = t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    return t("customer").select("c_custkey").join(o, "c_custkey", "left")


@query("join4_inner_limit", """
SELECT o_orderkey, l_linenumber, p_name FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
ORDER BY o_orderkey, l_linenumber, p_name LIMIT 100
""")
def _(t, spark):
    li = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    out = t("orders").select("o_orderkey").join(li, "o_orderkey").join(t("part").select("p_partkey", "p_name"), "p_partkey")
    return out.select("o_orderkey", "l_linenumber", "p_name").orderBy("o_orderkey", "l_linenumber", "p_name").limit(100)


@query("join5_candidate_pairs", """
SELECT a.c_nationkey, a.c_mktsegment, a.c_custkey AS c_custkey_1, b.c_custkey AS c_custkey_2 FROM customer a JOIN customer b
ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND a.c_custkey < b.c_custkey AND a.c_name <> b.c_name
""")
def _(t, spark):
    return ops.candidate_pairs(t("customer"), ["c_nationkey", "c_mktsegment"], "c_custkey", "c_name")


_PREFIX = [("src1", "one"), ("src", "other")]


@query("join6_first_prefix", """
SELECT doc_id, CASE WHEN starts_with(source, 'src1') THEN 'one' WHEN starts_with(source, 'src') THEN 'other' ELSE 'none' END AS region FROM documents
""")
def _(t, spark):
    d = t("documents")
    return d.select("doc_id", ops.first_prefix(d, F.col("source"), _PREFIX, "none").alias("region"))


@query("join7_co_occurrence", """
SELECT DISTINCT a.l_partkey AS a, b.l_partkey AS b FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey <> b.l_partkey
""")
def _(t, spark):
    return ops.co_occurring(t("lineitem"), "l_orderkey", "l_partkey")


@query("set1_shared_neighbours", """
WITH e AS (SELECT DISTINCT l_orderkey AS g, l_partkey AS m FROM lineitem),
n AS (SELECT DISTINCT x.m AS a, y.m AS b FROM e x JOIN e y ON x.g = y.g AND x.m <> y.m),
p AS (SELECT a, b FROM n WHERE a < b)
SELECT p.a, p.b, count(y.b) AS shared FROM p LEFT JOIN n x ON x.a = p.a LEFT JOIN n y ON y.a = p.b AND y.b = x.b GROUP BY p.a, p.b
""")
def _(t, spark):
    edges = t("lineitem").selectExpr("l_orderkey g", "l_partkey m")
    return ops.shared_neighbours(edges, "g", "m")


@query("join12_positional", """
WITH s AS (SELECT s_nationkey AS k, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS pos FROM supplier),
c AS (SELECT c_nationkey AS k, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS pos FROM customer)
SELECT coalesce(s.k, c.k) AS k, coalesce(s.pos, c.pos) AS pos, s_suppkey, c_custkey FROM s FULL JOIN c ON s.k = c.k AND s.pos = c.pos
""")
def _(t, spark):
    s, c = t("supplier").selectExpr("s_nationkey k", "s_suppkey"), t("customer").selectExpr("c_nationkey k", "c_custkey")
    return ops.positional_join(s, c, "s_suppkey", "c_custkey", "k")


@query("join16_exclusions", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def _(t, spark):
    return t("documents").select("doc_id", "source").join(t("labels").select("doc_id"), "doc_id", "left_anti")


@query("join17_semi_delete", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def _(t, spark):
    gone = t("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return t("lineitem").select("l_orderkey", "l_linenumber").join(gone, "l_orderkey", "left_anti")


@query("join18_reconcile", """
WITH e AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), o AS (SELECT c_custkey AS k, CAST(c_nationkey AS BIGINT) AS n FROM customer)
SELECT coalesce(e.k, o.k) AS k, e.n AS expected, o.n AS observed, CASE WHEN e.n IS NULL THEN 'extra' WHEN o.n IS NULL THEN 'missing' WHEN o.n = e.n THEN 'ok'
WHEN o.n = 0 THEN 'empty' WHEN o.n < e.n THEN 'partial' ELSE 'duplicate' END AS status FROM e FULL JOIN o ON e.k = o.k
""")
def _(t, spark):
    e = t("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return ops.reconciled(e, t("customer").selectExpr("c_custkey k", "cast(c_nationkey as bigint) n"), "k")


# Aggregations.


@query("agg1_top_customers", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 20")
def _(t, spark):
    return t("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "o_custkey").limit(20)


@query("agg2_count_per_source", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def _(t, spark):
    return t("documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("agg3_version_summary", """
SELECT o_orderpriority, count(*) AS n, min(o_orderdate) AS first, max(o_orderdate) AS last, count(*) FILTER (o_orderstatus = 'O') AS open FROM orders GROUP BY 1
""")
def _(t, spark):
    return t("orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"), F.count_if(F.col("o_orderstatus") == "O").alias("open")
    )


@query("agg4_correlated_counts", "SELECT n_nationkey, n_name, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers FROM nation")
def _(t, spark):
    counts = t("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    return t("nation").select("n_nationkey", "n_name").join(counts, "n_nationkey", "left").na.fill(0, ["customers"])


@query("agg5_group_order", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand")
def _(t, spark):
    return t("part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "p_brand")


@query("agg6_conditional_with_total", """
SELECT coalesce(source, 'TOTAL') AS source, count(*) AS n, count(*) FILTER (lang = 'en') AS english, count(*) FILTER (n_chars > 2000) AS long
FROM documents GROUP BY ROLLUP (source)
""")
def _(t, spark):
    return t("documents").rollup("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("lang") == "en").alias("english"), F.count_if(F.col("n_chars") > 2000).alias("long")).withColumn(
        "source", F.coalesce("source", F.lit("TOTAL"))
    )


@query("agg7_percent", """
SELECT source, CASE WHEN count(*) = 0 THEN 0 ELSE 100.0::DOUBLE * count(*) FILTER (lang = 'en') / count(*) END AS pct FROM documents GROUP BY source
""")
def _(t, spark):
    return t("documents").groupBy("source").agg(F.count_if(F.col("lang") == "en").alias("a"), F.count(F.lit(1)).alias("b")).select("source", F.when(F.col("b") == 0, 0.0).otherwise(F.lit(100.0) * F.col("a") / F.col("b")).alias("pct"))


@query("agg8_distinct", "SELECT source, count(DISTINCT lang) AS langs FROM documents GROUP BY source")
def _(t, spark):
    return t("documents").groupBy("source").agg(F.countDistinct("lang").alias("langs"))


@query("agg9_term_contexts", """
WITH w AS (SELECT p_partkey, p_name, unnest(string_split(p_name, ' ')) AS word FROM part),
c AS (SELECT DISTINCT word, p_name FROM w),
r AS (SELECT word, p_name, row_number() OVER (PARTITION BY word ORDER BY p_name) AS rn FROM c)
SELECT word, (SELECT count(*) FROM w WHERE w.word = r.word) AS n, list(p_name ORDER BY p_name) AS contexts FROM r WHERE rn <= 3 GROUP BY word HAVING n >= 3
""")
def _(t, spark):
    w = t("part").select("p_name", F.explode(F.split("p_name", " ")).alias("word"))
    counts = w.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
    top = Window.partitionBy("word").orderBy("p_name")
    contexts = w.distinct().withColumn("rn", F.row_number().over(top)).where("rn <= 3").groupBy("word").agg(F.sort_array(F.collect_list("p_name")).alias("contexts"))
    return counts.join(contexts, "word")


@query("agg11_buckets_and_rest", """
SELECT source, count(*) FILTER (starts_with(lang, 'e')) AS e, count(*) FILTER (lang = 'de') AS de, count(*) - count(*) FILTER (starts_with(lang, 'e')) - count(*) FILTER (lang = 'de') AS rest
FROM documents GROUP BY source
""")
def _(t, spark):
    return t("documents").groupBy("source").agg(F.count_if(F.col("lang").startswith("e")).alias("e"), F.count_if(F.col("lang") == "de").alias("de"), F.count(F.lit(1)).alias("n")).select("source", "e", "de", F.expr("n - e - de").alias("rest"))


@query("agg14_coverage", """
SELECT lang, count(*) AS n, count(quality) AS labelled, count(*) FILTER (toxic = 1) AS toxic FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang
""")
def _(t, spark):
    return t("documents").join(t("labels"), "doc_id", "left").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count("quality").alias("labelled"), F.count_if(F.col("toxic") == 1).alias("toxic"))


@query("agg15_sizes", "SELECT source, CAST(sum(n_chars) AS BIGINT) AS total, max(n_chars) AS largest FROM documents GROUP BY source")
def _(t, spark):
    return t("documents").groupBy("source").agg(F.sum("n_chars").alias("total"), F.max("n_chars").alias("largest"))


@query("agg16_first_known", """
SELECT user_id, first(value ORDER BY ts, event_id) AS value FROM events WHERE value IS NOT NULL GROUP BY user_id
""")
def _(t, spark):
    return t("events").where("value is not null").groupBy("user_id").agg(F.min_by("value", F.struct("ts", "event_id")).alias("value"))


@query("agg17_taxonomy", "SELECT word, count(DISTINCT p_partkey) AS n FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS word FROM part) GROUP BY word")
def _(t, spark):
    return t("part").select("p_partkey", F.explode(F.split("p_type", " ")).alias("word")).groupBy("word").agg(F.countDistinct("p_partkey").alias("n"))


@query("agg18_before_after", """
WITH l AS (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
d AS (SELECT source, doc_id, count(*) AS before, count(DISTINCT line) AS after FROM l GROUP BY ALL)
SELECT source, CAST(sum(before) AS BIGINT) AS before, CAST(sum(after) AS BIGINT) AS after, CAST(sum(before - after) AS BIGINT) AS removed FROM d GROUP BY source HAVING sum(before - after) <> 0
""")
def _(t, spark):
    lines = F.split("text", "\n")
    d = t("documents").select("source", F.size(lines).alias("b"), F.size(F.array_distinct(lines)).alias("a"))
    return d.groupBy("source").agg(F.sum("b").alias("before"), F.sum("a").alias("after"), F.sum(F.col("b") - F.col("a")).alias("removed")).where("removed <> 0")


# Windows and ordered loops.


@query("win1_page_intervals", """
SELECT conv_id, turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - 1, 30) AS end_page FROM conversations
""")
def _(t, spark):
    return ops.end_pages(t("conversations").select("conv_id", "turn"), "conv_id", "turn", F.lit(30))


@query("win4_lines_to_entries", """
WITH p AS (SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) AS pos, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, pos, trim(ls[pos], ' ') AS line FROM p),
m AS (SELECT *, CASE WHEN line <> '' AND (regexp_matches(line, '^[A-Z]') OR coalesce(lag(line) OVER w, '') = '') THEN 1 ELSE 0 END AS begins FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
g AS (SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY pos) AS no FROM m)
SELECT doc_id, CAST(no AS BIGINT) AS entry_no, string_agg(line, ' ' ORDER BY pos) AS entry FROM g WHERE line <> '' AND no > 0 GROUP BY doc_id, no HAVING length(string_agg(line, ' ')) >= 15
""")
def _(t, spark):
    return ops.entries_from_lines(t("documents"), "doc_id", "text", "^[A-Z]")


@query("win5_latest_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
""")
def _(t, spark):
    return ops.latest_per_key(t("orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), "o_custkey", [F.desc("o_orderdate"), F.asc("o_orderkey")]).drop("o_orderdate")


@query("win6_running_number", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS seq FROM orders")
def _(t, spark):
    return t("orders").select("o_custkey", "o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("seq"))


@query("win7_heading_changes", """
SELECT user_id, event_id, event_type FROM events QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id)
""")
def _(t, spark):
    return ops.changed_headings(t("events").select("user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"], "event_type").drop("ts")


@query("win8_nulls_last_then_newest", """
SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) ORDER BY coalesce(quality, 9), doc_id DESC LIMIT 200
""")
def _(t, spark):
    return t("documents").select("doc_id").join(t("labels").select("doc_id", "quality"), "doc_id", "left").orderBy(F.coalesce("quality", F.lit(9)), F.desc("doc_id")).limit(200)


# Sorts, sets, sinks.


@query("sort1_multi_key", "SELECT n_regionkey, n_name FROM nation ORDER BY n_regionkey NULLS FIRST, n_name")
def _(t, spark):
    return t("nation").select("n_regionkey", "n_name").orderBy(F.asc_nulls_first("n_regionkey"), "n_name")


@query("sort3_best_above_threshold", """
SELECT l_orderkey, max_by(l_linenumber, l_extendedprice * 100 - l_linenumber) AS best FROM lineitem GROUP BY 1 HAVING max(l_extendedprice) > 20000
""")
def _(t, spark):
    return t("lineitem").groupBy("l_orderkey").agg(F.max_by("l_linenumber", F.col("l_extendedprice") * 100 - F.col("l_linenumber")).alias("best"), F.max("l_extendedprice").alias("m")).where("m > 20000").drop("m")


@query("sort4_version_preference", """
SELECT c_nationkey, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE c_mktsegment WHEN 'MACHINERY' THEN 0 WHEN 'BUILDING' THEN 1 ELSE 2 END, c_custkey) = 1
""")
def _(t, spark):
    rank = F.when(F.col("c_mktsegment") == "MACHINERY", 0).when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(2)
    return ops.latest_per_key(t("customer"), "c_nationkey", [rank, F.col("c_custkey")]).select("c_nationkey", "c_custkey")


@query("sort5_candidate_cap", """
SELECT o_custkey, list_slice(list(o_orderkey ORDER BY o_orderkey), 1, 5) AS first_five FROM orders GROUP BY o_custkey
""")
def _(t, spark):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    top = t("orders").withColumn("rn", F.row_number().over(w)).where("rn <= 5")
    return top.groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("first_five"))


@query("set2_difference", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def _(t, spark):
    return t("orders").select("o_orderkey").subtract(t("lineitem").where("l_returnflag = 'R'").selectExpr("l_orderkey o_orderkey"))


@query("set6_union_of_buckets", "SELECT doc_id FROM labels WHERE quality = 0 UNION SELECT doc_id FROM labels WHERE toxic = 1")
def _(t, spark):
    return t("labels").where("quality = 0").select("doc_id").unionByName(t("labels").where("toxic = 1").select("doc_id")).distinct()


@query("snk11_batches", """
SELECT o_custkey, o_orderkey, CAST(ceil(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) / 5.0) AS BIGINT) AS batch FROM orders
""")
def _(t, spark):
    return ops.batches(t("orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", 5)


@query("snk1_nested_json", """
WITH l AS (SELECT l_orderkey, list({'n': l_linenumber, 'part': l_partkey} ORDER BY l_linenumber, l_partkey) AS lines FROM lineitem GROUP BY 1)
SELECT o_orderkey, to_json({'order': o_orderkey, 'status': o_orderstatus, 'lines': lines}) AS doc FROM orders JOIN l ON o_orderkey = l_orderkey
""")
def _(t, spark):
    lines = t("lineitem").selectExpr("l_orderkey o_orderkey", "l_linenumber n", "l_partkey part")
    o = ops.nested(t("orders").select("o_orderkey", "o_orderstatus"), lines, "o_orderkey", ["n", "part"], [], "lines").where("lines is not null")
    return o.select("o_orderkey", F.to_json(F.struct(F.col("o_orderkey").alias("order"), F.col("o_orderstatus").alias("status"), "lines")).alias("doc"))


# Upserts.


def _reloaded(t, spark):
    """Orders in folders by a digit of their customer, of which one is loaded anew without the orders of every third customer."""
    old = t("orders").select("o_orderkey", "o_custkey", "o_totalprice", (F.col("o_custkey") % 10).alias("slug"))
    path = f"{shared_dir(spark)}/orders-{uuid.uuid4().hex}"
    old.write.partitionBy("slug").parquet(path)
    return ops.replaced_partitions(path, old.where("slug = 3 and o_custkey % 3 <> 0").withColumn("o_totalprice", F.lit(0.0)), "slug")


@query("dml2_replace_partitions", """
SELECT o_orderkey, o_custkey % 10 AS slug, CASE WHEN o_custkey % 10 = 3 THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_custkey % 10 <> 3 OR o_custkey % 3 <> 0
""")
def _(t, spark):
    """One folder of the orders loaded anew; the others stay as they are."""
    return _reloaded(t, spark).select("o_orderkey", F.col("slug").cast("long").alias("slug"), "o_totalprice")


@query("dml2_orphans", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 10 <> 3 OR o_custkey % 3 <> 0)")
def _(t, spark):
    """Customers to whom no order leads after that."""
    return ops.orphans(t("customer").select("c_custkey"), _reloaded(t, spark), "c_custkey", "o_custkey")


@query("dml3_last_wins", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def _(t, spark):
    return ops.latest_per_key(t("events").select("user_id", "event_id", "event_type"), "user_id", [F.desc("event_id")])


@query("dml4_first_wins", """
WITH o AS (SELECT user_id, event_id FROM events WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1),
n AS (SELECT user_id, event_id FROM events WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)
SELECT * FROM o UNION ALL SELECT * FROM n WHERE user_id NOT IN (SELECT user_id FROM o)
""")
def _(t, spark):
    e = t("events").select("user_id", "event_id", "event_type")
    old = ops.latest_per_key(e.where("event_type = 'click'"), "user_id", [F.asc("event_id")]).drop("event_type")
    return ops.inserted(old, e.where("event_type = 'view'").drop("event_type"), "user_id", "event_id")


@query("dml5_get_or_create", "SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) AS id FROM (SELECT DISTINCT c_mktsegment FROM customer)")
def _(t, spark):
    return ops.numbered(t("customer").select("c_mktsegment").distinct(), ["c_mktsegment"], "id")


_OLD = [(1, "", "x"), (2, "kept", None), (3, None, "")]
_NEW = [(1, "", "n1", 1), (1, "a", "n2", 2), (1, "b", "n3", 3), (3, "c", "", 1), (4, "d", "d", 1)]


@case("dml6_fill_if_empty", f"""
WITH n AS (SELECT * FROM {values(_NEW, 'k, email, code, seq')}),
f AS (SELECT k, first(email ORDER BY seq) FILTER (nullif(email, '') IS NOT NULL) AS email, first(code ORDER BY seq) FILTER (nullif(code, '') IS NOT NULL) AS code FROM n GROUP BY k)
SELECT o.k, coalesce(nullif(o.email, ''), f.email) AS email, coalesce(nullif(o.code, ''), f.code) AS code FROM (SELECT * FROM {values(_OLD, 'k, email, code')}) o LEFT JOIN f ON o.k = f.k
""")
def _(t, spark):
    old = spark.createDataFrame(_OLD, "k int, email string, code string")
    return ops.filled(old, spark.createDataFrame(_NEW, "k int, email string, code string, seq int"), "k", ["email", "code"], "seq")


@query("dml12_add_column", "SELECT r_regionkey, r_name, CAST(NULL AS VARCHAR) AS note FROM region")
def _(t, spark):
    return ops.with_missing_columns(t("region").select("r_regionkey", "r_name"), note="string", r_name="string")


_EDGES = [(3, 2), (2, 1), (9, 8), (8, 7), (7, 6), (6, 5), (12, 11), (12, 10)]
_LINKS = [("x", 2), ("x", 1), ("x", 3), ("y", 9), ("y", 4), ("z", 12), ("z", 11)]


@case("er6_merge_fixpoint", f"""
WITH RECURSIVE e AS (SELECT removed, min(keep) AS keep FROM {values(_EDGES, 'removed, keep')} GROUP BY removed),
r AS (SELECT removed, keep, 1 AS d FROM e UNION ALL SELECT r.removed, e.keep, d + 1 FROM r JOIN e ON r.keep = e.removed)
SELECT removed, arg_max(keep, d) AS keep FROM r GROUP BY removed
""")
def _(t, spark):
    return ops.merge_targets(spark.createDataFrame(_EDGES, "removed int, keep int"))


@case("er6_repointed_links", f"""
WITH RECURSIVE e AS (SELECT removed, min(keep) AS keep FROM {values(_EDGES, 'removed, keep')} GROUP BY removed),
r AS (SELECT removed, keep, 1 AS d FROM e UNION ALL SELECT r.removed, e.keep, d + 1 FROM r JOIN e ON r.keep = e.removed),
m AS (SELECT removed, arg_max(keep, d) AS keep FROM r GROUP BY removed)
SELECT DISTINCT g, coalesce(m.keep, a) AS a FROM (SELECT * FROM {values(_LINKS, 'g, a')}) l LEFT JOIN m ON l.a = m.removed
""")
def _(t, spark):
    targets = ops.merge_targets(spark.createDataFrame(_EDGES, "removed int, keep int"))
    return ops.merged_edges(spark.createDataFrame(_LINKS, "g string, a int"), targets, "g", "a")
