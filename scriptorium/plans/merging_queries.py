"""The whole merge of authors over customers, orders and suppliers: one query for each table that it leaves."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from scriptorium.operators.merging import merge_authors
from scriptorium.plans.catalogue import query

# Customers of a nation and segment are one person from each number divisible by four on; each is merged into the one before.
_AUTHORS = """
SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'Ana' WHEN 1 THEN 'Ana Maria' WHEN 2 THEN 'Ána' ELSE 'Ana M.' END AS given, concat(c_mktsegment, '-', cast(c_nationkey AS {s})) AS family,
  CASE WHEN c_custkey % 3 = 0 THEN ' ' WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('p', cast(c_custkey AS {s}), '@example.org') END AS email,
  CASE WHEN c_custkey % 7 = 0 THEN concat('o', cast(c_custkey AS {s})) END AS orcid, c_nationkey AS n, c_mktsegment AS g FROM customer"""
_VARIANTS = """
SELECT s_suppkey * 5 AS author_id, concat('Var ', cast(s_suppkey AS {s})) AS given, 'V' AS family, 'old' AS source FROM supplier
UNION ALL SELECT min(id), given, family, 'older' FROM authors WHERE given = 'Ana' AND n < 3 GROUP BY given, family"""
_LINKS = "SELECT o_orderkey % 4000 AS article, o_custkey AS author_id, min(o_orderkey) AS seq, arg_min(o_orderpriority, o_orderkey) AS role FROM orders GROUP BY 1, 2"
_SQL = f"""
WITH authors AS ({_AUTHORS.format(s="varchar")}), variants AS ({_VARIANTS.format(s="varchar")}), links AS ({_LINKS}),
m AS (SELECT *, coalesce(max(CASE WHEN id % 4 = 0 THEN id END) OVER (PARTITION BY n, g ORDER BY id), min(id) OVER (PARTITION BY n, g)) AS keep FROM authors)
"""


def _merged(t, spark):
    authors = spark.sql(_AUTHORS.format(s="string").replace("FROM customer", "FROM {customer}"), customer=t("customer"))
    variants = spark.sql(_VARIANTS.format(s="string").replace("FROM supplier", "FROM {supplier}").replace("FROM authors", "FROM {authors}"), supplier=t("supplier"), authors=authors)
    links = t("orders").groupBy((F.col("o_orderkey") % 4000).alias("article"), F.col("o_custkey").alias("author_id")).agg(F.min("o_orderkey").alias("seq"), F.min_by("o_orderpriority", "o_orderkey").alias("role"))
    before = F.lag("id").over(Window.partitionBy("n", "g").orderBy("id"))
    pairs = authors.select(F.col("id").alias("removed"), before.alias("keep")).where("keep is not null and removed % 4 <> 0")
    return merge_authors(authors.drop("n", "g"), variants, links, pairs)


@query("er6_merged_authors", _SQL + """
SELECT keep AS id, first(given ORDER BY len(string_split(given, ' ')) DESC, length(given) DESC, given <> strip_accents(given) DESC, id) AS given, first(family ORDER BY id) AS family,
  first(email ORDER BY id) FILTER (trim(email) <> '') AS email, min(id) FILTER (trim(email) <> '') AS email_from, first(orcid ORDER BY id) FILTER (orcid <> '') AS orcid, min(id) FILTER (orcid <> '') AS orcid_from
FROM m GROUP BY keep
""")
def _(t, spark):
    """Who stays, with the fullest name and the first filled address and identifier of the group."""
    return _merged(t, spark).authors


@query("er6_merge_log", _SQL + "SELECT id AS removed, keep, given, family FROM m WHERE id <> keep")
def _(t, spark):
    """Every merge with the name that went."""
    return _merged(t, spark).log


@query("er6_merged_variants", _SQL + """
, v AS (SELECT coalesce(m.keep, author_id) AS author_id, v.given, v.family, source, 0 AS new, author_id AS src FROM variants v LEFT JOIN m ON m.id = v.author_id
  UNION ALL SELECT keep, given, family, 'dedup', 1, id FROM m WHERE id <> keep)
SELECT arg_min(author_id, (new, src)) AS author_id, given, family, arg_min(source, (new, src)) AS source FROM v GROUP BY given, family
""")
def _(t, spark):
    """Names by which people are known: each once, old ones first."""
    return _merged(t, spark).variants


@query("er6_merged_links", _SQL + """
SELECT article, keep AS author_id, arg_min(seq, (id <> keep, id)) AS seq, arg_min(role, (id <> keep, id)) AS role FROM links JOIN m ON m.id = links.author_id GROUP BY article, keep
""")
def _(t, spark):
    """Articles' links to those who stay, one for each."""
    return _merged(t, spark).links
