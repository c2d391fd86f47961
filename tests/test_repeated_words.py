"""Titles and files with the same words are scored once; members that meet are paired once, from the lesser."""

import time

from scriptorium.operators import relational as ops
from scriptorium.plans.registry import QUERIES


def test_equal_titles_are_scored_once(spark, tmp_path):
    """20,000 parts of two sets of words in one brand: before, every title met every file for each word."""
    name = "case id % 2 when 0 then 'large ring' else 'large bolt' end"
    spark.range(20_000).selectExpr("id p_partkey", f"{name} p_name", "'B' p_brand", "'STANDARD' p_type", "cast(1 as int) p_size", "1.0D + id p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    began = time.time()
    got = {r.id: (r.shared, r.file) for r in QUERIES["join14_table_token_overlap"](spark, str(tmp_path)).collect()}
    assert time.time() - began < 40
    words = lambda i: {"large", "ring" if i % 2 == 0 else "bolt", "standard", "sizeBB"} - (set() if i % 5 else {"sizeBB"})
    files = {f: words(f) - (set() if f % 2 == 0 else {"large"}) for f in range(0, 60, 3)}
    for i in (0, 1, 2, 9, 19_999):
        title = words(i) | {"sizeBB"}
        shared, file = min((-len(title & w), f) for f, w in files.items())
        assert got[i] == (-shared, file)
    assert len(got) == 20_000


def test_members_are_paired_once(spark):
    edges = [(g, m) for g in range(9) for m in range(g, g * 2 + 1)] + [(3, 4), (50, None), (51, 7)]
    df = spark.createDataFrame(edges, "g int, m int").repartition(3)
    want = sorted({(a, b) for g, a in edges for h, b in edges if g == h and a is not None and b is not None and a != b})
    found = ops.co_occurring(df, "g", "m")
    assert sorted(map(tuple, found.collect())) == want
    assert sorted(map(tuple, ops._linked(df, "g", "m").collect())) == [p for p in want if p[0] < p[1]]


def test_articles_are_taken_apart_over_many_tasks(spark, tmp_path):
    """Parts of one small file, whose papers each take long, are no one task's."""
    spark.range(40).selectExpr("id p_partkey", "'large ring' p_name", "'B' p_brand", "'STANDARD' p_type", "cast(1 as int) p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    got = QUERIES["ext16_assembled_articles"](spark, str(tmp_path))
    assert got.rdd.getNumPartitions() == 4 and got.count() == 40
