"""Common neighbours counted in cells: every triangle once, whatever its buckets; links that meet are not shuffled."""

import random

from scriptorium.operators import relational as ops


def test_triangles_are_counted_once(spark, monkeypatch):
    draws = random.Random(6)
    rows = [(g, m) for g in range(60) for m in draws.sample(range(40), draws.randint(1, 4))] + [(99, m) for m in range(100, 109)] + [(1, None), (None, 3)]
    near = {m: set() for _, m in rows}
    for g, m in rows:
        near[m] |= {x for h, x in rows if h == g and None not in (g, h, m, x) and x != m}
    want = sorted((a, b, len(near[a] & near[b])) for a in near if a is not None for b in near[a] if a < b)
    df = spark.createDataFrame(rows, "g int, m long")
    for cell, pack, wedges in ((4_000_000, 500, 1_000_000), (30, 3, 5), (5, 1, 1)):
        for name, value in (("CELL", cell), ("PACK", pack), ("WEDGES", wedges)):
            monkeypatch.setattr(ops, name, value, raising=False)
        assert sorted(map(tuple, ops.shared_neighbours(df, "g", "m").collect())) == want
    assert ops.shared_neighbours(df.where("false"), "g", "m").count() == 0


def test_pairs_of_links_are_not_shuffled(spark):
    """One member next to 1,500 others, who are in pairs: over a million pairs of links met by a join."""
    df = spark.range(1500).selectExpr("id g", "explode(array(-1L, id, id + 1)) m")
    plan = ops.shared_neighbours(df, "g", "m")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "FlatMapGroupsInArrow" in plan
