from scriptorium.operators import relational as ops


def brute(rows):
    key = lambda r: r[:2]
    whole = [r for r in rows if None not in r]
    return sorted((*key(a), a[2], b[2]) for a in whole for b in whole if key(a) == key(b) and a[2] < b[2] and a[3] != b[3])


def test_runs_of_a_block_meet_once(spark, monkeypatch):
    """Blocks of one run and of many, keys that repeat, equal values, nulls anywhere."""
    monkeypatch.setattr(ops, "RUN", 7)
    rows = [(i % 2, "s", i // 3 * 2, f"n{i % 5}") for i in range(90)] + [(5, "t", i, "n") for i in range(4)]
    rows += [(5, "t", 2, "m"), (None, "s", 1, "n"), (1, None, 1, "n"), (1, "s", None, "n"), (1, "s", 7, None)]
    df = spark.createDataFrame(rows, "g long, m string, id long, name string")
    assert sorted(map(tuple, ops.candidate_pairs(df, ["g", "m"], "id", "name").collect())) == brute(rows)
    all_ = ops.candidate_pairs(df, ["g", "m"], "id").collect()
    assert sorted(map(tuple, all_)) == sorted((a[0], a[1], a[2], b[2]) for a in rows for b in rows if None not in (*a[:3], *b[:3]) and a[:2] == b[:2] and a[2] < b[2])


def test_one_file_and_one_block_are_spread_over_tasks(spark, monkeypatch, tmp_path):
    """Pairs were made in as many tasks as the input had splits."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(ops, "RUN", 20, raising=False)
    path = str(tmp_path / "rows")
    spark.range(400).selectExpr("1 g", "id", "cast(id as string) name").coalesce(1).write.parquet(path)
    pairs = ops.candidate_pairs(spark.read.parquet(path), ["g"], "id", "name")
    per = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per) == 400 * 399 // 2 and len(per) > 1 and max(per) < 0.6 * sum(per)
