"""Texts of a key joined as they come: order, nulls, keys across batches; whole issues are not aggregated."""

from pyspark.sql import functions as F

from scriptorium.operators.serialize import joined_rows
from scriptorium.plans.catalogue import QUERIES


def test_joined_rows(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    rows = [(k, i, None if i % 5 == 0 else f"é{k}{i};") for k in ("a", None, "b", "") for i in range(23)] + [("none", 0, None)]
    df = spark.createDataFrame(rows, "k string, i int, x string").repartition(3, "k").sortWithinPartitions("k", "i")
    for run in (1, 4, 1000):
        got = {r.k: r.x for r in joined_rows(df, "k", "x", run).collect()}
        assert got == {k: "".join(x or "" for q, _, x in rows if q == k) for k in ("a", None, "b", "", "none")}
    assert joined_rows(df.where("false"), "k", "x").count() == 0
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_issues_are_not_aggregated(spark):
    """Every issue was a list of its pieces, their join and the elements around it, each a copy, in a task's heap."""
    plan = QUERIES["snk3_native_issues"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Aggregate" not in plan.split("MapInArrow")[0]
    kinds = QUERIES["snk3_native_issues"](spark, "/root/testdata/sf0.001").select(F.length("xml").alias("n"))
    assert kinds.where("n is null").count() == 0
