import os

import pytest

import __spark_entry__ as entry
from scriptorium.functions import names
from scriptorium.operators import relational
from scriptorium.operators.capitalize import capitalized
from scriptorium.plans.catalogue import CASES, ORACLES, QUERIES
from scriptorium.sources import nested, sinks
from scriptorium.streaming.events import windowed_counts

SF = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if hasattr(value, "asDict"):
        return tuple(sorted((k, plain(x)) for k, x in value.asDict().items()))
    if isinstance(value, dict):
        return tuple(sorted((k, plain(x)) for k, x in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    return value.replace(tzinfo=None) if hasattr(value, "tzinfo") and hasattr(value, "hour") else value


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    found = [c[0] for c in result.description]
    assert sorted(found) == cols
    want = [tuple(plain(r[found.index(c)]) for c in cols) for r in result.fetchall()]
    got = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def plain_jaro_winkler(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free, left = [True] * len(b), []
    for i, ch in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if free[j] and b[j] == ch), None)
        if j is not None:
            free[j] = False
            left.append(ch)
    if not left:
        return 0.0
    right = [ch for ch, f in zip(b, free) if not f]
    m, half = len(left), sum(x != y for x, y in zip(left, right)) / 2
    jaro = (m / len(a) + m / len(b) + (m - half) / m) / 3
    same = next((k for k, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return jaro + same * 0.1 * (1 - jaro)


def test_jaro_winkler(spark):
    import random

    from pyspark.sql import functions as F

    known = [("cappello", "capello", 0.9708), ("villela", "vilella", 0.9667), ("costa", "castro", 0.73), ("silva", "souza", 0.64), ("silva", "silveira", 0.925), ("", "x", 0.0)]
    assert all(plain_jaro_winkler(a, b) == pytest.approx(s, abs=5e-4) for a, b, s in known)
    draws = random.Random(2)
    word = lambda: "".join(draws.choice("abcé🙂") for _ in range(draws.randint(0, 9)))
    pairs = [(a, b) for a, b, _ in known] + [(word(), word()) for _ in range(600)] + [(None, "a"), ("", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = F.col("a"), F.col("b")
    for r in df.select("a", "b", names.jaro_winkler(a, b).alias("s"), names.jaro_winkler_bound(a, b).alias("most"), names.similar(a, b).alias("same")).collect():
        if r.a is None:
            assert r.s is None
            continue
        want = plain_jaro_winkler(r.a, r.b)
        assert r.s == pytest.approx(want, abs=1e-12), (r.a, r.b)
        assert r.a == r.b or r.most >= want - 1e-12
    assert "Python" not in df.select(names.jaro_winkler(a, b))._jdf.queryExecution().toString()


def test_capitalizing_twice_changes_nothing(spark):
    from pyspark.sql import functions as F

    rules = [("são paulo", "expressao", "São Paulo"), ("brasília", "lugar", "Brasília"), ("arquitetura", "area", "Arquitetura"), ("paulista", "toponimico", "Paulista"), ("bnh", "sigla", "BNH")]
    texts = ["O CASO DE SÃO PAULO", "Arquitetura moderna em Brasília", "Causa? Como e onde", "ARQUITETURA PAULISTA PAULISTA.", "Obra do bnh. outra (d'água)", "a/b-c x--y", "", " "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    once = capitalized(df, "t", F.lit(False), rules, "a")
    got = [(r.a, r.b) for r in capitalized(once, "a", F.lit(False), rules, "b").collect()]
    assert all(a == b for a, b in got)
    assert [a for a, _ in got][:5] == ["O caso de São Paulo", "Arquitetura moderna em Brasília", "Causa? Como e onde", "Arquitetura Paulista Paulista", "Obra do BNH. outra (d'água)"]


def test_merges_that_go_round_are_reported(spark):
    for edges in ([(1, 2), (2, 3), (3, 1), (5, 4)], [(1, 2), (2, 1)], [(1, 1)]):
        with pytest.raises(ValueError):
            relational.merge_targets(spark.createDataFrame(edges, "removed int, keep int"))
    long = spark.createDataFrame([(i + 1, i) for i in range(70)], "removed int, keep int")
    assert {r.keep for r in relational.merge_targets(long).collect()} == {0}


def test_clean_lists_reach_a_fixpoint(spark):
    from pyspark.sql import functions as F

    from scriptorium.functions.references import clean_references

    df = CASES["ref6_clean_lists"][0](spark)
    again = df.select("k", "refs", clean_references(F.col("refs")).alias("twice")).collect()
    assert all(r.refs == r.twice for r in again)


def test_nested_files_round_trip(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("issue: {slug: s1, title: Um, year: 2001}\narticles:\n- {id: s1-x, title: A, keywords: [k], authors: [{givenname: Ana, familyname: Lima}]}\n- {title: ''}\n")
    (tmp_path / "b.yml").write_text("slug: s2\nevento: {titulo: Dois}\nartigos:\n- {titulo: B, resumo: r, palavras_chave: [x, y], referencias: [z]}\n")
    (tmp_path / "c.yaml").write_text("bad: [unclosed")
    rows = {r.id or r.slug: r for r in nested.read_articles(spark, str(tmp_path)).collect()}
    assert rows["s1-x"].title == "A" and rows["s1-x"].authors[0].familyname == "Lima"
    assert rows["s1-002"].title == "" and rows["s2-001"].abstract == "r" and rows["s2-001"].keywords == ["x", "y"]
    assert rows["c"].problem.startswith("ParserError")
    docs = sinks.nested_documents(nested.read_articles(spark, str(tmp_path))).collect()
    out = tmp_path / "json"
    out.mkdir()
    for d in docs:
        (out / f"{d.slug}.json").write_text(d.document)
    back = {r.id: r for r in nested.read_articles(spark, str(out), "*.json").collect()}
    assert back["s1-x"].title == "A" and back["s2-001"].references == ["z"] and len(back) == 3


def test_windowed_counts_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet(SF + "/events.parquet*")
    run = windowed_counts(stream, late="3650 days").writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path)).start()
    run.processAllAvailable()
    run.stop()
    got = {(r.start, r.event_type): r.n for r in spark.table("counts").collect()}
    assert got == {(r.start, r.event_type): r.n for r in windowed_counts(events).collect()}


def test_numbers_over_ranges(spark):
    df = spark.range(1000).selectExpr("id * 7919 % 1000 as k", "id").repartition(5)
    got = {r.k: r.n for r in relational.numbered(df, ["k"], "n").collect()}
    assert got == {k: k + 1 for k in range(1000)}
    assert relational.numbered(df.where("false"), ["k"], "n").count() == 0


def test_numbers_within_a_hot_key_and_a_null_one(spark):
    df = spark.range(1500).selectExpr("case when id % 3 = 0 then 'hot' when id % 50 <> 1 then 'k' || id % 7 end as key", "id * 7919 % 1500 as v", "id").repartition(5)
    rows = lambda x: sorted((str(r.key), r.v, r.n) for r in x.collect())
    split = relational.numbered(df, ["v"], "n", "key", split=True)
    assert split.columns == ["key", "v", "id", "n"]
    assert rows(split) == rows(relational.numbered(df, ["v"], "n", "key"))
    assert relational.numbered(df.where("false"), ["v"], "n", "key", split=True).count() == 0
