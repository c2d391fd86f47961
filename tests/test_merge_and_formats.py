"""The whole merge and the serializer on small cases: chains, ties, nulls, empty lists, control characters."""

import json as js
import xml.etree.ElementTree as et

from pyspark.sql import functions as F

from scriptorium.operators import cite, serialize
from scriptorium.operators.merging import merge_authors
from scriptorium.operators.serialize import Field, Group, Many


def test_whole_merge(spark):
    authors = spark.createDataFrame(
        [(1, "A.", "Lima", None, ""), (2, "Ana", "Lima", "two@x", None), (3, "Ana Ú", "Lima", " ", "o3"), (4, "Ana U", "Lima", "four@x", "o4"), (5, "Rui", "Sá", None, None)],
        "id int, given string, family string, email string, orcid string",
    )
    variants = spark.createDataFrame([(3, "Aninha", "Lima", "old"), (5, "Ana", "Lima", "old")], "author_id int, given string, family string, source string")
    links = spark.createDataFrame([("x", 1, 9), ("x", 3, 8), ("y", 4, 7), ("y", 2, 6), ("z", 5, 5), ("z", 77, 4)], "article string, author_id int, seq int")
    pairs = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (99, 5)], "removed int, keep int")
    got = merge_authors(authors, variants, links, pairs)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(got.authors) == [(1, "Ana Ú", "Lima", "two@x", 2, "o3", 3), (5, "Rui", "Sá", None, None, None, None)]
    assert rows(got.links) == [("x", 1, 9), ("y", 1, 6), ("z", 5, 5), ("z", 77, 4)]
    assert rows(got.log) == [(2, 1, "Ana", "Lima"), (3, 1, "Ana Ú", "Lima"), (4, 1, "Ana U", "Lima")]
    assert rows(got.variants) == [(1, "Ana U", "Lima", "dedup"), (1, "Ana Ú", "Lima", "dedup"), (1, "Aninha", "Lima", "old"), (5, "Ana", "Lima", "old")]
    none = merge_authors(authors, variants.where("false"), links.where("false"), pairs.where("false"))
    assert none.authors.count() == 5 and none.links.count() == 0 == none.log.count() == none.variants.count()


def test_serializer(spark):
    df = spark.createDataFrame(
        [(1, 'a <b> & "c"', ["x&y", "é\n"], [("p", None), (None, 2)]), (2, None, [], None)], "id int, t string, k array<string>, m array<struct<n:string,v:int>>"
    )
    parts = [
        Field("id", F.col("id"), {"lang": F.col("t"), "fixed": 'a"b'}), Field("t", F.col("t")), Group("g", [Many("k", F.col("k"), lambda x: x)], {}, F.size("k") > 0),
        Many("m", F.col("m"), lambda x: [Field("n", x["n"]), Group("inner", [Field("v", x["v"])])], {"at": lambda x: x["v"]}),
    ]
    r = df.orderBy("id").select(serialize.xml(Group("all", parts)).alias("x"), serialize.json(parts).alias("j"), serialize.yaml(parts).alias("y"), serialize.pairs(parts).alias("p")).collect()
    root = et.fromstring(r[0].x)
    assert root.find("id").attrib == {"lang": 'a <b> & "c"', "fixed": 'a"b'} and root.find("t").text == 'a <b> & "c"'
    assert [k.text for k in root.find("g")] == ["x&y", "é\n"] and [m.attrib for m in root.findall("m")] == [{}, {"at": "2"}]
    assert et.fromstring(r[1].x).find("g") is None and r[1].x == '<all><id fixed="a&quot;b">2</id></all>'
    assert js.loads(r[0].j) == {"id": 1, "t": 'a <b> & "c"', "g": {"k": ["x&y", "é\n"]}, "m": [{"n": "p", "inner": {}}, {"inner": {"v": 2}}]} and r[1].j == '{"id":2}'
    assert r[0].y.split("\n") == ["id: 1", 't: "a <b> & \\"c\\""', "g:", "  k:", '    - "x&y"', '    - "é\\n"', "m:", '  - n: "p"', "    inner:", "  - inner:", "      v: 2"]
    assert [tuple(p) for p in r[0].p] == [("id", "1"), ("t", 'a <b> & "c"'), ("k", "x&y"), ("k", "é\n"), ("n", "p"), ("v", "2")] and r[1].y == "id: 2"


def test_records_with_nothing_in_them(spark):
    kind = "id string, title string, subtitle string, abstract string, locale string, pages string, doi string, isbn string, url string, page_url string, keywords array<string>, authors array<struct<given:string,family:string,orcid:string,affiliation:string,email:string,bio:string,country:string>>, published date, event string, publisher string, place string, section string"
    df = spark.createDataFrame([("1", "T", *[None] * 15)], kind).select(F.struct("*").alias("r"))
    r = F.col("r")
    forms = {"csl": serialize.json(cite.csl(r)), "ld": serialize.json(cite.json_ld(r)), "coins": cite.coins(r), "meta": cite.meta_tags(cite.highwire(r)), "ris": cite.ris_record(r), "bib": cite.bibtex_record(r), "sign": cite.signposts(r)}
    got = df.select(*[c.alias(k) for k, c in forms.items()]).first()
    assert js.loads(got.csl) == {"id": "1", "type": "paper-conference", "title": "T", "language": "pt-BR"}
    assert js.loads(got.ld)["name"] == "T" and "author" not in js.loads(got.ld)
    assert got.coins.endswith("rft.atitle=T") and got.meta.count("<meta") == 2 and got.ris == "TY  - CPAPER\nTI  - T\nLA  - pt-BR\nER  - "
    assert got.bib == "@inproceedings{1,\n  title = {T}\n}" and got.sign == '<https://schema.org/ScholarlyArticle>; rel="type"'


def test_issues_are_joined_in_runs(spark, monkeypatch):
    """Articles are in order whatever the runs in which their text is joined."""
    from scriptorium.plans import citation_queries
    from scriptorium.plans.catalogue import QUERIES

    issues = lambda: sorted(map(tuple, QUERIES["snk3_native_issues"](spark, "/root/testdata/sf0.001").collect()))
    whole = issues()
    monkeypatch.setattr(citation_queries, "RUN", 3)
    assert issues() == whole
