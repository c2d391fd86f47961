"""Small cases of nested layouts, list entries, reports and editions: nulls, empty values, ties and fallbacks."""

from pyspark.sql import functions as F

from scriptorium.functions import curation as cu
from scriptorium.functions import names as nm
from scriptorium.functions import references as ref
from scriptorium.functions.text import canonical_fold
from scriptorium.operators import extract
from scriptorium.sources import nested, sinks


def one(spark, value, f, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in value], f"x {kind}").select(f(F.col("x"))).collect()]


def test_entries(spark):
    fallback = "Obras\nSILVA COSTA, A. Casa" + " longa" * 60 + "\n\n---- outra\nfim"
    texts = [None, "", "solta\n1. um\nsegue\n[2] dois\n____. três\nBRASIL. quatro", fallback, "a\u0001b\n1. c"]
    got = one(spark, texts, ref.list_entries)
    assert got[0] is None and got[1] == []
    assert got[2] == ["solta", "1. um segue", "[2] dois", "____. três", "BRASIL. quatro"]
    assert got[3] == ["Obras", "SILVA COSTA, A. Casa" + " longa" * 60, "---- outra fim"]
    assert got[4] == ["a b", "1. c"]


def test_short_entries_go(spark):
    refs = [["Uma  referência\tboa 12", "curta", "http://example.org/a-longer-path", "1999 - 2001 / 12.3.4", "http://example.org/x com contexto"], [], None]
    assert one(spark, refs, ref.without_short_entries, "array<string>") == [["Uma referência boa", "http://example.org/x com contexto"], [], None]


def test_records_without_separators(spark):
    texts = ["slug: a\nficha: >-\n  um\n  dois\nslug: b\nslug: c\nficha: três", "", None, "sem registro"]
    got = one(spark, texts, cu.joined_records)
    assert [(r.slug, r.ficha) for r in got[0]] == [("a", "um dois"), ("b", None), ("c", "três")]
    assert got[1:] == [[], None, []]


def test_name_words(spark):
    got = one(spark, ["Ana M. de Sá-Lima A.B.", "ana Ana", "", None], nm.name_words)
    assert [(w.word, w.canonical) for w in got[0]] == [("ana", "Ana"), ("sálima", "SáLima")]
    assert [w.canonical for w in got[1]] == ["Ana"] and got[2:] == [[], []]


def test_canonical_fold(spark):
    assert one(spark, ["  Ação 1º ﬁm ", "Ἀθῆναι Й", "é", "", None], canonical_fold) == ["acao 1º ﬁm", "αθηναι и", "e", "", None]


def test_canonical_articles(spark):
    df = spark.createDataFrame([(None, "B", "", ["x"]), ("", "B", "3-4", None)], "title string, titulo string, pages string, references array<string>")
    a, b = nested.canonical(df).collect()
    assert (a.title, a.pages, a.references, a.locale, a.doi) == ("B", None, '["x"]', "pt-BR", None)
    assert (b.title, b.pages, b.references) == ("", "3-4", None)


def test_reports_and_editions(spark):
    counts = spark.createDataFrame([("a", 2), (None, 1)], "k string, n long")
    assert sorted(r.line for r in sinks.report_lines(counts, "k", "n").collect()) == ["-: 1 of 3", "a: 2 of 3"]
    assert sinks.report_lines(counts.where("false"), "k", "n").collect() == []
    rows = [("e", 1, "A & B", [("x", None)]), ("e", 2, None, None), ("e", 3, "C", [])]
    df = spark.createDataFrame(rows, "ed string, no int, title string, authors array<struct<given:string,family:string>>")
    docs = {r.batch: r.document for r in sinks.edition_xml(df, "ed", "no", 2).collect()}
    assert docs[0].split("\n")[1:3] == [
        '<article no="1"><title>A &amp; B</title><author seq="1" primary="true"><given>x</given><family></family></author></article>',
        '<article no="2"><title></title></article>',
    ]
    assert docs[1] == '<articles>\n<article no="3"><title>C</title></article>\n</articles>'


def test_assembled_from_little(spark):
    labels = {"abstract": "Resumo", "keywords": "Palavras-chave", "refs": ["Referências"], "ends": ["Anexos"], "next_label": "Abstract"}
    df = spark.createDataFrame([(1, ""), (2, None), (3, "Só um título"), (4, "T\nAna Lima\nResumo: x\nPalavras-chave: a, b\n")], "k int, text string")
    rows = {r.k: r for r in extract.assembled(df, "text", labels).collect()}
    assert rows[1].title is None and rows[2].title is None and rows[2].refs is None
    assert rows[3].title == "Só um título" and rows[3].authors is None and rows[3].abstract is None and rows[3].keywords is None
    assert rows[4].authors[0].family == "Lima" and rows[4].abstract == "x" and rows[4].keywords == ["a", "b"]


def test_many_files_in_one_batch(spark):
    files = [(f"f{i}.json", b'{"slug": "s%d", "articles": [{"title": "A"}, {"titulo": "B"}]}' % i) for i in range(1500)] + [("bad.json", b"{")]
    got = nested.parsed(spark.createDataFrame(files, "path string, content binary").coalesce(1)).select("slug", "seq", "title", "problem").collect()
    assert len(got) == 3001 and {(r.seq, r.title) for r in got if r.problem is None} == {(1, "A"), (2, "B")} and sum(r.problem is not None for r in got) == 1
