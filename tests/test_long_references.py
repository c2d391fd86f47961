"""References in long lines and long runs: patterns that need no stack, values that are computed once."""

import time

from pyspark.sql import functions as F

from scriptorium.operators import split_references as sr


def test_long_lines(spark):
    lines = ["Casa " + "de lado " * 60_000, "Casa " + "de lado " * 60_000 + "alto, Ana", "Costa do mar, Rui", "Recife, Ana"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, x string")
    got = [tuple(r) for r in df.orderBy("i").select(sr.mixed_author(F.col("x"), ["recife"]), sr.is_footnote(F.col("x"), ["recife"])).collect()]
    assert got == [(False, True), (True, False), (True, False), (False, True)]


def test_many_references_in_one_string(spark):
    one = "SOUZA, Maria. Outra casa da cidade e do mar. Natal: Editora, 2001."
    df = spark.createDataFrame([(" ".join([one] * 400),)], "x string")
    began = time.time()
    refs = df.select(sr.split_concatenated(F.array("x"), ["natal"]).alias("r")).first().r
    assert refs == [one] * 400 and time.time() - began < 20


def test_many_authors_of_one_paper(spark):
    """Notes are read once a text; of a number that comes twice the first counts, wherever it stands."""
    from scriptorium.operators.headers import numbered_authors

    n = 3000
    long = "\n".join([f"LIMA, Ana ({i})" for i in range(1, n + 1)] + [f"{i}. Centro {i}, p{i}@x.org" for i in range(1, n + 1)])
    odd = "LIMA, Ana (2)\nSILVA, Rui (9)\nREIS, Eva (1)\n2. Centro B, b@x.org\n1. Centro A, a@x.org\n2. Centro C, c@x.org"
    df = spark.createDataFrame([(0, long), (1, odd)], "i int, x string")
    began = time.time()
    got = [r.a for r in df.orderBy("i").select(numbered_authors(F.col("x")).alias("a")).collect()]
    assert time.time() - began < 30
    assert [(a.no, a.affiliation) for a in got[0]] == [(i, f"Centro {i}") for i in range(1, n + 1)]
    assert [(a.no, a.affiliation, a.email) for a in got[1]] == [(2, "Centro B", "b@x.org"), (9, None, None), (1, "Centro A", "a@x.org")]
