"""Folding against the Unicode data, for every character, and checked JSON lists."""

import unicodedata

from pyspark.sql import functions as F

from scriptorium.functions.references import checked_list
from scriptorium.functions.text import compatible_fold


def folded(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def test_every_character(spark):
    every = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(every[i : i + 64]) for i in range(0, len(every), 64)] + ["", None, "São º ﬁ ½ 한국어 Ǆ ﷺ"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").repartition(8)
    got = {r.i: r.y for r in df.select("i", compatible_fold(F.col("x")).alias("y")).collect()}
    for i, x in enumerate(texts):
        assert got[i] == (None if x is None else folded(x)), (i, x)


def test_lists(spark):
    lists = [None, "", "[", "{}", "7", "null", "[]", '["IBGE, 2001", 5, null, {"a": 1}, "SILVA, João. Casa moderna. Recife: Nova Editora, 1999."]', '["x", "' + "y" * 300 + '"] ', "nada " * 50]
    got = [[(p.pos, p.ref, p.problems) for p in r.p] for r in spark.createDataFrame(list(enumerate(lists)), "i int, x string").orderBy("i").select(checked_list(F.col("x")).alias("p")).collect()]
    assert got[0] == [(0, "", ["json_invalido"])] == got[1] and got[2] == [(0, "[", ["json_invalido"])]
    assert got[3] == [(0, "{}", ["formato_invalido"])] and got[4] == [(0, "7", ["formato_invalido"])] and got[5] == [(0, "null", ["formato_invalido"])] and got[6] == []
    assert got[7] == [(0, "IBGE, 2001", ["curta"]), (1, "5", ["tipo_invalido"]), (2, "null", ["tipo_invalido"]), (3, '{"a":1}', ["tipo_invalido"])]
    assert [p[0] for p in got[8]][0] == 0 and got[9] == [(0, ("nada " * 50)[:100], ["json_invalido"])]
