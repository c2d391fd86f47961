"""Machines against a plain loop over lines, on random documents; nulls, open parentheses, headings of every format."""

import random
import re

from pyspark.sql import functions as F

from scriptorium.operators import line_machine as lm


def plain(text, machine):
    """Records of a document, line by line."""
    out, now, held, state = [], None, {}, machine.start
    for line in [] if text is None else [x.strip(" ") for x in text.split("\n")]:
        kind = "blank" if not line else next((k for k, p in machine.kinds if re.search(p.replace(r"\p{Ll}", "a-zà-ÿ").replace("[^a-zà-ÿ]", "[^a-zà-ÿ]"), line)), "other")
        _, _, then, action = next((r for r in machine.rules if r[0] in ("*", state) and r[1] in ("*", kind)), ("", "", "*", "skip"))
        state = state if then == "*" else then
        if action == "stop":
            break
        verb, _, name = action.partition(":")
        if verb == "open":
            now = (dict(held), {name: [line]})
            out.append(now)
        elif verb == "add" and now:
            now[1].setdefault(name, []).append(line)
        elif verb == "hold":
            held[name] = line
    return [(h, f) for h, f in out]


LINES = ["", "EIXO A", "EIXO B", "TÍTULO GRANDE DEMAIS", "OUTRA PARTE DELE", "12", "7", "345", "SILVA, Ana", "LIMA, Rui", "texto solto", "COMUNICAÇÕES", "fim", "FIM", "A CASA  33", " x "]


def test_against_a_loop(spark):
    draws = random.Random(8)
    texts = [None, "", "COMUNICAÇÕES"] + ["\n".join(draws.choices(LINES, k=draws.randint(1, 40))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(3)
    machine = lm.contents_of_capitals("^COMUNICAÇÕES", "^EIXO ", "^fim$")
    simple = lm.Machine([(k, p.replace(r"\p{Ll}", "a-zà-ÿ") if k == "title" else p.replace(r"\p{Ll}", "[a-zà-ÿ]")) for k, p in machine.kinds], machine.rules, machine.start)
    got = {}
    for r in lm.records(df, "k", "text", machine).collect():
        got.setdefault(r.k, {})[r.no] = (r.section, r.title, r.page, r.authors)
    for k, text in enumerate(texts):
        want = {i + 1: (h.get("section"), f.get("title", []), f.get("page", []), f.get("authors", [])) for i, (h, f) in enumerate(plain(text, simple))}
        assert got.get(k, {}) == want, text


def test_open_parentheses(spark):
    texts = ["a (b\nc) d\ne", "a (b\n1\n2\n3\n4\n5", "x) y\n(z", "", "((a\n)\n)b\nc"]
    got = [r.l for r in spark.createDataFrame(list(enumerate(texts)), "i int, x string").orderBy("i").select(lm.rejoined(F.split("x", "\n")).alias("l")).collect()]
    assert got == [["a (b c) d", "e"], ["a (b 1 2 3 4", "5"], ["x) y", "(z"], [""], ["((a ) )b", "c"]]


def test_headings(spark):
    heads = [
        "TÍTULO DA OBRA\n(1) LIMA, Ana\n(2) SÁ COSTA, Rui P.\n(1) UFPE, a@x.br\n(2) USP", "SILVA JUNIOR, J. (2); REIS, Eva (1).\n1. Universidade B\n2. Universidade C, j@y.org\ne@z.org",
        "COSTA, Lia\nALVES, Bia.", "SOUZA¸ Eva", "sem autores", None,
    ]
    got = [r.a for r in spark.createDataFrame(list(enumerate(heads)), "i int, x string").orderBy("i").select(lm.header_authors(F.col("x")).alias("a")).collect()]
    rows = [None if a is None else [tuple(x) for x in a] for a in got]
    assert rows[0] == [("number_before", 1, "LIMA", "Ana", "UFPE", "a@x.br"), ("number_before", 2, "SÁ COSTA", "Rui P", "USP", None)]
    assert rows[1] == [("number_after", 2, "SILVA JUNIOR", "J", "Universidade C", "j@y.org"), ("number_after", 1, "REIS", "Eva", "Universidade B", "e@z.org")]
    assert rows[2] == [("plain", 1, "COSTA", "Lia", None, None), ("plain", 2, "ALVES", "Bia", None, None)] and rows[3] == [("cedilla", 1, "SOUZA", "Eva", None, None)] and rows[4] == [] and not rows[5]


def test_long_documents_take_one_pass(spark):
    """Time grows with the lines, not with their square."""
    import time

    draws = random.Random(5)
    text = "\n".join(draws.choices([*LINES, "a (b", "c) d"], k=60_000))
    df = spark.createDataFrame([(0, "COMUNICAÇÕES\n" + text.replace("fim", "meio"))], "k int, text string")
    machine = lm.contents_of_capitals("^COMUNICAÇÕES", "^EIXO ", "^fim$")
    began = time.time()
    found = lm.records(df, "k", "text", machine).agg(F.count(F.lit(1)).alias("n"), F.max("no").alias("last")).first()
    joined = df.select(F.size(lm.rejoined(F.split("text", "\n"))).alias("n")).first()
    assert time.time() - began < 40
    assert found.n == found.last > 1000 and 30_000 < joined.n < 60_000
