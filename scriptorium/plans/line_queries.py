"""Contents and headings in several formats, written from whole tables with lines of mixed shapes and read back by machines."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from scriptorium.operators import line_machine as lm
from scriptorium.plans.catalogue import query

# A brand's parts in order are a contents page: sections by type, a title in capitals over one or two lines, one or two people, a page.
_SURNAME = "translate({0}, '0123456789', 'ABCDEFGHIJ')"
_NO = "row_number() OVER (PARTITION BY p_brand ORDER BY p_type, p_partkey) AS no"
_TITLE_SQL = "'ESTUDO DE ' || upper(p_name) || CASE WHEN p_partkey % 2 = 0 THEN ' EM OBRA' ELSE '' END"
_PEOPLE_SQL = f"'SILVA ' || {_SURNAME.format('CAST(p_size AS VARCHAR)')} || ', Ana' || CASE WHEN p_partkey % 3 = 0 THEN '; LIMA, Rui' ELSE '' END"
_PAGE_SQL = "10 + p_partkey % 900"


def _pages(t, lines: str, head: str, tail: str, section: str = "concat('EIXO ', p_type)") -> object:
    """(k, text) of every brand: its parts' lines, a section's line before the first of it."""
    w = Window.partitionBy("k").orderBy("p_type", "p_partkey")
    rows = t("part").selectExpr("p_brand k", "p_type", "p_partkey", f"{lines} x", f"{section} s")
    rows = rows.withColumn("x", F.when(~F.col("p_type").eqNullSafe(F.lag("p_type").over(w)), F.concat("s", F.lit("\n"), "x")).otherwise(F.col("x")))
    pages = rows.groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_type", "p_partkey", "x"))), lambda r: r["x"]), "\n").alias("text"))
    return pages.withColumn("text", F.concat(F.lit(head), "text", F.lit(tail)))


_WHO = f"concat('SILVA ', {_SURNAME.format('cast(p_size as string)')}, ', Ana')"
_PAGE = "cast(10 + p_partkey % 900 as string)"
_CONTENTS = f"SELECT p_brand AS k, {_NO}, 'EIXO ' || p_type AS section, {_TITLE_SQL} AS title, {_PEOPLE_SQL} AS authors, {_PAGE_SQL} AS page FROM part"


@query("ext12_capital_titles", _CONTENTS)
def _(t, spark):
    """Titles in capitals over lines, pages on their own, feet of pages in between."""
    lines = f"concat_ws('\\n', concat('ESTUDO DE ', upper(p_name)), if(p_partkey % 2 = 0, 'EM OBRA', null), if(p_partkey % 5 = 0, '7', null), {_PAGE}, '', {_WHO}, if(p_partkey % 3 = 0, 'LIMA, Rui', null), if(p_partkey % 4 = 0, 'texto de apoio em letras pequenas', null))"
    found = lm.records(_pages(t, lines, "PROGRAMA\nNADA AINDA\n12\nCOMUNICAÇÕES | ARTIGOS\n", "\nNORMAS DA EDIÇÃO\nNÃO CONTA\n99\nLIMA, Rui"), "k", "text", lm.contents_of_capitals(r"^COMUNICAÇÕES", r"^EIXO ", r"^NORMAS"))
    return found.select("k", "no", "section", F.array_join("title", " ").alias("title"), F.array_join("authors", "; ").alias("authors"), F.get("page", F.lit(0)).cast("long").alias("page"))


@query("ext12_title_lines", _CONTENTS)
def _(t, spark):
    """A title and its page on one line, people after it."""
    lines = f"concat_ws('\\n', concat('ESTUDO DE ', upper(p_name), if(p_partkey % 2 = 0, ' EM OBRA', ''), '    ', {_PAGE}), {_WHO}, if(p_partkey % 4 = 0, 'texto de apoio', null), if(p_partkey % 3 = 0, 'LIMA, Rui', null), '')"
    found = lm.records(_pages(t, lines, "SUMÁRIO  11\n", "\nANEXOS\nOUTRO    99"), "k", "text", lm.contents_of_lines(r"^EIXO ", r"^ANEXOS"))
    line = F.get("title", F.lit(0))
    return found.select("k", "no", "section", F.regexp_extract(line, r"^(.*?)\s{2,}\d+$", 1).alias("title"), F.array_join("authors", "; ").alias("authors"), F.regexp_extract(line, r"(\d+)$", 1).cast("long").alias("page"))


@query("ext12_blocks", _CONTENTS)
def _(t, spark):
    """Entries between blank lines, with a bar before the people and dots before the page."""
    lines = f"concat_ws('\\n', '', concat('ESTUDO DE ', upper(p_name)), if(p_partkey % 2 = 0, 'EM OBRA', null), concat('| ', {_WHO}, if(p_partkey % 3 = 0, '; LIMA, Rui', ''), ' ..... ', {_PAGE}))"
    found = lm.records(_pages(t, lines, "SUMÁRIO\n\nantes\n\n", "\n\nAPÊNDICE\n\nfora .... 5"), "k", "text", lm.contents_of_blocks(r"^EIXO ", r"^APÊNDICE"))
    entry = F.array_join("entry", " ")
    return found.select("k", "no", "section", F.regexp_extract(entry, r"^(.*?) \|", 1).alias("title"), F.regexp_extract(entry, r"\| (.*?) \.+ \d+$", 1).alias("authors"), F.regexp_extract(entry, r"(\d+)$", 1).cast("long").alias("page"))


@query("ext12_bullets", f"SELECT p_brand AS k, {_NO}, 'EIXO ' || p_type AS section, {_TITLE_SQL} || CASE WHEN p_partkey % 7 = 0 THEN ' (um caso)' ELSE '' END AS title, {_PEOPLE_SQL} AS authors, {_PAGE_SQL} AS page FROM part")
def _(t, spark):
    """Bullets and bars, parentheses over the end of a line, people that go on in the next."""
    lines = f"concat_ws('\\n', concat('● ESTUDO DE ', upper(p_name)), if(p_partkey % 2 = 0, 'EM OBRA', null), if(p_partkey % 7 = 0, '(um\\ncaso)', null), concat('| ', {_WHO}, if(p_partkey % 3 = 0, ';\\nLIMA, Rui', ''), ' .... ', {_PAGE}))"
    found = lm.records(_pages(t, lines, "SUMÁRIO\nalgo antes\n", "\nNormas\n● fora | X ... 9"), "k", "text", lm.contents_of_bullets(r"^EIXO ", r"^Normas"))
    people = F.array_join("authors", " ")
    return found.select(
        "k", "no", "section", F.regexp_replace(F.array_join("title", " "), r"^●\s*", "").alias("title"), F.regexp_extract(people, r"^\| (.*?) \.+ \d+$", 1).alias("authors"), F.regexp_extract(people, r"(\d+)$", 1).cast("long").alias("page")
    )


@query("ext12_pages_first", _CONTENTS.replace("; LIMA", " / LIMA"))
def _(t, spark):
    """The page before the title, people with slashes between them, other lines ignored."""
    lines = f"concat_ws('\\n', concat({_PAGE}, ' ESTUDO DE ', upper(p_name), if(p_partkey % 2 = 0, ' EM OBRA', '')), concat({_WHO}, if(p_partkey % 3 = 0, ' / LIMA, Rui', '')), if(p_partkey % 4 = 0, 'linha a mais', null))"
    found = lm.records(_pages(t, lines, "ÍNDICE\n", "\nFIM\n12 fora"), "k", "text", lm.contents_of_numbers(r"^EIXO ", r"^FIM$"))
    line = F.get("title", F.lit(0))
    return found.select("k", "no", "section", F.regexp_extract(line, r"^\d+\s+(.*)$", 1).alias("title"), F.array_join("authors", " / ").alias("authors"), F.regexp_extract(line, r"^(\d+)", 1).cast("long").alias("page"))


# Orders are papers, their lineitems the authors of each, numbered in order; the format follows from the order's key.
_HEAD_SQL = """
WITH a AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS no, 'SA' || translate(CAST(l_partkey AS VARCHAR), '0123456789', 'ABCDEFGHIJ') AS family, 'Ana ' || translate(CAST(l_suppkey AS VARCHAR), '0123456789', 'abcdefghij') AS given,
  'Universidade ' || l_returnflag AS affiliation, 'a' || l_partkey || '@x.org' AS email FROM lineitem)"""


def _authors(t):
    a = t("lineitem").selectExpr(
        "l_orderkey k", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "concat('SA', translate(cast(l_partkey as string), '0123456789', 'ABCDEFGHIJ')) family", "concat('Ana ', translate(cast(l_suppkey as string), '0123456789', 'abcdefghij')) given",
        "concat('Universidade ', l_returnflag) affiliation", "concat('a', l_partkey, '@x.org') email",
    )
    return a.withColumn("no", F.row_number().over(Window.partitionBy("k").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")))


def _heads(t, *parts: str):
    """(k, text): each part is an expression of every author, joined by what follows a bar."""
    a = _authors(t).selectExpr("k", "no", *[f"{p.rsplit('|', 1)[0]} x{i}" for i, p in enumerate(parts)])
    rows = a.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("no", *[f"x{i}" for i in range(len(parts))]))).alias("p"))
    join = lambda i, by: F.array_join(F.transform("p", lambda r: r[f"x{i}"]), by.replace("\\n", "\n"))
    joined = [join(i, p.rsplit("|", 1)[1]) for i, p in enumerate(parts)]
    return rows.select("k", F.concat_ws("\n", *joined).alias("text"))


_FORMATS = [
    ("concat('(', no, ') ', family, ', ', given)|\\n", "concat('(', no, ') ', affiliation, ', ', email)|\\n"), ("concat(family, ', ', given, ' (', no, ')')|; ", "concat(no, '. ', affiliation, ', ', email)|\\n"),
    ("concat(family, ', ', given)|\\n", "concat(no, '. ', affiliation)|\\n", "email|\\n"), ("concat(family, '¸ ', given)|\\n", "concat('(', no, ') ', affiliation)|\\n", "email|\\n"),
]


@query("ext10_strategies", _HEAD_SQL + " SELECT k, ['number_before', 'number_after', 'plain', 'cedilla'][1 + k % 4] AS strategy, no, family, given, affiliation, email FROM a")
def _(t, spark):
    """Headings in four formats, told apart by what is found in them."""
    papers = None
    for i, parts in enumerate(_FORMATS):
        some = _heads(t, *parts).where(F.col("k") % 4 == i)  # which format a paper has
        papers = some if papers is None else papers.unionByName(some)
    return papers.select("k", F.explode(lm.header_authors(F.col("text"))).alias("a")).select("k", "a.strategy", F.col("a.no").cast("long").alias("no"), "a.family", "a.given", "a.affiliation", "a.email")


@query("ext8_author_blocks", _HEAD_SQL + """
SELECT k, no, family || ', ' || given AS name, CASE WHEN no % 2 = 0 THEN affiliation || ' (campus sul)' ELSE affiliation END AS affiliation, CASE WHEN no % 3 <> 0 THEN email ELSE '' END AS email, CASE WHEN no % 4 = 0 THEN 'Mestre em algo Bolsista' ELSE '' END AS bio FROM a
""")
def _(t, spark):
    """Authors one after the other, each with what is known in lines of any order."""
    block = "concat_ws('\\n', concat(family, ', ', given), if(no % 3 = 1, email, null), if(no % 2 = 0, concat(affiliation, ' (campus\\nsul)'), affiliation), if(no % 4 = 0, 'Mestre em algo\\nBolsista', null), if(no % 3 = 2, email, null), '')|\\n"
    papers = _heads(t, block).withColumn("text", F.concat(F.lit("Um título qualquer\n"), "text", F.lit("\nRESUMO\nSILVA, Fora")))
    machine = lm.author_blocks(r"^RESUMO$", r"@", r"^Universidade", lm.PERSON)
    join = lambda c: F.array_join(c, " ").alias(c)
    return lm.records(papers, "k", "text", machine).select("k", "no", join("name"), join("affiliation"), join("email"), join("bio"))
