"""Queries over bibliographic references: the lines of documents stand for reference lists, and literal rows for what the tables lack."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import references as ref
from scriptorium.operators import split_references

from scriptorium.plans.catalogue import case, literal, query, values

_CAP = "[A-ZÁÀÃÂÉÊÍÓÔÕÚÜÇ]"


def _problems_sql(source: str) -> str:
    """SQL for (keys..., r, n, problem flags) of a FROM item that has r, the stripped reference."""
    begins = "regexp_matches(r, '^(?:" + "|".join(p.replace("'", "''") for p in ref.BEGINNINGS) + ")')"
    not_ref = "regexp_matches(r, '" + "|".join(f"(?:{p})" for p in ref.NOT_REFERENCES[:2]).replace("'", "''") + "|^\\d+\\s+[A-Z][a-z]+\\s+(é|foi|são|era|tem|deve|pode|precisa|quer|como|quando|onde|porque)(?:[^\\p{L}\\p{N}_]|$)')"
    year = "regexp_matches(r, '(?:^|[^0-9])[12][0-9]{3}(?:[^0-9]|$)')"
    words = "list_filter(regexp_split_to_array(r, '[\\s\\p{Z}]+'), lambda w: w <> '')"
    common = f"len(list_filter({words}, lambda w: list_contains({literal(ref.COMMON_WORDS)}, lower(w)))) / len({words})"
    return f"""
SELECT *, n = 0 AS vazia, n > 0 AND n < 12 AS curta,
  n > 50 AND regexp_matches(substr(r, 51), '[12][0-9]{{3}}[a-z]?\\.\\s+{_CAP}{_CAP}+,\\s*[A-Z]') AS concatenada_padrao,
  n > 50 AND regexp_matches(substr(r, 51), '\\.\\s{{2,}}{_CAP}{_CAP}+,\\s') AS concatenada_padrao2,
  n > 0 AND NOT regexp_matches(r, '^[\\p{{Lu}}\\p{{Nd}}]') AND NOT {begins} AND n < 40 AS inicio_minuscula,
  NOT {begins} AND n > 100 AND NOT {year} AND NOT contains(r, '.') AS sem_ano_ponto,
  NOT {begins} AND n > 150 AND NOT {year} AND contains(r, '.') AND {common} > 0.40 AS texto_corrido,
  n > 0 AND {not_ref} AS nao_referencia
FROM ({source})"""


_LINES = "SELECT doc_id, source, i - 1 AS pos, r, length(r) AS n FROM (SELECT doc_id, source, i, regexp_replace(ls[i], '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS r FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents))"


def _lines(t):
    return t("documents").select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("pos", "ref"))


@query("ref3_quality_summary", f"""
WITH p AS ({_problems_sql(_LINES)})
SELECT coalesce(source, 'TOTAL') AS source, count(*) AS total_refs, count(*) FILTER (concatenada_padrao OR concatenada_padrao2) AS n_concat,
  count(*) FILTER (nao_referencia OR inicio_minuscula OR sem_ano_ponto OR texto_corrido) AS n_not_ref, count(*) FILTER (curta OR vazia) AS n_short,
  count(DISTINCT CASE WHEN vazia OR curta OR concatenada_padrao OR concatenada_padrao2 OR inicio_minuscula OR sem_ano_ponto OR texto_corrido OR nao_referencia THEN doc_id END) AS docs_with_problem
FROM p GROUP BY ROLLUP (source)
""")
def _(t, spark):
    """The report of problems per source, with a total (REF1 to REF3, AGG6): counted per document first, of
    which each has one source, so that only those small rows are rolled up."""
    p = _lines(t).withColumn("p", ref.reference_problems(F.col("ref")))
    has = lambda *names: F.arrays_overlap("p", F.array(*map(F.lit, names)))
    per = p.groupBy("source", "doc_id").agg(
        F.count(F.lit(1)).alias("total_refs"),
        F.count_if(has("concatenada_padrao", "concatenada_padrao2")).alias("n_concat"),
        F.count_if(has("nao_referencia", "inicio_minuscula", "sem_ano_ponto", "texto_corrido")).alias("n_not_ref"),
        F.count_if(has("curta", "vazia")).alias("n_short"),
        F.max((F.size("p") > 0).cast("long")).alias("docs_with_problem"),
    )
    counts = ["total_refs", "n_concat", "n_not_ref", "n_short", "docs_with_problem"]
    return per.rollup("source").agg(*[F.sum(c).alias(c) for c in counts]).withColumn("source", F.coalesce("source", F.lit("TOTAL")))


_UNPIVOT = " UNION ALL ".join(f"SELECT doc_id, pos, '{p}' AS problem FROM p WHERE {p}" for p in ref.PROBLEMS)


@query("ref2_problem_detail", f"WITH p AS ({_problems_sql(_LINES)}) {_UNPIVOT}")
def _(t, spark):
    """One row for every problem of every reference."""
    return _lines(t).select("doc_id", F.col("pos").cast("long").alias("pos"), F.explode(ref.reference_problems(F.col("ref"))).alias("problem"))


_LIST = """CASE o_orderkey % 9
  WHEN 0 THEN concat('["', o_orderpriority, '", "SILVA, A. Casa ', cast(o_orderkey AS varchar(99)), '. 1999."]') WHEN 1 THEN concat('{"a": ', cast(o_orderkey AS varchar(99)), '}')
  WHEN 2 THEN concat('[', cast(o_orderkey AS varchar(99)), ', "Casa moderna de ', cast(o_orderkey AS varchar(99)), '", null, {"b": [2, "x"]}, true, [1]]') WHEN 3 THEN concat('["', o_orderstatus) WHEN 4 THEN NULL
  WHEN 5 THEN concat('"', o_orderpriority, '"') WHEN 6 THEN '[]' WHEN 7 THEN cast(o_orderkey AS varchar(99)) ELSE 'null' END"""


@query("ref2_list_errors", f"""
WITH l AS (SELECT o_orderkey AS id, {_LIST} AS x FROM orders),
i AS (SELECT id, x, unnest(json_extract(x, '$[*]')) AS v, unnest(range(json_array_length(x)::BIGINT)) AS pos FROM l WHERE json_valid(x) AND json_type(x) = 'ARRAY'),
p AS ({_problems_sql("SELECT id AS doc_id, NULL AS source, pos, r, length(r) AS n FROM (SELECT id, pos, v->>'$' AS r FROM i WHERE json_type(v) = 'VARCHAR')")}),
o AS (SELECT id, 0 AS pos, 'json_invalido' AS problem, coalesce(x, '') AS ref FROM l WHERE x IS NULL OR NOT json_valid(x) UNION ALL SELECT id, 0, 'formato_invalido', CAST(json(x) AS VARCHAR) FROM l WHERE json_valid(x) AND json_type(x) <> 'ARRAY'
  UNION ALL SELECT id, pos, 'tipo_invalido', CAST(v AS VARCHAR) FROM i WHERE json_type(v) <> 'VARCHAR')
SELECT id, CAST(pos AS BIGINT) AS pos, problem, left(ref, 100) AS ref FROM o
UNION ALL SELECT doc_id, pos, problem, r FROM ({" UNION ALL ".join(f"SELECT doc_id, pos, '{p}' AS problem, r FROM p WHERE {p}" for p in ref.PROBLEMS)})
""")
def _(t, spark):
    """Lists of references as JSON of every kind: what is wrong with the list, with its items, and with the references in it."""
    lists = t("orders").select(F.col("o_orderkey").alias("id"), F.expr(_LIST.replace("varchar(99)", "string")).alias("x"))
    found = lists.select("id", F.explode(ref.checked_list(F.col("x"))).alias("p")).select("id", "p.*")
    return found.select("id", F.col("pos").cast("long").alias("pos"), F.explode("problems").alias("problem"), "ref")


_CASES = [
    "", "IBGE, 2001", "•", "sobre a casa", "www.exemplo.org/pagina", "Fonte: acervo do autor", "SILVA, João. Casa moderna. Recife: Nova Editora, 1999.",
    "SILVA, João. Casa moderna no nordeste. Recife: Nova Editora, 1999. SOUZA, Maria. Outra casa. 2001.",
    "SILVA, João. Casa moderna no nordeste do país. Recife.  SOUZA, Maria. Outra casa. 2001.",
    "Levantamento das casas modernas construídas no bairro central da cidade com plantas cortes elevações detalhes",
    "Segundo o que se viu, a casa que se fez para o autor é uma obra que se abre para a rua e para o mar, e que não se fecha em si. Por isso a casa é como um parque que se dá a quem passa.",
    "  idem, p. 4 ", "12 Casa é onde se mora", "figura 3 planta",
]
_CASE_ROWS = [(i, r) for i, r in enumerate(_CASES)]


@case("ref1_classify_cases", f"""
WITH p AS ({_problems_sql(f"SELECT i, r, length(r) AS n FROM (SELECT i, regexp_replace(x, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') AS r FROM {values(_CASE_ROWS, 'i, x')})")})
SELECT i, list_filter([{", ".join(f"CASE WHEN {p} THEN '{p}' END" for p in ref.PROBLEMS)}], lambda x: x IS NOT NULL) AS problems FROM p
""")
def _(t, spark):
    """Every branch of the classifier."""
    return spark.createDataFrame(_CASE_ROWS, "i int, ref string").select("i", ref.reference_problems(F.col("ref")).alias("problems"))


_LISTS = [
    (1, ["SEGAWA, Hugo. Arquiteturas no Brasil. ______. A pesada herança. ______. Outra obra."]),
    (2, ["sem autor", "____. x", "____. y"]),
    (3, ["____. x"]),
    (4, ["X. Título. Disponível em:", "https://a.b/c", "Acesso em 3 maio 2020.", "Y, Z. Livro."]),
    (5, ["https://a.b/c", "Y, Z. Livro."]),
    (6, ["IBGE. Censo. 1991.", "___. Outro. 1992.", "  ", "SILVA, A. Um. 2001.", "______, Dois. 2002.", "https://x.y", "https://z.w"]),
    (7, []),
]
_LIST_SQL = "(" + " UNION ALL ".join(f"SELECT {i} AS k, CAST({literal(r)} AS VARCHAR[]) AS refs" for i, r in _LISTS) + ")"


def _list_rows(spark):
    return spark.createDataFrame(_LISTS, "k int, refs array<string>")


@case("ref4_underscore_split", f"""
WITH e AS (SELECT k, i, trim(refs[i]) AS r FROM (SELECT k, refs, unnest(generate_series(1, len(refs))) AS i FROM {_LIST_SQL})),
c AS (SELECT k, i, j, trim(p[j]) AS part FROM (SELECT k, i, p, unnest(generate_series(1, len(p))) AS j FROM (SELECT k, i, string_split(regexp_replace(r, '\\s+(_{{3,}})', chr(1) || '\\1', 'g'), chr(1)) AS p FROM e WHERE r <> ''))),
d AS (SELECT k, i, j, regexp_replace(part, '^(_{{3,}})\\s+', '\\1') AS part FROM c)
SELECT k, list(part ORDER BY i, j) AS refs FROM d WHERE part <> '' AND NOT regexp_matches(part, '^_{{3,}}$') GROUP BY k UNION ALL SELECT 7, []
""")
def _(t, spark):
    return _list_rows(spark).select("k", ref.split_underscores(F.col("refs")).alias("refs"))


_AUTHOR = """CASE WHEN contains(regexp_extract({0}, '^([A-ZÁÉÍÓÚÀÂÊÔÃÕÇÑ][A-ZÁÉÍÓÚÀÂÊÔÃÕÇÑa-záéíóúàâêôãõçñ\\s,.]+?)\\.\\s', 1), ',')
THEN regexp_extract({0}, '^([A-ZÁÉÍÓÚÀÂÊÔÃÕÇÑ][A-ZÁÉÍÓÚÀÂÊÔÃÕÇÑa-záéíóúàâêôãõçñ\\s,.]+?)\\.\\s', 1) || '.'
WHEN regexp_matches({0}, '^([A-ZÁÉÍÓÚÀÂÊÔÃÕÇÑ][A-ZÁÉÍÓÚÀÂÊÔÃÕÇÑa-záéíóúàâêôãõçñ\\s]+?)\\.\\s') THEN regexp_extract({0}, '^([A-ZÁÉÍÓÚÀÂÊÔÃÕÇÑ][A-ZÁÉÍÓÚÀÂÊÔÃÕÇÑa-záéíóúàâêôãõçñ\\s]+?)\\.\\s', 1) || '.' END"""


@case("ref5_leading_author", f"SELECT i, {_AUTHOR.format('x')} AS author FROM {values(_CASE_ROWS, 'i, x')}")
def _(t, spark):
    return spark.createDataFrame(_CASE_ROWS, "i int, ref string").select("i", ref.leading_author(F.col("ref")).alias("author"))


@case("win2_author_backfill", f"""
WITH e AS (SELECT k, i, refs[i] AS raw, trim(refs[i]) AS r FROM (SELECT k, refs, unnest(generate_series(1, len(refs))) AS i FROM {_LIST_SQL})),
b AS (SELECT *, regexp_matches(r, '^_{{3,}}') AS blank, last_value(CASE WHEN NOT regexp_matches(r, '^_{{3,}}') THEN r END IGNORE NULLS) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base FROM e),
f AS (SELECT k, i, CASE WHEN blank AND {_AUTHOR.format('base')} IS NOT NULL THEN {_AUTHOR.format('base')} || ' ' || regexp_replace(r, '^_{{3,}}[.,]?\\s*', '') ELSE raw END AS ref FROM b)
SELECT k, list(ref ORDER BY i) AS refs FROM f GROUP BY k UNION ALL SELECT 7, []
""")
def _(t, spark):
    return _list_rows(spark).select("k", ref.backfill_authors(F.col("refs")).alias("refs"))


@case("win3_orphan_join", f"""
WITH e AS (SELECT k, i, trim(refs[i]) AS r FROM (SELECT k, refs, unnest(generate_series(1, len(refs))) AS i FROM {_LIST_SQL})),
n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY i) AS rn FROM e WHERE r <> ''),
s AS (SELECT *, CASE WHEN rn = 1 OR NOT (regexp_matches(r, '^https?://\\S+$') OR starts_with(r, 'Disponível em') OR starts_with(r, 'Acesso em') OR starts_with(r, 'Available at')) THEN 1 ELSE 0 END AS start FROM n),
g AS (SELECT *, sum(start) OVER (PARTITION BY k ORDER BY i) AS no FROM s),
j AS (SELECT k, no, string_agg(r, ' ' ORDER BY i) AS ref FROM g GROUP BY k, no)
SELECT k, list(ref ORDER BY no) AS refs FROM j GROUP BY k UNION ALL SELECT 7, []
""")
def _(t, spark):
    return _list_rows(spark).select("k", ref.join_orphans(F.col("refs")).alias("refs"))


@case("ref6_clean_lists", f"""
WITH e AS (SELECT k, i, trim(refs[i]) AS r FROM (SELECT k, refs, unnest(generate_series(1, len(refs))) AS i FROM {_LIST_SQL})),
c AS (SELECT k, i, j, trim(p[j]) AS part FROM (SELECT k, i, p, unnest(generate_series(1, len(p))) AS j FROM (SELECT k, i, string_split(regexp_replace(r, '\\s+(_{{3,}})', chr(1) || '\\1', 'g'), chr(1)) AS p FROM e WHERE r <> ''))),
d AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY i, j) AS i, regexp_replace(part, '^(_{{3,}})\\s+', '\\1') AS r FROM c WHERE part <> '' AND NOT regexp_matches(regexp_replace(part, '^(_{{3,}})\\s+', '\\1'), '^_{{3,}}$')),
b AS (SELECT *, regexp_matches(r, '^_{{3,}}') AS blank, last_value(CASE WHEN NOT regexp_matches(r, '^_{{3,}}') THEN r END IGNORE NULLS) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base FROM d),
f AS (SELECT k, i, trim(CASE WHEN blank AND {_AUTHOR.format('base')} IS NOT NULL THEN {_AUTHOR.format('base')} || ' ' || regexp_replace(r, '^_{{3,}}[.,]?\\s*', '') ELSE r END) AS r FROM b),
s AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY k ORDER BY i) = 1 OR NOT (regexp_matches(r, '^https?://\\S+$') OR starts_with(r, 'Disponível em') OR starts_with(r, 'Acesso em') OR starts_with(r, 'Available at')) THEN 1 ELSE 0 END AS start FROM f WHERE r <> ''),
g AS (SELECT *, sum(start) OVER (PARTITION BY k ORDER BY i) AS no FROM s),
j AS (SELECT k, no, string_agg(r, ' ' ORDER BY i) AS ref FROM g GROUP BY k, no)
SELECT k, list(ref ORDER BY no) AS refs FROM j GROUP BY k UNION ALL SELECT 7, []
""")
def _(t, spark):
    """The three phases in turn."""
    return _list_rows(spark).select("k", ref.clean_references(F.col("refs")).alias("refs"))


@query("ref13_without_non_references", f"""
SELECT doc_id, count(*) AS lines, count(*) FILTER (NOT regexp_matches(r, '{"|".join(f"(?:{p})" for p in ref.REMOVED)}') AND NOT (n < 15 AND NOT regexp_matches(r, '[0-9]{{4}}'))) AS kept FROM ({_LINES}) GROUP BY doc_id
""")
def _(t, spark):
    lines = F.split("text", "\n")
    return t("documents").select("doc_id", F.size(lines).cast("long").alias("lines"), F.size(ref.without_non_references(lines)).cast("long").alias("kept"))


@query("flt1_filled", "SELECT doc_id FROM documents WHERE text IS NOT NULL AND text <> '' AND text <> '[]' AND source IS NOT NULL AND source <> ''")
def _(t, spark):
    from scriptorium.functions.text import present

    return t("documents").where(present(F.col("text"), True) & present(F.col("source"))).select("doc_id")


@query("ext6_emails", """
SELECT doc_id, list_sort(list_distinct(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'))) AS emails FROM documents
WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')
""")
def _(t, spark):
    found = F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), F.lit(0))))
    return t("documents").select("doc_id", found.alias("emails")).where(F.size("emails") > 0)


_LINK = '<a href="([^"]*)">([^<]*)</a>'


@query("ext14_html_links", f"""
WITH p AS (SELECT page_id, regexp_extract_all(html, '{_LINK}', 1) AS hrefs, regexp_extract_all(html, '{_LINK}', 2) AS names FROM pages)
SELECT DISTINCT page_id, hrefs[i] AS href, names[i] AS name FROM (SELECT *, unnest(generate_series(1, len(hrefs))) AS i FROM p)
""")
def _(t, spark):
    """Address and name of every page's links, each pair once (EXT14): one pattern says both."""
    group = lambda k: F.regexp_extract_all("html", F.lit(_LINK), F.lit(k))
    pairs = F.array_distinct(F.arrays_zip(group(1).alias("h"), group(2).alias("n")))
    return t("pages").select("page_id", F.explode(pairs).alias("pair")).select("page_id", F.col("pair.h").alias("href"), F.col("pair.n").alias("name"))


_PAPERS = [
    (1, "TÍTULO\nJoão Silva\n\nResumo: " + "Este trabalho estuda a casa moderna no nordeste do país. " * 2 + "\nPalavras-chave: casa; moderno; nordeste.\nAbstract: " + "This paper studies the modern house of the northeast. " * 2 + "\nKeywords: house; modern.\n1. Introdução\nTexto.\nReferências\nSILVA, João. Casa moderna. Recife, 1999.\ncontinuação da primeira.\nSOUZA, Maria. Outra casa. 2001.\nAnexos\nfim"),
    (2, "Sem seções."),
    (3, "Resumo: curto.\nPalavras-chave: a, b."),
]


@case("ext2_section_fields", f"""
SELECT k, CASE WHEN length(a) > 50 AND length(a) <= 5000 THEN a END AS abstract, nullif(kw, '') AS keywords, CASE WHEN length(en) > 50 THEN en END AS abstract_en, nullif(string_split(refs, chr(10) || 'Anexos')[1], '') AS refs FROM (
SELECT k, trim(regexp_extract(x, '(?s)Resumo:\\s*(.*?)\\n(?:Palavras-chave|Abstract)', 1)) AS a, trim(regexp_extract(x, 'Palavras-chave:\\s*([^\\n]*)', 1)) AS kw,
trim(regexp_extract(x, '(?s)Abstract:\\s*(.*?)\\n(?:Keywords|1\\.)', 1)) AS en, trim(regexp_extract(x, '(?s)\\nReferências\\n(.*)$', 1)) AS refs FROM {values(_PAPERS, 'k, x')})
""")
def _(t, spark):
    """Abstracts, keywords and the reference section (EXT2 to EXT4, REF15)."""
    from scriptorium.operators.extract import sections

    return sections(spark.createDataFrame(_PAPERS, "k int, x string"), "x").drop("x")


#: Words that look like a surname after an end and are none.
_NO_SURNAMES = "disponível acesso recuperado tese dissertação revista caderno recife natal paris london tradução available in the le la".split()
_STOP_SQL = literal(_NO_SURNAMES)
_UP, _LOW = split_references._UP, split_references._LOW


@query("ref7_author_shapes", f"""
SELECT doc_id, pos, regexp_matches(r, '^[{_UP}][{_UP}\\s]+[{_UP}]\\s*,\\s*[{_UP}]') AND NOT list_contains({_STOP_SQL}, lower(trim(string_split(r, ',')[1]))) AS caps,
  regexp_matches(r, '^[{_UP}][{_LOW}]+(?:\\s+[{_LOW}]+)*,\\s*[{_UP}]') AND length(string_split(r, ',')[1]) >= 3 AND NOT list_contains({_STOP_SQL}, lower(regexp_extract(r, '^([{_UP}][{_LOW}]+)', 1))) AS mixed
FROM ({_LINES})
""")
def _(t, spark):
    """Which lines begin like an author."""
    from scriptorium.functions.text import strip

    r = strip(F.col("ref"))
    return _lines(t).select("doc_id", F.col("pos").cast("long").alias("pos"), split_references.caps_author(r, _NO_SURNAMES).alias("caps"), split_references.mixed_author(r, _NO_SURNAMES).alias("mixed"))


@query("ref9_thinned_positions", """
WITH RECURSIVE l AS (SELECT l_orderkey AS k, list(DISTINCT l_partkey % 200 ORDER BY l_partkey % 200) AS ps FROM lineitem GROUP BY l_orderkey),
r AS (SELECT k, ps, 2 AS i, [ps[1]] AS kept FROM l UNION ALL SELECT k, ps, i + 1, CASE WHEN ps[i] - kept[len(kept)] > 10 THEN list_append(kept, ps[i]) ELSE kept END FROM r WHERE i <= len(ps))
SELECT k, array_to_string(kept, ',') AS kept FROM r WHERE i = len(ps) + 1
""")
def _(t, spark):
    """Positions thinned in order, the parts of an order standing for them."""
    p = t("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_set((F.col("l_partkey") % 200).cast("int"))).alias("ps"))
    return p.select("k", F.array_join(split_references.thinned(F.col("ps")), ",").alias("kept"))


@query("ref11_footnotes", f"""
WITH f AS (SELECT doc_id, pos, trim(regexp_replace(r, '^[0-9]+\\s+', '')) AS x FROM ({_LINES})),
w AS (SELECT *, list_filter(regexp_split_to_array(x, '[\\s\\p{{Z}}]+'), lambda w: w <> '') AS ws FROM f)
SELECT doc_id, pos FROM w WHERE length(x) < 15 OR (NOT regexp_matches(left(x, 150), '[{_UP}]{{2,}},\\s*[A-Z]|[A-Z][a-z]+,\\s*[A-Z][a-z]')
  AND NOT (regexp_matches(x, '^[{_UP}][{_UP}\\s]+[{_UP}]\\s*,\\s*[{_UP}]') AND NOT list_contains({_STOP_SQL}, lower(trim(string_split(x, ',')[1]))))
  AND NOT (regexp_matches(x, '^[{_UP}][{_LOW}]+(?:\\s+[{_LOW}]+)*,\\s*[{_UP}]') AND length(string_split(x, ',')[1]) >= 3 AND NOT list_contains({_STOP_SQL}, lower(regexp_extract(x, '^([{_UP}][{_LOW}]+)', 1))))
  AND len(ws) > 8 AND len(list_filter(ws, lambda w: list_contains({literal(split_references.FOOTNOTE_WORDS)}, lower(w)))) / len(ws) > 0.30)
""")
def _(t, spark):
    """Lines that are footnotes or running text."""
    return _lines(t).where(split_references.is_footnote(F.col("ref"), _NO_SURNAMES)).select("doc_id", F.col("pos").cast("long").alias("pos"))


_RUN_ON = [
    (1, ["SILVA, João. Casa moderna no nordeste do Brasil. Recife: Nova Editora, 1999. SOUZA, Maria. Outra casa. Natal: Editora, 2001."]),
    (2, ["curta", "  ", "SILVA, João. Uma obra só, sem outra. Recife: Nova Editora, 1999."]),
    (3, ["LIMA, Ana. Arquitetura moderna no Recife e no nordeste. 1998 \u23d0 12 que se viu na casa de uma rua que foi para o mar de todos os dias"]),
    (4, ["Costa, Rui. Um livro com um título bem comprido mesmo. Natal, 2003. Disponível, A. em algum lugar da rede mundial de computadores"]),
]
_RUN_ON_WANT = [
    (1, ["SILVA, João. Casa moderna no nordeste do Brasil. Recife: Nova Editora, 1999.", "SOUZA, Maria. Outra casa. Natal: Editora, 2001."]),
    (2, ["curta", "SILVA, João. Uma obra só, sem outra. Recife: Nova Editora, 1999."]),
    (3, ["LIMA, Ana. Arquitetura moderna no Recife e no nordeste. 1998"]),
    (4, ["Costa, Rui. Um livro com um título bem comprido mesmo. Natal, 2003. Disponível, A. em algum lugar da rede mundial de computadores"]),
]


@case("ref12_split_concatenated", "SELECT * FROM " + values(_RUN_ON_WANT, "k, refs"))
def _(t, spark):
    """Boundaries found, thinned, cut and filtered (REF7 to REF12)."""
    return spark.createDataFrame(_RUN_ON, "k int, refs array<string>").select("k", split_references.split_concatenated(F.col("refs"), _NO_SURNAMES).alias("refs"))
