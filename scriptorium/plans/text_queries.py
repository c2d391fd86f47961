"""Queries over strings, dictionaries, capitalization and citation records, mostly on literal rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import text as tx
from scriptorium.operators import capitalize, cite
from scriptorium.operators import relational as ops
from scriptorium.plans.catalogue import case, query, values

_TEXTS = [
    (1, "Rino Levi - obra", "Natal-rn"), (2, "1930 - 1960", "cria-se"), (3, "casas 1930-1945", "Recife (pe) e Olinda/pe."), (4, "  a  b\t c ", "no estado de Sergipe"),
    (5, "no município do Recife", "10-20 x 2001-02"), (6, "a & b <c> \"d\"", "sem nada"),
]
_COLS = "id, a, b"


def _texts(spark):
    return spark.createDataFrame(_TEXTS, "id int, a string, b string")


@case("str5_collapse", f"SELECT id, trim(regexp_replace(a, '[\\s\\p{{Z}}]+', ' ', 'g')) AS a FROM {values(_TEXTS, _COLS)}")
def _(t, spark):
    return _texts(spark).select("id", tx.collapse(F.col("a")).alias("a"))


@case("str12_em_dash", f"SELECT id, regexp_replace(a, '([a-zA-ZÀ-ú]) - ([a-zA-ZÀ-ú])', '\\1 — \\2', 'g') AS a FROM {values(_TEXTS, _COLS)}")
def _(t, spark):
    return _texts(spark).select("id", tx.em_dash(F.col("a")).alias("a"))


_STATES_WANT = [(1, "Natal-RN"), (2, "cria-se"), (3, "Recife (PE) e Olinda/PE."), (4, "no estado de Sergipe"), (5, "10-20 x 2001-02"), (6, "sem nada")]


@case("str13_states", "SELECT * FROM " + values(_STATES_WANT, "id, b"))
def _(t, spark):
    return _texts(spark).select("id", tx.upper_states(F.col("b")).alias("b"))


@case("str14_regions", f"SELECT id, regexp_replace(regexp_replace(b, '\\bestado(\\s+d[eoa]s?\\s+[A-Z])', 'Estado\\1', 'g'), '\\bmunicípio(\\s+d[eoa]s?\\s+[A-Z])', 'Município\\1', 'g') AS b FROM {values(_TEXTS, _COLS)}")
def _(t, spark):
    return _texts(spark).select("id", tx.upper_regions(F.col("b")).alias("b"))


@case("str15_year_ranges", f"SELECT id, regexp_replace(b, '([0-9]{{4}})-([0-9]{{2,4}})\\b', '\\1–\\2', 'g') AS b FROM {values(_TEXTS, _COLS)}")
def _(t, spark):
    return _texts(spark).select("id", tx.year_ranges(F.col("b")).alias("b"))


@case("str20_xml_escape", f"SELECT id, replace(replace(replace(replace(a, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS a FROM {values(_TEXTS, _COLS)}")
def _(t, spark):
    return _texts(spark).select("id", tx.xml_escape(F.col("a")).alias("a"))


_TITLES = [(1, "Casa moderna: o caso de Natal"), (2, "Sem subtítulo"), (3, "A: B: C"), (4, "x:y")]


@case("str11_title_subtitle", f"""
SELECT id, trim(CASE WHEN instr(x, ': ') > 0 THEN substr(x, 1, instr(x, ': ') - 1) ELSE x END) AS title, CASE WHEN instr(x, ': ') > 0 THEN trim(substr(x, instr(x, ': ') + 2)) END AS subtitle FROM {values(_TITLES, 'id, x')}
""")
def _(t, spark):
    s = tx.title_and_subtitle(F.col("x"))
    return spark.createDataFrame(_TITLES, "id int, x string").select("id", s["title"].alias("title"), s["subtitle"].alias("subtitle"))


_KEYWORDS = [(1, '["a", "b c"]'), (2, "um; dois ;três."), (3, "x, y,z"), (4, "só"), (5, "• a\n- b\n"), (6, "")]
_KEYWORDS_WANT = [(1, ["a", "b c"]), (2, ["um", "dois", "três"]), (3, ["x", "y", "z"]), (4, ["só"]), (5, ["a", "b"])]


@case("str6_keyword_cascade", "SELECT * FROM " + values(_KEYWORDS_WANT, "id, k") + " UNION ALL SELECT 6, []")
def _(t, spark):
    return spark.createDataFrame(_KEYWORDS, "id int, x string").select("id", tx.keyword_list(F.col("x")).alias("k"))


_REPEATED = [(1, ["Casa", "casa", "Rua", "CASA", "rua"]), (2, ["a"])]


@case("set4_distinct_ignoring_case", "SELECT * FROM " + values([(1, ["Casa", "Rua"]), (2, ["a"])], "id, k"))
def _(t, spark):
    return spark.createDataFrame(_REPEATED, "id int, x array<string>").select("id", tx.distinct_ignoring_case(F.col("x")).alias("k"))


_FIXES = [(1, "abcdef", [(1, 2, "XX"), (4, 6, "")]), (2, "abc", [])]


@case("str18_span_fixes", "SELECT * FROM " + values([(1, "aXXcd"), (2, "abc")], "id, x"))
def _(t, spark):
    df = spark.createDataFrame(_FIXES, "id int, x string, f array<struct<start:int,stop:int,repl:string>>")
    return df.select("id", tx.replaced_spans(F.col("x"), F.col("f")).alias("x"))


@query("str24_slugs", """
SELECT p_partkey, array_to_string(list_slice(list_filter(string_split(regexp_replace(lower(strip_accents(p_name)), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> ''), 1, 6), '-') AS slug FROM part
""")
def _(t, spark):
    return t("part").select("p_partkey", tx.slug(F.col("p_name")).alias("slug"))


@query("str25_trailing_number", "SELECT DISTINCT source, CAST(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS INTEGER) AS n FROM documents")
def _(t, spark):
    return t("documents").select("source").distinct().withColumn("n", F.nullif(F.regexp_extract("source", r"([0-9]+)$", 1), F.lit("")).cast("int"))


@query("str29_locale", """
SELECT doc_id, CASE WHEN regexp_matches(lower(text), '(^|[^a-z])(the|and)([^a-z]|$)') THEN 'en' WHEN regexp_matches(lower(text), '(^|[^a-z])(der|und)([^a-z]|$)') THEN 'de' ELSE 'other' END AS locale FROM documents
""")
def _(t, spark):
    low = F.lower("text")
    return t("documents").select("doc_id", F.when(low.rlike("(^|[^a-z])(the|and)([^a-z]|$)"), "en").when(low.rlike("(^|[^a-z])(der|und)([^a-z]|$)"), "de").otherwise("other").alias("locale"))


_DICT = [
    ("brasília", "lugar", "Brasília"), ("bnh", "sigla", "BNH"), ("são paulo", "expressao", "São Paulo"), ("porto nacional", "expressao", "Porto Nacional"),
    ("brutalismo", "movimento", "Brutalismo"), ("paulista", "toponimico", "Paulista"), ("levi", "nome", "Levi"), ("arquitetura", "area", "Arquitetura"),
]
_CAPS = [
    (1, "MODERNO EM BRASÍLIA", False, "Moderno em Brasília"), (2, "O CASO DE SÃO PAULO", True, "o caso de São Paulo"), (3, "aeroporto nacional", True, "aeroporto nacional"),
    (4, "o brutalismo paulista", True, "o Brutalismo Paulista"), (5, "o estilo paulista", True, "o estilo paulista"), (6, "CONJUNTO DO BNH.", False, "Conjunto do BNH"),
    (7, "Causa? como e onde", False, "Causa? Como e onde"), (8, "RINO LEVI-OBRA", False, "Rino Levi-obra"), (9, None, False, None), (10, "A CASA E.U.A.", False, "A casa E.U.A."),
]


@case("cap2_capitalized_titles", "SELECT * FROM " + values([(i, w) for i, _, _, w in _CAPS], "id, title"))
def _(t, spark):
    """The three passes over a small dictionary (CAP1 to CAP4)."""
    df = spark.createDataFrame([(i, x, s) for i, x, s, _ in _CAPS], "id int, x string, s boolean")
    return capitalize.capitalized(df, "x", F.col("s"), _DICT, "title").select("id", "title")


@case("cap7_dictionary_stats", "SELECT category, count(*) AS n FROM " + values(_DICT, "word, category, canonical") + " GROUP BY category")
def _(t, spark):
    return spark.createDataFrame(_DICT, "word string, category string, canonical string").groupBy("category").agg(F.count(F.lit(1)).alias("n"))


_MORE = [("levi", "nome", "Levy", 1), ("rino", "nome", "Rino", 2), ("rino", "nome", "RINO", 3)]


@case("dml9_dictionary_seed", f"""
SELECT word, category, canonical FROM {values(_DICT, 'word, category, canonical')} UNION ALL
SELECT word, category, canonical FROM {values(_MORE, 'word, category, canonical, seq')} WHERE word NOT IN (SELECT word FROM {values(_DICT, 'word, category, canonical')}) QUALIFY row_number() OVER (PARTITION BY word ORDER BY seq) = 1
""")
def _(t, spark):
    """New words only; what is there is never overwritten."""
    old = spark.createDataFrame(_DICT, "word string, category string, canonical string")
    return ops.inserted(old, spark.createDataFrame(_MORE, "word string, category string, canonical string, seq int"), "word", "seq")


_FILES = [(1, "casa moderna natal.pdf"), (2, "escola parque recife.pdf")]
_ITEMS = [(10, "A Casa Moderna em Natal"), (11, "Escolas"), (12, "Escola-parque: Recife")]


@case("join14_token_overlap", "SELECT * FROM " + values([(10, 1, 3), (12, 2, 1)], "id, file, shared"))
def _(t, spark):
    """Files that share words with a title, without stop words; the side with the titles carries exploded words."""
    f = spark.createDataFrame(_FILES, "file int, name string").withColumn("w", F.explode(F.array_distinct(tx.words(tx.fold_key(F.regexp_replace("name", r"\.pdf$", ""))))))
    i = spark.createDataFrame(_ITEMS, "id int, title string").withColumn("w", F.explode(F.array_distinct(tx.words(F.regexp_replace(tx.fold_key(F.col("title")), "[:]", "")))))
    hits = i.join(f, "w").where(~F.col("w").isin("a", "em", "de")).groupBy("id", "file").agg(F.count(F.lit(1)).cast("int").alias("shared"))
    return ops.latest_per_key(hits, "id", [F.desc("shared"), F.asc("file")])


_AFF = [(1, "UFPE"), (2, "Universidade Federal de Pernambuco - Recife"), (3, "desconhecida")]
_AFF_DICT = [("ufpe", "UFPE", 1), ("universidade federal de pernambuco", "UFPE", 2), ("universidade", "Outra", 3)]


@case("join15_dictionary_lookup", f"""
WITH d AS (SELECT * FROM {values(_AFF_DICT, 'k, v, seq')}), a AS (SELECT * FROM {values(_AFF, 'id, x')})
SELECT id, coalesce((SELECT v FROM d WHERE k = lower(x)), (SELECT arg_min(v, seq) FROM d WHERE contains(lower(x), k) OR contains(k, lower(x)))) AS v FROM a
""")
def _(t, spark):
    """Exact, then the first entry that contains the text or is in it. The dictionary is a literal, so its size is known."""
    key = F.lower("x")
    exact, loose = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, v, _ in reversed(_AFF_DICT):
        exact = F.when(key == k, v).otherwise(exact)
        loose = F.when(key.contains(k) | F.lit(k).contains(key), v).otherwise(loose)
    return spark.createDataFrame(_AFF, "id int, x string").select("id", F.coalesce(exact, loose).alias("v"))


@query("join20_next_line", """
WITH p AS (SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) AS pos, string_split(text, chr(10)) AS ls FROM documents)
SELECT doc_id, pos - 1 AS pos, length(ls[pos]) AS n, length(ls[pos + 1]) AS n_next FROM p WHERE pos < len(ls)
""")
def _(t, spark):
    """Every line with the one after it."""
    lines = F.split("text", "\n")
    pairs = F.transform(F.slice(lines, F.lit(1), F.size(lines) - 1), lambda x, i: F.struct(F.length(x).cast("long").alias("n"), F.length(F.get(lines, i + 1)).cast("long").alias("n_next")))
    return t("documents").select("doc_id", F.posexplode(pairs).alias("pos", "x")).select("doc_id", F.col("pos").cast("long").alias("pos"), "x.n", "x.n_next")


_BOOKS = [(1, "Casa", "Silva", "Ana", 1999, "A & B"), (2, "Rua", "Lima", "Rui", 2001, None)]


@case("snk7_bibtex", f"""
SELECT id, '@article{{a' || id || ',' || chr(10) || '  title = {{' || title || '}},' || chr(10) || '  author = {{' || fam || ', ' || giv || '}},' || chr(10) || '  year = {{' || yr || '}}'
|| CASE WHEN pub IS NOT NULL THEN ',' || chr(10) || '  publisher = {{' || pub || '}}' ELSE '' END || chr(10) || '}}' AS bib FROM {values(_BOOKS, 'id, title, fam, giv, yr, pub')}
""")
def _(t, spark):
    df = spark.createDataFrame(_BOOKS, "id int, title string, fam string, giv string, yr int, pub string")
    return df.select("id", cite.bibtex("a", F.col("id"), {"title": F.col("title"), "author": F.concat_ws(", ", "fam", "giv"), "year": F.col("yr"), "publisher": F.col("pub")}).alias("bib"))


@case("snk7_ris", f"""
SELECT id, 'TY  - JOUR' || chr(10) || 'TI  - ' || title || chr(10) || 'AU  - ' || fam || ', ' || giv || chr(10) || 'PY  - ' || yr || CASE WHEN pub IS NOT NULL THEN chr(10) || 'PB  - ' || pub ELSE '' END || chr(10) || 'ER  - ' AS ris
FROM {values(_BOOKS, 'id, title, fam, giv, yr, pub')}
""")
def _(t, spark):
    df = spark.createDataFrame(_BOOKS, "id int, title string, fam string, giv string, yr int, pub string")
    return df.select("id", cite.ris({"TI": F.col("title"), "AU": F.concat_ws(", ", "fam", "giv"), "PY": F.col("yr"), "PB": F.col("pub")}).alias("ris"))


@case("snk3_xml_elements", f"""
SELECT id, '<article id="' || id || '"><title>' || replace(title, '&', '&amp;') || '</title><year>' || yr || '</year>' || CASE WHEN pub IS NOT NULL THEN '<publisher>' || replace(pub, '&', '&amp;') || '</publisher>' ELSE '' END || '</article>' AS xml
FROM {values(_BOOKS, 'id, title, fam, giv, yr, pub')}
""")
def _(t, spark):
    df = spark.createDataFrame(_BOOKS, "id int, title string, fam string, giv string, yr int, pub string")
    return df.select("id", cite.xml("article", F.col("id"), {"title": F.col("title"), "year": F.col("yr"), "publisher": F.col("pub")}).alias("xml"))


_EVENTS = [(1, "3º Seminário Casa Moderna Norte-Nordeste, 2010"), (2, "sem evento")]


@case("prj5_event_titles", f"""
SELECT id, nullif(regexp_extract(x, '^([0-9]+)º (\\S+) ', 1), '') AS no, nullif(regexp_extract(x, '([0-9]{{4}})$', 1), '') AS yr FROM {values(_EVENTS, 'id, x')}
""")
def _(t, spark):
    return spark.createDataFrame(_EVENTS, "id int, x string").select("id", F.nullif(F.regexp_extract("x", r"^([0-9]+)º (\S+) ", 1), F.lit("")).alias("no"), F.nullif(F.regexp_extract("x", "([0-9]{4})$", 1), F.lit("")).alias("yr"))


@query("prj3_surrogate_ids", "SELECT o_orderkey, o_custkey || '-' || lpad(CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS VARCHAR), 3, '0') AS id FROM orders")
def _(t, spark):
    from pyspark.sql import Window

    no = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return t("orders").select("o_orderkey", F.format_string("%d-%03d", "o_custkey", no).alias("id"))


@query("prj6_series_of_id", "SELECT c_custkey, regexp_extract(c_name, '^(.*)#([0-9]+)$', 1) AS series, CAST(nullif(regexp_extract(c_name, '^(.*)#([0-9]+)$', 2), '') AS BIGINT) AS no FROM customer")
def _(t, spark):
    p = r"^(.*)#([0-9]+)$"
    return t("customer").select("c_custkey", F.regexp_extract("c_name", p, 1).alias("series"), F.nullif(F.regexp_extract("c_name", p, 2), F.lit("")).cast("long").alias("no"))


@query("prj10_defaults", "SELECT doc_id, coalesce(nullif(lang, 'en'), 'pt-BR') AS locale, coalesce(CAST(quality AS VARCHAR), 'none') AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def _(t, spark):
    return t("documents").join(t("labels"), "doc_id", "left").select("doc_id", F.coalesce(F.nullif(F.col("lang"), F.lit("en")), F.lit("pt-BR")).alias("locale"), F.coalesce(F.col("quality").cast("string"), F.lit("none")).alias("quality"))


@query("flt2_like", "SELECT c_custkey FROM customer WHERE c_mktsegment NOT ILIKE 'buil%' AND c_name LIKE '%1%'")
def _(t, spark):
    return t("customer").where(~F.col("c_mktsegment").ilike("buil%") & F.col("c_name").contains("1")).select("c_custkey")


@query("flt5_recheck", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE NOT coalesce(n_chars >= 1000 AND quality = 1, false)")
def _(t, spark):
    """Rows stay unless both conditions hold; null counts as not holding."""
    d = t("documents").join(t("labels"), "doc_id", "left")
    return d.where(~F.coalesce((F.col("n_chars") >= 1000) & (F.col("quality") == 1), F.lit(False))).select("doc_id")


_NEAR = [(1, "O edifício Copan e a casa Cor de rosa"), (2, "casa Modernista"), (3, "sem nada")]


@case("str16_generics", "SELECT 1 AS id, ['edifício', 'casa'] AS g UNION ALL SELECT 2, [] UNION ALL SELECT 3, []")
def _(t, spark):
    return spark.createDataFrame(_NEAR, "id int, x string").select("id", tx.lower_generics(F.col("x")).alias("g"))


_LISTED = [(1, ["1. casa", "rua", "2) vila", "CONCRETO ARMADO NO BRASIL"], "Silva de Souza Neto"), (2, ["concreto. Curitiba. 32", "keywords: x"], "Lima")]


@case("str17_numbered_and_long", "SELECT 1 AS id, ['1. casa', '2) vila'] AS k, true AS long UNION ALL SELECT 2, [], false")
def _(t, spark):
    return spark.createDataFrame(_LISTED, "id int, k array<string>, f string").select("id", tx.numbered(F.col("k")).alias("k"), tx.many_words(F.col("f")).alias("long"))


@query("str9_usable_keywords", r"""
WITH l AS (SELECT doc_id, i, string_split(text, chr(10))[i] AS line FROM (SELECT doc_id, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents)),
p AS (SELECT doc_id, i, j, regexp_replace(regexp_replace(string_split_regex(line, '\.[ \t\n\x0B\f\r]+')[j], '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '[.;,]+$', '') AS k
  FROM (SELECT *, unnest(generate_series(1, len(string_split_regex(line, '\.[ \t\n\x0B\f\r]+')))) AS j FROM l)),
u AS (SELECT *, length(regexp_replace(k, '[^\p{L}]', '', 'g')) AS n, length(regexp_replace(k, '[^\p{Lu}]', '', 'g')) AS c FROM p)
SELECT doc_id, list(k ORDER BY i, j) AS k FROM u
WHERE k <> '' AND NOT regexp_matches(k, '^[0-9]+$') AND length(k) <= 100 AND NOT (n > 12 AND c > 0.55 * n)
  AND NOT regexp_matches(k, '(?i)^(palavras?[- ]chave|keywords?|abstract|resumo)([^\p{L}\p{N}_]|$)') GROUP BY doc_id
""")
def _(t, spark):
    """The rule over the lines of every document, which stand for keywords."""
    return t("documents").select("doc_id", tx.usable_keywords(F.split("text", "\n")).alias("k")).where(F.size("k") > 0)


@case("str10_trailing_event", "SELECT * FROM " + values([(1, "casa moderna"), (2, "rua")], "id, k"))
def _(t, spark):
    df = spark.createDataFrame([(1, "casa moderna. 5º Seminário Casa Moderna Sul"), (2, "rua")], "id int, k string")
    return df.select("id", tx.without_trailing_event(F.col("k"), r"\d+º\s+seminário").alias("k"))


@case("str23_running_header", "SELECT 1 AS id, ['SILVA, A. Um.', 'LIMA, B. Dois.'] AS r")
def _(t, spark):
    df = spark.createDataFrame([(1, ["ATAS 5", "ATAS 5 SILVA, A. Um.", "LIMA, B. ATAS 5 Dois."])], "id int, r array<string>")
    return df.select("id", tx.without_running_header(F.col("r"), "ATAS 5").alias("r"))


@case("str28_name_lists", "SELECT * FROM " + values([(1, "Silva, Ana; Instituto")], "id, n"))
def _(t, spark):
    df = spark.createDataFrame([(1, [("Ana", "Silva"), ("", "Instituto")])], "id int, p array<struct<given:string,family:string>>")
    return df.select("id", tx.name_list(F.col("p")).alias("n"))


@case("str30_leading_phrases", "SELECT * FROM " + values([(1, "Texto"), (2, "Um texto")], "id, x"))
def _(t, spark):
    df = spark.createDataFrame([(1, "Página 3 A. Texto"), (2, "Um texto")], "id int, x string")
    return df.select("id", tx.without_intro(F.col("x"), [r"Página \d+", r"[A-Z]\."]).alias("x"))


@case("nam16_clean_authors", "SELECT * FROM " + values([(1, "João da Silva"), (2, "Ana Lima")], "id, n"))
def _(t, spark):
    df = spark.createDataFrame([(1, "Prof. Dr. João\n da Silva."), (2, "Ana Lima, MSc.")], "id int, n string")
    return df.select("id", tx.clean_author(F.col("n")).alias("n"))


@case("win13_first_page_with_key", "SELECT * FROM " + values([(1, 2), (2, None)], "id, page"))
def _(t, spark):
    """The first page, from the second on, whose beginning has the key."""
    df = spark.createDataFrame([(1, "casa\fx\fy casa\fcasa"), (2, "a\fb")], "id int, x string")
    hits = F.filter(F.transform(F.split("x", "\f"), lambda p, i: F.when((i >= 1) & F.substring(p, 1, 600).contains("casa"), i)), lambda i: i.isNotNull())
    return df.select("id", F.array_min(hits).alias("page"))


_MINE = [(1, "Ana Lima"), (2, "Rui"), (3, "Eva")]
_THEIRS = [(1, "Ana"), (2, "Rui Costa"), (3, "Rui Sá")]


@case("join19_either_contains", "SELECT * FROM " + values([(1, 1), (2, 2)], "id, other"))
def _(t, spark):
    """Authors with the first extracted one that contains them or is contained, met on a shared word."""
    word = lambda c: F.explode(F.array_distinct(tx.words(F.lower(c))))
    a = spark.createDataFrame(_MINE, "id int, n string").withColumn("w", word("n"))
    b = spark.createDataFrame(_THEIRS, "other int, m string").withColumn("w", word("m"))
    hits = a.join(b, "w").where(F.lower("n").contains(F.lower("m")) | F.lower("m").contains(F.lower("n"))).select("id", "other").distinct()
    return ops.latest_per_key(hits, "id", [F.asc("other")])
