"""Queries over layouts of nested files, snapshots, reports, exports by edition, and papers assembled from their text. Files and
papers are written from the columns of a whole table and read back, so that the SQL can say what must come out."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scriptorium.functions import curation as cu
from scriptorium.functions import names as nm
from scriptorium.functions import references as ref
from scriptorium.functions.text import canonical_fold
from scriptorium.operators import extract
from scriptorium.plans.catalogue import query
from scriptorium.plans.reference_queries import _LINES, _lines
from scriptorium.sources import nested, sinks
from scriptorium.sources.shared import dealt, shared_dir


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/library-{uuid.uuid4().hex}"


@query("src2_three_layouts", """
SELECT 'c' || CAST(o_custkey AS VARCHAR) AS slug, 'Of ' || CAST(o_custkey AS VARCHAR) AS seminar_title, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS seq,
  'o' || CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title, [o_orderstatus, o_orderpriority] AS keywords FROM orders
""")
def _(t, spark):
    """A document for each customer with its orders as articles, in one of three layouts, read to one schema."""
    item = F.struct("o_orderkey", F.expr("concat('o', o_orderkey)").alias("id"), F.col("o_orderpriority").alias("p"), F.array("o_orderstatus", "o_orderpriority").alias("k"))
    per = t("orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(item)).alias("a"))
    slug, title = F.expr("concat('c', o_custkey)").alias("slug"), F.expr("concat('Of ', o_custkey)")
    articles = lambda *names: F.transform("a", lambda x: F.struct(x["id"].alias("id"), x["p"].alias(names[0]), x["k"].alias(names[1])))
    plain, other = articles("title", "keywords"), articles("titulo", "palavras_chave")
    issue = F.struct(F.struct(slug, title.alias("title")).alias("issue"), plain.alias("articles"))
    event = F.struct(slug, F.struct(title.alias("titulo")).alias("evento"), other.alias("artigos"))
    flat = F.struct(slug, title.alias("title"), other.alias("articles"))
    kind = F.col("o_custkey") % 3
    text = F.when(kind == 0, F.to_json(issue)).when(kind == 1, F.to_json(event)).otherwise(F.to_json(flat))
    files = per.select(F.expr("concat('f', o_custkey, '.json')").alias("path"), F.encode(text, "utf-8").alias("content"))
    return nested.parsed(files, as_json=True).select("slug", "seminar_title", "seq", "id", "title", "keywords")


@query("src3_articles_of_issue", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def _(t, spark):
    """The rows of one issue: its value, given as a parameter, is a filter that the scan takes."""
    return t("orders").where(F.col("o_orderstatus") == F.lit("F")).select("o_orderkey", "o_custkey", "o_totalprice")


@query("src4_joined_records", """
SELECT 'p' || CAST(p_partkey AS VARCHAR) AS slug, CASE WHEN p_size % 5 <> 0 THEN p_name || ' ' || p_type END AS ficha FROM part
""")
def _(t, spark):
    """Records of parts in one text for each brand and size, without separators, with folded bodies of two lines or none."""
    body = F.when(F.col("p_size") % 5 != 0, F.expr("concat('\nficha: >-\n  ', p_name, '\n  ', p_type)")).otherwise("")
    texts = t("part").groupBy("p_brand", "p_size").agg(F.array_join(F.collect_list(F.concat(F.expr("concat('slug: p', p_partkey)"), body)), "\n").alias("text"))
    return texts.select(F.explode(cu.joined_records(F.col("text"))).alias("r")).select("r.*")


@query("src12_registry_names", """
SELECT c_custkey, s_suppkey AS registered FROM customer LEFT JOIN supplier ON regexp_extract(c_name, '([0-9]+)$', 1) = regexp_extract(s_name, '([0-9]+)$', 1)
""")
def _(t, spark):
    """Names that a second table, the registry, knows under the same key; others have null."""
    key = lambda c: F.regexp_extract(c, r"(\d+)$", 1)
    known = t("supplier").select(key("s_name").alias("k"), F.col("s_suppkey").alias("registered"))
    return t("customer").select("c_custkey", key("c_name").alias("k")).join(known, "k", "left").drop("k")


@query("src13_saved_state", """
SELECT o_orderkey, o_custkey % 4 AS tries, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS found FROM orders WHERE o_orderstatus <> 'P'
""")
def _(t, spark):
    """A state written as JSON lines and read back to be resumed: what is pending is left out, a null field stays null."""
    folder = _folder(spark)
    state = F.struct("o_orderkey", (F.col("o_custkey") % 4).alias("tries"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("found"))
    t("orders").select(F.to_json(state).alias("value")).write.text(folder)
    kept = spark.read.text(folder).select(F.from_json("value", "o_orderkey bigint, tries bigint, status string, found string").alias("s")).select("s.*")
    return kept.where("status <> 'P'").drop("status")


@query("snk9_snapshot", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(t, spark):
    """A full copy, partitioned by a column, read back."""
    folder = _folder(spark)
    sinks.snapshot(t("customer").select("c_custkey", "c_name", "c_mktsegment"), folder, by="c_mktsegment")
    return spark.read.parquet(folder).select("c_custkey", "c_name", "c_mktsegment")


@query("dml1_full_reload", "SELECT p_partkey, p_name, p_size FROM part")
def _(t, spark):
    """A table that a second load replaces whole; nothing of the first is left."""
    folder = _folder(spark)
    rows = t("part").select("p_partkey", "p_name", "p_size")
    sinks.snapshot(rows.withColumn("p_partkey", F.col("p_partkey") + 1_000_000_000), folder)
    sinks.snapshot(rows, folder)
    return spark.read.schema(rows.schema).parquet(folder)


@query("snk10_json_report", "SELECT source, count(*) AS documents, sum(length(text)) AS chars, count(DISTINCT lang) AS langs FROM documents GROUP BY source")
def _(t, spark):
    """Figures for each source, written as a JSON report and read back."""
    folder = _folder(spark)
    sinks.report(t("documents").groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.length("text")).alias("chars"), F.countDistinct("lang").alias("langs")), folder)
    return spark.read.schema("source string, documents bigint, chars bigint, langs bigint").json(folder)


@query("snk13_report_lines", """
SELECT coalesce(lang, '-') || ': ' || CAST(n AS VARCHAR) || ' of ' || CAST(sum(n) OVER () AS VARCHAR) AS line FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
""")
def _(t, spark):
    """Lines of text for a reader: each group's count and the total."""
    return sinks.report_lines(t("documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang", "n")


_ARTICLE = """'<article no="' || CAST(no AS VARCHAR) || '"><title>' || p_name || ' &amp; ' || p_type || '</title><author seq="1" primary="true"><given>' || string_split(p_name, ' ')[1] || '</given><family>' || string_split(p_name, ' ')[2]
  || '</family></author><author seq="2"><given></given><family>' || p_type || '</family></author></article>'"""


@query("snk4_edition_xml", f"""
SELECT p_brand, (no - 1) // 8 AS batch, '<articles>' || chr(10) || string_agg({_ARTICLE}, chr(10) ORDER BY no) || chr(10) || '</articles>' AS document
FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS no FROM part) GROUP BY 1, 2
""")
def _(t, spark):
    """Documents of eight articles of an edition, with nested authors, the first being the contact."""
    word = lambda k: F.get(F.split("p_name", " "), F.lit(k))
    authors = F.array(F.struct(word(0).alias("given"), word(1).alias("family")), F.struct(F.lit(None).cast("string").alias("given"), F.col("p_type").alias("family")))
    articles = t("part").select("p_brand", "p_partkey", F.concat_ws(" & ", "p_name", "p_type").alias("title"), authors.alias("authors"))
    return sinks.edition_xml(articles, "p_brand", "p_partkey", 8)


@query("snk15_ordered_yaml", """
SELECT p_partkey, 'title: ' || p_name || chr(10) || 'section: ' || p_brand || chr(10) || 'keywords: ' || p_type || chr(10) || 'note: x' || CAST(p_size AS VARCHAR) AS document FROM part
""")
def _(t, spark):
    """Fields given in any order, written in the canonical one, unknown ones last."""
    fields = {"note": F.expr("concat('x', p_size)"), "keywords": F.col("p_type"), "section": F.col("p_brand"), "title": F.col("p_name")}
    return t("part").select("p_partkey", cu.yaml_in_order(fields, ["id", "title", "section", "keywords"]).alias("document"))


@query("prj1_first_of_synonyms", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN source WHEN 1 THEN '' ELSE lang END AS value FROM documents")
def _(t, spark):
    """The first of two fields that is not null; an empty one stays."""
    one = F.when(F.col("doc_id") % 3 == 1, "").when(F.col("doc_id") % 3 == 2, F.col("lang"))
    two = F.when(F.col("doc_id") % 3 != 2, F.col("source"))
    return t("documents").select("doc_id", extract.first_of(one, two).alias("value"))


@query("prj2_canonical_articles", """
SELECT 'p' || CAST(p_partkey AS VARCHAR) AS id, p_name AS title, p_brand AS section, '["' || p_type || '","' || p_brand || '"]' AS keywords, 'pt-BR' AS locale, CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS VARCHAR) END AS pages, CAST(NULL AS VARCHAR) AS abstract FROM part
""")
def _(t, spark):
    """Columns under either of their names become one canonical row; lists become JSON text."""
    size = F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_size").cast("string"))
    odd = F.col("p_partkey") % 2 == 1
    raw = t("part").select(
        F.expr("concat('p', p_partkey)").alias("id"), F.when(odd, F.col("p_name")).alias("title"), F.when(~odd, F.col("p_name")).alias("titulo"),
        F.col("p_brand").alias("secao"), F.array("p_type", "p_brand").alias("palavras_chave"), size.alias("paginas"),
    )
    return nested.canonical(raw).select("id", "title", "section", "keywords", "locale", "pages", "abstract")


@query("str2_canonical_fold", r"""
SELECT doc_id, md5(regexp_replace(lower(strip_accents(text)), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS folded FROM documents
""")
def _(t, spark):
    """Digests of whole texts without marks, in lower case."""
    return t("documents").select("doc_id", F.md5(canonical_fold(F.col("text")).cast("binary")).alias("folded"))


@query("nam17_name_words", r"""
SELECT lower(w) AS word, upper(substr(w, 1, 1)) || substr(w, 2) AS canonical, count(DISTINCT p_partkey) AS n
FROM (SELECT p_partkey, regexp_replace(unnest(string_split(p_name || ' de ' || p_brand || ' ' || p_type || ' A.B.', ' ')), '[^\p{L}\p{N}_]', '', 'g') AS w FROM part)
WHERE length(w) >= 2 AND lower(w) <> 'de' AND NOT regexp_matches(w, '^[A-Z]+$') GROUP BY 1, 2
""")
def _(t, spark):
    """Words of names for the dictionary, with how many have them; particles and initials, thus words in capitals, are none."""
    found = nm.name_words(F.concat_ws(" de ", "p_name", "p_brand"), F.concat_ws(" ", "p_type", F.lit("A.B.")))
    return t("part").select(F.explode(found).alias("w")).groupBy("w.word", "w.canonical").agg(F.count(F.lit(1)).alias("n"))


_STARTS = "^(?:" + "|".join(ref.ENTRY_STARTS) + ")"
_SURNAMES = "^(?:" + "|".join(ref.SURNAME_STARTS) + ")"
_BLANK = r"'^[\s\p{Z}]+|[\s\p{Z}]+$'"


@query("ref16_entry_starts", f"SELECT doc_id, pos, regexp_matches(r, '{_STARTS}') AS begins FROM ({_LINES})")
def _(t, spark):
    """Which lines begin an entry."""
    return _lines(t).select("doc_id", "pos", ref.begins_with(F.col("ref"), ref.ENTRY_STARTS).alias("begins"))


@query("ref17_without_short_entries", r"""
SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(trim(regexp_replace(x, '[\s\p{Z}]+', ' ', 'g')), '\s+[0-9]{1,3}$', '')),
  lambda r: length(r) >= 15 AND NOT (starts_with(r, 'http') AND NOT contains(r, ' ') AND length(r) < 50) AND NOT regexp_matches(r, '^[0-9\s./-]+$')) AS refs FROM documents
""")
def _(t, spark):
    """The lines of documents as entries, cleaned."""
    return t("documents").select("doc_id", ref.without_short_entries(F.split("text", "\n")).alias("refs"))


def _entries_sql(pattern: str, source: str) -> str:
    return f"""
SELECT doc_id, list(entry ORDER BY no) AS e FROM (SELECT doc_id, no, string_agg(r, ' ' ORDER BY pos) AS entry FROM
(SELECT *, sum(CASE WHEN first OR regexp_matches(r, '{pattern}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS no FROM
(SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) = 1 AS first FROM ({source}) WHERE r <> '')) GROUP BY doc_id, no) GROUP BY doc_id"""


@query("ref18_list_entries", f"""
SELECT d.doc_id, CASE WHEN text IS NOT NULL THEN coalesce(CASE WHEN coalesce(len(a.e), 0) <= 2 AND length(text) > 300 THEN b.e ELSE a.e END, []) END AS entries FROM documents d
LEFT JOIN ({_entries_sql(_STARTS, _LINES)}) a ON a.doc_id = d.doc_id LEFT JOIN ({_entries_sql(_SURNAMES, _LINES)}) b ON b.doc_id = d.doc_id
""")
def _(t, spark):
    """The entries of lists with broken lines; where few are found in a long text, by surnames in capitals."""
    return t("documents").select("doc_id", ref.list_entries(F.col("text")).alias("entries"))


_PAPER = """concat('Eixo ', p_size, ' - ', p_brand, '\n', upper(p_name), '\nLima, Ana; Rui SOUZA\n', 'Resumo:\nO texto sobre ', p_name, ' e ', p_type, '.\nPalavras-chave: ', p_type, '; ', p_brand, '.\n',
'1. Texto\nCorpo\nReferências\nSILVA, A. ', p_name, '. Recife: Casa,\n  de 1999. 12\n12\nBRASIL. ', p_type, ' e outros. Natal, 2001.\nAnexos\nfim')"""
_LABELS = {"abstract": "Resumo", "keywords": "Palavras-chave", "refs": ["Referências", "Bibliografia"], "ends": ["Anexos"], "next_label": r"1\."}


@query("ext15_edition_fields", """
SELECT p_partkey, 'El texto sobre ' || p_name || '.' AS abstract, [p_type, p_brand] AS keywords, ['LIMA, Ana. ' || p_name || ' en Natal. 1999.', '[2] ' || p_type || ' y otros. 2001.'] AS refs FROM part
""")
def _(t, spark):
    """Fields of an edition whose papers have labels in another language."""
    text = F.expr("concat('Resumen:\nEl texto sobre ', p_name, '.\nPalabras clave: ', p_type, ', ', p_brand, '\nTexto\nBibliografía\nLIMA, Ana. ', p_name, '\nen Natal. 1999.\n[2] ', p_type, ' y otros. 2001.\n')")
    fields = extract.labelled(text, abstract="Resumen", keywords="Palabras clave", refs=["Referencias", "Bibliografía"], ends=["Anexos"], next_label="Abstract")
    return t("part").select("p_partkey", *[c.alias(n) for n, c in fields.items()])


@query("ext16_assembled_articles", """
SELECT p_partkey, 'Eixo ' || CAST(p_size AS VARCHAR) || ' - ' || p_brand AS axis, upper(p_name) AS title, ['Ana', 'Rui'] AS given, ['Lima', 'Souza'] AS family, 'O texto sobre ' || p_name || ' e ' || p_type || '.' AS abstract,
  [p_type, p_brand] AS keywords, ['SILVA, A. ' || p_name || '. Recife: Casa, de 1999. 12', 'BRASIL. ' || p_type || ' e outros. Natal, 2001.'] AS refs FROM part
""")
def _(t, spark):
    """A paper's text for each part, taken apart into one article."""
    parts = dealt(t("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))  # a file of few letters is one task, a part takes long
    papers = extract.assembled(parts.select("p_partkey", F.expr(_PAPER).alias("text")), "text", _LABELS)
    of = lambda name: F.transform("authors", lambda a: a[name])
    return papers.select("p_partkey", "axis", "title", of("given").alias("given"), of("family").alias("family"), "abstract", "keywords", "refs")
