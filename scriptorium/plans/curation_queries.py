"""Queries over headers, contents, codes, corrections and exports. Header and contents texts are written from the columns of a
table, whole, so that what is read back from them can be held against those columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import curation as cu
from scriptorium.operators import entities as er
from scriptorium.operators import headers as hd
from scriptorium.operators import relational as ops
from scriptorium.plans.catalogue import literal, query, values

# People in customer: letters for digits give names; each nation is a paper.
_NAME = "upper(substr(translate(cast(c_custkey as {s}), '0123456789', 'bcdfghjklm'), 1, 1)) || substr(translate(cast(c_custkey as {s}), '0123456789', 'bcdfghjklm'), 2) || ' Maria'"
_PEOPLE_SQL = f"(SELECT c_nationkey AS k, c_custkey AS id, {_NAME.format(s='varchar')} AS given, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS family, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS no FROM customer)"


def _people(t):
    p = t("customer").selectExpr("c_nationkey k", "c_custkey id", f"{_NAME.format(s='string')} given", "upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) family")
    w = F.row_number().over(ops.Window.partitionBy("k").orderBy("id"))
    return p.withColumn("no", w.cast("long"))


def _papers(people, *line):
    """One text for each k: the given lines of each person, in order."""
    lines = people.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("no", *[F.expr(x).alias(f"x{i}") for i, x in enumerate(line)]))).alias("p"))
    join = lambda i: F.array_join(F.transform("p", lambda x: x[f"x{i}"]), "\n")
    return lines.select("k", F.concat_ws("\n", *[join(i) for i in range(len(line))]).alias("text"))


@query("ext7_numbered_authors", f"""
SELECT k, no, given, family, 'Centro ' || CAST(id AS VARCHAR) AS affiliation, 'p' || CAST(id AS VARCHAR) || '@example.org' AS email, no = 1 AS main FROM {_PEOPLE_SQL}
""")
def _(t, spark):
    """``FAMILY, Given (n)`` with numbered notes, written from customers and read back."""
    papers = _papers(_people(t), "concat(upper(family), ', ', given, ' (', no, ')')", "concat(no, '. Centro ', id, ', p', id, '@example.org')")
    return papers.select("k", F.explode(hd.numbered_authors(F.col("text"))).alias("a")).select("k", "a.*")


@query("ext8_listed_authors", f"SELECT k, no, given, family FROM {_PEOPLE_SQL}")
def _(t, spark):
    """Lists of names in both orders, written from customers and read back."""
    people = _people(t)
    lists = people.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("no", F.expr("if(no % 2 = 0, concat(family, ', ', given), concat(given, ' ', upper(family)))").alias("x")))).alias("p"))
    found = lists.select("k", F.posexplode(hd.listed_authors(F.array_join(F.transform("p", lambda x: x["x"]), "; "))).alias("i", "a"))
    return found.select("k", (F.col("i") + 1).cast("long").alias("no"), "a.given", "a.family")


@query("ext9_line_kinds", rf"""
SELECT page_id, pos, CASE WHEN trim(line) = '' THEN 'blank' WHEN regexp_matches(line, '{hd.MAIL}') THEN 'email'
  WHEN regexp_matches(line, '(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:universidade|faculdade|instituto|escola|departamento|university|faculty|institute|school|department)(?:[^\p{{L}}\p{{N}}_]|$)') THEN 'affiliation'
  WHEN len(ws) >= 2 AND len(re) > 0 AND len(list_filter(re, lambda w: NOT regexp_matches(w, '^\p{{Lu}}'))) = 0 AND NOT ends_with(line, '.') AND NOT regexp_matches(line, '(?:^|[^0-9])[0-9]{{4}}(?:[^0-9]|$)') THEN 'name' ELSE 'other' END AS kind
FROM (SELECT *, list_filter(regexp_split_to_array(line, '[\s\p{{Z}}]+'), lambda w: w <> '') AS ws,
  list_filter(regexp_split_to_array(regexp_replace(line, '\s*\([^)]*\)', '', 'g'), '[\s\p{{Z}}]+'), lambda w: w <> '' AND NOT list_contains({literal(hd.PARTICLES)}, lower(w))) AS re
  FROM (SELECT doc_id AS page_id, i - 1 AS pos, trim(string_split(text, chr(10))[i]) AS line FROM (SELECT doc_id, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents)))
""")
def _(t, spark):
    """The kind of every line of every document."""
    return hd.lines_of(t("documents").withColumnRenamed("doc_id", "page_id"), "page_id", "text").select("page_id", F.col("pos").cast("long").alias("pos"), "kind")


@query("ext10_header_authors", f"""
SELECT k, no AS seq, given || ' ' || family AS name, 'Universidade ' || CAST(id AS VARCHAR) AS affiliation, 'p' || CAST(id AS VARCHAR) || '@example.org' AS email, 'Professora em ' || lower(family) AS bio FROM {_PEOPLE_SQL}
""")
def _(t, spark):
    """Name, affiliation, address and biography in lines, written from customers and read back."""
    papers = _papers(_people(t), "concat_ws('\n', concat(given, ' ', family), concat('Universidade ', id), concat('Professora em ', lower(family)), concat('p', id, '@example.org'))")
    return hd.header_authors(papers, "k", "text")


@query("win14_names_before_bio", f"SELECT k, list(given || ' ' || family ORDER BY no) AS names FROM {_PEOPLE_SQL} GROUP BY k")
def _(t, spark):
    """The block of names between a title and the first biography."""
    names = _papers(_people(t), "concat(given, ' ', family)")
    text = F.concat(F.lit("um título em letras pequenas\nOutro Nome no título\n1998\n"), "text", F.lit("\nProfessora de algo\nMais Um\nMestre em algo"))
    return hd.names_before_bio(names.withColumn("text", text), "k", "text")


_KEYS = [("FURN", "F-1"), ("MACH", "M-2"), ("AUTO", "A-3")]


@query("ext11_acronyms", """
SELECT c_custkey, CASE WHEN contains(x, 'FURN') THEN 'F-1' WHEN contains(x, 'MACH') THEN 'M-2' WHEN contains(x, 'AUTO') THEN 'A-3' WHEN c_nationkey % 3 = 0 THEN 'USP' WHEN c_nationkey % 3 = 1 THEN 'UFBA' END AS acronym
FROM (SELECT *, c_mktsegment AS x FROM customer)
""")
def _(t, spark):
    """Ordered keys first, then the last acronym that is known."""
    text = F.concat_ws(" ", F.lit("UFRN"), "c_mktsegment", F.when(F.col("c_nationkey") % 3 == 0, "USP").when(F.col("c_nationkey") % 3 == 1, "UFBA"))
    text = F.when(F.col("c_nationkey") % 3 == 2, F.col("c_mktsegment")).otherwise(text)
    return t("customer").select("c_custkey", hd.acronym(text, _KEYS).alias("acronym"))


@query("ext12_contents", """
SELECT p_brand AS k, row_number() OVER (PARTITION BY p_brand ORDER BY p_type, p_partkey) AS no, p_type AS section, 'Estudo de ' || p_name AS title, 'AUTOR ' || translate(CAST(p_size AS VARCHAR), '0123456789', 'ABCDEFGHIJ') AS authors, 1 + p_partkey % 900 AS page FROM part
""")
def _(t, spark):
    """A contents page for each brand, with sections by type, entries over two lines and dot leaders, written from parts and read back."""
    entry = "concat('● Estudo de ', p_name, '\n| AUTOR ', translate(cast(p_size as string), '0123456789', 'ABCDEFGHIJ'), ' ....... ', 1 + p_partkey % 900)"
    rows = t("part").selectExpr("p_brand k", "p_type", "p_partkey", f"{entry} x")
    w = ops.Window.partitionBy("k").orderBy("p_type", "p_partkey")
    rows = rows.withColumn("x", F.when(~F.col("p_type").eqNullSafe(F.lag("p_type").over(w)), F.concat(F.lit("Eixo | "), "p_type", F.lit("\n"), "x")).otherwise(F.col("x")))
    pages = rows.groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_type", "p_partkey", "x"))), lambda r: r["x"]), "\n").alias("text"))
    pages = pages.withColumn("text", F.concat(F.lit("SUMÁRIO\n"), "text", F.lit("\nNormas da edição\nAnexo 999")))
    return hd.contents(pages, "k", "text", r"^Eixo \| (.*)$", by=r"^(.*?)\s*\|\s*(.*)$", stop="^Normas")


@query("ext13_full_titles", "SELECT p_partkey, upper(p_name) || ' ' || upper(p_type) AS title FROM part")
def _(t, spark):
    """The title in capitals at the head of a text, found by how it begins."""
    text = F.concat(F.lit("Revista de algo\n"), F.upper("p_name"), F.lit("\n"), F.upper("p_type"), F.lit("\nAutor de tudo\nCorpo do texto"))
    return t("part").select("p_partkey", hd.full_title(text, F.col("p_name")).alias("title"))


@query("ext5_axes", """
SELECT s_suppkey, CASE WHEN s_nationkey % 4 = 0 THEN NULL WHEN s_nationkey % 4 = 1 THEN 'Eixo 1 - Obras' ELSE 'Eixo ' || CAST(s_nationkey % 4 AS VARCHAR) || ' - ' || lower(s_name) END AS axis FROM supplier
""")
def _(t, spark):
    """The thematic axis that a text names, with the name of the list or its own."""
    line = F.expr("concat('EIXO TEMÁTICO: ', s_nationkey % 4, ' – ', lower(s_name))")
    text = F.concat(F.lit("Um título\n"), F.when(F.col("s_nationkey") % 4 == 0, F.lit("sem nada")).otherwise(line), F.lit("\nfim"))
    return t("supplier").select("s_suppkey", hd.axis(text, {"1": "Obras"}).alias("axis"))


@query("src14_file_names", """
SELECT p_partkey, CAST(1 + p_size % 5 AS INTEGER) AS axis, [upper(p_type), upper(string_split(p_brand, '#')[1])] AS families, p_name AS title FROM part
""")
def _(t, spark):
    """Axis, family names and title of file names, written from parts and read back."""
    name = F.expr("concat('a/b/E0', 1 + p_size % 5, '-', p_type, ', I._ ', split(p_brand, '#')[0], '. ', p_name, '..PDF')")
    return t("part").select("p_partkey", hd.name_parts_of_file(name).alias("f")).select("p_partkey", "f.*")


@query("src15_files_by_stem", """
SELECT lower(p_name) || ' ' || CAST(p_partkey AS VARCHAR) AS stem, [p_name || ' ' || CAST(p_partkey AS VARCHAR) || '_artigo.docx'] AS docx,
  CASE WHEN p_size % 2 = 0 THEN [upper(p_name) || ' ' || CAST(p_partkey AS VARCHAR) || ' (1).pdf', p_name || ' ' || CAST(p_partkey AS VARCHAR) || '.PDF'] ELSE [] END AS pdf FROM part
""")
def _(t, spark):
    """Files that belong together by their stems."""
    names = F.expr("concat(array(concat(p_name, ' ', p_partkey, '_artigo.docx'), concat(p_name, ' ', p_partkey, '.txt')), if(p_size % 2 = 0, array(concat(p_name, ' ', p_partkey, '.PDF'), concat(upper(p_name), ' ', p_partkey, ' (1).pdf')), array()))")
    return hd.files_by_stem(t("part").select(F.explode(names).alias("name")), "name", ["_artigo", "com ID"], ["docx", "pdf"])


_TITLES = "CASE p_size % 8 WHEN 0 THEN 'Eixo Dois e mais' WHEN 1 THEN 'Mesa ' || p_partkey WHEN 2 THEN 'Sessão 3 Mesa 4' WHEN 3 THEN 'Sessão de comunicação 7' WHEN 4 THEN 'Painéis' WHEN 5 THEN 'Artigos — tema' WHEN 6 THEN 'Outros — tema' ELSE p_name END"


@query("prj7_section_codes", f"""
SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'EDois' WHEN 1 THEN 'M' || p_partkey WHEN 2 THEN 'SM3-4' WHEN 3 THEN 'SC7' WHEN 4 THEN 'PN' || p_partkey WHEN 5 THEN 'A' || p_partkey WHEN 6 THEN 'OU' || p_partkey ELSE 'SEC' || p_partkey END || '-' || p_type AS code FROM part
""")
def _(t, spark):
    """Codes by ordered patterns, by what stands before a dash, or by number."""
    return t("part").select("p_partkey", cu.section_code(F.expr(_TITLES), F.col("p_type"), F.col("p_partkey")).alias("code"))


_EVERY_LINE = "(SELECT doc_id, i - 1 AS pos, string_split(text, chr(10))[i] AS line FROM (SELECT doc_id, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents))"


def _every_line(t):
    return t("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("pos", F.col("pos").cast("long"))


@query("prj8_display_sections", f"SELECT doc_id, pos, CASE WHEN position(' the' IN line) > 1 THEN substr(line, 1, position(' the' IN line) - 1) ELSE line END AS section FROM {_EVERY_LINE}")
def _(t, spark):
    """Lines up to a marker."""
    return _every_line(t).select("doc_id", "pos", cu.display_section(F.col("line"), [" the"]).alias("section"))


@query("prj9_record_ids", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS id FROM part")
def _(t, spark):
    doi = F.expr("if(p_size % 3 = 0, concat('10.1/', p_partkey), concat('10.1/record.', p_partkey, if(p_size % 3 = 1, '/x', '')))")
    return t("part").select("p_partkey", cu.record_id(doi, "record.").alias("id"))


@query("flt3_glob", "SELECT doc_id FROM documents WHERE text GLOB '*the*an?*'")
def _(t, spark):
    return t("documents").where(cu.glob(F.col("text"), "*the*an?*")).select("doc_id")


@query("flt4_given_filters", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def _(t, spark):
    """Of three filters that may be asked for, two are."""
    wanted = {"status": "F", "least": 100000, "priority": None}
    c = lambda name, make: None if wanted[name] is None else make(wanted[name])
    return t("orders").where(cu.all_of(c("status", lambda v: F.col("o_orderstatus") == v), c("least", lambda v: F.col("o_totalprice") > v), c("priority", lambda v: F.col("o_orderpriority") == v))).select("o_orderkey")


@query("flt6_category_filter", "SELECT event_id, CASE event_type WHEN 'error' THEN 'bad' WHEN 'signup' THEN 'good' ELSE 'other' END AS category FROM events WHERE event_type IN ('error', 'signup')")
def _(t, spark):
    """Rows of some categories, which a map gives for each type."""
    kinds = F.create_map(*[F.lit(x) for x in ("error", "bad", "signup", "good")])
    category = F.coalesce(F.try_element_at(kinds, F.col("event_type")), F.lit("other"))
    return t("events").select("event_id", category.alias("category")).where(F.col("category").isin("bad", "good"))


_REPLACED = [("the", "THE"), ("and", "&"), ("THEm", "them")]


_WHOLE = "regexp_replace({0}, '(^|[^\\p{{L}}\\p{{N}}_])the([^\\p{{L}}\\p{{N}}_]|$)', '\\1THE\\2', 'g')"


@query("str21_literal_replacements", f"SELECT doc_id, md5(replace(replace(replace(text, 'the', 'THE'), 'and', '&'), 'THEm', 'them')) AS parts, md5({_WHOLE.format(_WHOLE.format('text'))}) AS same FROM documents")
def _(t, spark):
    """Replacements in order inside words, and one of whole words (two in a row take the SQL two passes)."""
    return t("documents").select("doc_id", F.md5(cu.replaced_all(F.col("text"), _REPLACED)).alias("parts"), F.md5(cu.replaced_all(F.col("text"), _REPLACED[:1], True)).alias("same"))


@query("str22_small_first", f"SELECT doc_id, pos, CASE WHEN starts_with(line, 'The ') THEN 't' || substr(line, 2) ELSE line END AS line FROM {_EVERY_LINE}")
def _(t, spark):
    return _every_line(t).select("doc_id", "pos", cu.small_first(F.col("line"), "The ").alias("line"))


@query("str26_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%Y/%m/%d') AS day, [year(o_orderdate), month(o_orderdate), day(o_orderdate)] AS parts FROM orders")
def _(t, spark):
    """The date forms of citation records."""
    d = F.col("o_orderdate")
    return t("orders").select("o_orderkey", F.date_format(d, "yyyy").alias("year"), F.date_format(d, "yyyy/MM/dd").alias("day"), F.array(F.year(d).cast("long"), F.month(d).cast("long"), F.dayofmonth(d).cast("long")).alias("parts"))


@query("str27_excerpts", r"""
WITH x AS (SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g')) AS s FROM pages)
SELECT page_id, CASE WHEN length(s) <= 200 THEN s ELSE coalesce(nullif(trim(regexp_extract(s, '^(.{0,200})(?: |$)', 1)), ''), left(s, 200)) || '…' END AS excerpt FROM x
""")
def _(t, spark):
    """Text of a page without tags, up to 200 characters."""
    return t("pages").select("page_id", cu.excerpt(F.col("html"), 200).alias("excerpt"))


@query("sort2_top_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 200")
def _(t, spark):
    """The cap of a report."""
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(200)


@query("sort6_capped_lists", "SELECT doc_id, len(list_slice(string_split(text, chr(10)), 1, 50)) AS n, list_slice(string_split(text, chr(10)), 1, 50)[-1] AS last FROM documents")
def _(t, spark):
    """At most 50 entries of a list."""
    refs = F.slice(F.split("text", "\n"), 1, 50)
    return t("documents").select("doc_id", F.size(refs).cast("long").alias("n"), F.element_at(refs, -1).alias("last"))


_GONE = "SELECT doc_id AS k, doc_id % 3 AS pos FROM documents UNION ALL SELECT doc_id, 2 FROM documents UNION ALL SELECT doc_id, 1000000 FROM documents"


@query("set3_removal_positions", f"SELECT k, list(DISTINCT pos ORDER BY pos) AS pos FROM ({_GONE}) GROUP BY k")
def _(t, spark):
    """Positions that several checks name, each once and in order."""
    d = t("documents")
    gone = d.selectExpr("doc_id k", "doc_id % 3 pos").unionByName(d.selectExpr("doc_id k", "2L pos")).unionByName(d.selectExpr("doc_id k", "1000000L pos"))
    return gone.groupBy("k").agg(F.array_sort(F.collect_set("pos")).alias("pos"))


@query("ref14_curated_removals", f"""
WITH l AS (SELECT doc_id AS k, i - 1 AS pos, string_split(text, chr(10))[i] AS line FROM (SELECT doc_id, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)))
SELECT k, count(g.pos IS NULL OR NULL) AS kept, coalesce(md5(string_agg(line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL)), md5('')) AS digest FROM l LEFT JOIN (SELECT DISTINCT * FROM ({_GONE})) g USING (k, pos) GROUP BY k
""")
def _(t, spark):
    """Lists without the entries that a table of positions names."""
    d = t("documents").selectExpr("doc_id k", "split(coalesce(text, ''), '\n') refs", "doc_id")
    gone = d.selectExpr("k", "doc_id % 3 pos").unionByName(d.selectExpr("k", "2L pos")).unionByName(d.selectExpr("k", "1000000L pos"))
    left = ops.without_positions(d, "k", "refs", gone)
    return left.select("k", F.size("refs").cast("long").alias("kept"), F.md5(F.array_join("refs", "\n")).alias("digest"))


@query("dml8_dictionary_by_priority", """
SELECT word, category FROM (SELECT word, category, row_number() OVER (PARTITION BY word ORDER BY rank DESC, category) AS n FROM (
SELECT p_type AS word, 'type' AS category, 0 AS rank FROM part UNION ALL SELECT string_split(p_name, ' ')[1], 'name', 1 FROM part UNION ALL SELECT upper(c_mktsegment), 'segment', 2 FROM customer)) WHERE n = 1
""")
def _(t, spark):
    """Categories loaded in a fixed order; a later one has the word."""
    p, c = t("part"), t("customer")
    word = lambda df, x, category: df.select(x.alias("word"), F.lit(category).alias("category"))
    return ops.by_priority([word(p, F.col("p_type"), "type"), word(p, F.get(F.split("p_name", " "), F.lit(0)), "name"), word(c, F.upper("c_mktsegment"), "segment")], "word")


_MERGED = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS a, o_orderstatus AS b FROM orders"


@query("dml10_kept_or_extracted", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'new' END ELSE o_orderpriority END AS a, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE o_orderstatus END AS b FROM orders")
def _(t, spark):
    """Fields keep what they have, but for those that new values overwrite."""
    old = t("orders").selectExpr("o_orderkey", "if(o_orderkey % 3 = 0, '', o_orderpriority) a", "o_orderstatus b")
    found = t("orders").where("o_orderkey % 2 = 0").selectExpr("o_orderkey", "'new' a", "'new' b")
    return ops.kept_or_extracted(old, found, "o_orderkey", ["a"], ["b"])


@query("dml11_dry_run", """
SELECT o_orderkey, 'status' AS field, o_orderstatus AS before, 'X' AS after FROM orders WHERE o_orderkey % 5 = 0 AND o_orderstatus <> 'X'
UNION ALL SELECT o_orderkey, 'priority', o_orderpriority, NULL FROM orders WHERE o_orderkey % 7 = 0
""")
def _(t, spark):
    """What an update would change, field by field."""
    old = t("orders").selectExpr("o_orderkey", "o_orderstatus status", "o_orderpriority priority")
    new = t("orders").selectExpr("o_orderkey", "if(o_orderkey % 5 = 0, 'X', o_orderstatus) status", "if(o_orderkey % 7 = 0, null, o_orderpriority) priority")
    return ops.changes(old, new, "o_orderkey", ["status", "priority"])


@query("er2_enriched_by_email", f"""
WITH p AS {_PEOPLE_SQL}
SELECT id, CASE WHEN no % 2 = 0 THEN given ELSE substr(given, 1, 1) || '.' END AS given, family, 'P' || CAST(id AS VARCHAR) || '@Example.org ' AS email, no % 4 = 0 AS enriched, NULL::BIGINT AS merge_into
FROM (SELECT id, given, family, no FROM p) WHERE no % 4 <> 2
UNION ALL SELECT id, substr(given, 1, 1) || '.', family, 'P' || CAST(id AS VARCHAR) || '@Example.org ', false, NULL FROM p WHERE no % 4 = 2
""")
def _(t, spark):
    """Initials become whole given names by address; every fourth author has a registered one, and odd ones are unknown there."""
    people = _people(t)
    authors = people.selectExpr("id", "substr(given, 1, 1) || '.' given", "family", "concat('P', id, '@Example.org ') email")
    return er.enriched_by_email(authors, people.where("no % 4 = 0").selectExpr("concat(' p', id, '@example.org') email", "given", "family"))


@query("er11_faculty_matches", """
SELECT c_custkey AS id, c_custkey + 1000000 AS member FROM customer WHERE c_nationkey % 2 = 0
""")
def _(t, spark):
    """Names with and without a middle word, accents and case apart."""
    letters = "translate(cast(c_custkey as string), '0123456789', 'abcdefghij')"
    c = t("customer")
    authors = c.selectExpr("c_custkey id", f"concat('África', {letters}, ' de Lima') name")
    return er.faculty_matches(authors, c.where("c_nationkey % 2 = 0").selectExpr("c_custkey + 1000000L member", f"concat('AFRICA', upper({letters}), ' Souza de Lima') name"))


@query("snk2_yaml", """
SELECT p_partkey, 'title: ' || p_name || chr(10) || 'brand: ' || p_brand || chr(10) || 'size: ''' || CAST(p_size AS VARCHAR) || '''' || chr(10) || 'note: |-' || chr(10) || '  one' || chr(10) || '  ' || p_type || chr(10) || 'flag: ''no''' AS document FROM part
""")
def _(t, spark):
    """Records as YAML text: plain, quoted and block scalars in the order of the fields, null ones left out."""
    fields = {"title": F.col("p_name"), "brand": F.col("p_brand"), "size": F.col("p_size").cast("string"), "none": F.lit(None).cast("string"), "note": F.concat(F.lit("one\n"), "p_type"), "flag": F.lit("no")}
    return t("part").select("p_partkey", cu.yaml_mapping(fields).alias("document"))


@query("snk6_group_pages", """
SELECT r_name, '<h1>' || r_name || '</h1>' || chr(10) || '<ul>' || chr(10) || string_agg('<li>' || n_name || ' (' || CAST(n AS VARCHAR) || ')</li>', chr(10) ORDER BY n DESC, n_name) || chr(10) || '</ul>' AS page
FROM (SELECT r_name, n_name, count(c_custkey) AS n FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY r_name, n_name) GROUP BY r_name
""")
def _(t, spark):
    """A page for each group with the counts of its members."""
    n = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    counts = n.join(t("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")), F.col("c_nationkey") == F.col("n_nationkey"), "left").na.fill(0, ["n"])
    items = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "n_name", "n")))
    li = F.array_join(F.transform(items, lambda x: F.concat(F.lit("<li>"), x["n_name"], F.lit(" ("), x["n"].cast("string"), F.lit(")</li>"))), "\n")
    return counts.groupBy("r_name").agg(F.concat(F.lit("<h1>"), F.first("r_name"), F.lit("</h1>\n<ul>\n"), li, F.lit("\n</ul>")).alias("page"))


_FOUND = "(SELECT o_custkey || '-' || o_orderstatus || left(o_orderpriority, 1) AS author, o_orderkey AS orcid, o_totalprice > 150000 AS local, count(*) OVER (PARTITION BY o_custkey, o_orderstatus, left(o_orderpriority, 1)) AS every, count(*) FILTER (o_totalprice > 150000) OVER (PARTITION BY o_custkey, o_orderstatus, left(o_orderpriority, 1)) AS locals FROM orders)"


@query("er9_confirmed", f"SELECT author, max(orcid) FILTER (local) AS orcid FROM {_FOUND} GROUP BY author HAVING max(every) = 1 AND max(locals) = 1")
def _(t, spark):
    """An author's only profile, if it is compatible."""
    found = t("orders").selectExpr("o_orderkey orcid", "concat(o_custkey, '-', o_orderstatus, left(o_orderpriority, 1)) author", "o_totalprice > 150000 local")
    per = found.groupBy("author").agg(F.count(F.lit(1)).alias("n"), F.count_if("local").alias("locals"), F.max(F.when(F.col("local"), F.col("orcid"))).alias("orcid"))
    return per.where("n = 1 and locals = 1").select("author", "orcid")


@query("agg12_grouped_lists", "SELECT n_regionkey, list(n_name ORDER BY n_nationkey) AS names FROM nation GROUP BY n_regionkey")
def _(t, spark):
    """An ordered list for each group."""
    one = t("region").select(F.col("r_regionkey").alias("n_regionkey"))
    return ops.nested(one, t("nation"), "n_regionkey", ["n_nationkey"], ["n_name"], "x").where("x is not null").select("n_regionkey", F.transform("x", lambda v: v["n_name"]).alias("names"))


@query("set5_common_words", """
SELECT p_partkey, list_sort(list_distinct(list_filter(string_split(p_name, ' '), lambda w: w = lower(p_type) OR w = 'widget'))) AS common FROM part
""")
def _(t, spark):
    """Words that two texts share but for stop words."""
    other = F.concat_ws(" ", F.lit("Widget COLD"), F.lower("p_type"))
    return t("part").select("p_partkey", F.array_sort(ops.token_overlap(F.col("p_name"), other, ["cold"])).alias("common"))


@query("nam2_jaro_winkler", "SELECT a, b, round(CASE WHEN lower(a) = lower(b) THEN 1 ELSE j + least(4, CASE WHEN left(lower(a), 1) <> left(lower(b), 1) THEN 0 WHEN left(lower(a), 2) <> left(lower(b), 2) THEN 1 WHEN left(lower(a), 3) <> left(lower(b), 3) THEN 2 WHEN left(lower(a), 4) <> left(lower(b), 4) THEN 3 ELSE 4 END) * 0.1 * (1 - j) END, 6) AS score FROM (SELECT x.n_name AS a, y.n_name AS b, jaro_similarity(lower(x.n_name), lower(y.n_name)) AS j FROM nation x JOIN nation y ON x.n_regionkey = y.n_regionkey AND x.n_name < y.n_name)")
def _(t, spark):
    """The similarity of names in a block."""
    from scriptorium.functions.names import surname_score

    n = t("nation")
    a, b = n.select("n_regionkey", F.col("n_name").alias("a")), n.select("n_regionkey", F.col("n_name").alias("b"))
    return a.join(b, "n_regionkey").where("a < b").select("a", "b", F.round(surname_score(F.col("a"), F.col("b")), 6).alias("score"))


@query("prj4_region_codes", "SELECT p_partkey, CASE WHEN starts_with(p_brand, 'Brand#1') THEN 'one' WHEN starts_with(p_brand, 'Brand#') THEN 'more' END AS region FROM part")
def _(t, spark):
    p = t("part")
    return p.select("p_partkey", ops.first_prefix(p, F.col("p_brand"), [("Brand#1", "one"), ("Brand#", "more")]).alias("region"))


@query("ext1_page_noise", "SELECT doc_id, md5(regexp_replace(replace(coalesce(text, '') || chr(10) || '12' || chr(10) || 'x', chr(12), chr(10)), '(?m)^[ \\t\\n\\x0B\\f\\r]*[0-9]{1,3}[ \\t\\n\\x0B\\f\\r]*$', '', 'g')) AS digest FROM documents")
def _(t, spark):
    """Documents without form feeds and lines of a page number."""
    from scriptorium.operators.extract import without_page_noise

    return t("documents").select("doc_id", F.md5(without_page_noise(F.concat(F.coalesce("text", F.lit("")), F.lit("\n12\nx")))).alias("digest"))


_SPLIT_SQL = "SELECT p_partkey, 'SILVA, João. ' || p_name || ' ' || p_type || ' e outras coisas daquele lugar. Recife: Editora, 1999. ' AS a, 'SOUZA, Maria. Outra ' || p_name || ' da cidade. Natal: Editora, 2001.' AS b FROM part"


def _run_on(t):
    return t("part").selectExpr("p_partkey", "concat('SILVA, João. ', p_name, ' ', p_type, ' e outras coisas daquele lugar. Recife: Editora, 1999. ', 'SOUZA, Maria. Outra ', p_name, ' da cidade. Natal: Editora, 2001.') r")


@query("ref8_boundaries", f"SELECT p_partkey, length(a) AS at FROM ({_SPLIT_SQL})")
def _(t, spark):
    """Where the second of two references begins, over references written from parts."""
    from scriptorium.operators.split_references import boundaries

    return _run_on(t).select("p_partkey", F.explode(boundaries(F.col("r"), ["recife", "natal"])).alias("at")).select("p_partkey", F.col("at").cast("long").alias("at"))


@query("ref10_pieces", "SELECT p_partkey, [trim(substr(p_name, 1, 3)), trim(substr(p_name, 4, CAST(p_size AS BIGINT) % 4 + 1)), trim(substr(p_name, 5 + p_size % 4))] AS pieces FROM part")
def _(t, spark):
    """Texts cut at given positions."""
    from scriptorium.operators.split_references import pieces

    return t("part").select("p_partkey", pieces(F.col("p_name"), F.expr("array(3, cast(4 + p_size % 4 as int))")).alias("pieces"))


@query("ref12_split_table", f"SELECT p_partkey, [trim(a), trim(b)] AS refs FROM ({_SPLIT_SQL})")
def _(t, spark):
    """Two references in one string for every part, cut apart."""
    from scriptorium.operators.split_references import split_concatenated

    return _run_on(t).select("p_partkey", split_concatenated(F.array("r"), ["recife", "natal"]).alias("refs"))


_SECTIONS = "'Título' || chr(10) || 'Resumo: ' || x || chr(10) || 'Palavras-chave: ' || w || chr(10) || 'Abstract: ' || x || chr(10) || 'Keywords: k' || chr(10) || 'Referências' || chr(10) || y || chr(10) || 'Anexos' || chr(10) || 'fim'"


@query("ref15_ext3_ext4_sections", """
SELECT p_brand, CASE WHEN length(x) > 50 AND length(x) <= 5000 THEN x END AS abstract, w AS keywords, CASE WHEN length(x) > 50 THEN x END AS abstract_en, y AS refs
FROM (SELECT p_brand, string_agg(p_name, ' ' ORDER BY p_partkey) AS x, min(p_type) AS w, string_agg(p_name, chr(10) ORDER BY p_partkey DESC) AS y FROM part GROUP BY p_brand)
""")
def _(t, spark):
    """Abstracts within their limits of length, keywords and references of a paper for each brand."""
    from scriptorium.operators.extract import sections

    names = F.array_sort(F.collect_list(F.struct("p_partkey", "p_name")))
    join = lambda x, by: F.array_join(F.transform(x, lambda v: v["p_name"]), by)
    papers = t("part").groupBy("p_brand").agg(join(names, " ").alias("x"), F.min("p_type").alias("w"), join(F.reverse(names), "\n").alias("y"))
    return sections(papers.select("p_brand", F.expr(_SECTIONS.replace("chr(10)", "'\n'")).alias("text")), "text").drop("text")


_RULES = [("widget", "nome", "Widget"), ("anvil", "sigla", "Anvil"), ("cold", "movimento", "Cold"), ("gear", "toponimico", "Gear"), ("old widget", "expressao", "Old-Widget"), ("economy", "area", "Economy")]


@query("cap1_cased_words", """
SELECT p_partkey, CASE w WHEN 'widget' THEN 'Widget' WHEN 'anvil' THEN 'ANVIL' WHEN 'cold' THEN 'Cold' WHEN 'economy' THEN 'Economy' ELSE CASE WHEN p_size % 2 = 0 THEN upper(substr(w, 1, 1)) || substr(w, 2) ELSE w END END AS word
FROM (SELECT p_partkey, p_size, string_split(p_name, ' ')[1] AS w FROM part)
""")
def _(t, spark):
    """One word of each name by the dictionary (SRC11), or by whether it opens a sentence."""
    from scriptorium.operators.capitalize import Rules, cased_word

    word = F.upper(F.get(F.split("p_name", " "), F.lit(0)))
    return t("part").select("p_partkey", cased_word(Rules(_RULES), word, F.col("p_size") % 2 == 0).alias("word"))


@query("cap3_phrases", "SELECT p_partkey, regexp_replace(upper(p_name) || ', um ' || p_name, '\\b(?i:old widget)\\b', 'Old-Widget', 'g') AS name FROM part")
def _(t, spark):
    """Phrases of several words in any case."""
    from scriptorium.operators.capitalize import Rules, with_phrases

    return t("part").select("p_partkey", with_phrases(Rules(_RULES), F.concat(F.upper("p_name"), F.lit(", um "), "p_name")).alias("name"))


@query("cap4_toponyms", """
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'cold Gear' WHEN 1 THEN 'economy Moderna (Gear)' WHEN 2 THEN 'economy moderna gear' ELSE CASE p_name WHEN 'cold gear' THEN 'cold Gear Gear' WHEN 'old widget' THEN 'old widget Gear' ELSE p_name || ' gear' END END AS name FROM part
""")
def _(t, spark):
    """Adjectives of place after what lends them a capital."""
    from scriptorium.operators.capitalize import Rules, with_toponyms

    name = F.expr("case p_size % 4 when 0 then 'cold gear' when 1 then 'economy Moderna (gear)' when 2 then 'economy moderna gear' else concat(p_name, ' gear') end")
    return t("part").select("p_partkey", with_toponyms(Rules(_RULES), name).alias("name"))


@query("win10_sentence_state", """
SELECT p_partkey, 'Um caso. Outro ' || CASE WHEN p_size % 2 = 0 THEN 'da ANVIL. casa' ELSE 'caso? Casa' END || ' do Widget' AS title FROM part
""")
def _(t, spark):
    """Capitals after what ends a sentence, but not after an acronym's dot."""
    from scriptorium.operators.capitalize import capitalized

    raw = F.expr("concat('UM CASO. OUTRO ', if(p_size % 2 = 0, 'DA anvil. CASA', 'CASO? CASA'), ' DO WIDGET.')")
    return capitalized(t("part").select("p_partkey", raw.alias("raw")), "raw", F.lit(False), _RULES, "title").select("p_partkey", "title")


@query("nam7_confidence", f"SELECT id, CASE WHEN no % 2 = 0 OR length(given) = 7 THEN 'baixa' ELSE 'alta' END AS confidence, no % 2 = 0 AS initials FROM {_PEOPLE_SQL}")
def _(t, spark):
    """How sure a given name is, and whether it has initials only (NAM17)."""
    from scriptorium.functions.names import confidence, initials_only

    given = F.expr("if(no % 2 = 0, concat(left(given, 1), '. de M.'), given)")
    return _people(t).select("id", confidence(given).alias("confidence"), initials_only(given).alias("initials"))


@query("nam3_similar_surnames", "SELECT a, b FROM (SELECT x.n_name AS a, y.n_name AS b, jaro_similarity(lower(x.n_name), lower(y.n_name)) AS j FROM nation x JOIN nation y ON x.n_regionkey = y.n_regionkey AND x.n_name < y.n_name) WHERE j + CASE WHEN left(a, 1) <> left(b, 1) THEN 0 WHEN left(a, 2) <> left(b, 2) THEN 1 WHEN left(a, 3) <> left(b, 3) THEN 2 WHEN left(a, 4) <> left(b, 4) THEN 3 ELSE 4 END * 0.1 * (1 - j) >= 0.92")
def _(t, spark):
    """Names of a block that count as spellings of one."""
    from scriptorium.functions.names import similar

    n = t("nation").select("n_regionkey", "n_name")
    pairs = n.toDF("block", "a").join(n.toDF("block", "b"), "block").where("a < b")
    return pairs.where(similar(F.col("a"), F.col("b"))).select("a", "b")


@query("str3_str4_normal_names", f"SELECT id, 'dr ' || lower(given) || ' ' || lower(family) AS spaced, 'dr' || lower(given) || ' ' || lower(family) AS deleted FROM {_PEOPLE_SQL}")
def _(t, spark):
    """Dots and commas as spaces, and deleted, with accents folded (STR2)."""
    from scriptorium.functions.names import normal

    name = F.expr("concat('DR.', given, ' ,', translate(family, 'uaio', 'uaio'), '.')")
    return _people(t).select("id", normal(name).alias("spaced"), normal(name, True).alias("deleted"))


@query("str7_str8_keyword_lists", "SELECT p_partkey, CASE p_size % 4 WHEN 3 THEN [p_name] ELSE [p_name, p_type] END AS k FROM part")
def _(t, spark):
    """Keywords from JSON lists, semicolons, commas and alone."""
    from scriptorium.functions.text import keyword_list

    raw = F.expr("case p_size % 4 when 0 then to_json(array(p_name, p_type)) when 1 then concat('• ', p_name, ' ; ', p_type, '.') when 2 then concat(p_name, ',', p_type, ',') else p_name end")
    return t("part").select("p_partkey", keyword_list(raw).alias("k"))


@query("str19_links", """
SELECT p_partkey, '<a href="https://doi.org/10.1234/x' || p_partkey || '">10.1234/x' || p_partkey || '</a> e <a href="https://x.org/' || p_partkey || '">https://x.org/' || p_partkey || '</a> fim' AS x FROM part
""")
def _(t, spark):
    """DOIs and bare URLs as links."""
    from scriptorium.functions.text import linked

    return t("part").select("p_partkey", linked(F.expr("concat('DOI: 10.1234/x', p_partkey, ' e https://x.org/', p_partkey, ' fim')")).alias("x"))


@query("dml7_repointed_links", "SELECT DISTINCT l_orderkey, l_suppkey % 8 AS l_suppkey FROM lineitem")
def _(t, spark):
    """Links of all suppliers re-pointed along chains of merges to their ends, each once (ER6)."""
    edges = t("supplier").where("s_suppkey >= 8").selectExpr("s_suppkey removed", "s_suppkey - 8 keep")
    return ops.merged_edges(t("lineitem").select("l_orderkey", "l_suppkey"), ops.merge_targets(edges), "l_orderkey", "l_suppkey")


@query("er10_filled_with_provenance", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'old' WHEN c_custkey % 2 = 0 THEN 'id' || CAST(c_custkey AS VARCHAR) END AS code, CASE WHEN c_custkey % 3 = 0 THEN 'existing' WHEN c_custkey % 2 = 0 THEN 'v2' END AS version FROM customer
""")
def _(t, spark):
    """Confirmed codes only where there is none; those that were there before are marked so."""
    old = t("customer").selectExpr("c_custkey", "if(c_custkey % 3 = 0, 'old', '') code", "if(c_custkey % 3 = 0, 'existing', '') version")
    new = t("customer").where("c_custkey % 2 = 0").selectExpr("c_custkey", "concat('id', c_custkey) code", "'v2' version", "1 seq")
    return ops.filled(old, new, "c_custkey", ["code", "version"], "seq")


@query("set4_distinct_lines", """
WITH l AS (SELECT doc_id, i, string_split(text, chr(10))[i] AS line FROM (SELECT doc_id, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))),
f AS (SELECT doc_id, lower(line) AS k, arg_min(line, i) AS line, min(i) AS i FROM l GROUP BY doc_id, lower(line))
SELECT doc_id, count(*) AS n, md5(string_agg(line, chr(10) ORDER BY i)) AS digest FROM f GROUP BY doc_id
""")
def _(t, spark):
    """The lines of every document that no earlier one equals but for case; a null text has one empty line."""
    from scriptorium.functions.text import distinct_ignoring_case

    d = t("documents").select("doc_id", distinct_ignoring_case(F.split(F.coalesce("text", F.lit("")), "\n")).alias("x"))
    return d.select("doc_id", F.size("x").cast("long").alias("n"), F.md5(F.array_join("x", "\n")).alias("digest"))


@query("src1_nested_round_trip", """
SELECT lower(replace(r_name, ' ', '-')) AS slug, 'About ' || r_name AS seminar_title, CAST(2000 + r_regionkey AS INTEGER) AS year, CAST(row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey) AS INTEGER) AS seq,
  'n' || CAST(n_nationkey AS VARCHAR) AS id, n_name AS title, [lower(n_name), r_name] AS keywords FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def _(t, spark):
    """A file for each region, written to the shared folder in two layouts of field names, found again below it and read to one schema
    (SRC1, SRC2, SRC4, SRC13, PRJ1, PRJ2, SNK9, SNK10)."""
    import uuid

    from scriptorium.sources import nested
    from scriptorium.sources.shared import shared_dir

    n = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    item = F.struct("n_nationkey", F.expr("concat('n', n_nationkey)").alias("id"), "n_name", F.array(F.lower("n_name"), F.col("r_name")).alias("k"))
    per = n.groupBy("r_regionkey", "r_name").agg(F.array_sort(F.collect_list(item)).alias("a"))
    slug = F.expr("lower(replace(r_name, ' ', '-'))")
    one = F.to_json(F.struct(F.struct(slug.alias("slug"), F.expr("concat('About ', r_name)").alias("title"), F.expr("2000 + r_regionkey").alias("year")).alias("issue"), F.transform("a", lambda x: F.struct(x["id"].alias("id"), x["n_name"].alias("title"), x["k"].alias("keywords"))).alias("articles")))
    two = F.to_json(F.struct(slug.alias("slug"), F.expr("2000 + r_regionkey").alias("year"), F.struct(F.expr("concat('About ', r_name)").alias("titulo")).alias("evento"), F.transform("a", lambda x: F.struct(x["id"].alias("id"), x["n_name"].alias("titulo"), x["k"].alias("palavras_chave"))).alias("artigos")))
    folder = f"{shared_dir(spark)}/nested-{uuid.uuid4().hex}"
    per.select(slug.alias("slug"), F.when(F.col("r_regionkey") % 2 == 0, one).otherwise(two).alias("document")).write.partitionBy("slug").text(folder)
    files = spark.read.format("text").option("recursiveFileLookup", True).option("wholetext", True).load(folder)
    return nested.parsed(files.select(F.input_file_name().alias("path"), F.encode("value", "utf-8").alias("content")), as_json=True).select("slug", "seminar_title", "year", "seq", "id", "title", "keywords")


# Every third author has an initial only.
_AUTHORS_SQL = f"(SELECT id, CASE WHEN no % 3 = 0 THEN substr(given, 1, 1) || '. Maria' ELSE given END AS given, family FROM {_PEOPLE_SQL})"
_PAIRS_SQL = f"""(SELECT a.id, b.id AS id_2, a.given AS g, b.given AS g_2, a.family FROM {_AUTHORS_SQL} a JOIN {_AUTHORS_SQL} b ON a.family = b.family AND a.id < b.id
WHERE starts_with(lower(b.given), lower(rtrim(string_split(a.given, ' ')[1], '.'))) OR starts_with(lower(a.given), lower(rtrim(string_split(b.given, ' ')[1], '.'))))"""
_MERGE_SQL = "SELECT removed, min(keep) AS keep FROM (SELECT CASE WHEN length(g) >= length(g_2) THEN id_2 ELSE id END AS removed, CASE WHEN length(g) >= length(g_2) THEN id ELSE id_2 END AS keep FROM {0}) GROUP BY removed"
_UNSURE = "length(rtrim(split_part(CASE WHEN length(g) <= length(g_2) THEN g ELSE g_2 END, ' ', 1), '.')) = 1"


def _authors(t):
    """Authors, and the block of those who share surname and first letter."""
    authors = _people(t).selectExpr("id", "if(no % 3 = 0, concat(left(given, 1), '. Maria'), given) given", "family")
    return authors, F.concat(er.surname_block(F.col("family")), F.lit(" "), F.lower(F.left("given", F.lit(1))))


@query("er3_table_merges", _MERGE_SQL.format(_PAIRS_SQL))
def _(t, spark):
    """Compatible whole names among all customers, the longer one kept."""
    return er.merges(*_authors(t), er.same_full_name(2), er.lead_of_names())


@query("er4_table_merges", _MERGE_SQL.format(f"(SELECT * FROM {_PAIRS_SQL} WHERE NOT ({_UNSURE}))"))
def _(t, spark):
    """Sure variants among all customers."""
    return er.merges(*_authors(t), er.same_surname_variant("alta"), er.lead_of_given())


@query("er5_table_report", f"SELECT id, id_2 FROM {_PAIRS_SQL} WHERE {_UNSURE}")
def _(t, spark):
    """Unsure variants among all customers."""
    return er.judged_pairs(*_authors(t), er.lead_of_given(), er.same_surname_variant("baixa"))


@query("er1_table_particles", f"SELECT id, CASE WHEN no % 2 = 0 THEN given || ' de' ELSE given END AS given, family FROM {_PEOPLE_SQL}")
def _(t, spark):
    """Particles before family names move to the given ones."""
    s = er.particles_to_given(F.col("given"), F.expr("if(no % 2 = 0, concat('De ', family), family)"))
    return _people(t).select("id", s["given"].alias("given"), s["family"].alias("family"))


@query("nam10_table_split_names", f"SELECT id, given, CASE WHEN no % 2 = 0 THEN family || ' Neto' ELSE family END AS family FROM {_PEOPLE_SQL}")
def _(t, spark):
    """Whole names split, suffixes kept with the surname."""
    from scriptorium.functions import names
    from scriptorium.functions.text import words

    s = names.split_name(words(F.expr("concat_ws(' ', given, family, if(no % 2 = 0, 'Neto', null))")))
    return _people(t).select("id", s["given"].alias("given"), s["family"].alias("family"))


@query("nam12_table_family_first", f"SELECT id, given || ' da Silva' AS given, family FROM {_PEOPLE_SQL}")
def _(t, spark):
    """``SURNAME, GIVEN`` in title case with small particles."""
    from scriptorium.functions import names

    s = names.family_first(F.expr("upper(concat(family, ', ', given, ' da Silva'))"))
    return _people(t).select("id", s["given"].alias("given"), s["family"].alias("family"))


@query("nam16_table_clean_authors", f"SELECT id, given || ' ' || family AS name FROM {_PEOPLE_SQL}")
def _(t, spark):
    """Names without degrees, line breaks and trailing dots."""
    from scriptorium.functions.text import clean_author

    return _people(t).select("id", clean_author(F.expr("concat('Prof. Dr. ', given, '\n', family, if(no % 2 = 0, ', MSc.', '.'))")).alias("name"))


@query("str28_table_name_lists", f"SELECT k, string_agg(family || ', ' || given, '; ' ORDER BY no) AS names FROM {_PEOPLE_SQL} GROUP BY k")
def _(t, spark):
    """The name list of every nation's authors."""
    from scriptorium.functions.text import name_list

    people = _people(t).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("no", "given", "family"))).alias("p"))
    return people.select("k", name_list(F.col("p")).alias("names"))


@query("str30_table_leading_phrases", "SELECT p_partkey, p_name AS x FROM part")
def _(t, spark):
    from scriptorium.functions.text import without_intro

    return t("part").select("p_partkey", without_intro(F.expr("concat('Página ', p_partkey, ' A. ', p_name)"), [r"Página \d+", r"[A-Z]\."]).alias("x"))


@query("str16_table_generics", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN ['edifício', 'casa'] ELSE [] END AS g FROM part")
def _(t, spark):
    from scriptorium.functions.text import lower_generics

    return t("part").select("p_partkey", lower_generics(F.expr("if(p_size % 2 = 0, concat('O edifício ', upper(p_name), ' e a casa ', p_brand), concat('casa ', p_name))")).alias("g"))


@query("str23_table_running_headers", "SELECT p_partkey, [p_name, p_type || ' ' || p_brand] AS r FROM part")
def _(t, spark):
    """Running headers alone, before and inside entries."""
    from scriptorium.functions.text import without_running_header

    return t("part").select("p_partkey", without_running_header(F.expr("array('ATAS 5', concat('ATAS 5 ', p_name), concat(p_type, ' ATAS 5 ', p_brand))"), "ATAS 5").alias("r"))


@query("str11_table_titles", "SELECT p_partkey, p_name AS title, CASE WHEN p_size % 2 = 0 THEN p_type || ': ' || p_brand END AS subtitle FROM part")
def _(t, spark):
    """Title and subtitle at the first colon."""
    from scriptorium.functions.text import title_and_subtitle

    s = title_and_subtitle(F.expr("if(p_size % 2 = 0, concat(p_name, ': ', p_type, ': ', p_brand), p_name)"))
    return t("part").select("p_partkey", s["title"].alias("title"), s["subtitle"].alias("subtitle"))


@query("ref4_table_underscores", "SELECT p_partkey, [upper(p_type) || ', A. ' || p_name || '.', '____. ' || p_brand || '.', 'Outro.'] AS refs FROM part")
def _(t, spark):
    """References cut before underscores, over lists written from parts."""
    from scriptorium.functions.references import split_underscores

    return t("part").select("p_partkey", split_underscores(F.expr("array(concat(upper(p_type), ', A. ', p_name, '. ____. ', p_brand, '.'), ' ', 'Outro.')")).alias("refs"))


@query("ref6_table_clean_lists", """
SELECT p_partkey, [upper(p_type) || ', Ana. ' || p_name || '.', upper(p_type) || ', Ana. ' || p_brand || '. https://x.org/' || p_partkey, 'Outro, B. Livro.'] AS refs FROM part
""")
def _(t, spark):
    """The three phases in turn over lists written from parts (WIN2, WIN3)."""
    from scriptorium.functions.references import clean_references

    raw = F.expr("array(concat(upper(p_type), ', Ana. ', p_name, '. ____. ', p_brand, '.'), concat('https://x.org/', p_partkey), 'Outro, B. Livro.')")
    return t("part").select("p_partkey", clean_references(raw).alias("refs"))


@query("cap2_table_titles", """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CASE split_part(p_name, ' ', 1) WHEN 'old' THEN 'Old' WHEN 'cold' THEN 'Cold' ELSE upper(substr(split_part(p_name, ' ', 1), 1, 1)) || substr(split_part(p_name, ' ', 1), 2) END ELSE CASE split_part(p_name, ' ', 1) WHEN 'cold' THEN 'Cold' ELSE split_part(p_name, ' ', 1) END END || ' de ' || upper(p_brand) AS title FROM part
""")
def _(t, spark):
    """Titles and subtitles in capitals, by the dictionary."""
    from scriptorium.operators.capitalize import capitalized

    raw = F.expr("upper(concat(split(p_name, ' ')[0], ' DE ', p_brand, '.'))")
    return capitalized(t("part").select("p_partkey", "p_size", raw.alias("raw")), "raw", F.col("p_size") % 2 == 1, _RULES, "title").select("p_partkey", "title")
