"""Exchange and citation formats over orders as articles and lineitems as their authors; months are issues."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from scriptorium.operators import cite, serialize
from scriptorium.plans.catalogue import query

_AUTHOR = """struct(l_linenumber as no, concat('G', cast(l_suppkey as string)) as given, concat('F<', cast(l_partkey % 100 as string), '>') as family, case when l_partkey % 3 = 0 then concat('0000-', cast(l_partkey as string)) end as orcid,
  case when l_partkey % 2 = 0 then concat('Univ. "', l_returnflag, '" & co') end as affiliation, concat('a', cast(l_suppkey as string), '@example.org') as email, cast(null as string) as bio, case when l_linestatus = 'F' then 'PT' end as country)"""


def _articles(t):
    """(issue, r) with the record of every order; null where a column has none."""
    people = t("lineitem").selectExpr("l_orderkey", "l_partkey", f"{_AUTHOR} a").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("a.no", "l_partkey", "a"))).alias("p"))
    people = people.select(F.col("l_orderkey").alias("o_orderkey"), F.transform("p", lambda x: x["a"]).alias("authors"))
    r = F.expr("""struct(cast(o_orderkey as string) as id, concat('Casa & rua ', cast(o_orderkey as string)) as title, case when o_orderkey % 3 = 0 then 'um "estudo"' when o_orderkey % 3 = 1 then '' end as subtitle,
      case when o_orderkey % 4 = 0 then concat('Resumo\\n<', o_orderstatus, '>') end as abstract, case when o_orderkey % 7 = 0 then 'en' end as locale, case when o_orderkey % 2 = 0 then concat(cast(o_orderkey % 90 as string), '-', cast(o_orderkey % 90 + 9 as string)) end as pages,
      case when o_orderkey % 5 = 0 then concat('10.1/', cast(o_orderkey as string)) end as doi, cast(null as string) as isbn, concat('https://x.org/', cast(o_orderkey as string), '.pdf') as url, concat('https://x.org/', cast(o_orderkey as string)) as page_url,
      split(o_orderpriority, '-') as keywords, coalesce(authors, array()) as authors, to_date(o_orderdate) as published, concat('Encontro ', date_format(o_orderdate, 'yyyy-MM')) as event, case when o_orderkey % 6 = 0 then 'Editora Ã' end as publisher,
      case when o_orderkey % 9 = 0 then 'Recife' end as place, o_orderstatus as section)""")
    return t("orders").join(people, "o_orderkey", "left").select(F.date_format("o_orderdate", "yyyy-MM").alias("issue"), r.alias("r"))


_X = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_Q = "replace(" + _X + ", '\"', '&quot;')"
_RECORDS_SQL = """
a AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, 'G' || l_suppkey AS given, 'F<' || l_partkey % 100 || '>' AS family, CASE WHEN l_partkey % 3 = 0 THEN 'https://orcid.org/0000-' || l_partkey END AS orcid,
  CASE WHEN l_partkey % 2 = 0 THEN 'Univ. "' || l_returnflag || '" & co' END AS affiliation, 'a' || l_suppkey || '@example.org' AS email, CASE WHEN l_linestatus = 'F' THEN 'PT' ELSE 'BR' END AS country, l_suppkey AS s FROM lineitem),
r AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m') AS issue, 'Casa & rua ' || o_orderkey AS title, CASE WHEN o_orderkey % 3 = 0 THEN 'um "estudo"' END AS subtitle,
  'Casa & rua ' || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN ': um "estudo"' ELSE '' END AS whole, CASE WHEN o_orderkey % 4 = 0 THEN 'Resumo' || chr(10) || '<' || o_orderstatus || '>' END AS abstract,
  CASE WHEN o_orderkey % 7 = 0 THEN 'en' ELSE 'pt-BR' END AS locale, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 90 || '-' || (o_orderkey % 90 + 9) END AS pages, CASE WHEN o_orderkey % 5 = 0 THEN '10.1/' || o_orderkey END AS doi,
  'https://x.org/' || o_orderkey AS page_url, string_split(o_orderpriority, '-') AS kw, CAST(o_orderdate AS DATE) AS day, 'Encontro ' || strftime(o_orderdate, '%Y-%m') AS event, CASE WHEN o_orderkey % 6 = 0 THEN 'Editora Ã' END AS publisher,
  CASE WHEN o_orderkey % 9 = 0 THEN 'Recife' END AS place, o_orderstatus AS section FROM orders)"""


def _people_table(form: str, by: str) -> str:
    return f"(SELECT k, string_agg({form}, {by} ORDER BY n, p, given, family, affiliation NULLS FIRST, country) AS people FROM a GROUP BY k)"


_XSI, _NATIVE = cite.INSTANCE, cite.NATIVE
_AUTHOR_XML = f"""'<author><givenname locale="pt_BR">' || given || '</givenname><familyname locale="pt_BR">' || {_X.format('family')} || '</familyname>' || coalesce('<affiliation locale="pt_BR">' || {_X.format('affiliation')} || '</affiliation>', '')
  || '<country>' || country || '</country><email>' || email || '</email>' || coalesce('<orcid>' || orcid || '</orcid>', '') || '</author>'"""
_ISSUE_XML = f"""
, u AS (SELECT r.*, people, row_number() OVER (PARTITION BY {{per}} ORDER BY r.k) AS no FROM r LEFT JOIN {_people_table(_AUTHOR_XML, "''")} x ON x.k = r.k),
v AS (SELECT *, '<article xmlns:xsi="{_XSI}" locale="pt_BR" date_submitted="' || day || '" status="3" submission_progress="0" current_publication_id="' || no || '" stage="production"><id type="internal" advice="ignore">' || k || '</id><publication xmlns:xsi="{_XSI}" locale="pt_BR" version="1" status="3" url_path="" seq="'
  || (no - 1) || '" date_published="' || day || '" section_ref="' || section || '" access_status="0" xsi:schemaLocation="{_NATIVE} native.xsd"><id type="internal" advice="ignore">' || no || '</id><title locale="pt_BR">' || {_X.format('title')} || '</title>'
  || coalesce('<subtitle locale="pt_BR">' || {_X.format('subtitle')} || '</subtitle>', '') || coalesce('<abstract locale="pt_BR">' || {_X.format('abstract')} || '</abstract>', '') || '<keywords locale="pt_BR">' || array_to_string(list_transform(kw, lambda w: '<keyword>' || w || '</keyword>'), '') || '</keywords>'
  || coalesce('<authors>' || people || '</authors>', '') || coalesce('<pages>' || pages || '</pages>', '') || '</publication></article>' AS x FROM u)
SELECT {{key}}, '<issue xmlns="{_NATIVE}" xmlns:xsi="{_XSI}" published="1" current="0" access_status="1" url_path="' || issue || '" xsi:schemaLocation="{_NATIVE} native.xsd"><id type="internal" advice="ignore">' || issue || '</id><issue_identification><volume>' || issue[6:7] || '</volume><number>' || issue[6:7]
  || '</number><year>' || issue[1:4] || '</year><title locale="pt_BR">Encontro ' || issue || '</title></issue_identification><date_published>' || issue || '-01</date_published><last_modified>' || issue || '-01</last_modified><sections>'
  || array_to_string(list_transform(list_sort(list(DISTINCT section)), lambda s: '<section ref="' || s || '"><abbrev locale="pt_BR">' || s || '</abbrev><title locale="pt_BR">' || s || '</title></section>'), '') || '</sections><articles>' || string_agg(x, '' ORDER BY no) || '</articles></issue>' AS xml
FROM v GROUP BY {{group}}"""


#: Articles that are added to an issue's text at once.
RUN = 1000


def _numbered(t, *per):
    """Records with their number in the issue, or whatever ``per`` is."""
    rows = _articles(t).select("issue", F.col("r.id").alias("id"), F.col("r.id").cast("long").alias("k"), "r", F.col("r.section").alias("section"))
    return rows.withColumn("no", F.row_number().over(Window.partitionBy(*per).orderBy("k")))


def _written(sections, articles):
    first = F.concat(F.col("issue"), F.lit("-01")).cast("date")
    return cite.native_issue(F.col("issue"), F.concat(F.lit("Encontro "), "issue"), F.left("issue", F.lit(4)), F.right("issue", F.lit(2)), first, sections, articles)


def _article():
    return cite.written_article(F.col("r").withField("no", F.col("no")))


@query("snk3_native_issues", "WITH " + _RECORDS_SQL + _ISSUE_XML.format(per="issue", key="issue", group="issue"))
def _(t, spark):
    """The exchange format of every month, with all its articles."""
    # What stands before and after the articles goes with the first and the last, so that only the text of whole issues is left to be joined, and nothing is made of it.
    month = Window.partitionBy("issue")
    rows = _numbered(t, "issue").withColumns({"s": F.array_sort(F.collect_set("section").over(month)), "n": F.count(F.lit(1)).over(month)})
    around = F.split(_written(F.col("s"), F.lit("\0")), "\0")
    x = F.concat(F.when(F.col("no") == 1, around[0]).otherwise(""), _article(), F.when(F.col("no") == F.col("n"), around[1]).otherwise(""))
    return serialize.joined_rows(rows.select("issue", "k", x.alias("xml")).sortWithinPartitions("issue", "k").drop("k"), "issue", "xml", RUN)


@query("snk3_native_articles", "WITH " + _RECORDS_SQL + _ISSUE_XML.format(per="r.k", key="CAST(k AS VARCHAR) AS id", group="issue, k"))
def _(t, spark):
    """The exchange format of every article, in an issue of its own."""
    rows = _numbered(t, "issue", "id").select("issue", "id", "no", "section", _article().alias("x"))
    every = rows.groupBy("issue", "id").agg(F.array_sort(F.collect_list(F.struct("no", "x"))).alias("a"), F.array_sort(F.collect_set("section")).alias("s"))
    return every.select("id", _written(F.col("s"), F.array_join(F.transform("a", lambda v: v["x"]), "")).alias("xml"))


def _each(t, form):
    return _articles(t).select(F.col("r.id").alias("id"), form(F.col("r")).alias("x"))


_J = "CAST(to_json({0}) AS VARCHAR)"


def _optional(name: str, value: str) -> str:
    return f"coalesce(',\"{name}\":' || {_J.format(value)}, '')"


_CSL_AUTHOR = f"""'{{"family":' || {_J.format('family')} || ',"given":' || {_J.format('given')} || coalesce(',"ORCID":' || {_J.format('orcid')}, '') || '}}'"""


@query("snk7_csl_json", f"""
WITH {_RECORDS_SQL}
SELECT CAST(r.k AS VARCHAR) AS id, '{{"id":"' || r.k || '","type":"paper-conference","title":' || {_J.format('whole')} || ',"container-title":"' || event || '","event-title":"' || event || '"' || {_optional('event-place', 'place')} || {_optional('publisher-place', 'place')}
  || ',"issued":{{"date-parts":[[' || year(day) || ',' || month(day) || ',' || day(day) || ']]}}' || {_optional('DOI', 'doi')} || {_optional('page', 'pages')} || ',"URL":"' || page_url || '.pdf","language":"' || locale || '"' || coalesce(',"author":[' || people || ']', '') || '}}' AS x
FROM r LEFT JOIN {_people_table(_CSL_AUTHOR, "','")} p ON p.k = r.k
""")
def _(t, spark):
    """CSL-JSON of every article."""
    return _each(t, lambda r: serialize.json(cite.csl(r)))


_LD_AUTHOR = f"""'{{"@type":"Person","givenName":' || {_J.format('given')} || ',"familyName":' || {_J.format('family')} || coalesce(',"sameAs":' || {_J.format('orcid')}, '') || coalesce(',"affiliation":{{"@type":"Organization","name":' || {_J.format('affiliation')} || '}}', '') || '}}'"""


@query("snk7_json_ld", f"""
WITH {_RECORDS_SQL}
SELECT CAST(r.k AS VARCHAR) AS id, '{{"@context":"https://schema.org","@type":"ScholarlyArticle","name":' || {_J.format('whole')} || ',"headline":' || {_J.format('whole')} || {_optional('abstract', 'abstract')} || ',"datePublished":"' || day || '","inLanguage":"' || locale || '"'
  || coalesce(',"identifier":{{"@type":"PropertyValue","propertyID":"DOI","value":"' || doi || '"}},"sameAs":"https://doi.org/' || doi || '"', '') || coalesce(',"author":[' || people || ']', '') || ',"keywords":' || {_J.format('kw')}
  || ',"isPartOf":{{"@type":"Book","name":"' || event || '"' || coalesce(',"publisher":{{"@type":"Organization","name":"' || publisher || '"}}', '') || ',"isPartOf":{{"@type":"Event","name":"' || event || '"' || coalesce(',"location":{{"@type":"Place","name":"' || place || '"}}', '')
  || ',"startDate":"' || day || '"}}}}' || coalesce(',"publisher":{{"@type":"Organization","name":"' || publisher || '"}}', '') || '}}' AS x
FROM r LEFT JOIN {_people_table(_LD_AUTHOR, "','")} p ON p.k = r.k
""")
def _(t, spark):
    """schema.org's description of every article."""
    return _each(t, lambda r: serialize.json(cite.json_ld(r)))


_YAML_AUTHOR = f"""'  - family: ' || {_J.format('family')} || chr(10) || '    given: ' || {_J.format('given')} || coalesce(chr(10) || '    ORCID: ' || {_J.format('orcid')}, '')"""


@query("snk7_yaml", f"""
WITH {_RECORDS_SQL}
SELECT CAST(r.k AS VARCHAR) AS id, concat_ws(chr(10), 'id: "' || r.k || '"', 'type: "paper-conference"', 'title: ' || {_J.format('whole')}, 'container-title: "' || event || '"', 'event-title: "' || event || '"', 'event-place: "' || place || '"', 'publisher-place: "' || place || '"',
  'issued:', '  date-parts: [[' || year(day) || ',' || month(day) || ',' || day(day) || ']]', 'DOI: "' || doi || '"', 'page: "' || pages || '"', 'URL: "' || page_url || '.pdf"', 'language: "' || locale || '"', 'author:' || chr(10) || people) AS x
FROM r LEFT JOIN {_people_table(_YAML_AUTHOR, "chr(10)")} p ON p.k = r.k
""")
def _(t, spark):
    """The same record in YAML."""
    return _each(t, lambda r: serialize.yaml(cite.csl(r)))


@query("snk7_coins", f"""
WITH {_RECORDS_SQL}, e AS (SELECT r.*, people FROM r LEFT JOIN {_people_table("'&amp;rft.au=' || replace(url_encode(family || ', ' || given), '%20', '+')", "''")} p ON p.k = r.k)
SELECT CAST(k AS VARCHAR) AS id, 'ctx_ver=Z39.88-2004&amp;rft_val_fmt=info%3Aofi%2Ffmt%3Akev%3Amtx%3Abook&amp;rft.genre=conference&amp;rft.atitle=' || replace(url_encode(whole), '%20', '+') || '&amp;rft.btitle=' || replace(event, ' ', '+') || '&amp;rft.date=' || year(day)
  || coalesce(people, '') || coalesce('&amp;rft_id=info%3Adoi%2F10.1%2F' || k || substr(doi, 1, 0), '') || coalesce('&amp;rft.pages=' || pages, '') || coalesce('&amp;rft.pub=' || replace(url_encode(publisher), '%20', '+'), '') || coalesce('&amp;rft.place=' || place, '') AS x FROM e
""")
def _(t, spark):
    """The OpenURL of every article."""
    return _each(t, cite.coins)


_TAG = "'<meta name=\"{0}\" content=\"' || {1} || '\">'"
_META_AUTHOR = "concat_ws(chr(10), " + ", ".join(_TAG.format(n, v) for n, v in (("citation_author", _Q.format("family || ', ' || given")), ("citation_author_orcid", "orcid"), ("citation_author_institution", _Q.format("affiliation")))) + ")"


@query("snk7_meta_tags", f"""
WITH {_RECORDS_SQL}
SELECT CAST(r.k AS VARCHAR) AS id, concat_ws(chr(10), {_TAG.format('citation_title', _Q.format('whole'))}, people, {_TAG.format('citation_publication_date', "strftime(day, '%Y/%m/%d')")}, {_TAG.format('citation_conference_title', 'event')}, {_TAG.format('citation_publisher', 'publisher')},
  {_TAG.format('citation_doi', 'doi')}, {_TAG.format('citation_pdf_url', "page_url || '.pdf'")}, {_TAG.format('citation_abstract', _Q.format('abstract'))}, {_TAG.format('citation_language', 'locale')}, {_TAG.format('citation_firstpage', "string_split(pages, '-')[1]")}, {_TAG.format('citation_lastpage', "string_split(pages, '-')[2]")}) AS x
FROM r LEFT JOIN {_people_table(_META_AUTHOR, "chr(10)")} p ON p.k = r.k
""")
def _(t, spark):
    """Highwire tags of every article."""
    return _each(t, lambda r: cite.meta_tags(cite.highwire(r)))


@query("snk7_dublin_core", f"""
WITH {_RECORDS_SQL}
SELECT CAST(r.k AS VARCHAR) AS id, concat_ws(chr(10), {_TAG.format('DC.title', _Q.format('whole'))}, people, array_to_string(list_transform(kw, lambda w: {_TAG.format('DC.subject', 'w')}), chr(10)), {_TAG.format('DC.description', _Q.format('abstract'))}, {_TAG.format('DC.publisher', 'publisher')},
  {_TAG.format('DC.date', 'CAST(day AS VARCHAR)')}, '<meta name="DC.type" content="ConferencePaper">', '<meta name="DC.format" content="text/html">', {_TAG.format('DC.language', 'locale')}, {_TAG.format('DC.identifier', 'page_url')}, {_TAG.format('DC.identifier', "'doi:' || doi")}) AS x
FROM r LEFT JOIN {_people_table(_TAG.format('DC.creator', _Q.format("family || ', ' || given")), "chr(10)")} p ON p.k = r.k
""")
def _(t, spark):
    """Dublin Core tags of every article."""
    return _each(t, lambda r: cite.meta_tags(cite.dublin_core(r)))


@query("snk7_ris", f"""
WITH {_RECORDS_SQL}
SELECT CAST(r.k AS VARCHAR) AS id, concat_ws(chr(10), 'TY  - CPAPER', people, 'TI  - ' || whole, 'T2  - ' || event, 'PY  - ' || year(day), 'DO  - ' || doi, 'SP  - ' || pages, 'PB  - ' || publisher, 'CY  - ' || place, 'AB  - ' || abstract,
  array_to_string(list_transform(kw, lambda w: 'KW  - ' || w), chr(10)), 'UR  - ' || page_url || '.pdf', 'LA  - ' || locale, 'ER  - ') AS x
FROM r LEFT JOIN {_people_table("'AU  - ' || family || ', ' || given", "chr(10)")} p ON p.k = r.k
""")
def _(t, spark):
    """RIS of every article."""
    return _each(t, cite.ris_record)


@query("snk7_bibtex", f"""
WITH {_RECORDS_SQL}
SELECT CAST(r.k AS VARCHAR) AS id, '@inproceedings{{' || r.k || ',' || chr(10) || concat_ws(',' || chr(10), '  author = {{' || people || '}}', '  title = {{' || whole || '}}', '  booktitle = {{' || event || '}}', '  year = {{' || year(day) || '}}', '  publisher = {{' || publisher || '}}', '  address = {{' || place || '}}',
  '  pages = {{' || replace(pages, '-', '--') || '}}', '  doi = {{' || doi || '}}', '  url = {{' || page_url || '.pdf}}') || chr(10) || '}}' AS x
FROM r LEFT JOIN {_people_table("family || ', ' || given", "' and '")} p ON p.k = r.k
""")
def _(t, spark):
    """BibTeX of every article."""
    return _each(t, cite.bibtex_record)


@query("snk7_signposts", f"""
WITH {_RECORDS_SQL}
SELECT CAST(r.k AS VARCHAR) AS id, concat_ws(', ', '<https://doi.org/' || doi || '>; rel="cite-as"', people, '<' || page_url || '.pdf>; rel="item"', '<https://schema.org/ScholarlyArticle>; rel="type"') AS x
FROM r LEFT JOIN (SELECT k, string_agg('<' || orcid || '>; rel="author"', ', ' ORDER BY n, p, given, family, affiliation NULLS FIRST, country) AS people FROM a WHERE orcid IS NOT NULL GROUP BY k) p ON p.k = r.k
""")
def _(t, spark):
    """Link headers of every article."""
    return _each(t, cite.signposts)
