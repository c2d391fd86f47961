"""Queries over entity resolution and the remaining joins, windows and extractions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from scriptorium.operators import entities as er
from scriptorium.operators import relational as ops
from scriptorium.plans.catalogue import case, query, values

_AUTHORS = [
    (1, "Maria Beatriz", "Cappello"), (2, "M. B.", "Cappello"), (3, "Maria Beatriz", "Capello"), (4, "Ana", "Lima"), (5, "Ana Paula", "Lima"), (6, "Ana Paula Souza", "Lima"),
    (7, "João", "de Souza"), (8, "João Carlos", "Silva Neto"), (9, "J. Carlos", "Silva Neto"), (10, "Rui", "Costa"), (11, "Eva", "Costa"),
]


def _authors(spark):
    return spark.createDataFrame(_AUTHORS, "id int, given string, family string")


@case("er1_particles", "SELECT * FROM " + values([(i, g if i != 7 else "João de", f if i != 7 else "Souza") for i, g, f in _AUTHORS], "id, given, family"))
def _(t, spark):
    s = er.particles_to_given(F.col("given"), F.col("family"))
    return _authors(spark).select("id", s["given"].alias("given"), s["family"].alias("family"))


_FULL_NAME_WANT = [(2, 1), (4, 5), (5, 6), (9, 8)]


@case("er3_full_name_merges", "SELECT * FROM " + values(_FULL_NAME_WANT, "removed, keep"))
def _(t, spark):
    """Blocks of last surnames, compatible whole names, the longer one kept; chains are for merge_targets to follow."""
    pairs = er.pairs_of(_authors(spark), er.surname_block(F.col("family")))
    return er.merge_map(pairs, er.same_full_name(2))


@case("er4_sure_variants", "SELECT * FROM " + values([(5, 6)], "removed, keep"))
def _(t, spark):
    pairs = er.pairs_of(_authors(spark), er.surname_block(F.col("family")))
    return er.merge_map(pairs, er.same_surname_variant("alta"))


@case("er5_unsure_report", "SELECT * FROM " + values([(1, 2), (4, 5), (4, 6), (8, 9)], "id, id_2"))
def _(t, spark):
    pairs = er.pairs_of(_authors(spark), er.surname_block(F.col("family")))
    return pairs.where(er.same_surname_variant("baixa")).select("id", "id_2")


_TOGETHER, _SHARED = [(4, 5)], [(1, 3)]
_REASONS = [(1, 2, True, "exact"), (1, 3, True, "jw+coauthors"), (2, 3, True, "jw"), (4, 5, False, "coappear"), (10, 11, False, "name_mismatch")]


@case("nam5_reasons", "SELECT * FROM " + values(_REASONS, "id, id_2, is_match, reason"))
def _(t, spark):
    a = _authors(spark)
    b = a.toDF("id_2", "given_2", "family_2")
    wanted = spark.createDataFrame([r[:2] for r in _REASONS], "id int, id_2 int")
    pairs = wanted.join(a, "id").join(b, "id_2")
    pair = "id int, id_2 int"
    return er.reasons(pairs, spark.createDataFrame(_TOGETHER, pair), spark.createDataFrame(_SHARED, pair)).select("id", "id_2", "is_match", "reason")


_EXTERNAL = [(1, "Ana Paula", "Lima", "Ana", "de Lima", True), (2, "A.", "Lima", "Ana", "Lima", False), (3, "Rui", "Sá", "Eva", "Sá", False)]


@case("nam14_external_names", "SELECT * FROM " + values([(r[0], r[5]) for r in _EXTERNAL], "id, ok"))
def _(t, spark):
    df = spark.createDataFrame([r[:5] for r in _EXTERNAL], "id int, g string, f string, og string, of string")
    return df.select("id", er.external_compatible(*[F.col(c) for c in ("g", "f", "og", "of")]).alias("ok"))


_AFF = [(1, "UFPE", ["Universidade Federal de Pernambuco"], True), (2, "FAU-USP", ["USP São Paulo"], True), (3, "PUC", ["Outra"], False), (4, None, ["x"], False)]


@case("nam15_affiliations", "SELECT * FROM " + values([(r[0], r[3]) for r in _AFF], "id, ok"))
def _(t, spark):
    df = spark.createDataFrame([r[:3] for r in _AFF], "id int, a string, o array<string>")
    return df.select("id", er.affiliation_matches(F.col("a"), F.col("o"), {"ufpe": "federal de pernambuco"}).alias("ok"))


_TITLES = [(1, "Casa moderna em Natal"), (2, "Escola parque no Recife"), (3, "Outra coisa")]
_PDFS = [(10, "E01-SILVA. Casa moderna.pdf"), (11, "E02-LIMA. Escola parque.pdf"), (12, "E03-LIMA. Escola.pdf")]


@case("join11_fuzzy_best_match", "SELECT * FROM " + values([(1, 10, 20), (2, 11, 20)], "id, file, score"))
def _(t, spark):
    """Ten points for every word in common, from 20 on; each file goes to its best title and each title to its best file."""
    word = lambda c: F.explode(F.array_distinct(F.filter(F.split(F.lower(c), "[^\\p{L}]+"), lambda w: F.length(w) > 3)))
    a = spark.createDataFrame(_TITLES, "id int, x string").select("id", word("x").alias("w"))
    b = spark.createDataFrame(_PDFS, "file int, x string").select("file", word("x").alias("w"))
    scores = a.join(b, "w").groupBy("id", "file").agg((F.count(F.lit(1)) * 10).cast("int").alias("score")).where("score >= 20")
    best = ops.latest_per_key(scores, "id", [F.desc("score"), F.asc("file")])
    return ops.latest_per_key(best, "file", [F.desc("score"), F.asc("id")])


_META = [("a.pdf", "x"), ("B C.pdf", "y")]
_ASKED = [(1, "a.pdf"), (2, "b_c.pdf"), (3, "d.pdf")]


@case("join13_exact_then_normal", "SELECT * FROM " + values([(1, "x"), (2, "y"), (3, None)], "id, v"))
def _(t, spark):
    key = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")
    m = spark.createDataFrame(_META, "name string, v string")
    a = spark.createDataFrame(_ASKED, "id int, name string")
    exact = a.join(m.withColumnRenamed("v", "v1"), "name", "left")
    loose = exact.withColumn("k", key("name")).join(m.select(key("name").alias("k"), F.col("v").alias("v2")), "k", "left")
    return loose.select("id", F.coalesce("v1", "v2").alias("v"))


@query("join21_position_overrides", """
WITH p AS (SELECT doc_id, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS pos, string_split(text, chr(10)) AS ls FROM documents)
SELECT doc_id, pos, ls[pos + 1] AS line FROM p WHERE pos <> doc_id % 5
""")
def _(t, spark):
    """Lines without those named by (document, position)."""
    lines = t("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    gone = t("documents").selectExpr("doc_id", "cast(doc_id % 5 as int) pos")
    return lines.join(gone, ["doc_id", "pos"], "left_anti").select("doc_id", F.col("pos").cast("long").alias("pos"), "line")


@query("win9_nearest_tag", """
WITH p AS (SELECT page_id, string_split_regex(html, '<(?:p|h1|h2|h3|title)[^>]*>') AS xs, regexp_extract_all(html, '<(p|h1|h2|h3|title)[^>]*>', 1) AS tags FROM pages WHERE html IS NOT NULL),
r AS (SELECT page_id, i, tags[i] AS tag, trim(regexp_extract(xs[i + 1], '^([^<]*)', 1)) AS x FROM (SELECT *, unnest(generate_series(1, len(tags))) AS i FROM p)),
n AS (SELECT *, last_value(CASE WHEN tag <> 'p' AND x <> '' THEN x END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY i) AS heading FROM r)
SELECT page_id, x AS paragraph, arg_min(heading, i) AS heading FROM n WHERE tag = 'p' AND x <> '' GROUP BY page_id, x
""")
def _(t, spark):
    """Each paragraph of a page with the nearest heading before it; the first place of a repeated one counts (EXT14)."""
    marks = "<(?:p|h1|h2|h3|title)[^>]*>"
    pieces = t("pages").where("html is not null").select("page_id", F.arrays_zip(
        F.regexp_extract_all("html", F.lit(marks.replace("?:", "")), F.lit(1)).alias("tag"),
        F.slice(F.split("html", marks), 2, 1_000_000_000).alias("x"),
    ).alias("z")).select("page_id", F.posexplode("z").alias("pos", "z"))
    x = F.trim(F.regexp_extract("z.x", "^([^<]*)", 1))
    w = Window.partitionBy("page_id").orderBy("pos")
    named = pieces.select("page_id", "pos", F.col("z.tag").alias("tag"), x.alias("x"))
    named = named.withColumn("heading", F.last(F.when((F.col("tag") != "p") & (F.col("x") != ""), F.col("x")), ignorenulls=True).over(w))
    found = named.where("tag = 'p' and x <> ''").groupBy("page_id", F.col("x").alias("paragraph"))
    return found.agg(F.min_by(F.struct("heading"), "pos").alias("h")).select("page_id", "paragraph", F.col("h.heading").alias("heading"))


@query("win12_first_and_last_heading", """
WITH p AS (SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) AS pos, string_split(text, chr(10)) AS ls FROM documents)
SELECT doc_id, min(pos) - 1 AS first, max(pos) - 1 AS last FROM p WHERE length(ls[pos]) < 40 GROUP BY doc_id
""")
def _(t, spark):
    lines = t("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(F.length("line") < 40)
    return lines.groupBy("doc_id").agg(F.min("pos").cast("long").alias("first"), F.max("pos").cast("long").alias("last"))


@query("agg10_having_order", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand HAVING count(*) >= 70 ORDER BY n DESC, p_brand")
def _(t, spark):
    return t("part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).where("n >= 70").orderBy(F.desc("n"), "p_brand")


@query("agg13_unmapped_values", """
WITH p AS (SELECT p_brand || '/' || p_type AS v, p_size FROM part) SELECT v, count(*) AS n FROM p WHERE v NOT IN (SELECT v FROM p WHERE p_size > 48) GROUP BY v
""")
def _(t, spark):
    """How often each value occurs that no large part maps."""
    p = t("part").selectExpr("concat(p_brand, '/', p_type) v", "p_size")
    return p.join(p.where("p_size > 48").select("v").distinct(), "v", "left_anti").groupBy("v").agg(F.count(F.lit(1)).alias("n"))


@query("cap5_changed_counts", """
SELECT p_brand, count(*) AS total, count(*) FILTER (upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) <> p_name) AS changed FROM part GROUP BY p_brand
""")
def _(t, spark):
    from scriptorium.functions.text import sentence_case
    from scriptorium.operators.capitalize import changed_counts

    return changed_counts(t("part").withColumn("new", sentence_case(F.col("p_name"))), "p_brand", "p_name", "new")


@query("snk8_deposit_metadata", """
SELECT p_partkey, to_json({'title': p_name, 'upload_type': 'publication', 'keywords': string_split(p_type, ' '), 'creators': [{'name': p_brand}]}) AS metadata FROM part
""")
def _(t, spark):
    creators = F.array(F.struct(F.col("p_brand").alias("name")))
    return t("part").select("p_partkey", F.to_json(F.struct(F.col("p_name").alias("title"), F.lit("publication").alias("upload_type"), F.split("p_type", " ").alias("keywords"), creators.alias("creators"))).alias("metadata"))


@query("snk5_front_matter", "SELECT n_nationkey, '---' || chr(10) || 'title: \"' || n_name || '\"' || chr(10) || 'region: ' || r_name || chr(10) || '---' AS page FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(t, spark):
    n = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select("n_nationkey", F.concat(F.lit('---\ntitle: "'), "n_name", F.lit('"\nregion: '), "r_name", F.lit("\n---")).alias("page"))
