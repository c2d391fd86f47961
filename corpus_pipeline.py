"""From documents to sampled token sequences: the stages that make a training corpus.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import jaccard_join, language_id, line_dedup, piece_sampling, source_mixing
from scriptorium.llm.common import DOC_COLUMNS, stored, table

#: Share of a document's letters that learned languages must explain.
EXPLAINED = 0.5
#: A line in more than this share of the different texts of its source goes, if the source has so many. On sf0.1, 1424 of
#: the 1458 lines that any source repeats are in up to 0.047 of its texts, most of them short; those planted in all sources are
#: in 0.085 to 0.13. The share lies where lines of more than a few words end.
FREQUENT, LEAST_DOCUMENTS = 0.03, 100
#: What becomes of the tokens of each domain in documents whose likeliest domain is not WHOLE; those where it is stay.
FACTORS, WHOLE = {"good": 1.0, "low": 0.3, "toxic": 0.05}, "good"


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which languages learned from those with a language explain at least EXPLAINED of the letters;
    others, key-mash and texts without a letter go.

    A low score alone rejects nothing: it marks mixed texts, which may be clean.
    """
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    found = language_id.identify(docs, model, tuple(DOC_COLUMNS))
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("explained") >= EXPLAINED)).select(*DOC_COLUMNS)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are frequent in their source; those with nothing left go.

    Copies are no evidence here, as the next stage keeps one of each group. Documents without a source are one group.
    """
    source = F.coalesce(F.col("source"), F.lit(""))
    found = line_dedup.drop_boilerplate(docs.select(*DOC_COLUMNS), "text", source, FREQUENT, LEAST_DOCUMENTS, once=True)
    left = found.where((F.col("n_dropped") == 0) | (F.length(F.trim("text")) > 0))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*DOC_COLUMNS)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; of repeated rows, one."""
    groups = jaccard_join.jaccard_components(docs)
    gone = groups.where("doc_id <> component_id").select("doc_id")
    return docs.select(*DOC_COLUMNS).join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"]).select(*DOC_COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its fitted rate says: once if it is likeliest good, others are thinned."""
    rates = source_mixing.mix(docs, source_mixing.labelled(spark, sf_dir), factors=FACTORS, whole=WHOLE)
    taken = rates.where("copies >= 1").select(F.col("doc_id").alias("_id"), "copies")
    rows = docs.select(*DOC_COLUMNS).join(taken, F.col("doc_id").eqNullSafe(F.col("_id")))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*DOC_COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations: (doc_id, sample, ids, log_prob, value, inclusion)."""
    return piece_sampling.sample(docs.select("doc_id", "text"))


STAGES = [
    ("language ID", identified),
    ("line dedup", without_boilerplate),
    ("n-gram Jaccard join", deduplicated),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Sampling and learned models are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL = None
