"""The whole merge of people who are one: who survives with what, which names are kept as variants, whose links move (ER6)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.text import strip_accents, words
from scriptorium.operators.relational import merge_targets
from scriptorium.sources.shared import stored


class Merged(NamedTuple):
    """The four tables that a merge leaves."""

    authors: DataFrame
    variants: DataFrame
    links: DataFrame
    log: DataFrame


def _filled(c: str) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def fullness(name: str) -> Column:
    """What makes a name the fuller one: its words, then its letters, then marks on them (NAM6)."""
    return F.struct(F.size(words(F.col(name))).alias("w"), F.length(name).alias("n"), (F.col(name) != strip_accents(F.col(name))).alias("a"))


def merge_authors(authors: DataFrame, variants: DataFrame, links: DataFrame, pairs: DataFrame, source: str = "dedup") -> Merged:
    """All merges of pairs (removed, keep) at once, chains followed to their ends.

    - authors (id, given, family, email, orcid): the kept ones. The fullest given name of the group stays (of equals the kept
      one's, then that of the least id), as do the kept one's e-mail and identifier where filled, else the first filled ones by id of those removed;
      ``email_from`` and ``orcid_from`` say whose they are.
    - variants (author_id, given, family, source): those known, of their kept authors, and the names of those removed under
      ``source``. A name is a variant once: a known one before a new one, then that of the least id.
    - links (article, author_id, ...): of their kept authors. Of several of one group in an article one stays: the kept one's own, else
      that of the least removed id; other columns are that link's.
    - log (removed, keep, given, family): every merge. Removed ids that authors lack are followed, but not logged.

    Groups are reduced by partial aggregates; an author merged into a third of all others is no single task's.
    """
    targets = stored(merge_targets(pairs))
    at = authors.join(targets.withColumnRenamed("removed", "id"), "id", "left").withColumn("_to", F.coalesce("keep", "id")).withColumn("_own", F.col("keep").isNull())
    # Order of a group: the kept one, then those removed by id. The greatest fullness comes first, so order counts backwards there.
    order = F.struct(~F.col("_own"), F.col("id"))
    first = lambda c: F.min(F.when(_filled(c).isNotNull(), F.struct(~F.col("_own"), F.col("id").alias("id"), F.col(c).alias("v"))))
    full = F.struct(fullness("given").alias("f"), F.col("_own").alias("o"), (-F.col("id")).alias("i"), F.col("given").alias("v"))
    groups = at.groupBy("_to").agg(F.max(full)["v"].alias("given"), F.min_by("family", order).alias("family"), first("email").alias("_e"), first("orcid").alias("_o"), F.count_if("_own").alias("_n"))
    kept = groups.where("_n > 0").select(
        F.col("_to").alias("id"), "given", "family", F.col("_e.v").alias("email"), F.col("_e.id").alias("email_from"), F.col("_o.v").alias("orcid"), F.col("_o.id").alias("orcid_from")
    )
    log = at.where("not _own").select(F.col("id").alias("removed"), F.col("_to").alias("keep"), "given", "family")
    moved = lambda df, key: df.join(targets.withColumnRenamed("removed", key), key, "left").withColumn("_own", F.col("keep").isNull()).withColumn("_from", F.col(key)).withColumn(key, F.coalesce("keep", key))
    known = moved(variants.select("author_id", "given", "family", "source"), "author_id").select("author_id", "given", "family", "source", F.lit(0).alias("_new"), "_from")
    new = log.select(F.col("keep").alias("author_id"), "given", "family", F.lit(source).alias("source"), F.lit(1).alias("_new"), F.col("removed").alias("_from"))
    every = known.unionByName(new).groupBy("given", "family").agg(F.min(F.struct("_new", "_from", "author_id", "source")).alias("_v"))
    rest = [c for c in links.columns if c not in ("article", "author_id")]
    one = moved(links, "author_id").groupBy("article", "author_id").agg(F.min(F.struct(~F.col("_own"), "_from", *rest)).alias("_l"))
    return Merged(kept, every.select("_v.author_id", "given", "family", "_v.source"), one.select("article", "author_id", *[F.col(f"_l.{c}").alias(c) for c in rest]), log)
