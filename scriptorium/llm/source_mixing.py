"""Mixing documents to target weights by soft membership, in DataFrame operations only.

1. A naive Bayes classifier over hashed words learns the domains from a table of
   labels and gives every document posterior shares p of the domains.
2. Rates x >= 0 are fitted so that the expected domain totals
   sum(x * tokens * p) meet the targets T: least squares weighted by the inverse of
   G = sum(tokens * p * p'), solved by projected gradient from x = 1. In the metric of
   the tokens the gradient's Lipschitz constant is 1, so the step is 1:
   x <- max(0, x - p' inverse(G) (sum(x * tokens * p) - T)).

Each iteration is one aggregation to as many numbers as there are domains; a
document's rate is a fold over the residuals so far, so no state is carried.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import stored, table

#: Hashed features: words, and the last two characters of words.
WORDS, ENDINGS = 1 << 16, 1 << 12
#: Labelled documents to learn from at most (in expectation; chosen by a hash of the id).
TRAIN_ROWS = 20_000
#: Words that a document's evidence counts for at most; more words are averaged to so many.
EVIDENCE = 30.0
SMOOTHING = 0.5
ITERATIONS, TOLERANCE = 40, 1e-4

DOMAINS = ("good", "low", "toxic")


def domain_of(quality: Column, toxic: Column) -> Column:
    """The domains of the labels table: toxic, else low quality, else good."""
    return F.when(toxic == 1, "toxic").when(quality == 0, "low").when(quality == 1, "good")


def _features(df: DataFrame, *keep: str) -> DataFrame:
    """A row for every word (one with null for a text without any): its word and ending features."""
    words = df.select(*keep, F.explode_outer(F.split("text", "[ \\t\\n\\x0B\\f\\r]+")).alias("w"))
    return words.select(
        *keep,
        F.when(F.col("w") != "", F.pmod(F.xxhash64("w"), F.lit(WORDS)).cast("int")).alias("word"),
        F.when(F.col("w") != "", (F.pmod(F.hash(F.right(F.col("w"), F.lit(2))), F.lit(ENDINGS)) + WORDS).cast("int")).alias("ending"),
    )


def learn(docs: DataFrame, labels: DataFrame, domains: tuple[str, ...] = DOMAINS, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row: for each domain d the array ll_d of log-likelihoods by feature, and prior_d.

    labels has (doc_id, domain); domains not asked for and nulls don't count, and of
    several domains of one document the first by name does. A domain without labelled
    words is as likely as chance everywhere.
    """
    known = labels.where(F.col("domain").isin(*domains) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    total = known.count()
    share = min(1.0, train_rows / max(1, total))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < int(share * 1_000_000))
    words = _features(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "domain").where("word is not null")
    sums = [F.count(F.when(F.col("domain") == d, 1)).alias(f"n_{d}") for d in domains]
    counts = words.select("domain", F.explode(F.array("word", "ending")).alias("feature")).groupBy("feature").agg(*sums)
    every = docs.sparkSession.range(WORDS + ENDINGS).select(F.col("id").cast("int").alias("feature"))
    dense = every.join(counts, "feature", "left").na.fill(0)
    in_order = F.sort_array(F.collect_list(F.struct("feature", *[f"n_{d}" for d in domains])))
    one = dense.agg(in_order.alias("rows"), *[F.sum(f"n_{d}").alias(f"all_{d}") for d in domains])
    width = WORDS + ENDINGS
    # Smoothing in proportion to a domain's words: words that no domain has speak for none.
    every_word = " + ".join(f"all_{d}" for d in domains)
    part = {d: f"({SMOOTHING}D * greatest(coalesce(all_{d} * {len(domains)}D / nullif({every_word}, 0), 0D), 1e-9D))" for d in domains}
    arrays = [F.expr(f"transform(rows, r -> ln(r.n_{d} + {part[d]}) - ln(all_{d} + {width}D * {part[d]}))").alias(f"ll_{d}") for d in domains]
    priors = chosen.agg(*[((F.count(F.when(F.col("domain") == d, 1)) + 1.0) / (F.count(F.lit(1)) + float(len(domains)))).alias(f"prior_{d}") for d in domains])
    return stored(one.select(*arrays).crossJoin(F.broadcast(priors)))


def posteriors(docs: DataFrame, model: DataFrame, domains: tuple[str, ...] = DOMAINS) -> DataFrame:
    """(doc_id, tokens, p_<domain>...) for every doc_id; the p of a document without words are the priors.

    Rows that repeat a doc_id are one document. The model's arrays have a fixed
    size and come in as scalar subqueries, so that no row carries them.
    """
    ll = {d: model.select(f"ll_{d}").scalar() for d in domains}
    score = [
        F.sum(F.when(F.col("word").isNull(), 0.0).otherwise(F.get(ll[d], F.col("word")) + F.get(ll[d], F.col("ending")))).alias(f"s_{d}")
        for d in domains
    ]
    sums = _features(docs.select("doc_id", "text"), "doc_id").groupBy("doc_id").agg(F.count("word").alias("tokens"), *score)
    weight = F.lit(EVIDENCE) / F.greatest(F.lit(EVIDENCE), F.col("tokens"))
    logit = sums.select("doc_id", "tokens", *[(F.col(f"s_{d}") * weight + F.ln(model.select(f"prior_{d}").scalar())).alias(f"z_{d}") for d in domains])
    top = F.greatest(*[F.col(f"z_{d}") for d in domains]) if len(domains) > 1 else F.col(f"z_{domains[0]}")
    powers = logit.select("doc_id", "tokens", *[F.exp(F.col(f"z_{d}") - top).alias(f"e_{d}") for d in domains])
    total = sum((F.col(f"e_{d}") for d in domains), F.lit(0.0))
    return powers.select("doc_id", "tokens", *[(F.col(f"e_{d}") / total).alias(f"p_{d}") for d in domains])


def _fold(domains: tuple[str, ...], steps: list[np.ndarray]) -> Column:
    """The rate after the given steps (one vector over the domains each)."""
    if not steps:
        return F.lit(1.0)
    rows = "array(" + ", ".join("array(" + ", ".join(f"{v!r}D" for v in map(float, s)) + ")" for s in steps) + ")"
    dot = " + ".join(f"p_{d} * s[{i}]" for i, d in enumerate(domains))
    return F.expr(f"aggregate({rows}, 1.0D, (x, s) -> greatest(0.0D, x - ({dot})))")


def fit_rates(members: DataFrame, targets: Mapping[str, float]) -> tuple[Column, list[float], int]:
    """The rate as a Column of members (doc_id, tokens, p_...), the domain totals it reaches, and the steps taken.

    members should be stored: every step reads it. targets are token totals.
    Steps end when every total is within TOLERANCE of its target (relative to
    the tokens of all documents), no longer moves, or after ITERATIONS.
    """
    domains = tuple(targets)
    want = np.array([float(targets[d]) for d in domains])
    gram = members.agg(
        *[F.coalesce(F.sum(F.col("tokens") * F.col(f"p_{a}") * F.col(f"p_{b}")), F.lit(0.0)) for i, a in enumerate(domains) for b in domains[i:]],
        F.coalesce(F.sum("tokens"), F.lit(0)),
    ).first()
    n = len(domains)
    g = np.zeros((n, n))
    g[np.triu_indices(n)] = gram[:-1]
    g = g + np.triu(g, 1).T
    total = float(gram[-1])
    if not total:
        return F.lit(1.0), [0.0] * n, 0
    inverse = np.linalg.pinv(g + np.eye(n) * 1e-9 * total)
    steps: list[np.ndarray] = []
    while True:
        rate = _fold(domains, steps)
        at = members.select(rate.alias("x"), "tokens", *[f"p_{d}" for d in domains]).agg(*[F.sum(F.col("x") * F.col("tokens") * F.col(f"p_{d}")) for d in domains]).first()
        reached = np.array([float(v) for v in at])
        residual = reached - want
        still = len(steps) > 0 and np.abs(reached - last).max() <= TOLERANCE * 1e-2 * total
        if np.abs(residual).max() <= TOLERANCE * total or still or len(steps) == ITERATIONS:
            return rate, reached.tolist(), len(steps)
        steps.append(inverse @ residual)
        last = reached


def copies(rate: Column, key: Column) -> Column:
    """How often to take a document: the rate, rounded up or down by a hash of the key so that the mean is kept."""
    draw = F.pmod(F.xxhash64(key, F.lit(29)), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + draw).cast("int")


def mix(docs: DataFrame, labels: DataFrame, shares: Mapping[str, float] | None = None, budget: float = 1.0, factors: Mapping[str, float] | None = None, whole: str | None = None) -> DataFrame:
    """(doc_id, tokens, p_<domain>..., rate, copies) for every doc_id of docs (doc_id, text).

    Targets are either shares of budget times all tokens, or factors of the
    expected total that each domain has now. Documents whose likeliest domain is
    ``whole`` have rate 1; targets and rates are then those of the others. Null and empty texts have no tokens
    and the rate that their prior posteriors give.
    """
    domains = tuple(shares or factors)
    members = stored(posteriors(docs, learn(docs, labels, domains), domains))
    sure = F.lit(False)
    if whole:
        sure = F.col(f"p_{whole}") >= F.array_max(F.array(*[F.col(f"p_{d}") for d in domains]))
    fitted = members.where(~sure)
    now = fitted.agg(F.sum("tokens"), *[F.sum(F.col("tokens") * F.col(f"p_{d}")) for d in domains]).first()
    now = [float(v or 0) for v in now]
    if shares:
        total = sum(shares.values())
        targets = {d: shares[d] / total * budget * now[0] for d in domains}
    else:
        targets = {d: factors[d] * now[i + 1] for i, d in enumerate(domains)}
    rate, _, _ = fit_rates(fitted, targets)
    return members.withColumn("rate", F.when(sure, 1.0).otherwise(rate) if whole else rate).withColumn("copies", copies(F.col("rate"), F.col("doc_id")))


#: Target shares of the tokens, and the tokens asked for as a share of all.
SHARES, BUDGET = {"good": 0.95, "low": 0.04, "toxic": 0.01}, 0.9


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain) of the labels table."""
    return table(spark, sf_dir, "labels").select("doc_id", domain_of(F.col("quality"), F.col("toxic")).alias("domain"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: rates that mix all documents to the target shares of the labels' domains."""
    return mix(table(spark, sf_dir, "documents"), labelled(spark, sf_dir), shares=SHARES, budget=BUDGET)
