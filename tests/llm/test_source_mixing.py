import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import source_mixing as sm


def make(spark, n=400):
    rng = np.random.default_rng(12)
    rows, labels = [], []
    for i in range(n):
        d = ["good", "good", "low", "toxic"][i % 4]
        own = [f"{d}{k}" for k in range(20)]
        both = [f"any{k}" for k in range(200)]
        words = [str(rng.choice(own)) if rng.random() < 0.2 else str(rng.choice(both)) for _ in range(int(rng.integers(3, 120)))]
        rows.append((i, " ".join(words), "x"))
        if i % 3:
            labels.append((i, d))
    rows += [(n, None, "x"), (n + 1, "", "x"), (n + 2, " \n", "x"), (n + 3, "any1 " * 30000, "x"), (None, "good1", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, rate string").repartition(3), spark.createDataFrame(labels + [(0, None), (None, "low"), (1, "other")], "doc_id long, domain string")


def test_targets_are_met(spark):
    docs, labels = make(spark)
    got = sm.mix(docs, labels, shares={"good": 0.8, "low": 0.15, "toxic": 0.05}, budget=0.6).collect()
    assert len(got) == docs.count()
    tokens = np.array([r.tokens for r in got], dtype=float)
    x = np.array([r.rate for r in got])
    p = np.array([[r.p_good, r.p_low, r.p_toxic] for r in got])
    assert np.allclose(p.sum(axis=1), 1) and (x >= 0).all()
    reached = (x * tokens) @ p
    assert np.allclose(reached / tokens.sum(), [0.48, 0.09, 0.03], atol=2e-3)
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in got)
    by = {r.doc_id: r for r in got}
    right = np.mean([max(("good", "low", "toxic"), key=lambda d: by[i][f"p_{d}"]) == ["good", "good", "low", "toxic"][i % 4] for i in range(400) if by[i].tokens > 30])
    assert right > 0.9


def test_against_plain_projected_gradient(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 60)
    tokens = rng.integers(1, 500, 60)
    members = spark.createDataFrame([(i, int(t), *map(float, q)) for i, (t, q) in enumerate(zip(tokens, p))], "doc_id long, tokens long, p_a double, p_b double, p_c double")
    want = np.array([1.3, 0.4, 0.3]) * tokens.sum() / 3
    rate, reached, steps = sm.fit_rates(members, dict(zip("abc", want)))
    got = np.array([r.x for r in members.select("doc_id", rate.alias("x")).orderBy("doc_id").collect()])
    x, g = np.ones(60), np.linalg.pinv((p.T * tokens) @ p + np.eye(3) * 1e-9 * tokens.sum())
    for _ in range(steps):
        x = np.maximum(0, x - p @ g @ ((x * tokens) @ p - want))
    assert np.allclose(got, x) and np.allclose(reached, (x * tokens) @ p)
    assert np.abs(reached - want).max() < 0.02 * tokens.sum()


def test_posteriors_against_plain_counts(spark):
    docs, labels = make(spark, 60)
    domains = ("good", "low", "toxic")
    model = sm.learn(docs, labels, domains)
    got = {r.doc_id: r for r in sm.posteriors(docs, model, domains).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    known = {r.doc_id: r.domain for r in labels.where(F.col("domain").isin(*domains)).collect() if r.doc_id is not None}
    split = lambda t: [w for w in re.split("[ \t\n\x0b\f\r]+", t) if w]
    vocab = sorted({w for t in texts.values() for w in split(t)})
    ids = {r.w: (r.a, r.b) for r in spark.createDataFrame([(w,) for w in vocab], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(sm.WORDS)).alias("a"), (F.pmod(F.hash(F.expr("right(w, 2)")), F.lit(sm.ENDINGS)) + sm.WORDS).alias("b")).collect()}
    counts = {d: np.zeros(sm.WORDS + sm.ENDINGS) for d in domains}
    for i, d in known.items():
        for w in split(texts[i]):
            for f in ids[w]:
                counts[d][f] += 1
    all_words = sum(c.sum() for c in counts.values())
    part = {d: sm.SMOOTHING * max(c.sum() * 3 / all_words, 1e-9) for d, c in counts.items()}
    ll = {d: np.log(c + part[d]) - np.log(c.sum() + part[d] * len(c)) for d, c in counts.items()}
    for i, t in texts.items():
        words = split(t)
        z = np.array([sum(ll[d][f] for w in words for f in ids[w]) * sm.EVIDENCE / max(sm.EVIDENCE, len(words)) + math.log((sum(v == d for v in known.values()) + 1) / (len(known) + 3)) for d in domains])
        q = np.exp(z - z.max())
        assert got[i].tokens == len(words)
        assert np.allclose([got[i][f"p_{d}"] for d in domains], q / q.sum(), atol=1e-9)


@pytest.mark.parametrize("which", ["docs", "labels"])
def test_empty_tables(spark, which):
    docs, labels = make(spark, 20)
    if which == "docs":
        assert sm.mix(docs.where("false"), labels, factors={"good": 1, "low": 0.5}).count() == 0
    else:
        got = sm.mix(docs, labels.where("false"), shares={"good": 1, "low": 1}).collect()
        assert all(abs(r.p_good - 0.5) < 1e-9 for r in got)


def test_likeliest_good_stay_whole(spark):
    docs, labels = make(spark)
    factors = {"good": 1.0, "low": 0.3, "toxic": 0.05}
    got = sm.mix(docs, labels, factors=factors, whole="good").collect()
    assert len(got) == docs.count()
    good = [r for r in got if r.p_good >= max(r.p_low, r.p_toxic)]
    assert any(r.p_good < 0.9 for r in good) and all(r.rate == 1 and r.copies == 1 for r in good)
    rest = [r for r in got if r.p_good < max(r.p_low, r.p_toxic)]
    total = sum(r.tokens for r in rest)
    for d, f in factors.items():
        p = np.array([r[f"p_{d}"] * r.tokens for r in rest])
        assert abs(p @ np.array([r.rate for r in rest]) - f * p.sum()) < 0.02 * total
    assert np.mean([r.copies for r in rest]) < 0.7
