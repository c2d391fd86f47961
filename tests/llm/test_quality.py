import numpy as np
import pyarrow as pa

from scriptorium.llm import quality
from scriptorium.llm.textbytes import slices


def make(spark, n=300):
    rng = np.random.default_rng(3)
    words = [f"word{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(n):
        text = " ".join(rng.choice(words, 40))
        if i % 3 == 0:
            text = " ".join(w + "$$$" for w in text.split()) if i % 2 else text.upper().replace(" ", "!! ")
        rows.append((i, text, "x"))
        labels.append((i, int(i % 3 != 0)))
    rows += [(n, None, "x"), (n + 1, "", "x"), (n + 2, " ", "x"), (n + 3, "long " * 60000, "x"), (0, rows[0][1], "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels + [(1, None), (None, 1)], "doc_id long, label int")


def test_learns_and_scores_every_row(spark):
    docs, labels = make(spark)
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r.score for r in got}
    assert all(0 <= r.score <= 1 for r in got)
    right = np.mean([(by[i] >= 0.5) == (i % 3 != 0) for i in range(300)])
    assert right > 0.95


def test_scores_are_dot_products():
    weights = np.random.default_rng(0).normal(size=2**quality.BITS + 1)
    texts = ["One two, two THREE!!", "", "a", "é b é"]
    whole = [s for _, _, part in slices(pa.array(texts)) for s in quality.scores(weights, part)]
    alone = [quality.scores(weights, part)[0] for t in texts for _, _, part in slices(pa.array([t]))]
    assert np.allclose(whole, alone)
    (_, _, part), = slices(pa.array(["One two"]))
    logit = sum(weights[i].sum() for i, _ in quality.features(part)) * quality.SCALE / 2 + weights[-1]
    assert np.isclose(quality.scores(weights, part)[0], 1 / (1 + np.exp(-logit)))


def test_without_labels_or_rows(spark):
    docs, labels = make(spark, 6)
    weights = quality.fit(docs, labels.where("false"))
    assert {r.score for r in quality.score(docs, weights).collect()} == {0.5}
    assert quality.score(docs.where("false"), weights).count() == 0


def test_training_is_ftrl_proximal():
    """train() against the update rule written out feature by feature."""
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["a", "bb", "Cc", "d1", "e!", "ff"], int(rng.integers(0, 12)))) for _ in range(60)]
    labels = rng.integers(0, 2, 60).astype(float)
    got, intercept = quality.train(texts, labels)
    rows = []
    for t in texts:
        (_, _, part), = slices(pa.array([t]))
        kinds = quality.features(part)
        counts = {}
        for index, _ in kinds:
            for f in index.tolist():
                counts[f] = counts.get(f, 0) + 1
        rows.append({f: c * quality.SCALE / len(kinds[0][0]) for f, c in counts.items()})
    z, n = {}, {}

    def weight(f, l1):
        if abs(z.get(f, 0.0)) <= l1:
            return 0.0
        l2 = 0.0 if f == "bias" else quality.L2
        return -(z[f] - np.sign(z[f]) * l1) / ((quality.BETA + np.sqrt(n[f])) / quality.ALPHA + l2)

    for _ in range(quality.EPOCHS):
        for row, label in zip(rows, labels):
            w = {f: weight(f, quality.L1) for f in row} | {"bias": weight("bias", 0.0)}
            p = 1 / (1 + np.exp(-(sum(w[f] * x for f, x in row.items()) + w["bias"])))
            for f, x in (row | {"bias": 1.0}).items():
                g = (p - label) * x
                before = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - (np.sqrt(before + g * g) - np.sqrt(before)) / quality.ALPHA * w[f]
                n[f] = before + g * g
    assert np.isclose(intercept, weight("bias", 0.0))
    want = np.zeros(2**quality.BITS)
    for f in z:
        if f != "bias":
            want[f] = weight(f, quality.L1)
    assert np.allclose(got, want)


def test_query_holds_out_a_quarter(spark, tmp_path):
    """Labels of held-out rows are turned round: what is learned must not notice, and must predict the true ones."""
    import zlib

    docs, labels = make(spark, 400)
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    rows = [(r.doc_id, 1 - r.label if held(r.doc_id) else r.label, 0) for r in labels.collect() if r.doc_id is not None and r.label is not None]
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in quality.query(spark, str(tmp_path)).collect()}
    out = [i for i in range(400) if held(i)]
    assert all(got[i].held_out == held(i) and got[i].predicted == int(got[i].score >= 0.7) for i in got)
    assert np.mean([(got[i].score >= 0.5) == (i % 3 != 0) for i in out]) > 0.95


def test_one_row_trains_at_full_weight(spark):
    """Weights are averaged over the shards that have rows."""
    docs = spark.createDataFrame([(7, "a b c a b c")], "doc_id long, text string")
    weights = quality.fit(docs, spark.createDataFrame([(7, 1)], "doc_id long, label int"))
    w, bias = quality.train(["a b c a b c"], np.array([1.0]))
    assert np.isclose(weights[-1], bias) and np.allclose(weights[:-1], w)
