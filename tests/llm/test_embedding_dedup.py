import numpy as np
import pytest

from scriptorium.llm import embedding_dedup as ed


def brute(rows):
    good = {}
    for k, (i, v) in enumerate(rows):
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, dtype=np.float32).astype(float)
        good[k] = x / np.linalg.norm(x)
    comp = {k: k for k in range(len(rows))}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    links = dict.fromkeys(range(len(rows)), 0)
    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.95:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    low = {}
    for k in comp:
        low.setdefault(find(k), []).append(rows[k][0])
    return sorted(((rows[k][0] is None, rows[k][0]), links[k], min(low[find(k)]) if rows[k][0] is not None else None) for k in comp)


def fixture(n=64):
    rng = np.random.default_rng(6)
    rows = []
    for c in range(30):
        centre = rng.normal(size=n)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((centre + rng.normal(size=n) * rng.choice([0.05, 0.15, 0.3])).astype(np.float32).tolist())
    hot = rng.normal(size=n)
    rows += [(hot + rng.normal(size=n) * 0.1).astype(np.float32).tolist() for _ in range(60)]
    rows += [rows[0]] * 5 + [[2 * x for x in rows[0]]]
    rows += [None, [], [0.0] * n, [float("nan")] * n, [float("inf")] + [1.0] * (n - 1), [None] + [1.0] * (n - 1), [1.0, 2.0], [1.0, 2.01], [-3.0], [-4.0], [1e30] * n, [1e-30] * n]
    return list(enumerate(rows)) + [(None, rows[0])]


@pytest.mark.parametrize("block", [1024, 16])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ed, "BLOCK", block)
    monkeypatch.setattr(ed, "CODE_BLOCK", 2 * block)
    monkeypatch.setattr(ed, "STRIP", 40 * block)
    rows = fixture()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", ed.F.lit(1)).withColumn("rep", ed.F.lit(1)).repartition(3)
    got = ed.near_duplicates(df).collect()
    assert sorted(((r.vec_id is None, r.vec_id), r.n_links, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(9)
    dim, t = 64, 0.95
    errors, short = [], 0
    for _ in range(300):
        r = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        x = rng.normal(size=dim)
        x /= np.linalg.norm(x)
        w = rng.normal(size=dim)
        w -= w @ x * x
        y = t * x + np.sqrt(1 - t * t) * w / np.linalg.norm(w)
        o = np.sign(x @ r) / np.sqrt(dim)
        f = o @ (x @ r)
        errors.append(o @ (y @ r) / f - t)
        short += errors[-1] < -np.sqrt(1 - t * t) * np.sqrt(1 - f * f) / f * ed.EPSILON / np.sqrt(dim - 1)
    assert abs(np.mean(errors)) < 4 * np.std(errors) / np.sqrt(len(errors)) and short == 0


def test_empty_table(spark):
    assert ed.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_repeated_ids_on_different_vectors(spark):
    rng = np.random.default_rng(3)
    x, y, z = (rng.normal(size=64).astype(np.float32).tolist() for _ in range(3))
    rows = [(1, x), (1, y), (2, x), (3, y), (4, z), (4, z), (5, [-0.0, 1.0]), (6, [0.0, 1.0])]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 1, 4, True), (4, 1, 4, True), (5, 1, 5, True), (6, 1, 5, False)]


def test_recall_on_the_table(spark):
    """Every link that all pairs in double precision show is found, on a real table and on one of near copies at the threshold."""
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect() if r.embedding]
    rng = np.random.default_rng(8)
    for i in range(300):
        x = rng.normal(size=64)
        w = rng.normal(size=64)
        x, w = x / np.linalg.norm(x), w - w @ x * x / (x @ x)
        w /= np.linalg.norm(w)
        rows += [(100_000 + 2 * i, x.tolist()), (100_001 + 2 * i, (0.951 * x + np.sqrt(1 - 0.951**2) * w).tolist())]
    v = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = {r[0]: int(n) - 1 for r, n in zip(rows, ((v @ v.T) >= 0.95).sum(axis=1))}
    got = {r.vec_id: r.n_links for r in ed.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert sum(min(got[i], n) for i, n in want.items()) >= 0.99 * sum(want.values()) and all(got[i] <= n for i, n in want.items())


def test_sign_bits_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(10)
    bits, tables = ed.shape_of_tables(50_000)
    for _ in range(300):
        x, w = rng.normal(size=(2, 64))
        x /= np.linalg.norm(x)
        w -= w @ x * x
        pair = np.stack([x, 0.95 * x + np.sqrt(1 - 0.95**2) * w / np.linalg.norm(w)])
        _, codes, _ = ed.encode(pair, bits, tables)
        signs = np.unpackbits(codes, axis=1)
        assert (signs[0] == signs[1]).mean() >= ed.least_agreement(signs.shape[1])
