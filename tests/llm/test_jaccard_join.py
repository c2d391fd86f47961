import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from scriptorium.llm import jaccard_join as jj
from scriptorium.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def brute(rows):
    sets = {i: brute_sets(t) for i, t in rows}
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    comp[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def fixture_rows():
    rng = np.random.default_rng(5)
    vocab = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "a b c d"), (6, "a b c d"), (7, "a b c d e"), (8, "a b c e d")]
    for base in range(12):
        words = list(rng.choice(vocab, 60 if base % 3 else 300))
        for _ in range(8):
            copy = list(words)
            for k in rng.integers(0, len(copy), rng.integers(0, 5)):
                copy[k] = str(rng.choice(vocab))
            rows.append((len(rows), " ".join(copy)))
    chain = list(rng.choice(vocab, 100))
    for step in range(12):
        rows.append((len(rows), "\n".join(chain[step * 4 : step * 4 + 50])))
    rows.append((len(rows), " ".join(rng.choice(vocab, 20000))))
    return rows


def test_components_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}


def test_tree_bound_loses_nothing():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, 80).astype(np.uint64)) for _ in range(40)]
    sets += [np.unique(np.concatenate([s[rng.integers(0, 12) :], rng.integers(0, 2**63, 6).astype(np.uint64)])) for s in sets for _ in range(3)]
    points = np.stack([jj.folded(jj.count_vector(s), 64) for s in sets])
    sizes = np.array([len(s) for s in sets])
    tree = jj.CountVectorRTree(points, sizes)
    seen = 0
    for q, s in enumerate(sets):
        hit = set(tree.search(points[q], sizes[q]).tolist())
        seen += len(hit)
        for k, t in enumerate(sets):
            both = len(np.intersect1d(s, t))
            if 100 * both >= 75 * (len(s) + len(t) - both):
                assert k in hit
    assert seen < len(sets) ** 2 / 3


def test_against_brute_force(spark):
    rows = fixture_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rep", jj.F.lit(1)).withColumn("band", jj.F.lit("x"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(df.repartition(3)).collect()}
    assert got == brute(rows)


def parts(spark, rows):
    """What the operator's steps work on, from distinct sets in plain Python: points, and (band, rep)."""
    table = []
    for i, t in rows:
        (_, _, part), = jj.slices(pa.array([t or ""]))
        (own,) = jj.shingle_sets(part)
        if len(own):
            table.append((i, len(own), bytearray(zlib.compress(jj.count_vector(own).tobytes())), [int(k) for k in jj.band_keys([own])[0].view(np.int64)]))
    df = spark.createDataFrame(table, "rep long, n long, vec binary, bands array<long>")
    return df.select("rep", "n", "vec"), df.select("rep", jj.F.explode("bands").alias("band")), {t[0]: t for t in table}


def links_of(rows):
    sets = {i: brute_sets(t) for i, t in rows}
    return {(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}


def test_residual_search_alone(spark, monkeypatch):
    """With no link known before, the block trees find every link."""
    rows = fixture_rows()
    monkeypatch.setattr(jj, "BLOCK", 5)
    points, banded, _ = parts(spark, rows)
    found = {tuple(r) for r in jj.residual_candidates(banded, points.select("rep", jj.F.col("rep").alias("comp")), points).collect()}
    want = links_of(rows)
    assert want <= found and len(found) < 3 * len(want)


@pytest.mark.parametrize("block", [5, 512])
def test_lead_trees_keep_every_link_of_a_lead_and_no_other_pair(spark, monkeypatch, block):
    rows = fixture_rows()
    monkeypatch.setattr(jj, "BLOCK", block)
    points, banded, table = parts(spark, rows)
    # Every document is dealt to documents 9 and 30, whether they are alike or not.
    stars = [(u, v, table[u][1], table[v][1]) for u in (9, 30) for v in table if v > u]
    found = {tuple(r) for r in jj.lead_candidates(spark.createDataFrame(stars, "u long, v long, n_u long, n_v long"), points).collect()}
    want = {p for p in links_of(rows) if p[0] in (9, 30)}
    assert want <= found <= {s[:2] for s in stars} and len(found) < len(stars) / 4


def test_pairs_by_path(spark, monkeypatch):
    """Links come out of the lead trees; the residual trees are left those of bands with several components."""
    rows, seen = fixture_rows(), []
    real = jj._verified
    monkeypatch.setattr(jj, "_verified", lambda pairs, docs: seen.append({tuple(r) for r in pairs.collect()}) or real(pairs, docs))
    jj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).count()
    want = links_of(rows)
    leads, residual = seen
    assert len(leads & want) > 0.3 * len(want) and not leads & residual


def test_empty_table(spark):
    assert jj.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
