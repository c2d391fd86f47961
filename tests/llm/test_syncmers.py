import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import syncmers as sy


def texts():
    rng = np.random.default_rng(8)
    alphabet = list("abcdefghij  éß\n") + ["\U0001f600"]
    made = ["".join(rng.choice(alphabet, n)) for n in (0, 1, 7, 15, 16, 17, 31, 40, 64, 200, 201, 999, 5000)]
    return made + [None, "", made[9], made[9][:100] + made[10][:100], "a" * 300, "x" * 70000]


def brute_sketch(spark, texts):
    """By text: {hash: first position} below the text's limit, from all anchors; the text's own hash if there are none."""
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    every = {}
    for r in sy.anchors(df, "k").collect():
        every.setdefault(r.k, []).append(((r.code % 2**64) >> 32, r.position))
    own = {r.k: (r.h % 2**64) >> 32 for r in df.selectExpr("k", "xxhash64(coalesce(text, '')) h").collect()}
    out = []
    for k, t in enumerate(texts):
        n = len((t or "").encode("utf-16-be")) // 2
        halvings = min(sy.HALVINGS, max(0, int(np.ceil(np.log2(max(n, 1) / sy.WHOLE)))))
        bound = 2**32 >> halvings
        kept = {}
        for code, at in sorted(every.get(k, [])):
            if code < bound:
                kept.setdefault(code, at)
        out.append((bound, kept or {own[k]: 0}))
    return out


def brute_likeness(a, b):
    if a[1] == b[1]:
        return 1.0
    bound = min(a[0], b[0])
    p, q = ({c for c in x[1] if c < bound} for x in (a, b))
    return len(p & q) / len(p | q) if p | q else 0.0


def brute_passage(a, b):
    shifts = {}
    for c in set(a) & set(b):
        shifts.setdefault(a[c] - b[c], []).append(a[c])
    return max(((len(v), d, min(v), max(v) + sy.K) for d, v in shifts.items()), default=None)


@pytest.mark.parametrize("run", [2, 256])
def test_query_against_plain_python(spark, tmp_path, monkeypatch, run):
    monkeypatch.setattr(sy, "RUN", run)
    rows = [(i * 100 if i % 2 else i * 100 + 70000, t, "z") for i, t in enumerate(texts())]
    rows.append(rows[9])
    spark.createDataFrame(rows, "doc_id long, text string, codes string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sy.query(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    order = sorted((i, t or "") for i, t, _ in rows)
    edited = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        edited.append(t[: len(t) - len(t) // 2] + after[: len(t) // 2])
    every = [t for _, t in order] + edited
    direct = spark.createDataFrame(list(enumerate(every)), "k int, text string")
    prints = {r.k: r.fingerprint for r in sy.fingerprints(direct, "k").collect()}
    plain = brute_sketch(spark, every)
    assert prints == {k: "".join(f"{c:08x}" for c in sorted(x[1])) for k, x in enumerate(plain)}
    n = len(order)
    place = {(i, hashlib.sha256(edited[k].encode()).hexdigest()): k for k, (i, _) in enumerate(order)}
    got = sorted(got, key=lambda r: place[r.doc_id, r.edited_sha256])
    for k, r in enumerate(got):
        assert r.doc_id == order[k][0] and r.n_chars == len(order[k][1])
        assert r.edited_sha256 == hashlib.sha256(edited[k].encode()).hexdigest()
        assert r.fingerprint == prints[k]
        assert r.edited_fingerprint == prints[n + k]
        assert r.near_edited == brute_likeness(plain[k], plain[n + k])
        assert r.near_next == brute_likeness(plain[k], plain[(k + 1) % n])
        found = brute_passage(plain[k][1], plain[(k + 1) % n][1])
        assert (tuple(r.next_passage) if r.next_passage else None) == found
    long = [r for k, r in enumerate(got) if r.n_chars >= 200 and len(set(order[k][1])) > 5]
    assert all(r.near_edited > 0.15 for r in long)


def test_sparse_ids_are_dealt_to_many_runs(spark):
    ids = [int(x) for x in np.random.default_rng(2).integers(-(2**62), 2**62, 3000)]
    df = spark.createDataFrame([(i, str(i)) for i in ids] + [(None, "none")], "k long, v string")
    got = sy.with_next(df, "k", ["v"]).collect()
    order = [None, *sorted(ids)]
    follows = dict(zip(order, order[1:] + order[:1]))
    assert {r.k: r.next_k for r in got} == follows and len({r._run for r in got}) > 8
    with pytest.raises(ValueError):
        sy.with_next(df, "v", ["k"])


def test_passages_by_position(spark):
    rng = np.random.default_rng(5)
    word = lambda n: " ".join("".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(n))
    shared = word(50)
    a, b = f"{word(400)} {shared} {word(300)}", f"{word(2000)} {shared} {word(100)}"
    rows = [(1, a, b), (2, a, word(50)), (3, None, a), (4, a, a)]
    found = {r.k: r for r in sy.passages(spark.createDataFrame(rows, "k int, x string, y string"), "x", "y").collect()}
    assert set(found) == {1, 4}
    at = a.index(shared)
    assert found[1].shift == at - b.index(shared) and at - 1 <= found[1].start < found[1].end <= at + len(shared) + 1
    assert found[1].end - found[1].start > 0.9 * len(shared) and found[4].shift == 0


def test_anchor_rule(spark):
    text = "the quick brown fox jumps over the lazy dog, then rests a while."
    units = text.encode("utf-16-be")
    smer = [units[2 * i : 2 * i + 2 * sy.S] for i in range(len(text) - sy.S + 1)]
    rows = spark.createDataFrame([(i, bytearray(s)) for i, s in enumerate(smer)], "i int, s binary").select("i", F.xxhash64("s").alias("h")).collect()
    h = [r.h for r in sorted(rows)]
    w = sy.K - sy.S + 1
    want = [i for i in range(len(text) - sy.K + 1) if min(h[i : i + w]) in (h[i], h[i + w - 1])]
    def anchors(t):
        df = spark.createDataFrame([(t,)], "t string").selectExpr(f"{sy.units('t')} b").selectExpr("b", f"explode(sequence(0, cast({sy.positions('b')} as int) - 1)) i")
        return {r.i: r.code for r in df.where(sy.is_anchor("b", "i")).selectExpr("i", f"{sy.anchor_hash('b', 'i')} code").collect()}

    got = anchors(text)
    assert sorted(got) == want
    assert set(got.values()) <= set(anchors("zz" + text).values())


def test_one_row_and_none(spark, tmp_path):
    for n in (0, 1):
        spark.createDataFrame([(5, "only one text here, long enough")][:n], "doc_id long, text string").write.parquet(f"{tmp_path}/{n}/documents.parquet")
        got = sy.query(spark, f"{tmp_path}/{n}").collect()
        assert len(got) == n and all(r.near_next == 1.0 for r in got)
