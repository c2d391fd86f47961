import random
import re
from collections import Counter

import numpy as np
import pytest

from scriptorium.llm import substring_dedup as sd
from scriptorium.llm.fm_index import FMIndex, WaveletTree


def brute(texts):
    words = [re.findall(r"[^\x20\x09-\x0D]+", x or "") for x in texts]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        out.append((len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def texts():
    draws = random.Random(11)
    word = lambda n=400: "w%d" % draws.randrange(n)
    some = lambda n, v=400: [word(v) for _ in range(n)]
    passage, gram = some(60), some(12)
    out = [None, "", "one two", " ".join(some(34)), "\n".join(some(35)), "same " * 300, "a b " * 40, "é ü " * 50, " ".join(some(80))]
    out += [" ".join(some(draws.randint(0, 120))) for _ in range(30)]
    out += [" \t\n".join(some(draws.randint(0, 60)) + passage + some(draws.randint(0, 60))) for _ in range(12)]
    out += [" ".join(some(40) + gram + some(40)) for _ in range(40)]  # one gram, many surroundings
    out += [" ".join(passage[k : k + 35]) for k in (0, 5, 25, 26)] + [" ".join(passage[:34] + ["x"] + passage[35:])]
    copy = " ".join(some(200))
    out += [copy] * 5 + [copy + " end", "start " + copy, copy.replace(" ", "  ", 3), copy + "\n" + copy]
    return out + [" ".join(some(30000) + passage)]


@pytest.mark.parametrize("crowded, shard", [(1000, 1 << 19), (1, 300)])
def test_against_brute_force(spark, monkeypatch, crowded, shard):
    monkeypatch.setattr(sd, "CROWDED", crowded)
    monkeypatch.setattr(sd, "SHARD_WORDS", shard)
    every = texts()
    ids = [None if i % 9 == 0 else i // 2 for i in range(len(every))]
    rows = [(i, x, "clash", 1, 2) for i, x in zip(ids, every)] + [(999, every[-1], "clash", 1, 2)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, content string, doc int, pos int").repartition(4)
    got = sd.dedup(df)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    want = [(r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows]))]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
    assert sum(w[2] for w in want) > 1000


def test_every_least_gram_is_the_windows_own():
    """Equal windows of any surroundings have the same gram, and segments cover each window once."""
    draws = np.random.default_rng(2)
    codes = draws.integers(0, 5, 3000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first = np.array([0, 20, 20, 1000, 1034, 3000])
    row, pos, windows, gram, content = sd.segments_of(codes, first)
    by_window, total = {}, 0
    for r, p, n, g in zip(row, pos, windows, gram):
        for k in range(n):
            w = tuple(codes[first[r] + p + k : first[r] + p + k + 35])
            assert len(w) == 35 and by_window.setdefault(w, g) == g
        total += n
    assert total == sum(max(0, n - 34) for n in np.diff(first))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sd.dedup(df).count() == 0
    assert [tuple(r) for r in sd.dedup(spark.createDataFrame([(1, None), (2, "a  b")], "doc_id long, text string")).orderBy("doc_id").collect()] == [(1, 0, 0, ""), (2, 2, 0, "a b")]


def plain_statistics(indexed, weights, streamed, least):
    seen = Counter()
    for t, w in zip(indexed, weights):
        for i in range(len(t)):
            for j in range(i + 1, len(t) + 1):
                seen[tuple(t[i:j])] += w
    out = []
    for p in streamed:
        for i in range(len(p)):
            k = 0
            while i + k < len(p) and seen[tuple(p[i : i + k + 1])] >= least:
                k += 1
            out.append(k)
    return out


def test_matching_statistics_against_all_substrings():
    draws = random.Random(1)
    flat = lambda x: np.array([z for y in x for z in y], dtype=np.uint64)
    for trial in range(150):
        v = draws.choice([1, 2, 3, 8])
        indexed = [[draws.randrange(v) * 7919 + 3 for _ in range(draws.randint(trial % 2, 14))] for _ in range(draws.randint(1, 8))]
        streamed = indexed + [[draws.randrange(v + 1) * 7919 + 3 for _ in range(draws.randint(0, 10))] for _ in range(4)]
        weights, least = [draws.randint(1, 2) for _ in indexed], draws.choice([1, 2, 3])
        index = FMIndex(flat(indexed), np.array([*map(len, indexed)]), np.array(weights))
        assert index.matching_statistics(flat(streamed), np.array([*map(len, streamed)]), least).tolist() == plain_statistics(indexed, weights, streamed, least)


def test_wavelet_rank():
    draws = np.random.default_rng(4)
    for n, sigma in ((1, 1), (64, 2), (1000, 37), (129, 300)):
        seq = draws.integers(0, sigma, n)
        tree = WaveletTree(seq, sigma)
        at, symbol = draws.integers(0, n + 1, 200), draws.integers(0, sigma, 200)
        assert tree.rank(symbol, at).tolist() == [int((seq[:a] == s).sum()) for a, s in zip(at, symbol)]
