import hashlib
import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from scriptorium.llm import piece_sampling as ps
from scriptorium.llm.textbytes import U, mix

VOCAB = ps.vocabulary()


def brute(text):
    """Every segmentation (as tuples of ids) with its probability."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=ps.MODEL)
    pieces = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if VOCAB.weight[i]}
    s = "▁" + text.replace("▁", "\0").replace(" ", "▁")
    found = {}

    def walk(p, ids, w):
        if p == len(s):
            found[tuple(ids)] = w
            return
        for e in range(p + 1, min(len(s), p + VOCAB.longest) + 1):
            i = pieces.get(s[p:e])
            if i is not None:
                walk(e, ids + [i], w * VOCAB.weight[i])
        if s[p] not in pieces:
            raw = s[p].replace("\0", "▁").encode()
            walk(p + 1, ids + [int(VOCAB.byte_ids[b]) for b in raw], w * VOCAB.byte_weight ** len(raw))

    walk(0, [], 1.0)
    total = sum(found.values())
    return {k: v / total for k, v in found.items()}


def seeds(n):
    return mix(np.arange(n).astype(U))


@pytest.mark.parametrize("text", ["the cat", "on to", "é▁ x", "  a", "\n"])
def test_probabilities_against_enumeration(text):
    every = brute(text)
    got = ps.Encoder(VOCAB, 3).slice([text] * 50, seeds(50))
    for rows in got:
        assert len(rows) == min(3, len(every)) and len({tuple(r[0]) for r in rows}) == len(rows)
        assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
        for ids, logp, _, inclusion in rows:
            assert math.isclose(math.exp(logp), every[tuple(ids.tolist())], rel_tol=1e-9)
            assert 0 < inclusion <= 1


def test_first_two_samples_follow_the_law_without_replacement():
    text, n = "onto", 20000
    every = brute(text)
    got = ps.Encoder(VOCAB, 2).slice([text] * n, seeds(n))
    pairs = Counter((tuple(r[0][0].tolist()), tuple(r[1][0].tolist())) for r in got)
    top = sorted(every, key=every.get, reverse=True)[:5]
    for a, b in itertools.permutations(top, 2):
        want = every[a] * every[b] / (1 - every[a])
        assert abs(pairs[a, b] / n - want) < 5 * math.sqrt(want * (1 - want) / n) + 1e-4
    # Weighted by 1 / inclusion, the samples estimate a sum over all segmentations.
    sizes = [sum(math.exp(lp) / q * len(ids) for ids, lp, _, q in rows) for rows in got]
    want = sum(p * len(k) for k, p in every.items())
    assert abs(np.mean(sizes) - want) < 5 * np.std(sizes) / math.sqrt(n)


def test_all_segmentations_of_a_short_text():
    every = brute("on")
    rows = ps.Encoder(VOCAB, 50).slice(["on"], seeds(1))[0]
    assert {tuple(r[0].tolist()) for r in rows} == set(every)
    assert all(r[3] == 1.0 for r in rows)


@pytest.mark.parametrize("text", ["鬱" * 32, "鬱" * 10000, "鬱 " * 5000, "a鬱" * 4000, "😀▁" * 3000, "a" * 10000, "鬱the" * 3000, "\ufffd" * 33 + "x" * 33])
def test_characters_outside_the_vocabulary_in_any_number(text):
    rows = ps.Encoder(VOCAB, 2).slice([text, "the"], seeds(2))
    for ids, logp, value, inclusion in rows[0]:
        assert math.isfinite(logp) and math.isfinite(value) and 0 < inclusion <= 1
        assert ps.decode_lists(pa.array([ids.tolist()]))[0].as_py() == text
    assert len({tuple(r[0].tolist()) for r in rows[0]}) == len(rows[0])
    assert [r[0].tolist() for r in rows[1]] == [r[0].tolist() for r in ps.Encoder(VOCAB, 2).slice([text, "the"], seeds(2))[1]]


@pytest.mark.parametrize("text", ["鬱an鬱 o", "ab鬱", "é鬱▁on"])
def test_parts_of_words_against_enumeration(text):
    every = brute(text)
    for rows in ps.Encoder(VOCAB, 4).slice([text] * 30, seeds(30)):
        for ids, logp, _, _ in rows:
            assert math.isclose(math.exp(logp), every[tuple(ids.tolist())], rel_tol=1e-9)


def test_rows(spark):
    hard = "a▁b ▁▁  c\t\n\r\x00 é 漢字 😀 <0x0A> <s> </s> " + "x" * 400 + " " * 40 + "deadbeef" * 60
    texts = [None, "", " ", hard, "plain words here", "plain words here", "w " * 40000 + "end", "z" * 3000]
    df = spark.createDataFrame([(i if i != 5 else 4, t, "e") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(2)
    got = ps.decode(ps.sample(df)).collect()
    want = {i if i != 5 else 4: t or "" for i, t in enumerate(texts)}
    for r in got:
        assert r.decoded == want[r.doc_id]
    by = {i: [tuple(r.ids) for r in got if r.doc_id == i] for i in want}
    assert len(by[0]) == len(by[1]) == 1 and len(set(by[3])) == len(by[3]) == 2
    assert len(by[4]) == 4 and len(set(by[4])) == 2
    again = ps.sample(df.repartition(5)).collect()
    assert sorted((r.doc_id, r["sample"], tuple(r.ids)) for r in again) == sorted((r.doc_id, r["sample"], tuple(r.ids)) for r in got)
    assert ps.sample(df.where("false")).count() == 0


def test_shares_of_a_word_do_not_depend_on_the_words_before_it():
    """To the last bit, with characters outside the vocabulary before it too."""
    vocab = VOCAB
    code = lambda x: np.array([ps.SPACE_PIECE if c == " " else ord(c) for c in x], dtype=np.int64)
    own, before = code(" international"), code(" \U0001f9ff\U0001f9ff\U0001f9ff\U0001f9ff\U0001f9ff")
    alone = ps.Lattices(vocab, own, np.array([0, len(own)]))
    later = ps.Lattices(vocab, np.concatenate([before, own]), np.array([0, len(before), len(before) + len(own)]))
    assert (later.share[len(before) :] == alone.share).all() and (later.cumulated[len(before) :] == alone.cumulated).all()


def test_lattices_are_built_in_less_than_twice_what_they_keep():
    """A task's memory beside a full heap: the tables are written without copies of the whole."""
    import tracemalloc

    rng = np.random.default_rng(3)
    sizes = rng.integers(2, 14, 12_000)
    heads = np.concatenate([[0], np.cumsum(sizes)])
    code = rng.choice(np.frombuffer("eeeaaattioonsrhldcué".encode("utf-32-le"), dtype=np.uint32), heads[-1]).astype(np.int64)
    code[heads[:-1]] = ps.SPACE_PIECE
    tracemalloc.start()
    try:
        lat = ps.Lattices(VOCAB, code, heads)
        kept, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(lat.share) == len(code) and peak < 2 * kept
