import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from scriptorium.llm import token_alignment as ta

TEXTS = [
    "Plain words, twice. Plain words.", "", None, "naïve café ünïcode 漢字 🙂🙂 é", "<|endoftext|> and </s><s> as text", "a\n\n\tb  c   \r\n", " ", "▁ in text", "tail ",
    "x" * 900 + " " * 700 + "y", "Plain words, twice. Plain words.", "\x00\x07 control ﻿", "1234567890 98.6% don't I'll", "word " * 3000,
]


def brute(texts, folder=ta.FOLDER):
    """Every document on its own, from the JSON vocabulary, token by token; groups by cutting at common ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tool = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
    a_tool.encode_special_tokens = True
    b_tool = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
    alphabet = ta._byte_alphabet()
    docs, counts = [], Counter()
    for text in texts:
        said = b" " + (text or "").encode()
        a = a_tool.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tool.encode(text) if text else []
        in_a = [bytes(alphabet[c] for c in a_tool.id_to_token(i)) for i in a]
        in_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(b_tool.id_to_piece, b)]
        if not text or b"".join(in_a) != said or b"".join(in_b) != said:
            docs.append(None)
            continue
        ends_a, ends_b = np.cumsum([*map(len, in_a)]).tolist(), np.cumsum([*map(len, in_b)]).tolist()
        groups, left_a, left_b = [], list(zip(a, ends_a)), list(zip(b, ends_b))
        for cut in sorted(set(ends_a) & set(ends_b)):
            groups.append(([i for i, e in left_a if e <= cut], [i for i, e in left_b if e <= cut]))
            left_a, left_b = [x for x in left_a if x[1] > cut], [x for x in left_b if x[1] > cut]
        at_b = dict(zip(ends_b, b))
        links = [(i, at_b[e]) for i, e in zip(a, ends_a) if e in at_b]
        counts.update(links)
        docs.append((len(a), len(b), groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc in docs:
        if doc is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        na, nb, groups, links = doc
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((na, nb, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(line.encode()).hexdigest()))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("bound", [100_000, 5])
def test_against_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(ta, "BROADCAST_PAIRS", bound)
    monkeypatch.setattr(ta, "SLICE_CHARS", 60)
    real = [x for x in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist() if len(x) < 3000][:60]
    texts = TEXTS + real
    rows = [(i if i % 7 else None, x, "clash", 1) for i, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pair string, row int").repartition(3)
    got = ta.token_alignment(df)
    assert got.columns == ["doc_id", *COLUMNS]
    want = sorted(((i if i % 7 else None, *x) for i, x in enumerate(brute(texts))), key=str)
    assert sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in got.collect()), key=str) == want
    assert any(w[1] == 0 for w in want) and any(w[3] < w[1] for w in want)


def test_components_are_the_groups():
    draws = random.Random(7)
    for _ in range(200):
        n = draws.randint(1, 60)
        cut = lambda: np.diff([0, *sorted(draws.sample(range(1, n), draws.randint(0, n - 1))), n])
        a, b = cut(), cut()
        of_a, of_b, at_a, at_b = ta.groups(a, b)
        ends_a, ends_b = np.cumsum(a), np.cumsum(b)
        common = np.intersect1d(ends_a, ends_b)
        assert of_a.tolist() == np.searchsorted(common, ends_a).tolist() and of_b.tolist() == np.searchsorted(common, ends_b).tolist()
        assert ends_a[at_a].tolist() == common.tolist() == ends_b[at_b].tolist()
    path = 5000
    assert set(ta.components(path, np.arange(path - 1)[::-1], np.arange(1, path)[::-1])) == {0}


def test_same_ids_from_both_files_and_empty_table(spark):
    tools = ta.coder(ta.FOLDER)
    texts = [x for x in TEXTS if x] + pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    whole = [e.ids for e in tools.whole.encode_batch([" " + x for x in texts], add_special_tokens=False)]
    assert [tools.fast.encode_ordinary(" " + x) for x in texts] == whole
    assert ta.token_alignment(spark.createDataFrame([], "doc_id long, text string")).count() == 0
