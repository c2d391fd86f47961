import tracemalloc

import numpy as np
import pyarrow as pa

from scriptorium.llm import language_id as li
from scriptorium.llm.textbytes import slices

VOCAB = {"en": "the and thing with over that hence", "fr": "là même être avec où français nous", "ru": "это слово язык когда потому"}


def text(lang, rng, n=40):
    return " ".join(rng.choice(VOCAB[lang].split(), n))


def make(spark):
    rng = np.random.default_rng(1)
    rows = [(i, text(lang, rng), lang, "z") for i, lang in enumerate(sorted(VOCAB) * 20)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_spans_of_mixed_text(spark):
    rng = np.random.default_rng(2)
    model = li.fit(make(spark))
    assert model.langs == ["en", "fr", "ru"]
    a, b, c = text("en", rng, 30), text("fr", rng, 12), text("ru", rng, 9)
    rows = [(0, f"{a} {b}\n{c}"), (1, None), (2, ""), (3, "123 !? 4"), (4, "où"), (5, "когда"), (6, f"{b} " * 3000), (7, "ª"), (8, "漢字")]
    got = {r.doc_id: r for r in li.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    mixed = got[0]
    assert mixed.lang_pred == "en"
    assert [s.lang for s in mixed.spans] == ["en", "fr", "ru"]
    raw = rows[0][1].encode()
    assert [raw[s.start : s.end].decode().strip() for s in mixed.spans] == [a, b, c]
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert got[4].lang_pred == "fr" and got[5].lang_pred == "ru" and got[6].lang_pred == "fr"
    assert got[8].lang_pred in model.langs
    assert all(0 <= r.score <= 1 for r in got.values())


def test_viterbi_against_plain_loop():
    rng = np.random.default_rng(4)
    counts = np.concatenate([rng.integers(0, 30, 35), [li.STRETCH, li.STRETCH + 1, 2 * li.STRETCH, 700, 0]])
    first = np.concatenate([[0], np.cumsum(counts)])
    emit = rng.normal(0, 3, (first[-1], 3)).astype(np.float32)
    got = li.viterbi(emit, first, 2.0)

    def value(e, path):
        return sum(e[i, p] for i, p in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))

    for r in range(40):
        e = emit[first[r] : first[r + 1]]
        best = e[0].astype(float).copy() if len(e) else np.zeros(3)
        for t in range(1, len(e)):
            best = np.array([max(best[m] - (2.0 if m != l else 0) for m in range(3)) for l in range(3)]) + e[t]
        assert np.isclose(value(e, got[first[r] : first[r + 1]]), best.max() if len(e) else 0, atol=5e-3)


def test_viterbi_of_many_labels_is_bounded():
    rng = np.random.default_rng(5)
    for n, words in ((100, 20_000), (30, 20_000)):
        emit = rng.normal(0, 6, (words, n)).astype(np.float32)
        tracemalloc.start()
        got = li.viterbi(emit, np.array([0, words]))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 4 * emit.nbytes
        path = emit[np.arange(words), got].sum(dtype=np.float64) - li.SWITCH * (got[1:] != got[:-1]).sum()
        best = emit[0].astype(np.float64)
        for row in emit[1:]:
            best = np.maximum(best, best.max() - li.SWITCH) + row
        assert np.isclose(path, best.max(), rtol=1e-4)


def test_repeated_rows_and_other_columns(spark):
    docs = make(spark)
    model = li.fit(docs)
    twice = docs.unionByName(docs).selectExpr("*", "'x' score", "1 spans", "2 explained")
    once = {r.doc_id: r for r in li.identify(docs, model).collect()}
    got = li.identify(twice, model).collect()
    assert len(got) == 2 * len(once)
    assert all(r == once[r.doc_id] for r in got)


def test_scripts_of_code_points():
    letters = {"Latin": "aZéÿƀḀ", "Greek": "αἀ", "Cyrillic": "яҐ", "Thai": "ก", "Lao": "ກ", "Khmer": "ក", "Myanmar": "မ", "Ethiopic": "አ", "Tibetan": "ཀ", "Tamil": "அ", "Devanagari": "अ", "Han": "漢𠀀", "Kana": "かカ", "Hangul": "한", "Supplementary": "𐌰"}
    for script, some in letters.items():
        for c in some:
            raw = np.frombuffer(c.encode(), dtype=np.uint8)
            got = li.byte_scripts(raw)
            assert li.SCRIPTS[got[0]] == script and not got[1:].any(), c
    assert not li.byte_scripts(np.frombuffer("1 !–×÷💡".encode()[:-4], dtype=np.uint8)).any()
    assert list(li.code_scripts(np.array([lo for _, lo, _ in li.BLOCKS]))) == [li.SCRIPTS.index(s) for s, _, _ in li.BLOCKS]


def test_query_never_reads_held_out_labels(spark, tmp_path):
    import zlib

    rng = np.random.default_rng(7)
    langs = sorted(VOCAB)
    rows = [(i, text(langs[i % 3], rng), "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else langs[i % 3], "s", 1) for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in li.query(spark, str(tmp_path)).collect()}
    assert len(got) == 120
    for i, *_ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i].lang_pred == langs[i % 3]


def test_empty_tables(spark):
    docs = make(spark)
    model = li.fit(docs.where("false"))
    assert {r.lang_pred for r in li.identify(docs, model).collect()} == {"und"}
    assert li.identify(docs.where("false"), li.fit(docs)).count() == 0


def test_grams_do_not_cross_rows():
    (_, _, both), = slices(pa.array(["ab cd", "ef"]))
    (_, _, one), = slices(pa.array(["ef"]))
    two, _ = li.grams(both)
    own, _ = li.grams(one)
    for (h, _), (g, _) in zip(two, own):
        assert list(h[-len(g):]) == list(g)
