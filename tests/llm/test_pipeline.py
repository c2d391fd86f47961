import corpus_pipeline as cp
import numpy as np
import pytest

from scriptorium.llm import piece_sampling as ps

VOCAB = {"en": "the and thing with over that hence among where would", "fr": "là même être avec où français nous vous très déjà"}


def make(spark, tmp_path, empty=False):
    rng = np.random.default_rng(4)
    rows, labels = [], []

    def text(lang, n=40):
        return " ".join(rng.choice(VOCAB[lang].split(), n)) + f" w{len(rows)}"

    for i in range(120):
        lang = ("en", "fr")[i % 2]
        body = text(lang)
        if i % 8 == 7:
            body = " ".join(w + "$$$" for w in body.split())
        rows.append((i, "all rights reserved here\n" + body if i % 4 == 0 else body, lang, "s0"))
        labels.append((i, int(i % 8 != 7), 0))
    rows += [(200, rows[3][1], "fr", "s1"), (201, rows[5][1] + " plus", "fr", "s1"), (202, "123 456", "en", "s0"), (203, None, "en", "s0"), (204, "", None, None), (205, "all rights reserved here", "en", "s0")]
    rows += [rows[1], (206, "the thing " * 9000, None, "s2")]
    rows = [] if empty else rows
    labels = [] if empty else labels
    frame = spark.createDataFrame([(*r, len(r[1]) if r[1] else 0, "extra") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, rep string")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return rows


@pytest.mark.parametrize("empty", [False, True])
def test_run_against_expectation(spark, tmp_path, empty):
    rows = make(spark, tmp_path, empty)
    docs = cp.table(spark, str(tmp_path), "documents")
    by_stage = []
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stored(stage(spark, docs, str(tmp_path)))
        assert docs.columns == cp.DOC_COLUMNS
        by_stage.append({r.doc_id: r for r in docs.collect()})
    final = cp.run(spark, str(tmp_path))
    got = ps.decode(final).collect()
    if empty:
        assert not got
        return
    one, two, three, four = by_stage
    assert set(one) == {r[0] for r in rows} - {202, 203, 204}
    assert set(two) == set(one) - {205}
    assert two[0].text == rows[0][1].split("\n")[1] and two[0].n_chars == len(two[0].text)
    assert set(three) == set(two) - {200, 201}
    clean = {i for i in three if i % 8 != 7 or i > 199}
    assert set(four) <= set(three) and clean - {206} <= set(four)
    assert len(set(four) - clean) < len(set(three) - clean)
    assert {r.doc_id for r in got} == set(four)
    assert all(r.decoded == four[r.doc_id].text for r in got)
    assert max(r["sample"] for r in got) == 1


def test_language_stage_rejects_unlearned_text(spark):
    rng = np.random.default_rng(6)
    learned = [(i, " ".join(rng.choice(VOCAB[lang].split(), 40)), lang) for i, lang in enumerate(["en", "fr"] * 20)]
    mash = " ".join("".join(rng.choice(list("bcdfgjklmpqxz"), 6)) for _ in range(40))
    finnish = "kaikki ihmiset syntyvät vapaina tasavertaisina arvoltaan oikeuksiltaan heille annettu järki omatunto"
    both = f"{learned[0][1]} {learned[1][1]} {learned[2][1]} {learned[3][1]}"
    more = [(100, mash, None), (101, finnish, None), (102, "$$$ %%% a 123 ### 漢", None), (103, both, None), (104, f"{learned[4][1]} {mash[:60]}", None)]
    docs = spark.createDataFrame([(i, t, lang, "s0", len(t)) for i, t, lang in learned + more], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in cp.identified(spark, docs, "").collect()} == {i for i, *_ in learned} | {103, 104}


def test_mixing_stage_emits_copies(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"t{i}", "en", "s0", 2) for i in (0, 1, 2, 3)] + [(None, "t", "en", "s0", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    rates = spark.createDataFrame([(0, 0), (1, 1), (2, 2), (3, 3), (None, 1)], "doc_id long, copies int")
    monkeypatch.setattr(cp.source_mixing, "labelled", lambda *a: None)
    monkeypatch.setattr(cp.source_mixing, "mix", lambda *a, **b: rates)
    assert sorted(r.text for r in cp.mixed(spark, docs, "").collect()) == ["t", "t1", "t2", "t2", "t3", "t3", "t3"]
