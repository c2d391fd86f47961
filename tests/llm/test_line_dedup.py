from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from scriptorium.llm import line_dedup as ld


def brute(rows, ratio, least):
    pages, seen = Counter(), defaultdict(Counter)
    for _, text, host in rows:
        if host is not None:
            pages[host] += 1
            seen[host].update({x.strip(" ") for x in (text or "").split("\n") if x.strip(" ")} if text is not None else ())
    out = []
    for i, text, host in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        gone = {x for x, n in seen[host].items() if n >= 3 and pages[host] >= least and n > ratio * pages[host]} if host is not None else set()
        kept = [x for x in lines if x.strip(" ") not in gone or not x.strip(" ")]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


ROWS = (
    [(i, f"menu\nbody {i}\n\nfoot  \nbody {i % 4}", "a") for i in range(20)]
    + [(i, f" menu\nown {i}", "b") for i in range(30, 33)]
    + [(40, None, "a"), (41, "", "a"), (42, "menu", "a"), (43, "menu", None), (44, "menu\nmenu\nx", "a"), (44, "menu\nmenu\nx", "a"), (45, "long " * 50000 + "\nmenu", "a")]
)


@pytest.mark.parametrize("bound", [100_000, 0])
def test_against_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(ld, "BROADCAST_LINES", bound)
    df = spark.createDataFrame(ROWS, "page_id long, text string, host string").withColumn("line_key", F.lit("clash")).repartition(3)
    got = ld.drop_boilerplate(df, "text", F.col("host"), 0.3, 5)
    assert got.columns == ["page_id", "text", "host", "line_key", "n_lines", "n_dropped"]
    assert sorted(((r.page_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=repr) == brute(ROWS, 0.3, 5)
    assert ld.drop_boilerplate(df.where("false"), "text", F.col("host")).count() == 0


def test_small_hosts(spark):
    """A menu on all pages of a small host goes; what two pages share stays."""
    rows = [(i, f"menu\nown {i}\nhalf {i // 2}", "s") for i in range(4)] + [(9, "menu\nx", "t"), (10, "menu\nx", "t")]
    df = spark.createDataFrame(rows, "page_id long, text string, host string")
    got = {r.page_id: (r.text, r.n_dropped) for r in ld.drop_boilerplate(df, "text", F.col("host")).collect()}
    assert got == {**{i: (f"own {i}\nhalf {i // 2}", 1) for i in range(4)}, 9: ("menu\nx", 0), 10: ("menu\nx", 0)}
    assert sorted((i, t, n) for i, (t, n) in got.items()) == sorted((a, b, d) for a, b, _, d in brute(rows, ld.RATIO, 1))


def test_page_text_and_host(spark):
    html = "<html><head><style>p{}</style><title>T</title></head><body><!-- x --><p>One <b>two</b></p><script>var a='<p>';</script><div>three<br>four</div></body></html>"
    r = spark.createDataFrame([(html, "HTTP://u@Www.A.org:80/x"), ("", "none")], "h string, u string").select(ld.page_text(F.col("h")).alias("t"), ld.url_host(F.col("u")).alias("h")).collect()
    assert r[0].t.strip().split("\n") == ["T", "One two", "three", "four"] and r[0].h == "www.a.org"
    assert r[1].h is None


def test_copies_are_no_evidence_with_once(spark):
    """A line of many different texts goes; those of a large group of copies and near copies stay."""
    rows = [(f"own {i} a\nfooter\nown {i} b", "s") for i in range(60)]
    rows += [("x1\nx2\nx3", "s")] * 40 + [("\n".join(f"y{k}" if k != i % 10 else f"z{i}" for k in range(10)), "s") for i in range(40)]
    df = spark.createDataFrame([(i, *r, "kept", 1) for i, r in enumerate(rows)], "doc_id long, text string, host string, drop string, salt int")
    got = {r.doc_id: r for r in ld.drop_boilerplate(df, "text", F.col("host"), 0.2, 20, once=True).collect()}
    assert all(got[i].text == f"own {i} a\nown {i} b" and got[i].n_dropped == 1 for i in range(60))
    assert all(got[i].text == rows[i][0] and got[i].drop == "kept" and got[i].salt == 1 for i in range(60, len(rows)))
    plain = {r.doc_id: r for r in ld.drop_boilerplate(df, "text", F.col("host"), 0.2, 20).collect()}
    assert plain[60].text == "" and plain[0].text == got[0].text


def test_refused_names(spark):
    with pytest.raises(ValueError):
        ld.drop_boilerplate(spark.createDataFrame([("a", "h", 1)], "text string, host string, N_Lines int"), "text", F.col("host"))
