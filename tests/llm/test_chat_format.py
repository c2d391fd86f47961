import hashlib

from hypothesis import given
from hypothesis import strategies as st

from scriptorium.llm import chat_format as cf

NASTY = st.text(alphabet="<|im_endstar>\\\n é😀", max_size=30)


@given(st.lists(st.tuples(NASTY, NASTY), max_size=5))
def test_round_trip(turns):
    found = cf.locate(turns, cf.chat_template)
    assert not found.rewrites
    assert [cf.parse_span(found.text[a:b]) for a, b in found.spans] == turns
    assert found.text.count(cf.OPEN) == found.text.count(cf.CLOSE) == len(turns)
    for (a, b), (_, text) in zip(found.spans, turns):
        s, e = cf.text_span(found.text[a:b], a)
        assert cf.unescape(found.text[s:e]) == text


def test_templates_that_rewrite():
    last_only = lambda turns: "".join(f"[{r}:{t if i == len(turns) - 1 else '...'}]" for i, (r, t) in enumerate(turns))
    found = cf.locate([("user", "a"), ("assistant", "b"), ("user", "c")], last_only)
    assert found.rewrites == [1, 2]
    assert found.text == "[user:...][assistant:...][user:c]"
    footer = lambda turns: "<s>" + "".join(t for _, t in turns) + "</s>"
    found = cf.locate([("user", "abc"), ("user", "def")], footer)
    assert found.rewrites == [0, 1] and found.spans[-1] == (6, len(found.text))
    bos = lambda turns: "<s>" + "".join(t for _, t in turns)
    found = cf.locate([("user", "abc"), ("user", "def")], bos)
    assert not found.rewrites and found.spans == [(3, 6), (6, 9)]


def test_rows(spark):
    rows = [(1, 1, "assistant", "yes <|im_end|>", "x"), (1, 0, "user", None, "x"), (2, 0, None, "hi", "x"), (2, 0, "assistant", "b", "x"), (2, 0, "assistant", "a", "x"), (2, 0, "assistant", "a", "x"), (None, None, None, None, "x")]
    rows += [(3, t, "user" if t % 2 else "assistant", f"t{t} " * 50, "x") for t in range(300)]
    rows += [(2**53, 0, "user", "big", "x"), (2**53 + 1, 0, "user", "bigger", "x"), (-(2**63), 0, "assistant", "least", "x")]
    rows += [(4, 0, "assistant", "long \\ <| " * 30000, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in cf.digests(cf.format_chats(df.repartition(5))).collect()}
    by = {}
    for c, t, r, x, _ in rows:
        by.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    assert got.keys() == by.keys()
    for c, turns in by.items():
        turns.sort()
        said = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert got[c].formatted_chars == len(cf.chat_template([(r, x) for _, r, x in turns]))
    assert cf.digests(cf.format_chats(df.where("false"))).count() == 0
