import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

from scriptorium.llm import conversation_repair as cr

GRAMMAR = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, roles) of rows (initial, fault) by trying all edits with up to two insertions at each place, nothing remembered."""
    best = None
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for (_, f), e in zip(rows, edits)):
            continue
        base = sum({"K": 0, "R": 3, "D": 4}[e] + (3 if f == "truncated" and e != "D" else 0) for (_, f), e in zip(rows, edits))
        for gaps in itertools.product((0, 1, 2), repeat=len(rows) + 1):
            cost = base + 3 * sum(gaps)
            if best and cost > best[0]:
                continue
            slots = []
            for n, (row, e) in zip(gaps, [*zip(rows, edits), (None, "")]):
                slots += [("I", "ua")] * n + ([(e, {"K": row[0], "R": "ua", "D": ""}[e])] if e else [])
            for roles in itertools.product(*(x if x else [""] for _, x in slots)):
                if GRAMMAR.fullmatch("".join(roles)):
                    found = (cost, "".join(e for e, _ in slots), roles)
                    best = min(best or found, found)
    return best


def test_solve_against_all_edits():
    kinds = [("s", ""), ("u", ""), ("a", ""), ("x", ""), ("u", "truncated"), ("a", "truncated"), ("s", "blank"), ("u", "duplicate")]
    letters = {"": cr.FINE, "truncated": cr.TRUNCATED, "blank": cr.BLANK, "duplicate": cr.DUPLICATE}
    assert cr.solve("") == (0, "")
    draws = random.Random(3)
    for n in (1, 2, 3, 4):
        every = list(itertools.product(kinds, repeat=n))
        for rows in every if n < 3 else draws.sample(every, 120 if n == 3 else 60):
            signature = "".join(letters[f]["suax".index(r)] for r, f in rows)
            assert cr.solve(signature) == cheapest(rows)[:2], rows


def test_long_signatures_by_a_plain_forward_search():
    draws = random.Random(5)
    for n in (65, 128, 1000, 4097):
        signature = "".join(draws.choices("suaxSUA0246", k=n))
        rows = signature.translate(cr._KINDS)
        best = {0: (0, "")}
        for kind in [*rows, None]:
            closed = {}
            for p, way in best.items():
                for m, more in cr._inserted(p):
                    closed[m] = min(closed.get(m, (1 << 60, "")), (way[0] + 3 * len(more), way[1] + more))
            if kind is None:
                assert cr.solve(signature) == min(closed[m] for m in (0, 3) if m in closed)
                break
            best = {}
            for m, way in closed.items():
                steps = [(m, 4, "D")]
                if kind != "d":
                    extra = 3 * kind.isupper()
                    steps += [(2 if m != 2 else 3, 3 + extra, "R")] + [(q, extra, "K") for i, q in cr.NEXT[m].items() if i == kind.lower()]
                for q, cost, letter in steps:
                    best[q] = min(best.get(q, (1 << 60, "")), (way[0] + cost, way[1] + letter))


def plain(rows):
    """The whole result of rows (conv_id, turn, role, text) as they are, one conversation after the other."""
    space = " \t\n\x0b\x0c\r"
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[" " if conv is None else str(conv)].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, group in groups.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in group:
            body = text.strip(space)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role[:1] if role[:1] in ("s", "u", "a") else "x", fault))
        turns = [t for t, _, _ in group if t is not None]
        cost, audit, roles = cheapest(marked)
        lines, at, names = [], iter(group), {"u": "user", "a": "assistant"}
        for letter, role in zip(audit, roles):
            row = next(at) if letter != "I" else None
            if letter != "D":
                lines.append(f"{row[1] if letter == 'K' else names[role]}:{row[2] if row else ''}")
        pairs = [x[0][:1] + y[0][:1] for x, y in zip([g[1:] for g in group], [g[1:] for g in group][1:])]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(sum(f == k for _, f in marked) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def collected(audits, repaired):
    found = {r.conv: r.repaired_sha256 for r in cr.digests(repaired).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, found.get(r.conv, empty)) for r in audits.collect()}


ROWS = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes"), (1, 4, "user", "Hi?"),
    (2, None, "user", "a."), (2, None, "user", "a."), (2, 5, "tool", None), (2, 5, None, "x."),
    (None, 1, "assistant", "b!"), (None, 9, "user", "\t\n"), (3, 1, "", ""), (4, None, "student", "z. \x0b"), (4, None, "assistant", "é"),
    (5, 1, "user", "same."), (5, 1, "assistant", "same."), (5, 2, "user", "same."), (5, 3, "assistant", "long " * 40000),
]


def test_against_plain_python(spark):
    df = spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "conv_id long, turn long, role string, text string, conv string, at int").repartition(5)
    got = collected(*cr.repair(df))
    assert got == plain(ROWS) and len(got) == 6


def test_blocks_and_repeats(spark, monkeypatch):
    """A conversation cut into many pieces, a row repeated often: as if in one piece."""
    monkeypatch.setattr(cr, "BLOCK", 3)
    rows = [(7, i, "user" if i % 3 else "assistant", f"t{i % 11}.") for i in range(60)] + [(7, 30, "user", "again.")] * 25 + [(8, 1, "user", "")] * 9
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    audits, repaired = cr.repair(df)
    found = {r.conv: r for r in audits.collect()}
    assert found["8"].audit == "D" * 9 and found["8"].blank == 9 and found["7"].gaps == 0
    order = sorted((t, r, x) for c, t, r, x in rows if c == 7)
    seen, letters = set(), ""
    for _, role, text in order:
        letters += (cr.DUPLICATE if (role, text) in seen else cr.FINE)["sua".index(role[0])]
        seen.add((role, text))
    assert (found["7"].cost, found["7"].audit) == cr.solve(letters)
    lines, at, state = [], iter(order), 0
    for e in found["7"].audit:
        row = next(at) if e != "I" else None
        role = row[1] if e == "K" else {"u": "user", "a": "assistant"}[cr._turn(state)]
        if e != "D":
            lines.append((role, row[2] if row else ""))
            state = cr.NEXT[state][role[0]]
    assert [(r.role, r.text) for r in repaired.orderBy("at", "k").collect()] == lines


def test_empty_and_damage(spark):
    schema = "conv_id long, turn long, role string, text string"
    audits, repaired = cr.repair(spark.createDataFrame([], schema))
    assert audits.count() == 0 and repaired.count() == 0
    rows = [(i, t, "assistant", "a.b!c?") for i in range(30) for t in range(4)] + [(None, None, None, None)]
    want = []
    for c, t, role, text in rows:
        draw = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if draw == 4 else role or " ", "" if draw == 1 else "abc" if draw == 2 else text or " ")
        want += [row] * (0 if draw == 0 else 2 if draw == 3 else 1)
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in cr.damage(spark.createDataFrame(rows, schema)).collect())
