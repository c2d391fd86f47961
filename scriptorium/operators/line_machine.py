"""Line parsers with state: a table of transitions as data, folded over a document's lines (EXT8, EXT10, EXT12).

A machine names kinds of lines by patterns and says, for a state and a kind, which state follows and what becomes of the line. Formats
differ in their tables only. A document of any length takes one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType

from scriptorium.functions.text import bound

#: Lines that an open parenthesis may take in at most.
TAKEN_IN = 4


@dataclass(frozen=True)
class Machine:
    """kinds: (name, pattern) in the order in which they are tried; a line that fits none is ``other``, an empty one ``blank``.

    rules: (state, kind, next state, action), the first that fits counts, ``*`` fits all, also as the next state: the same. Actions: ``skip``,
    ``stop`` (nothing counts from here on), ``open:field`` (a record begins, with the line in that field), ``add:field`` (the line goes to
    the field of the record that is open), ``hold:name`` (the line holds for records from here on), ``close`` (the record has all it will
    have; lines before the next one belong to none). Without a rule a line is skipped and the state stays.
    """

    kinds: list[tuple[str, str]]
    rules: list[tuple[str, str, str, str]]
    start: str
    rejoin: bool = False

    def table(self) -> tuple[dict[str, str], list[str], list[str], list[str]]:
        """(letters of state and kind -> letters of the next state and action), and the names behind the letters."""
        kinds = ["blank", "other", *[k for k, _ in self.kinds]]
        states = sorted({self.start, *[s for r in self.rules for s in (r[0], r[2]) if s != "*"]})
        actions = sorted({"skip", *[r[3] for r in self.rules]})
        letter = lambda names, x: chr(65 + names.index(x))
        out = {}
        for s in states:
            for k in kinds:
                _, _, then, action = next((r for r in self.rules if r[0] in ("*", s) and r[1] in ("*", k)), ("", "", "*", "skip"))
                out[letter(states, s) + letter(kinds, k)] = letter(states, s if then == "*" else then) + letter(actions, action)
        return out, states, kinds, actions


@F.arrow_udf(ArrayType(BooleanType()))
def _taken_in(opened: pa.Array) -> pa.Array:
    """Which lines the one before takes in, from the number of parentheses that each opens."""
    out = []
    for counts in opened.to_pylist():
        depth = taken = 0
        marks = []
        for n in counts or ():
            inside = depth > 0 and taken < TAKEN_IN
            depth, taken = max((depth if inside else 0) + n, 0), taken + 1 if inside else 0
            marks.append(inside)
        out.append(marks)
    return pa.array(out, pa.list_(pa.bool_()))


def rejoined(lines: Column) -> Column:
    """Lines of which one with an open parenthesis takes in the next, up to TAKEN_IN, until it is closed. One pass over the lines."""
    opens = F.transform(lines, lambda x: F.regexp_count(x, F.lit(r"\(")) - F.regexp_count(x, F.lit(r"\)")))
    marked = F.transform(F.arrays_zip(lines.alias("line"), _taken_in(opens).alias("taken")), lambda x: F.concat(F.when(x["taken"], " ").otherwise("\n"), x["line"]))
    return F.split(F.substr(F.array_join(marked, ""), F.lit(2)), "\n")


def _walk(machine: Machine, fields: list[str], held: list[str]):
    """Column function: letters of the kinds of a document's lines -> its records, with places of lines instead of lines. One pass over the letters."""
    table, states, kinds, actions = machine.table()
    moves = {}
    for (at, kind), (then, said) in table.items():
        verb, _, name = actions[ord(said) - 65].partition(":")
        moves.setdefault(at, {})[kind] = (then, verb, name)
    start = chr(65 + states.index(machine.start))
    inner = ", ".join(["no: bigint", *[f"f_{f}: array<int>" for f in fields], *[f"h_{h}: int" for h in held]])

    @F.arrow_udf(f"array<struct<{inner}>>")
    def walk(letters: pa.Array) -> pa.Array:
        ends, no, found, begins, holds = [0], [], {f: [] for f in fields}, {f: [] for f in fields}, {h: [] for h in held}
        for text in letters.to_pylist():
            state, n, live, last = start, 0, False, dict.fromkeys(held)
            for pos, letter in enumerate(text or ""):
                state, verb, name = moves[state][letter]
                if verb == "skip":
                    continue
                if verb == "open":
                    n, live = n + 1, True
                    no.append(n)
                    for f in fields:
                        begins[f].append(len(found[f]))
                    for h in held:
                        holds[h].append(last[h])
                    found[name].append(pos)
                elif verb == "add":
                    if live:
                        found[name].append(pos)
                elif verb == "hold":
                    last[name] = pos
                elif verb == "close":
                    live = False
                else:  # stop
                    break
            ends.append(len(no))
        lists = [pa.ListArray.from_arrays(pa.array([*begins[f], len(found[f])], pa.int32()), pa.array(found[f], pa.int32())) for f in fields]
        parts = [pa.array(no, pa.int64()), *lists, *[pa.array(holds[h], pa.int32()) for h in held]]
        rows = pa.StructArray.from_arrays(parts, names=["no", *[f"f_{f}" for f in fields], *[f"h_{h}" for h in held]])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    return walk


def records(df: DataFrame, key: str, text: str, machine: Machine) -> DataFrame:
    """(key, no, one array of lines for each field, one line for each held name) of every record, numbered from 1. Null texts have none.

    A row's text is a document; Spark splits it and tells the kinds of its lines, a pass in Python over a letter a line finds the places of each record's lines.
    """
    actions = sorted({r[3] for r in machine.rules})
    fields = sorted({a.split(":")[1] for a in actions if a.startswith(("open:", "add:"))})
    held = sorted({a.split(":")[1] for a in actions if a.startswith("hold:")})
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(x))

    def kind(x: Column) -> Column:
        out = F.lit(chr(65 + 1))
        for i, (_, pattern) in reversed(list(enumerate(machine.kinds))):
            out = F.when(x.rlike(pattern), chr(65 + 2 + i)).otherwise(out)
        return F.when(x == "", "A").otherwise(out)

    given = df.select(key, (rejoined(lines) if machine.rejoin else lines).alias("_l"))
    walked = given.select(key, "_l", _walk(machine, fields, held)(F.array_join(F.transform("_l", kind), "")).alias("_r"))
    line = lambda i: F.get("_l", i)
    made = F.transform("_r", lambda r: F.struct(r["no"].alias("no"), *[F.transform(r[f"f_{f}"], line).alias(f) for f in fields], *[line(r[f"h_{h}"]).alias(h) for h in held]))
    return walked.select(key, F.explode(made).alias("_x")).select(key, "_x.*")


#: Letters of names and titles in capitals.
_UP = "A-ZÁÀÂÃÉÈÊÍÓÔÕÚÇ"
CAPITALS = rf"^(?=.{{4,}})[^\p{{Ll}}]*[{_UP}]{{3}}[^\p{{Ll}}]*$"
PERSON = rf"^[{_UP}][{_UP}' -]+, ?[{_UP}]\p{{Ll}}"
PAGE = r"^\d{2,4}$"
FOOTER = r"^\d$"


def contents_of_blocks(section: str, end: str) -> Machine:
    """Entries between blank lines: title lines, the last one closed by dots and a page."""
    kinds = [("end", end), ("section", section), ("paged", r"[.\s]\s*\d{1,4}$")]
    return Machine(kinds, [("*", "end", "*", "stop"), ("*", "section", "new", "hold:section"), ("off", "*", "*", "skip"), ("*", "blank", "new", "skip"), ("new", "*", "in", "open:entry"), ("in", "*", "in", "add:entry")], "off")


def contents_of_capitals(begin: str, section: str, end: str) -> Machine:
    """Titles in capitals over any lines, a page on a line of its own, then people; single digits are feet of pages."""
    kinds = [("end", end), ("begin", begin), ("foot", FOOTER), ("page", PAGE), ("section", section), ("person", PERSON), ("title", CAPITALS)]
    return Machine(kinds, [
        ("*", "end", "*", "stop"), ("off", "begin", "new", "skip"), ("off", "*", "off", "skip"), ("*", "section", "new", "hold:section"), ("*", "foot", "*", "skip"), ("title", "title", "title", "add:title"), ("*", "title", "title", "open:title"),
        ("title", "page", "people", "add:page"), ("people", "person", "people", "add:authors"),
    ], "off")


def contents_of_lines(section: str, end: str) -> Machine:
    """A title with its page after two spaces or more; people in the lines that follow."""
    kinds = [("end", end), ("section", section), ("paged", r"\S\s{2,}\d{2,4}$"), ("person", PERSON)]
    return Machine(kinds, [("*", "end", "*", "stop"), ("*", "section", "new", "hold:section"), ("off", "*", "*", "skip"), ("*", "paged", "people", "open:title"), ("people", "person", "people", "add:authors")], "off")


def contents_of_bullets(section: str, end: str) -> Machine:
    """A bullet begins a title, a bar its people, dots lead to the page; either may go on in the next lines."""
    kinds = [("end", end), ("section", section), ("bullet", r"^[●•]"), ("bar", r"^\|")]
    return Machine(kinds, [
        ("*", "end", "*", "stop"), ("*", "section", "new", "hold:section"), ("off", "*", "*", "skip"), ("*", "bullet", "title", "open:title"), ("title", "bar", "people", "add:authors"), ("title", "other", "title", "add:title"),
        ("people", "other", "people", "add:authors"),
    ], "off", rejoin=True)


def contents_of_numbers(section: str, end: str) -> Machine:
    """The page comes first, on the title's line; the line of people has slashes between them."""
    kinds = [("end", end), ("section", section), ("numbered", r"^\d{1,4}\s+\S"), ("people", r"^[^/]+(?: / [^/]+)*$")]
    return Machine(kinds, [("*", "end", "*", "stop"), ("*", "section", "new", "hold:section"), ("off", "*", "*", "skip"), ("*", "numbered", "people", "open:title"), ("people", "people", "done", "add:authors")], "off")


def author_blocks(end: str, mail: str, affiliation: str, name: str) -> Machine:
    """A name opens an author; affiliations, addresses and other lines up to the next name are theirs (EXT8, EXT10)."""
    kinds = [("end", end), ("email", mail), ("affiliation", affiliation), ("name", name)]
    return Machine(kinds, [
        ("*", "end", "*", "stop"), ("*", "name", "author", "open:name"), ("author", "email", "author", "add:email"), ("author", "affiliation", "author", "add:affiliation"), ("author", "other", "author", "add:bio"),
    ], "head", rejoin=True)


#: Ways in which a heading names its authors, in the order in which they are tried: (name, pattern, groups of number, family and given name; 0 for none).
STRATEGIES = [
    ("number_before", rf"\((\d+)\)\s*([{_UP}][{_UP}\s]*?),\s*([^;\n(]+)", (1, 2, 3)),
    ("number_after", rf"([{_UP}][{_UP}\s]*?),\s*([^;\n(]+?)\s*\((\d+)\)", (3, 1, 2)),
    ("plain", rf"(?m)^([{_UP}][{_UP} ]{{2,}}),\s*([^\n;]+)$", (0, 1, 2)),
    ("cedilla", rf"(?m)([{_UP}][{_UP} ]*)¸\s*([^\n;]+)$", (0, 1, 2)),
]


def header_authors(head: Column, strategies=STRATEGIES, mail: str = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}") -> Column:
    """Structs (strategy, no, family, given, affiliation, email) of a heading, by the first strategy that finds anyone (EXT10).

    A line ``(n) affiliation`` or ``n. affiliation`` is that author's; of addresses, the n-th is the n-th author's. Numbers are those written, or the order.
    """
    mails = F.regexp_extract_all(head, F.lit(f"({mail})"), F.lit(1))
    notes = F.arrays_zip(*[F.regexp_extract_all(head, F.lit(r"(?m)^\s*(?:\((\d+)\)|(\d+)\.)\s*([^\s(\d][^\n]*)$"), F.lit(k)).alias(n) for k, n in ((1, "a"), (2, "b"), (3, "said"))])
    clean = lambda c: F.regexp_replace(F.trim(c), r"^[\s;.]+|[\s;.]+$", "")

    def by(name: str, pattern: str, groups: tuple[int, int, int], mails: Column, notes: Column) -> Column:
        all_of = lambda k: F.regexp_extract_all(head, F.lit(pattern), F.lit(k))
        zipped = F.arrays_zip(all_of(groups[0] or groups[1]).alias("no"), all_of(groups[1]).alias("family"), all_of(groups[2]).alias("given"))
        zipped = F.filter(zipped, lambda x: ~x["given"].contains("@"))  # an acronym and an address are no name

        def author(x: Column, i: Column) -> Column:
            no = x["no"].cast("int") if groups[0] else i + 1
            note = F.get(F.filter(notes, lambda n: (F.coalesce(F.nullif(n["a"], F.lit("")), n["b"]).cast("int") == no) & (n["said"].contains("@") | ~n["said"].rlike(rf"^[{_UP}][{_UP}\s]*,"))), F.lit(0))["said"]
            said = F.trim(F.regexp_replace(note, rf"[,;\s]*{mail}", ""))
            return F.struct(F.lit(name).alias("strategy"), no.alias("no"), clean(x["family"]).alias("family"), clean(x["given"]).alias("given"), F.nullif(said, F.lit("")).alias("affiliation"), F.get(mails, i).alias("email"))

        return F.transform(zipped, author)

    def first(left: list, said: Column) -> Column:
        if not left:
            return F.array().cast("array<struct<strategy:string,no:int,family:string,given:string,affiliation:string,email:string>>")
        return bound(by(*left[0], said["mails"], said["notes"]), lambda found: F.when(F.size(found) > 0, found).otherwise(first(left[1:], said)))

    return bound(F.struct(mails.alias("mails"), notes.alias("notes")), lambda said: first(list(strategies), said))
