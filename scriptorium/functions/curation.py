"""Columns for codes, identifiers, excerpts, literal replacements and YAML text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions.text import collapse

#: Beginnings of section titles, the prefix of their code, in the order in which they are tried.
SECTIONS = [
    (r"Eixo ([\p{L}\p{N}_]+)", "E"), (r"Mesa (\d+)", "M"), (r"Sessão (\d+)\s+Mesa\s+(\d+)", "SM"), (r"Sessão de comunicação (\d+)", "SC"), (r"Sessão (\d+)", "S"),
    (r"Painel (\d+)", "P"), ("Painéis", "PN"), ("Comunicações Orais", "CO"), (r"Parte (\d+)", "PT"),
]
#: Codes of what stands before a dash.
SECTION_KINDS = {"Artigos Completos": "AC", "Resumos Expandidos": "RE", "Artigos": "A"}


def section_code(title: Column, series: Column, number: Column) -> Column:
    """A section's code (PRJ7): of the first pattern, its numbers or else the section's own; of a title with a
    dash, what stands before it; else SEC and the section's number; and the series."""
    t = F.trim(title)
    before = F.trim(F.get(F.split(t, "—"), F.lit(0)))
    kind = F.upper(F.left(before, F.lit(2)))
    for name, code in SECTION_KINDS.items():
        kind = F.when(before == name, code).otherwise(kind)
    code = F.when(t.contains("—"), F.concat(kind, number.cast("string"))).otherwise(F.concat(F.lit("SEC"), number.cast("string")))
    for pattern, prefix in reversed(SECTIONS):
        groups = re.compile(pattern.replace(r"[\p{L}\p{N}_]", r"\w")).groups
        found = F.concat_ws("-", *[F.regexp_extract(t, "^" + pattern, k) for k in range(1, groups + 1)]) if groups else number.cast("string")
        code = F.when(t.rlike("^" + pattern), F.concat(F.lit(prefix), found)).otherwise(code)
    return F.concat_ws("-", code, series)


def display_section(title: Column, markers: list[str]) -> Column:
    """A section title up to the first of the markers, tried in turn, unless it begins with one (PRJ8)."""
    for marker in markers:
        at = F.instr(title, marker)
        title = F.when(at > 1, F.left(title, at - 1)).otherwise(title)
    return title


def record_id(doi: Column, label: str) -> Column:
    """What follows the label in the last part of a DOI that begins with it; null without one (PRJ9)."""
    parts = F.filter(F.split(doi, "/"), lambda p: p.startswith(label))
    return F.replace(F.try_element_at(parts, F.lit(-1)), F.lit(label), F.lit(""))


def glob(c: Column, pattern: str) -> Column:
    """A case-sensitive shell pattern of * and ? (FLT3)."""
    body = "".join(".*" if x == "*" else "." if x == "?" else re.escape(x) for x in pattern)
    return c.rlike(f"(?s)^{body}$")


def all_of(*conditions: Column | None) -> Column:
    """The conditions that are given, together; true if none is (FLT4)."""
    out = F.lit(True)
    for condition in conditions:
        out = out if condition is None else out & condition
    return out


def replaced_all(c: Column, pairs: list[tuple[str, str]], whole_words: bool = False) -> Column:
    """Literal replacements in order, also inside words unless asked otherwise (STR21)."""
    for old, new in pairs:
        if whole_words:
            c = F.regexp_replace(c, rf"(?<![\p{{L}}\p{{N}}_])\Q{old}\E(?![\p{{L}}\p{{N}}_])", new.replace("\\", "\\\\").replace("$", "\\$"))
        else:
            c = F.replace(c, F.lit(old), F.lit(new))
    return c


def small_first(c: Column, beginning: str) -> Column:
    """A text with a small first letter if it begins so (STR22)."""
    return F.when(c.startswith(beginning), F.concat(F.lower(F.left(c, F.lit(1))), c.substr(F.lit(2), F.length(c)))).otherwise(c)


def excerpt(html: Column, most: int) -> Column:
    """Text without tags, cut after the last whole word within so many characters, with an ellipsis if it is cut (STR27)."""
    text = collapse(F.regexp_replace(html, "<[^>]*>", " "))
    cut = F.regexp_replace(F.regexp_extract(text, rf"^(.{{0,{most}}})(?: |$)", 1), r"\s+$", "")
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.when(cut != "", cut).otherwise(F.left(text, F.lit(most))), F.lit("…")))


def yaml_scalar(c: Column, indent: int = 2) -> Column:
    """A string as a YAML value (SNK2): several lines as a block, what would read as something else in quotes, null as nothing."""
    block = F.concat(F.lit("|-\n"), F.array_join(F.transform(F.split(c, "\n"), lambda x: F.when(x == "", "").otherwise(F.concat(F.lit(" " * indent), x))), "\n"))
    special = c.rlike(r"^$|^[\s\-?:,\[\]{}#&*!|>'\"%@`=]|^~$|: |:$| #|\s$|(?i)^(?:true|false|yes|no|on|off|null)$|^[-+.]?\d[\d_.:eE+-]*$")
    quoted = F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(c.isNull(), "").when(c.rlike(r"\n") & ~c.rlike(r"^\s|\s$"), block).when(c.contains("\n"), F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)).when(special, quoted).otherwise(c)


def yaml_mapping(fields: dict[str, Column]) -> Column:
    """Fields in the order given, null ones left out, as the lines of a YAML mapping (SNK2, SNK15)."""
    lines = [F.when(c.isNotNull(), F.concat(F.lit(f"{name}: "), yaml_scalar(c))) for name, c in fields.items()]
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


def yaml_in_order(fields: dict[str, Column], order: list[str]) -> Column:
    """A YAML mapping with the fields of the order first, then all others as given (SNK15)."""
    return yaml_mapping({name: fields[name] for name in [*[x for x in order if x in fields], *[x for x in fields if x not in order]]})


def joined_records(text: Column, first: str = "slug", body: str = "ficha") -> Column:
    """Structs (first, body) of records that stand in one text without separators (SRC4).

    A line that begins with the first key opens a record; lines of its body, which may begin with a folding mark, are
    trimmed and joined by spaces. A record without a body has null there.
    """
    records = F.filter(F.split(text, rf"(?:^|\n)(?={first}:)"), lambda r: r.startswith(first + ":"))

    def record(r: Column) -> Column:
        key = F.trim(F.regexp_extract(r, rf"^{first}:([^\n]*)", 1))
        rest = F.regexp_extract(r, rf"(?s)\n{body}:[ ]*(?:>-?)?(.*)$", 1)
        return F.struct(key.alias(first), F.when(r.contains(f"\n{body}:"), collapse(rest)).alias(body))

    return F.transform(records, record)
