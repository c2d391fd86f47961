"""Fields taken from the plain text of papers (EXT1 to EXT4, EXT15, EXT16, REF15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.references import list_entries, without_short_entries
from scriptorium.functions.text import keyword_list
from scriptorium.operators.headers import axis, listed_authors


def without_page_noise(c: Column) -> Column:
    """No form feeds, and no lines that hold a page number only (EXT1)."""
    return F.regexp_replace(F.replace(c, F.lit("\f"), F.lit("\n")), r"(?m)^\s*\d{1,3}\s*$", "")


def between(c: Column, start: str, stop: str, shortest: int = 0, longest: int | None = None) -> Column:
    """The text from a start pattern to the nearest stop pattern, if its length fits; else null."""
    found = F.trim(F.regexp_extract(c, f"(?s){start}\\s*(.*?)\\n(?:{stop})", 1))
    fits = F.length(found) > shortest
    return F.when(fits & (F.length(found) <= longest) if longest else fits, found)


def first_of(*rungs: Column) -> Column:
    """The first pattern that found something."""
    return F.coalesce(*rungs)


def reference_section(c: Column, headings: list[str], end_markers: list[str]) -> Column:
    """The text after the first heading that occurs, up to the first end marker; null without a heading."""
    rungs = [F.nullif(F.trim(F.regexp_extract(c, f"(?s)\\n{h}\\n(.*)$", 1)), F.lit("")) for h in headings]
    body = F.coalesce(*rungs)
    return F.nullif(F.get(F.split(body, "|".join(f"\\n{m}" for m in end_markers)), F.lit(0)), F.lit("")) if end_markers else body


def sections(df: DataFrame, text: str) -> DataFrame:
    """df with abstract, keywords, abstract_en and refs."""
    c = F.col(text)
    return df.withColumns(
        {
            "abstract": between(c, "Resumo:", "Palavras-chave|Abstract", 50, 5000),
            "keywords": F.nullif(F.trim(F.regexp_extract(c, r"Palavras-chave:\s*([^\n]*)", 1)), F.lit("")),
            "abstract_en": between(c, "Abstract:", r"Keywords|1\.", 50),
            "refs": reference_section(c, ["Referências", "Bibliografia"], ["Anexos", "Notas"]),
        }
    )


def labelled(c: Column, abstract: str, keywords: str, refs: list[str], ends: list[str], next_label: str) -> dict[str, Column]:
    """The fields of an edition that has labels of its own (EXT15): abstract, keywords as a list, reference entries."""
    line = F.nullif(F.trim(F.regexp_extract(c, rf"(?:^|\n){keywords}:[ ]*([^\n]*)", 1)), F.lit(""))
    listed = F.when(line.isNotNull(), keyword_list(line))
    section = reference_section(c, refs, ends)
    return {
        "abstract": F.nullif(between(c, f"{abstract}:", f"{keywords}|{next_label}", 0), F.lit("")),
        "keywords": listed,
        "refs": F.when(section.isNotNull(), without_short_entries(list_entries(section))),
    }


def assembled(df: DataFrame, text: str, labels: dict) -> DataFrame:
    """df with axis, title, authors and the fields of ``labelled`` (EXT16).

    The head of a text is its lines up to the abstract's label: an axis line if there is one, a title, and authors on the line after it.
    """
    c = F.col(text)
    head = F.get(F.split(c, f"\n{labels['abstract']}:"), F.lit(0))
    lines = F.filter(F.transform(F.split(head, "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.rlike(r"(?iu)^eixo\s"))
    first = {"axis": axis(head), "title": F.get(lines, F.lit(0)), "authors": F.when(F.size(lines) > 1, listed_authors(F.get(lines, F.lit(1))))}
    return df.withColumns({**first, **labelled(c, **labels)})
