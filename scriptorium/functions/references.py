"""Columns over bibliographic references and lists of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions.text import collapse, strip

_CAP = "[A-ZÁÀÃÂÉÊÍÓÔÕÚÜÇ]"

#: How a legitimate reference may begin.
BEGINNINGS = [
    rf"{_CAP}[A-ZÁÀÃÂÉÊÍÓÔÕÚÜÇ\s]+,\s*{_CAP}",
    rf"{_CAP}[A-Za-záàãâéêíóôõúüç]+,\s",
    rf"{_CAP}[A-Za-záàãâéêíóôõúüç\s]+\.\s",
    r"[_\-–—]{2,}",
    rf"\d+[.)]\s*{_CAP}",
    r"[A-Z]{2,}[\s.,]",
    "[\"“«']",
    r"(?i:s\.n\.a\.|www\.|http)",
    r"\.{2,}",
    r"<",
    r"\(",
    r"(?i:fontes|cr[eé]dito|processos|entrevistas|arquivos|acervos|depoimentos)",
    r"\[",
    r"[•·]",
    r"(?i:idem|ibid|op\.\s*cit)",
    r"(?i:(?:arqto|arqta|prof\.|dr\.|dra\.)\s)",
]

#: What shows that a line is no reference.
NOT_REFERENCES = [
    r"^\(?\s*(?i:fig\.|figura|foto|imagem|fonte:)\s",
    r"^[\s•\-–—·.,;:]+$",
    r"^\d+\s+[A-Z][a-z]+\s+(é|foi|são|era|tem|deve|pode|precisa|quer|como|quando|onde|porque)(?![\p{L}\p{N}_])",
]

#: Words that running text is full of.
COMMON_WORDS = """de do da dos das em no na nos nas um uma o a os as que se com por para como mais não ou é foi são ser e ao à
pelo pela sobre entre até já mas nem também ainda muito essa este esta esse isso aqui onde quando porque sua seu suas seus""".split()

CONCATENATED = rf"[12]\d{{3}}[a-z]?\.\s+{_CAP}{_CAP}+,\s*[A-Z]"
CONCATENATED_WIDE = rf"\.\s{{2,}}{_CAP}{_CAP}+,\s"
PROBLEMS = ["vazia", "curta", "concatenada_padrao", "concatenada_padrao2", "inicio_minuscula", "sem_ano_ponto", "texto_corrido", "nao_referencia"]


def common_share(c: Column, common: list[str] = COMMON_WORDS) -> Column:
    """Share of a text's words that are in the list; both counts are one pass of a pattern."""
    n = F.regexp_count(c, F.lit(r"[^\s\p{Z}]+"))
    alone = rf"(?<![^\s\p{{Z}}])(?:{'|'.join(common)})(?![^\s\p{{Z}}])"
    return F.when(n > 0, F.regexp_count(F.lower(c), F.lit(alone)) / n).otherwise(0.0)


def _problems(x: Column) -> Column:
    r, n = x["r"], x["n"]
    # What lies before the 50th character is the reference's own beginning.
    later = F.when(n > 50, r.substr(F.lit(51), n)).otherwise("")
    long, period = ~x["begins"] & (n > 100), r.contains(".")
    found = F.array_compact(
        F.array(
            F.when(n < 12, "curta"),
            F.when(later.rlike(CONCATENATED), "concatenada_padrao"),
            F.when(later.rlike(CONCATENATED_WIDE), "concatenada_padrao2"),
            F.when((n < 40) & ~x["begins"] & ~r.rlike(r"^[\p{Lu}\p{Nd}]"), "inicio_minuscula"),
            F.when(long & ~x["year"] & ~period, "sem_ano_ponto"),
            F.when(long & (n > 150) & ~x["year"] & period & (common_share(r) > 0.40), "texto_corrido"),
            F.when(r.rlike("|".join(f"(?:{p})" for p in NOT_REFERENCES)), "nao_referencia"),
        )
    )
    return F.when(n == 0, F.array(F.lit("vazia"))).otherwise(found)


def reference_problems(c: Column) -> Column:
    """Array of the problems of one reference, in the order of PROBLEMS (REF1).

    What several tests ask for is bound once, in arrays of one element: as plain expressions every test would strip and match anew.
    """
    begins, year = "^(?:" + "|".join(BEGINNINGS) + ")", r"(?<!\d)[12]\d{3}(?!\d)"
    facts = F.transform(F.array(strip(c)), lambda r: F.struct(r.alias("r"), F.length(r).alias("n"), r.rlike(begins).alias("begins"), r.rlike(year).alias("year")))
    return F.get(F.transform(facts, _problems), F.lit(0))


_MARK = "\u0001"


def split_underscores(refs: Column) -> Column:
    """References cut before a run of underscores that stands for the author of the one before (REF4)."""
    cut = F.transform(F.filter(F.transform(refs, strip), lambda r: r != ""), lambda r: F.split(F.regexp_replace(r, r"\s+(_{3,})", _MARK + "$1"), _MARK))
    parts = F.transform(F.flatten(cut), lambda p: F.regexp_replace(strip(p), r"^(_{3,})\s+", "$1"))
    return F.filter(parts, lambda p: (p != "") & ~p.rlike(r"^_{3,}$"))


def leading_author(c: Column) -> Column:
    """``SURNAME, Given.`` or ``ORGANIZATION.`` at the beginning of a reference, else null (REF5)."""
    first, letters = "[A-ZÁÉÍÓÚÀÂÊÔÃÕÇÑ]", "A-ZÁÉÍÓÚÀÂÊÔÃÕÇÑa-záéíóúàâêôãõçñ"
    person = F.regexp_extract(c, rf"^({first}[{letters}\s,.]+?)\.\s", 1)
    body = F.regexp_extract(c, rf"^({first}[{letters}\s]+?)\.\s", 1)
    return F.when(person.contains(","), F.concat(person, F.lit("."))).when(body != "", F.concat(body, F.lit(".")))


def backfill_authors(refs: Column) -> Column:
    """A leading run of underscores becomes the author of the nearest reference before it that has
    none; if that has no author to take, nothing changes (REF6, WIN2). One fold over the list."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("author"))

    def step(state: Column, ref: Column) -> Column:
        r = strip(ref)
        blank = r.rlike("^_{3,}")
        filled = F.when(blank & state["author"].isNotNull(), F.concat(state["author"], F.lit(" "), F.regexp_replace(r, r"^_{3,}[.,]?\s*", ""))).otherwise(ref)
        return F.struct(F.concat(state["done"], F.array(filled)).alias("done"), F.when(blank, state["author"]).otherwise(leading_author(r)).alias("author"))

    return F.aggregate(refs, start, step, lambda s: s["done"])


def join_orphans(refs: Column) -> Column:
    """URLs and ``available at`` lines on their own are appended to the reference before them (REF6, WIN3)."""

    def step(done: Column, ref: Column) -> Column:
        r = strip(ref)
        orphan = r.rlike(r"^https?://\S+$") | r.startswith("Disponível em") | r.startswith("Acesso em") | r.startswith("Available at")
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.concat(F.rtrim(F.element_at(done, -1)), F.lit(" "), r)))
        return F.when(r == "", done).when((F.size(done) > 0) & orphan, grown).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(refs, F.array().cast("array<string>"), step)


def clean_references(refs: Column) -> Column:
    """Underscores split, authors filled in, orphans joined (REF6)."""
    return join_orphans(backfill_authors(split_underscores(refs)))


#: Entries that are removed from lists. Bullets count here, though the classifier accepts them.
REMOVED = [
    r"^\(?\s*(?i:fig\.|figura|foto|imagem|fonte:)\s",
    r"^(?i:https?://|www\.)\S+$",
    r"^[•\-–—]\s",
    r"^[\s•\-–—·.,;:\x{23d0}\x{f8e6}\x{f0bd}]+$",
    r"^.{0,10}$",
]


def without_non_references(refs: Column, shortest: int = 15) -> Column:
    """Without captions, bare URLs, bullets, punctuation, and short entries that have no year (REF13)."""
    drop = "|".join(f"(?:{p})" for p in REMOVED)
    return F.filter(refs, lambda r: ~strip(r).rlike(drop) & ~((F.length(strip(r)) < shortest) & ~r.rlike(r"\d{4}")))


#: How a line of a list begins a new entry.
ENTRY_STARTS = [r"\d+[.)]\s+", r"\[\d+\]\s+", r"_{3,}\.?\s", r"[A-ZÁÉÍÓÚÀÂÃÊÔÇÜ]{2,}[\s,.]"]
#: The same where only surnames in capitals and rules count.
SURNAME_STARTS = [r"[A-ZÀ-Ü][A-ZÀ-Ü\s]{2,},", r"_{3,}", r"-{3,}"]


def begins_with(line: Column, starts: list[str]) -> Column:
    """Whether a line begins in one of the ways (REF16)."""
    return strip(line).rlike("^(?:" + "|".join(starts) + ")")


def entries(text: Column, starts: list[str]) -> Column:
    """The entries of a list whose lines are broken: a line that begins so opens one, others go on with it; blank lines
    and the control character U+0001 count as white space (REF18)."""
    lines = F.filter(F.transform(F.split(F.translate(text, _MARK, " "), "\n"), strip), lambda x: x != "")
    marked = F.transform(lines, lambda x, i: F.when((i > 0) & begins_with(x, starts), F.concat(F.lit(_MARK), x)).otherwise(x))
    return F.filter(F.split(F.array_join(marked, " "), " " + _MARK), lambda x: x != "")


def list_entries(text: Column, few: int = 2, long: int = 300) -> Column:
    """Entries by ENTRY_STARTS; where these find few in a long text, by SURNAME_STARTS (REF18)."""
    found = entries(text, ENTRY_STARTS)
    return F.when((F.size(found) <= few) & (F.length(text) > long), entries(text, SURNAME_STARTS)).otherwise(found)


def without_short_entries(refs: Column, shortest: int = 15, bare_url: int = 50) -> Column:
    """Single-spaced entries without page numbers at their ends; short ones, short bare URLs and those without letters go (REF17)."""
    plain = F.transform(refs, lambda r: F.regexp_replace(collapse(r), r"\s+\d{1,3}$", ""))
    url = lambda r: r.startswith("http") & ~r.contains(" ") & (F.length(r) < bare_url)
    return F.filter(plain, lambda r: (F.length(r) >= shortest) & ~url(r) & ~r.rlike(r"^[\d\s./-]+$"))


def checked_list(c: Column, most: int = 100) -> Column:
    """Structs (pos, ref, problems) of a JSON list of references (REF2): ``json_invalido`` for what is no JSON or null, ``formato_invalido`` for JSON
    that is no list, ``tipo_invalido`` for an item that is no string, with up to ``most`` characters of it as ref; strings have their problems, if any.

    The text is parsed once into a VARIANT, which says of every value what it is.
    """
    kind = "array<struct<pos:int,ref:string,problems:array<string>>>"
    value = F.try_parse_json(c)
    shape = F.schema_of_variant(value)
    error = lambda pos, x, name: F.struct(pos.alias("pos"), F.left(F.coalesce(x, F.lit("")), F.lit(most)).alias("ref"), F.array(F.lit(name)).alias("problems"))
    first = F.lit(0)
    items = F.try_variant_get(value, "$", "array<variant>")

    def item(x: Column, i: Column) -> Column:
        text = F.try_variant_get(x, "$", "string")
        is_text = F.coalesce(F.schema_of_variant(x) == "STRING", F.lit(False))
        return F.when(is_text, F.struct(i.alias("pos"), text.alias("ref"), reference_problems(text).alias("problems"))).otherwise(error(i, F.coalesce(F.to_json(x), F.lit("null")), "tipo_invalido"))

    return (
        F.when(value.isNull(), F.array(error(first, c, "json_invalido")))
        .when(~shape.startswith("ARRAY<"), F.array(error(first, F.to_json(value), "formato_invalido")))
        .otherwise(F.filter(F.transform(items, item), lambda x: F.size(x["problems"]) > 0)).cast(kind)
    )
