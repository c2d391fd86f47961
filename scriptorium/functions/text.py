"""Unicode-safe text primitives as Column builders."""

from __future__ import annotations

import json
import unicodedata
import zlib
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


class Lookup:
    """A literal table from words to words."""

    def __init__(self, entries: dict[str, str]):
        self.buckets = 1 << max(0, (len(entries) // 4).bit_length())
        maps: list[dict[str, str]] = [{} for _ in range(self.buckets)]
        for word, canonical in entries.items():
            maps[zlib.crc32(word.encode()) % self.buckets][word] = canonical
        self.table = F.from_json(F.lit(json.dumps(maps, ensure_ascii=False)), "array<map<string,string>>")

    def __call__(self, word: Column) -> Column:
        return F.try_element_at(F.get(self.table, F.pmod(F.crc32(word), F.lit(self.buckets)).cast("int")), word)


def _accent_table() -> tuple[str, str]:
    """Letters whose canonical decomposition is one ASCII letter and marks, from the Unicode data."""
    source, target = [], []
    for code in range(0xC0, 0x250):
        parts = [c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)]
        if len(parts) == 1 and parts[0].isascii() and parts[0] != chr(code):
            source.append(chr(code))
            target.append(parts[0])
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_table()


def _canonical_table() -> tuple[str, str]:
    """Characters whose canonical decomposition is one character and marks, in all scripts but Hangul, from the Unicode data."""
    source, target = [], []
    for code in [*range(0xC0, 0xAC00), *range(0xF900, 0xFFFF)]:
        parts = [c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn"]
        if len(parts) == 1 and parts[0] != chr(code):
            source.append(chr(code))
            target.append(parts[0])
    return "".join(source), "".join(target)


_COMPOSED, _BASES = _canonical_table()
_SPACE = r"[\p{Z}\s]+"


def _compatible_table() -> tuple[str, str, dict[str, str]]:
    """What NFKD without combining marks makes of every character but Hangul, from the Unicode data: characters that become one (those that
    become none are at the end, for translate to drop), what they become, and those that become several."""
    one, none, several = {}, [], {}
    for code in range(0x80, 0x110000):
        if 0xAC00 <= code < 0xD7A4 or 0xD800 <= code < 0xE000:
            continue
        made = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if made == chr(code):
            continue
        if len(made) == 1:
            one[chr(code)] = made
        elif made:
            several[chr(code)] = made
        else:
            none.append(chr(code))
    return "".join([*one, *none]), "".join(one.values()), several


@lru_cache(maxsize=1)
def _compatible() -> tuple[str, str, Lookup, str]:
    source, target, several = _compatible_table()
    return source, target, Lookup(several), "[" + "".join(several) + "가-힣]"


def _jamo(c: Column) -> Column:
    """The letters of a Hangul syllable, by its number: 21 vowels and 28 endings (27, and none) for each first letter."""
    n = F.ascii(c) - 0xAC00
    pick = lambda first, count, k: F.get(F.array(*[F.lit(chr(first + i)) for i in range(count)]), k.cast("int"))
    last = F.when(n % 28 > 0, pick(0x11A8, 27, n % 28 - 1)).otherwise("")
    return F.concat(pick(0x1100, 19, F.floor(n / 588)), pick(0x1161, 21, F.floor(n % 588 / 28)), last)


def compatible_fold(c: Column) -> Column:
    """NFKD without combining marks, for every character: ``º`` is o, a no-break space a space, ``ﬁ`` fi (STR1).

    One pass of translate does what becomes one character or none; only texts with a character that becomes several
    are taken apart for a lookup in the table of those.
    """
    source, target, several, marks = _compatible()
    letter = lambda x: F.when(x.between("가", "힣"), _jamo(x)).otherwise(F.coalesce(several(x), x))
    apart = F.array_join(F.transform(F.split(c, ""), lambda x: F.when(x.rlike(marks), letter(x)).otherwise(x)), "")
    return F.translate(F.when(c.rlike(marks), apart).otherwise(c), source, target)


def strip_accents(c: Column) -> Column:
    """Latin letters without their marks (STR1, STR2)."""
    return F.translate(c, _ACCENTED, _PLAIN)


def canonical_fold(c: Column) -> Column:
    """Lower case without marks in any script, nothing at the ends; what only looks like a letter, such as an ordinal sign, stays (STR2)."""
    return strip(F.lower(F.regexp_replace(F.translate(c, _COMPOSED, _BASES), r"\p{Mn}+", "")))


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once; as a plain expression it would be computed wherever it stands, in a lambda for every item."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def collapse(c: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends (STR5)."""
    return F.trim(F.regexp_replace(c, _SPACE, " "))


def strip(c: Column) -> Column:
    """No Unicode white space at the ends."""
    return F.regexp_replace(c, rf"^{_SPACE}|{_SPACE}$", "")


def words(c: Column) -> Column:
    """The white-space separated words of a text; none for a blank one."""
    return F.filter(F.split(strip(c), _SPACE), lambda w: w != "")


def sentence_case(c: Column) -> Column:
    """First letter upper, the others lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def fold_key(c: Column) -> Column:
    """Lower-case, accent-free, single-spaced: the key for comparing names."""
    return collapse(F.lower(strip_accents(c)))


def present(c: Column, json_list: bool = False) -> Column:
    """Neither null nor empty, nor, for a list kept as JSON text, the empty list (FLT1)."""
    filled = c.isNotNull() & (c != "")
    return filled & (c != "[]") if json_list else filled


def em_dash(c: Column) -> Column:
    """A spaced hyphen between letters becomes an em dash (STR12)."""
    return F.regexp_replace(c, r"(?<=[a-zA-ZÀ-ú]) - (?=[a-zA-ZÀ-ú])", " — ")


def year_ranges(c: Column) -> Column:
    """The hyphen of a range of years becomes an en dash (STR15)."""
    return F.regexp_replace(c, r"(\d{4})-(\d{2,4})\b", "$1–$2")


#: Brazilian states.
STATES = "ac al am ap ba ce df es go ma mg ms mt pa pb pe pi pr rj rn ro rr rs sc sp to".split()


def upper_states(c: Column) -> Column:
    """State codes in lower case after a hyphen, slash or parenthesis become upper case (STR13)."""
    for code in STATES:
        c = F.regexp_replace(c, rf"([-–/]\s*){code}(?=\s*[)\s,;.!?']|\s*$)", f"$1{code.upper()}")
        c = F.regexp_replace(c, rf"(\(\s*){code}(?=\s*\))", f"$1{code.upper()}")
    return c


def upper_regions(c: Column) -> Column:
    """``estado de X`` and ``município de X`` begin with a capital (STR14)."""
    c = F.regexp_replace(c, r"\bestado(\s+d[eoa]s?\s+[A-Z])", "Estado$1")
    return F.regexp_replace(c, r"\bmunicípio(\s+d[eoa]s?\s+[A-Z])", "Município$1")


def xml_escape(c: Column) -> Column:
    """Text for XML content and attributes (STR20)."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def title_and_subtitle(c: Column, mark: str = ": ") -> Column:
    """Struct (title, subtitle) cut at the first mark; subtitle is null without one (STR11)."""
    at = F.locate(mark, c)
    return F.when(at > 0, F.struct(F.trim(c.substr(F.lit(1), at - 1)).alias("title"), F.trim(c.substr(at + len(mark), F.length(c))).alias("subtitle"))).otherwise(
        F.struct(F.trim(c).alias("title"), F.lit(None).cast("string").alias("subtitle"))
    )


def keyword_list(c: Column) -> Column:
    """Keywords from a JSON list, else lines, else ``;``, else ``,``, trimmed, none empty (STR6 to STR8)."""
    parsed = F.when(F.ltrim(c).startswith("["), F.from_json(c, "array<string>"))
    cut = F.when(c.contains("\n"), F.split(c, "\n")).when(c.contains(";"), F.split(c, ";")).otherwise(F.split(c, ","))
    return F.filter(F.transform(F.coalesce(parsed, cut), lambda k: F.regexp_replace(F.trim(k), r"^[•\-\s]+|[.;,\s]+$", "")), lambda k: k != "")


def distinct_ignoring_case(c: Column) -> Column:
    """The elements of an array that no earlier one equals but for case, in order (SET4)."""
    marked = F.array_sort(F.transform(c, lambda k, i: F.struct(F.lower(k).alias("l"), i.alias("i"), k.alias("k"))))
    # Bound to a name by the array around it, so that a comparison with the one before doesn't sort again.
    first = F.get(F.transform(F.array(marked), lambda s: F.filter(s, lambda x, j: x["l"].isNotNull() & ((j == 0) | ~x["l"].eqNullSafe(F.get(s, j - 1)["l"])))), F.lit(0))
    return F.transform(F.array_sort(F.transform(first, lambda x: F.struct(x["i"], x["k"]))), lambda x: x["k"])


def replaced_spans(c: Column, fixes: Column) -> Column:
    """Spans (start, stop, repl), counted from 0, replaced from the end of the text to its beginning (STR18)."""
    return F.aggregate(
        F.reverse(F.array_sort(fixes)),
        c,
        lambda text, f: F.concat(text.substr(F.lit(1), f["start"]), f["repl"], text.substr(f["stop"] + 1, F.length(text))),
    )


def linked(c: Column) -> Column:
    """DOIs and bare URLs as links (STR19)."""
    c = F.regexp_replace(c, r"(?i)\bdoi:\s*(10\.\d{4,9}/[^\s<]+)", '<a href="https://doi.org/$1">$1</a>')
    return F.regexp_replace(c, r'(?<!["/>])\b(https?://[^\s<"]+)', '<a href="$1">$1</a>')


def slug(c: Column, most: int = 6) -> Column:
    """A file name's stem: no accents, lower case, words joined by hyphens, at most so many (STR24)."""
    plain = F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]+", " ")
    return F.array_join(F.slice(words(plain), 1, most), "-")


#: Generic words that a proper name follows.
GENERICS = "edifício escola parque igreja teatro museu palácio hospital residência casa conjunto centro vila praça avenida terminal estação instituto".split()


def lower_generics(c: Column) -> Column:
    """Generic words in lower case before a capital, not at the beginning of the text (STR16)."""
    found = F.regexp_extract_all(F.concat(F.lit(" "), c.substr(F.lit(2), F.length(c))), F.lit(r"(?<![\p{L}\p{N}_])(" + "|".join(GENERICS) + r")\s+[A-Z]"), F.lit(1))
    return found


def numbered(keywords: Column) -> Column:
    """Keywords that begin with a number and ``.``, ``)`` or ``-`` (STR17)."""
    return F.filter(keywords, lambda k: F.trim(k).rlike(r"^\d+[.)\-]"))


def many_words(c: Column, least: int = 3) -> Column:
    """Whether a family name has so many words that it may be wrong (STR17)."""
    return F.size(words(c)) >= least


def usable_keywords(keywords: Column, longest: int = 100) -> Column:
    """Keywords cut at ``. ``, without page numbers, labels, headings in capitals and overlong ones (STR9)."""
    letters = lambda k: F.length(F.regexp_replace(k, r"[^\p{L}]", ""))
    capitals = lambda k: F.length(F.regexp_replace(k, r"[^\p{Lu}]", ""))
    cut = F.transform(F.flatten(F.transform(keywords, lambda k: F.split(k, r"\.\s+"))), lambda k: F.regexp_replace(strip(k), r"[.;,]+$", ""))
    heading = lambda k: (letters(k) > 12) & (capitals(k) > 0.55 * letters(k))
    label = r"(?iu)^(?:palavras?[- ]chave|keywords?|abstract|resumo)\b"
    return F.filter(cut, lambda k: (k != "") & ~k.rlike(r"^\d+$") & (F.length(k) <= longest) & ~heading(k) & ~k.rlike(label))


def without_trailing_event(c: Column, pattern: str) -> Column:
    """A keyword without the event's name at its end (STR10)."""
    return F.trim(F.regexp_replace(c, rf"(?iu)[\s.,;–-]*(?:{pattern}).*$", ""))


def without_running_header(refs: Column, header: str) -> Column:
    """References that are the running header go; where it leads or is inside, it is cut out (STR23)."""
    kept = F.filter(refs, lambda r: F.trim(r) != header)
    return F.filter(F.transform(kept, lambda r: collapse(F.replace(r, F.lit(header), F.lit(" ")))), lambda r: r != "")


def name_list(people: Column, joiner: str = "; ") -> Column:
    """Structs (given, family) as ``Family, Given`` joined (STR28)."""
    return F.array_join(F.transform(people, lambda p: F.concat_ws(", ", p["family"], F.nullif(p["given"], F.lit("")))), joiner)


def without_intro(c: Column, intros: list[str], times: int = 3) -> Column:
    """A text without up to so many of the phrases at its beginning (STR30)."""
    return F.regexp_replace(c, "^(?:(?:" + "|".join(intros) + r")\s*){1," + str(times) + "}", "")


def clean_author(c: Column) -> Column:
    """An author string on one line without academic degrees and trailing dots (NAM16)."""
    plain = F.regexp_replace(collapse(c), r"(?iu)(?:^|[\s,(])(?:dr|dra|prof|profa|msc|phd|arq|arqto|arqta)\.?(?=[\s,)]|$)", " ")
    return F.regexp_replace(collapse(plain), r"[\s.,;]+$", "")
