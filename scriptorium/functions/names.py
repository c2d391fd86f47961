"""Columns over people's names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions.text import collapse, strip_accents, words

#: Particles of names, and suffixes that keep the surname before them.
PARTICLES = "de da do das dos e del von van di".split()
SUFFIXES = "filho junior júnior neto sobrinho segundo terceiro".split()
#: Similarity from which two surnames count as spellings of one.
SIMILAR = 0.92


def normal(c: Column, delete_dots: bool = False) -> Column:
    """Lower case, no accents; dots and commas become spaces (STR3) or go (STR4)."""
    plain = F.lower(strip_accents(c))
    return collapse(F.translate(plain, ".,", "") if delete_dots else F.translate(plain, ".,", "  "))


def abbreviates(short: Column, long: Column, delete_dots: bool = False) -> Column:
    """Whether short is long, its beginning, or begins each of its words in turn (NAM1)."""
    s, lo = normal(short, delete_dots), normal(long, delete_dots)
    sw, lw = words(s), words(lo)
    each = F.forall(F.arrays_zip(sw.alias("s"), lw.alias("l")), lambda p: F.coalesce(p["l"].startswith(p["s"]), F.lit(True)))
    return (s == lo) | lo.startswith(s) | ((F.size(sw) <= F.size(lw)) & each)


def _common_prefix(a: Column, b: Column) -> Column:
    """How many of up to four first letters agree."""
    return F.aggregate(F.array(*[F.lit(k) for k in range(1, 5)]), F.lit(0), lambda n, k: F.when((n == k - 1) & (F.length(a) >= k) & (F.left(a, k) == F.left(b, k)), k).otherwise(n))


def _raised(jaro: Column, a: Column, b: Column) -> Column:
    return jaro + _common_prefix(a, b) * 0.1 * (1 - jaro)


def jaro_winkler(a: Column, b: Column) -> Column:
    """Jaro similarity raised by 0.1 for each of up to four equal first letters, without Python: a fold over the letters of a,
    each of which takes the first free equal letter of b within reach. Taken letters of b become U+0000."""
    la, lb = F.length(a), F.length(b)
    reach = F.greatest(F.floor(F.greatest(la, lb) / 2) - 1, F.lit(0)).cast("int")

    def step(s: Column, i: Column) -> Column:
        letter, start = F.substr(a, i, F.lit(1)), F.greatest(i - reach, F.lit(1))
        found = F.position(letter, F.substr(s["rest"], start, i + reach - start + 1))
        return F.when(found == 0, s).otherwise(F.struct(F.overlay(s["rest"], F.lit("\0"), start + found - 1, F.lit(1)).alias("rest"), F.concat(s["left"], letter).alias("left")))

    done = F.aggregate(F.sequence(F.lit(1), la), F.struct(b.alias("rest"), F.lit("").alias("left")), step)
    order = lambda x: F.filter(F.transform(F.sequence(F.lit(1), lb), lambda i: F.when(F.substr(x, i, F.lit(1)) == "\0", F.substr(b, i, F.lit(1)))), lambda y: y.isNotNull())

    def score(s: Column) -> Column:
        m, right = F.length(s["left"]), order(s["rest"])
        half = F.size(F.filter(F.sequence(F.lit(1), m), lambda i: F.substr(s["left"], i, F.lit(1)) != F.get(right, i - 1))) / 2
        return F.when(m == 0, 0.0).otherwise(_raised((m / la + m / lb + (m - half) / m) / 3, a, b))

    scored = F.get(F.transform(F.array(done), score), F.lit(0))
    return F.when(a == b, 1.0).when((la == 0) | (lb == 0), 0.0).otherwise(scored)


def jaro_winkler_bound(a: Column, b: Column) -> Column:
    """What the similarity is at most, from lengths, first letters and letters that the other name lacks: cheap, and never too low."""
    la, lb = F.length(a), F.length(b)
    common = F.least(F.length(a) - F.length(F.call_function("translate", a, b, F.lit(""))), F.length(b) - F.length(F.call_function("translate", b, a, F.lit(""))))
    return F.when(common == 0, 0.0).otherwise(_raised((common / la + common / lb + 1) / 3, a, b))


def surname_score(a: Column, b: Column) -> Column:
    """1 for equal normal forms, else their Jaro-Winkler similarity (NAM2, NAM3). Block before use."""
    return jaro_winkler(normal(a), normal(b))


def similar(a: Column, b: Column) -> Column:
    """Whether two surnames count as spellings of one; the score is taken only where its bound reaches SIMILAR (NAM3)."""
    x, y = normal(a), normal(b)
    return F.when(x == y, True).when(jaro_winkler_bound(x, y) < SIMILAR, False).otherwise(jaro_winkler(x, y) >= SIMILAR)


def is_variant(given_a: Column, family_a: Column, given_b: Column, family_b: Column) -> Column:
    """Similar surnames and one given name abbreviates the other (NAM4)."""
    return similar(family_a, family_b) & (abbreviates(given_a, given_b) | abbreviates(given_b, given_a))


def longer(a: Column, b: Column) -> Column:
    """The fuller name: more words, then more letters, then the accented one, then the first (NAM6)."""
    na, nb, la, lb = F.size(words(a)), F.size(words(b)), F.length(a), F.length(b)
    plain = strip_accents(a)
    return (
        F.when(na != nb, F.when(na > nb, a).otherwise(b))
        .when(la != lb, F.when(la > lb, a).otherwise(b))
        .when(plain == strip_accents(b), F.when(a != plain, a).otherwise(b))
        .otherwise(a)
    )


def confidence(short: Column) -> Column:
    """``alta`` if the shorter given name has two words of more than a letter, else ``baixa`` (NAM7)."""
    return F.when(F.size(F.filter(words(normal(short)), lambda w: F.length(w) > 1)) <= 1, "baixa").otherwise("alta")


def full_tokens(given: Column, family: Column) -> Column:
    """Normal words of the whole name without particles (NAM8)."""
    return F.filter(words(normal(F.concat_ws(" ", given, family))), lambda w: ~w.isin(PARTICLES))


def tokens_compatible(short: Column, long: Column) -> Column:
    """First words begin alike, last ones are equal, and those between follow in order (NAM9).

    The fold keeps the place in long up to which words are used, -1 once one is missing.
    """
    middle = F.slice(long, 2, F.greatest(F.size(long) - 2, F.lit(0)))

    def step(at: Column, w: Column) -> Column:
        hit = F.array_min(F.filter(F.transform(middle, lambda x, i: F.when((i >= at) & x.startswith(w), i)), lambda i: i.isNotNull()))
        return F.when(at < 0, at).otherwise(F.coalesce(hit + 1, F.lit(-1)))

    placed = F.aggregate(F.slice(short, 2, F.greatest(F.size(short) - 2, F.lit(0))), F.lit(0), step)
    ends = F.get(long, F.lit(0)).startswith(F.get(short, F.lit(0))) & (F.try_element_at(short, F.lit(-1)) == F.try_element_at(long, F.lit(-1)))
    return F.when((F.size(short) == 0) | (F.size(long) == 0), False).otherwise(ends & (placed >= 0))


def split_name(tokens: Column, suffixes: bool = True) -> Column:
    """Struct (given, family): the last word is the family name, with the one before it
    if it is a suffix of a name of three words or more (NAM10; NAM11 without suffixes)."""
    n = F.size(tokens)
    last = F.lower(F.try_element_at(tokens, F.lit(-1)))
    take = F.when(last.isin(SUFFIXES) & (n >= 3), 2).otherwise(1) if suffixes else F.lit(1)
    take = F.least(take, n)
    return F.struct(
        F.array_join(F.slice(tokens, F.lit(1), n - take), " ").alias("given"),
        F.array_join(F.slice(tokens, n - take + 1, take), " ").alias("family"),
    )


def first_real_name(given: Column) -> Column:
    """The first word that is no particle and has more than two letters, else null (NAM13)."""
    return F.get(F.filter(words(normal(given)), lambda w: ~w.isin(PARTICLES) & (F.length(w) > 2)), F.lit(0))


def initials_only(given: Column) -> Column:
    """Whether every word but particles is a single letter, and there is one (NAM13, NAM17)."""
    real = F.filter(words(normal(given)), lambda w: ~w.isin(PARTICLES))
    return (F.size(real) > 0) & F.forall(real, lambda w: F.length(w) == 1)


def title_case(c: Column) -> Column:
    """Words with a first capital; particles stay lower but at the beginning (NAM12)."""
    return F.array_join(
        F.transform(words(c), lambda w, i: F.when((i > 0) & F.lower(w).isin(PARTICLES), F.lower(w)).otherwise(F.concat(F.upper(w.substr(1, 1)), F.lower(w.substr(F.lit(2), F.length(w)))))), " "
    )


def family_first(c: Column) -> Column:
    """``SURNAME, Given`` as struct (given, family) in title case (NAM12)."""
    parts = F.split(c, ",", 2)
    return F.struct(title_case(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).alias("given"), title_case(F.get(parts, F.lit(0))).alias("family"))


def is_initial(c: Column) -> Column:
    """Whether a word is capitals with or without dots only, such as ``M.`` or ``A.B.`` (NAM17)."""
    return c.rlike(r"^(?:[A-Z]\.?)+$")


def name_words(*fields: Column, skipped: list[str] = PARTICLES + SUFFIXES) -> Column:
    """Distinct structs (word, canonical) of the words of names, without initials, single letters and the words to skip (NAM17)."""
    every = F.flatten(F.array(*[F.coalesce(words(f), F.array().cast("array<string>")) for f in fields]))
    plain = F.filter(F.transform(every, lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}_]", "")), lambda w: (F.length(w) >= 2) & ~F.lower(w).isin(skipped) & ~is_initial(w))
    return F.array_distinct(F.transform(plain, lambda w: F.struct(F.lower(w).alias("word"), F.concat(F.upper(F.left(w, F.lit(1))), w.substr(F.lit(2), F.length(w))).alias("canonical"))))
