"""Authors, titles, axes and tables of contents from the plain text of papers (EXT5, EXT7 to EXT13, WIN14).

Lines are exploded and told apart by patterns; what follows a line until the next of its kind belongs to it, found by
a running count per document, so that a document is a window partition and never a Python loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions.text import bound, collapse, fold_key, words

_UP, _LET = "A-ZÁÉÍÓÚÀÂÊÔÃÕÇ", "A-ZÁÉÍÓÚÀÂÊÔÃÕÇa-záéíóúàâêôãõç"
MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
#: Stems of words with which lines about a person begin; up to five letters may follow. An input of line_kind.
BIO_STEMS = ["arquitet", "professor", "doutor", "mestr", "graduand", "estudante", "técnic", "tecnic", "pós-doutor", "pos-doutor", "pesquisador", "bolsista", "especialista"]
#: Words of an affiliation.
AFFILIATION = r"(?iu)(?<![\p{L}\p{N}_])(?:universidade|faculdade|instituto|escola|departamento|university|faculty|institute|school|department)(?![\p{L}\p{N}_])"
#: Particles of names, and words after which a name belongs to the title.
PARTICLES = ["de", "da", "do", "dos", "das", "e", "di"]
LEADS_ON = ["de", "do", "da", "dos", "das", "por", "ao", "no", "na", "nos", "nas", "em", "com", "para", "arquiteto", "arquiteta", "engenheiro", "engenheira"]


def name_pattern(particles: list[str] = PARTICLES) -> str:
    """Two words or more, each with a capital, a particle or in parentheses, one at least a name, and no year among them."""
    end, small = r"(?=[\s\p{Z}]|$)", "|".join(particles)
    word = rf"(?:\p{{Lu}}\S*|(?iu:{small}){end}|\([^)]*\))"
    some_name = rf"(?=(?:.*[\s\p{{Z}}])?(?!(?iu:{small}){end})\p{{Lu}})"
    return rf"^(?!.*(?<!\d)\d{{4}}(?!\d)){some_name}{word}(?:[\s\p{{Z}}]+{word})+$"


def is_name(line: Column, title_words: list[str] | None = None, particles: list[str] = PARTICLES) -> Column:
    """Whether a line may be a person's name: it fits name_pattern, has no dot at its end and no word of titles."""
    fits = line.rlike(name_pattern(particles)) & ~F.rtrim(line).endswith(".")
    return fits & ~F.exists(words(line), lambda w: fold_key(w).isin(title_words)) if title_words else fits


def line_kind(line: Column, title_words: list[str] | None = None, bio: list[str] = BIO_STEMS) -> Column:
    """blank, email, bio, affiliation, name or other, the first that fits (EXT9)."""
    about = rf"(?iu)^(?:{'|'.join(bio)})\p{{L}}{{0,5}}(?![\p{{L}}\p{{N}}_])"
    return (
        F.when(F.trim(line) == "", "blank").when(line.rlike(MAIL), "email").when(F.trim(line).rlike(about), "bio").when(line.rlike(AFFILIATION), "affiliation")
        .when(is_name(line, title_words), "name").otherwise("other")
    )


def continues_title(before: Column) -> Column:
    """Whether a title's line asks for more: its last word is a preposition or a profession (EXT9)."""
    return ~F.rtrim(before).endswith(".") & F.coalesce(F.lower(F.try_element_at(words(before), F.lit(-1))).isin(LEADS_ON), F.lit(False))


def lines_of(df: DataFrame, key: str, text: str, most: int | None = None) -> DataFrame:
    """(key, pos, line, kind) of the first lines, or all."""
    lines = F.split(text, "\n")
    lines = df.select(key, F.posexplode(F.slice(lines, 1, most) if most else lines).alias("pos", "line"))
    return lines.withColumn("line", F.trim("line")).withColumn("kind", line_kind(F.col("line")))


def header_authors(df: DataFrame, key: str, text: str, most: int | None = None) -> DataFrame:
    """(key, seq, name, affiliation, email, bio) from header lines: what follows a name up to the next one is about that person (EXT10)."""
    w = Window.partitionBy(key).orderBy("pos")
    lines = lines_of(df, key, text, most).withColumn("seq", F.sum((F.col("kind") == "name").cast("long")).over(w)).where("seq > 0")
    of = lambda kind: F.min_by(F.when(F.col("kind") == kind, F.col("line")), F.when(F.col("kind") == kind, F.col("pos")))
    mail = F.regexp_extract(of("email"), MAIL, 0)
    bio = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == "bio", F.struct("pos", "line")))), lambda x: x["line"]), " ")
    return lines.groupBy(key, "seq").agg(of("name").alias("name"), of("affiliation").alias("affiliation"), mail.alias("email"), F.nullif(bio, F.lit("")).alias("bio"))


def names_before_bio(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, names): the name lines that stand together right before the first line about a person (WIN14)."""
    lines = lines_of(df, key, text).where("kind <> 'blank'")
    up = Window.partitionBy(key).orderBy("pos")
    before = lines.withColumn("bios", F.sum((F.col("kind") == "bio").cast("int")).over(up)).where("bios = 0")
    with_bio = lines.where("kind = 'bio'").select(key).distinct()
    down = Window.partitionBy(key).orderBy(F.desc("pos"))
    block = before.withColumn("others", F.sum((F.col("kind") != "name").cast("int")).over(down)).where("others = 0")
    names = block.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]).alias("names"))
    return names.join(with_bio, key, "left_semi")


def numbered_authors(text: Column) -> Column:
    """Structs (no, given, family, affiliation, email, main) of ``FAMILY, Given (n)`` with the notes ``n. affiliation, e-mail`` (EXT7)."""
    name = rf"([{_UP}][{_UP} ]+),\s*([{_UP}][{_LET}\s.]+?)\s*\((\d+)\)"
    note = rf"(?m)^\s*(\d+)\.\s*([^@\n]+?),\s*({MAIL})"
    every = lambda pattern, *fields: F.arrays_zip(*[F.regexp_extract_all(text, F.lit(pattern), F.lit(k)).alias(f) for k, f in enumerate(fields, 1)])
    notes = every(note, "no", "affiliation", "email")

    def authors(notes: Column, apart: Column) -> Column:
        def author(a: Column) -> Column:
            # Where no number comes twice, notes in order are found by their place; others are searched for the first of the number.
            placed = F.get(notes, a["no"].try_cast("int") - 1)
            found = F.when(apart & (placed["no"] == a["no"]), placed).otherwise(F.get(F.filter(notes, lambda n: n["no"] == a["no"]), F.lit(0)))
            said = lambda n: F.struct(
                a["no"].cast("long").alias("no"), F.trim(a["given"]).alias("given"), F.initcap(F.lower(F.trim(a["family"]))).alias("family"),
                F.trim(n["affiliation"]).alias("affiliation"), n["email"].alias("email"), (a["no"] == "1").alias("main"),
            )
            return bound(found, said)

        return F.transform(every(name, "family", "given", "no"), author)

    numbers = lambda notes: F.transform(notes, lambda n: n["no"])
    return bound(every(note, "no", "affiliation", "email"), lambda notes: bound(F.size(F.array_distinct(numbers(notes))) == F.size(notes), lambda apart: authors(notes, apart)))


def listed_authors(text: Column) -> Column:
    """Structs (given, family) of names parted by ``;``, a slash or ``&``: ``Family, Given``, or the last words in capitals, or the last word (EXT8)."""

    def author(x: Column) -> Column:
        capitals = F.regexp_extract(x, rf"^(.*?)\s+([{_UP}][{_UP}'-]+(?:\s+[{_UP}][{_UP}'-]+)*)$", 2)
        last = F.when(capitals != "", capitals).otherwise(F.regexp_extract(x, r"(\S+)$", 1))
        comma = F.split(x, r"\s*,\s*", 2)
        return F.when(x.contains(","), F.struct(F.get(comma, F.lit(1)).alias("given"), F.initcap(F.lower(F.get(comma, F.lit(0)))).alias("family"))).otherwise(
            F.struct(F.trim(F.left(x, F.length(x) - F.length(last))).alias("given"), F.initcap(F.lower(last)).alias("family"))
        )

    return F.transform(F.filter(F.transform(F.split(text, r"[;/&]"), collapse), lambda x: x != ""), author)


def acronym(c: Column, keys: list[tuple[str, str]], known: str = r"(?<![\p{L}\p{N}_])(UF[A-Z]{1,4}|USP|UnB)(?![\p{L}\p{N}_])") -> Column:
    """The value of the first key that a text contains, else the last known acronym in it, else null (EXT11)."""
    found = F.try_element_at(F.regexp_extract_all(c, F.lit(known), F.lit(1)), F.lit(-1))
    for key, value in reversed(keys):
        found = F.when(c.contains(key), value).otherwise(found)
    return found


def axis(c: Column, names: dict[str, str] | None = None) -> Column:
    """``Eixo n`` or ``Eixo n - name`` of a text (EXT5), with the name of that number if it has one; null without."""
    n = F.nullif(F.regexp_extract(c, r"(?imu)^\s*eixo(?:\s+tem[aá]tico)?\s*:?\s*(\d+)", 1), F.lit("")).cast("int")
    own = F.nullif(F.trim(F.regexp_extract(c, r"(?imu)^\s*eixo(?:\s+tem[aá]tico)?\s*:?\s*\d+\s*[-–—:.|]\s*([^\n]*)", 1)), F.lit(""))
    name = own
    if names:
        table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
        name = F.coalesce(F.try_element_at(table, n.cast("string")), own)
    return F.when(n.isNotNull(), F.concat_ws(" - ", F.concat(F.lit("Eixo "), n.cast("string")), name))


def full_title(text: Column, start: Column) -> Column:
    """The title at the head of a text: from the line that begins like ``start`` on, while most letters are capitals (EXT13);
    null if no line does."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    count = lambda x, kind: F.regexp_count(x, F.lit(kind))
    upper = lambda x: count(x, r"\p{Lu}") > 0.5 * count(x, r"\p{L}")
    from_ = F.array_position(F.transform(lines, lambda x: (F.length(x) > 0) & fold_key(x).startswith(fold_key(start))), True)
    rest = F.slice(lines, F.greatest(from_, F.lit(1)).cast("int"), F.size(lines))
    stop = F.array_position(F.transform(rest, lambda x, i: (i > 0) & ~upper(x)), True)
    return F.when(from_ > 0, F.array_join(F.when(stop > 0, F.slice(rest, F.lit(1), (stop - 1).cast("int"))).otherwise(rest), " "))


def contents(df: DataFrame, key: str, text: str, section: str, ends: str = r"(\d{1,4})$", by: str | None = None, stop: str | None = None) -> DataFrame:
    """(key, no, section, title, authors, page) of a table of contents (EXT12).

    Lines of a page number at the end close an entry, whatever the lines it runs over; ``section`` has one group, the heading that holds from
    there on. ``by`` parts title and authors (``title | authors``), in the order that its groups named title and authors have; without it all
    is the title. From a line that matches ``stop`` on, nothing counts. Dot leaders and bullets go.
    """
    w = Window.partitionBy(key).orderBy("pos")
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line")).withColumn("line", F.regexp_replace(F.trim("line"), r"^[●•]\s*", "")).where("line <> ''")
    if stop:
        lines = lines.withColumn("after", F.max(F.col("line").rlike(stop).cast("int")).over(w)).where("after = 0")
    heading = F.nullif(F.regexp_extract("line", section, 1), F.lit(""))
    lines = lines.withColumn("section", F.last(heading, ignorenulls=True).over(w)).where(~F.col("line").rlike(section) & F.col("section").isNotNull())
    closed = F.sum(F.col("line").rlike(ends).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    entries = lines.withColumn("no", F.coalesce(closed, F.lit(0)) + 1).groupBy(key, "no").agg(
        F.max_by("section", "pos").alias("section"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), " ").alias("entry")
    )
    page = F.regexp_extract("entry", ends, 1)
    body = F.regexp_replace("entry", r"[\s.·|]*" + ends, "")
    title, authors = (F.trim(F.regexp_extract(body, by, k)) for k in (1, 2)) if by else (body, F.lit(""))
    fits = F.col("entry").rlike(ends)
    return entries.where(fits).select(key, "no", "section", title.alias("title"), F.nullif(authors, F.lit("")).alias("authors"), page.cast("long").alias("page"))


#: A file's name: folders, the axis, people up to the first full stop or dash with a space after it, the title, the ending.
_FILE = r"(?i)^(?:.*/)?(?:E0?(\d)-?)?(?:([^/]*?)(?:\.\s|\s-\s)\s*)?([^/]*?)\.*(?:\.pdf)?$"


def name_parts_of_file(name: Column) -> Column:
    """Struct (axis, families, title) of ``E01-FAMILY, I._ FAMILY2. Title.pdf`` or ``FAMILY - Title.pdf`` (SRC14); a family
    is the first word, of three letters or more, after a sign that parts people."""
    part = lambda k: F.regexp_extract(name, _FILE, k)
    families = F.regexp_extract_all(part(2), F.lit(r"(?:^|[_,;])[\s.]*([^\s_,;.]{3,})"), F.lit(1))
    return F.struct(F.nullif(part(1), F.lit("")).cast("int").alias("axis"), F.transform(families, lambda f: F.upper(f)).alias("families"), part(3).alias("title"))


def files_by_stem(files: DataFrame, name: str, suffixes: list[str], kinds: list[str]) -> DataFrame:
    """(stem, <kind>...) with the names of each kind of file, in order, that agree but for suffixes, numbers of copies and case (SRC15)."""
    stem = F.regexp_replace(F.col(name), r"\.[^.]+$", "")
    stem = F.regexp_replace(stem, r"\s*\(\d+\)\s*$", "")
    for suffix in suffixes:
        stem = F.regexp_replace(stem, rf"(?iu)\s*\Q{suffix}\E\s*$", "")
    stem = F.regexp_replace(F.lower(F.trim(stem)), r"[._]+$", "")
    kind = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    lists = [F.array_sort(F.collect_list(F.when(kind == k, F.col(name)))).alias(k) for k in kinds]
    return files.where(kind.isin(kinds)).groupBy(stem.alias("stem")).agg(*lists)
