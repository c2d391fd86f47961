"""Document fingerprints from closed syncmers, in DataFrame operations only.

A K-mer of a text's UTF-16 code units is an anchor if the least hash among its
S-mers stands at either edge. Whether a K-mer is an anchor depends on nothing
around it, so texts that share a passage share its anchors wherever it
stands, at positions that differ by one shift.

``anchors`` gives every anchor with its position, and ``passages`` matches two texts' anchors
by position: anchors at one shift show a passage that both hold. A fingerprint keeps
the anchors, with positions, whose hash is below a limit: all of those in texts of up to WHOLE units, half of
those in texts of twice as many, and so on down to 1 / 2**HALVINGS, from where it grows with the text. Limits being nested,
two fingerprints compare at the lower one; the share of anchors that they have in common is the likeness of the texts.

Anchors being free of context, the fingerprint of an edited text is put together
from the anchors of the part that was kept and those of the new part.

Positions are exploded to rows and anchors chosen in generated code, once;
rows of a document stay in the task that has its text, so that only texts are shuffled,
once, to bring each next to the following one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scriptorium.llm.common import stored, table

K, S = 16, 9
_INNER = K - S + 1
#: Code units up to which every anchor is kept, and how often their share is halved at most.
WHOLE, HALVINGS = 256, 4
#: Ids in a run of documents that are sorted together to find each one's next.
RUN = 256


def units(text: str) -> str:
    """SQL for a text's UTF-16 code units; substrings of binary take constant time."""
    return f"encode({text}, 'UTF-16BE')"


def positions(codes: str) -> str:
    """SQL for the number of K-mers in code units."""
    return f"greatest(octet_length({codes}) div 2 - {K - 1}, 0)"


def is_anchor(codes: str, i: str) -> str:
    """SQL for whether the K-mer at position i of code units is an anchor."""
    smers = [f"xxhash64(substring({codes}, 2 * ({i} + {j}) + 1, {2 * S}))" for j in range(_INNER)]
    return f"least({', '.join(smers)}) = least({smers[0]}, {smers[-1]})"


def anchor_hash(codes: str, i: str) -> str:
    return f"xxhash64(substring({codes}, 2 * {i} + 1, {2 * K}))"


#: A text's own hash, for texts without an anchor.
_OWN = "xxhash64({0})"


def limit(n_units: str) -> str:
    """SQL for the limit of kept hashes (32 bits) of a text of so many code units."""
    return f"shiftright(4294967296L, cast(least({HALVINGS}, greatest(0, ceil(log2(greatest({n_units}, 1) / {WHOLE}.0D)))) as int))"


def packed(code: str, position: str) -> str:
    """SQL for an anchor as one number, its hash before its position."""
    return f"shiftrightunsigned({code}, 32) * 2147483648L + {position}"


def _hash(x: str) -> str:
    return f"shiftright({x}, 31)"


def _below(code: str, bound: str) -> str:
    return f"shiftrightunsigned({code}, 32) < {bound}"


def sketch(found: str, own: str) -> str:
    """SQL for a fingerprint from the kept anchors (packed, in any order, with repeats): each hash at its first
    position, in order; the text's own hash if there are none."""
    firsts = f"transform(array(sort_array({found})), r -> filter(r, (x, i) -> i = 0 or {_hash('r[i - 1]')} <> {_hash('x')}))[0]"
    return f"if(size({found}) > 0, {firsts}, array({packed(own, '0')}))"


def shown(codes: str) -> str:
    """SQL for a fingerprint as a string: eight hexadecimal digits for each hash."""
    return f"array_join(transform({codes}, x -> lpad(lower(hex({_hash('x')})), 8, '0')), '')"


def likeness(a: str, bound_a: str, b: str, bound_b: str) -> str:
    """SQL for the share of hashes in both fingerprints among those in either, below both limits; 1 for equal ones."""
    part = lambda x: f"transform(filter({x}, x -> {_hash('x')} < least({bound_a}, {bound_b})), x -> {_hash('x')})"
    share = "if(size(r.p) + size(r.q) = 0, 0D, size(array_intersect(r.p, r.q)) / cast(size(array_union(r.p, r.q)) as double))"
    return f"if({a} = {b}, 1D, transform(array(struct({part(a)} as p, {part(b)} as q)), r -> {share})[0])"


def passage(a: str, b: str) -> str:
    """SQL for the longest passage by the fingerprints' positions: (anchors, shift, start, end) of the shift that
    most anchors in both agree on, start and end being code units of the first text; null if they share none."""
    place = lambda x, y: f"({x}[cast(array_position({y}, c) - 1 as int)] & 2147483647L)"
    hashes = lambda x: f"transform({x}, x -> {_hash('x')})"
    common = f"transform(array_intersect(r.p, r.q), c -> transform(array({place('r.a', 'r.p')}), v -> struct(v - {place('r.b', 'r.q')} as shift, v as at))[0])"
    of_shift = f"transform(array(filter(m, y -> y.shift = d)), g -> struct(size(g) as anchors, d as shift, array_min(g.at) as start, array_max(g.at) + {K} as end))[0]"
    best = f"transform(array({common}), m -> array_max(transform(array_distinct(m.shift), d -> {of_shift})))[0]"
    return f"transform(array(struct({a} as a, {b} as b, {hashes(a)} as p, {hashes(b)} as q)), r -> {best})[0]"


def _numbered(df: DataFrame, key: str, text: str) -> DataFrame:
    rows = df.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("t"))
    return rows.withColumn("no", F.row_number().over(Window.partitionBy("key").orderBy("t")))


def _found(rows: DataFrame, *columns: str) -> DataFrame:
    """The anchors of rows with code units b: (*columns, i, code)."""
    at = rows.selectExpr(*columns, "b", f"explode(if({positions('b')} > 0, sequence(0, cast({positions('b')} as int) - 1), cast(array() as array<int>))) i")
    return at.where(is_anchor("b", "i")).selectExpr(*columns, "i", f"{anchor_hash('b', 'i')} code")


def anchors(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, no, position, code) of every anchor of every row of df; rows that repeat a key are told apart by ``no``."""
    found = _found(_numbered(df, key, text).selectExpr("key", "no", f"{units('t')} b"), "key", "no")
    return found.selectExpr(f"key as `{key}`", "no", "cast(i as long) position", "code")


def passages(pairs: DataFrame, a: str, b: str, least: int = 2) -> DataFrame:
    """The rows of pairs, each with (shift, start, end, anchors) for every passage that its texts a and b share.

    A passage is what at least ``least`` anchors show that stand once in either text and differ by one shift in position; start
    and end are code units of a. Anchors that a text repeats do not say where they belong. Null counts as empty.
    """
    rows = pairs.withColumn("_pair", F.monotonically_increasing_id())
    sides = []
    for name in (a, b):
        coded = rows.select("_pair", F.expr(units(f"coalesce(`{name}`, '')")).alias("b"))
        sides.append(_found(coded, "_pair").groupBy("_pair", "code").agg(F.min("i").alias("i"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n"))
    met = sides[0].join(sides[1].withColumnRenamed("i", "j"), ["_pair", "code"])
    runs = met.groupBy("_pair", F.expr("i - j").cast("long").alias("shift")).agg(F.min("i").cast("long").alias("start"), (F.max("i") + K).cast("long").alias("end"), F.count(F.lit(1)).alias("anchors"))
    return rows.join(runs.where(F.col("anchors") >= least), "_pair").drop("_pair")


def fingerprints(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, codes, fingerprint) for every row of df; null counts as empty, and equal texts have equal
    ones. Rows that repeat a key are told apart by a number and give a row each.

    codes has a packed number (see there) for each hash kept. A text that is longer than WHOLE but
    repeats few anchors may keep none; its own hash stands for it then, as for one without anchors.
    """
    rows = _numbered(df, key, text)
    coded = rows.selectExpr("key", "no", f"{units('t')} b").withColumn("bound", F.expr(limit("(octet_length(b) div 2)")))
    kept = _found(coded, "key", "no", "bound").where(_below("code", "bound"))
    found = kept.groupBy("key", "no").agg(F.collect_list(F.expr(packed("code", "i"))).alias("found"))
    full = rows.alias("r").join(found.alias("f"), F.expr("r.key <=> f.key and r.no = f.no"), "left").selectExpr("r.key", "coalesce(found, array()) found", f"{_OWN.format('t')} own")
    return full.selectExpr(f"key as `{key}`", f"{sketch('found', 'own')} codes").withColumn("fingerprint", F.expr(shown("codes")))


def run_of(df: DataFrame, key: str) -> Column:
    """The number of a row's run: about RUN rows, whatever the spread of the ids, if they are spread evenly; null keys are run -1."""
    kind = dict(df.dtypes)[key]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"the next row is found by integers, but {key} is {kind}")
    low, high, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    width = max(RUN, -(-RUN * (high - low + 1) // n)) if n else RUN
    return F.coalesce(F.expr(f"cast(floor((cast({key} as decimal(20, 0)) - {low or 0}BD) / {width}BD) as bigint)"), F.lit(-1))


def successors(heads: DataFrame) -> DataFrame:
    """(_from, _run): each run of heads (_run, ...) with the next that there is, the last with the first.

    Found over the runs' numbers alone, in runs of RUN of them; the window over everything has a row for RUN * RUN rows.
    """
    runs = heads.select("_run", F.floor(F.col("_run") / RUN).alias("_over"))
    overs = runs.groupBy("_over").agg(F.min("_run").alias("first"))
    everything = Window.orderBy("_over")
    overs = overs.select(
        "_over", F.coalesce(F.lead("first").over(everything), F.first("first").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after")
    )
    inside = Window.partitionBy("_over").orderBy("_run")
    return runs.withColumn("n", F.lead("_run").over(inside)).join(overs, "_over").select(F.col("_run").alias("_from"), F.coalesce("n", "after").alias("_run"))


def with_next(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """df with next_<column> from the row with the next larger key; the last row gets the first one's.

    The key must be an integer. Rows of equal key follow each other in the order of ``columns``; null keys come
    first. Rows are sorted within runs (``_run``, numbered ``_no`` there); a run's last row takes the
    first row of the next run that has any.
    """
    df = df.withColumn("_run", run_of(df, key))
    row = F.struct(F.col(key), *columns)
    heads = df.groupBy("_run").agg(F.min(row).alias("_head"))
    tails = heads.join(successors(heads), "_run").select(F.col("_from").alias("_run"), F.col("_head").alias("_after"))
    inside = Window.partitionBy("_run").orderBy(key, *columns)
    named = df.withColumn("_no", F.row_number().over(inside)).withColumn("_lead", F.lead(row).over(inside))
    # Every row has a successor but the last of its run, whose _lead is null.
    both = named.join(tails, "_run", "left").withColumn("_lead", F.coalesce("_lead", "_after"))
    return both.select("_run", "_no", *[c for c in df.columns if c != "_run"], *[F.col(f"_lead.{c}").alias(f"next_{c}") for c in [key, *columns]])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: fingerprints of every document and of its edited text, their likeness, that to the next document, and where
    both hold the longest passage (next_passage: anchors, shift, start, end)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    half = "cast(n_chars div 2 as int)"
    pairs = (
        with_next(docs, "doc_id", ["text"])
        .withColumn("n_chars", F.length("text").cast("long"))
        .selectExpr("_run", "_no", "doc_id", "text", "n_chars", f"left(text, cast(n_chars as int) - {half}) as before", f"left(next_text, {half}) as after")
    )
    # Positions of the text, then those of the new part with the last units before it; -1 stands for the document itself.
    coded = pairs.selectExpr(
        "_run", "_no", "doc_id", "text", "n_chars", "concat(before, after) edited", f"{units('text')} b", f"octet_length({units('before')}) div 2 kept",
        f"octet_length({units(f'right(before, {K - 1})')}) div 2 again", f"{units(f'concat(right(before, {K - 1}), after)')} c",
    )
    sized = coded.selectExpr("*", f"cast({positions('b')} as int) n_b", f"cast({positions('c')} as int) n_c", f"{limit('(octet_length(b) div 2)')} bound", f"{limit('(kept - again + octet_length(c) div 2)')} edited_bound")
    at = sized.selectExpr("*", "explode(sequence(-1, n_b + n_c - 1)) p").selectExpr("*", "if(p < n_b, b, c) u", "if(p < n_b, p, p - n_b) i")
    rows = at.where(f"p < 0 or {is_anchor('u', 'i')}").selectExpr(
        "*", f"if(p < 0, null, {anchor_hash('u', 'i')}) code", "p >= 0 and p < n_b own", f"p >= n_b or (p >= 0 and p <= kept - {K}) new", "if(p < n_b, p, kept - again + i) place",
        f"if(p < 0, struct(n_chars, sha2(edited, 256) as sha, {_OWN.format('text')} as own, {_OWN.format('edited')} as own_edited), null) facts",
    )
    # Facts stay a column of their own under the aggregate, as they are asked for several times; so no text enters it.
    fact = lambda x: F.max(f"facts.{x}")
    kept = rows.where(f"p < 0 or own and {_below('code', 'bound')} or new and {_below('code', 'edited_bound')}")
    found = kept.groupBy("_run", "_no", "doc_id").agg(
        F.collect_list(F.expr(f"if(own and {_below('code', 'bound')}, {packed('code', 'i')}, null)")).alias("full"),
        F.collect_list(F.expr(f"if(new and {_below('code', 'edited_bound')}, {packed('code', 'place')}, null)")).alias("edit"),
        fact("n_chars").alias("n_chars"), fact("sha").alias("edited_sha256"), F.max("bound").alias("bound"), F.max("edited_bound").alias("edited_bound"),
        fact("own").alias("own"), fact("own_edited").alias("own_edited"),
    )
    sketches = found.selectExpr("_run", "_no", "doc_id", "n_chars", "edited_sha256", f"struct({sketch('full', 'own')} as codes, bound) s", f"struct({sketch('edit', 'own_edited')} as codes, edited_bound bound) e")
    follows = sketches.withColumn("n", F.lead("s").over(Window.partitionBy("_run").orderBy("_no")))
    near_next = [f"{likeness('s.codes', 's.bound', 'n.codes', 'n.bound')} near_next", f"{passage('s.codes', 'n.codes')} next_passage"]
    # The last row of each run still lacks its next one; of the sketches, only those of first and last rows are kept.
    done = stored(
        follows.selectExpr(
            "_run", "doc_id", "n_chars", "edited_sha256", f"{shown('s.codes')} fingerprint", f"{shown('e.codes')} edited_fingerprint",
            f"{likeness('s.codes', 's.bound', 'e.codes', 'e.bound')} near_edited", *[f"if(n is null, null, {x.rsplit(' ', 1)[0]}) {x.rsplit(' ', 1)[1]}" for x in near_next],
            "n is null last", "if(_no = 1, s, null) head", "if(n is null, s, null) tail",
        )
    )
    heads = done.where("head is not null").select("_run", "head")
    after = heads.join(successors(heads), "_run").select(F.col("_from").alias("_run"), F.col("head").alias("n"))
    ends = done.where("last").drop("near_next", "next_passage").withColumnRenamed("tail", "s").join(after, "_run").selectExpr("*", *near_next)
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "next_passage"]
    return done.where("not last").select(*columns).unionByName(ends.select(*columns))
