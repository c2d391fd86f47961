"""Conversation structure repair by deduplicated signatures.

Every conversation is written as a compact string, one letter a row for its role
and its first fault. Many conversations share one, so each distinct signature
is solved once: a memoised recursion over halves finds, for each pair of
states of the role grammar ``(s?(ua)+)?``, the cheapest edits that lead from one to the other.
The audits (one letter an edit) are joined back to the conversations and replayed on their rows.

Rows are dealt by ranges of (conversation, turn, role, text), so a conversation
of any length is spread over tasks; blocks of BLOCK rows at most are gathered into pieces of
signature, and only those, a byte a row, meet in one row of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import stored, table

#: Letters of a row: its role's initial (s, u, a, any other) for each kind of fault, first fault first.
FINE, TRUNCATED, BLANK, DUPLICATE = "suax", "SUAX", "0123", "4567"
_KINDS = str.maketrans(BLANK + DUPLICATE, "d" * 8)
#: What each edit costs; a truncated row that stays adds LEFT_TRUNCATED.
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
LEFT_TRUNCATED = 3
#: The role grammar: from a state, the state after each initial. 0 and 3 accept. Of u and a, every state allows one.
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ACCEPT = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
#: Rows of one piece of signature at most.
BLOCK = 4096
#: Signatures of up to this length are remembered between calls.
REMEMBERED = 64
_SPACE = " \t\n\x0b\x0c\r"

Ways = tuple  # 4 x 4 of None or (cost, audit)


def _turn(state: int) -> str:
    """The initial of the user or assistant row that may follow in a state."""
    return "a" if state == 2 else "u"


def _inserted(p: int) -> list[tuple[int, str]]:
    """(state, audit) of what insertions alone reach from p: the shortest way to each state."""
    found, state = [(p, "")], p
    while (state := NEXT[state][_turn(state)]) not in [s for s, _ in found]:
        found.append((state, "I" * len(found)))
    return found


def _single(kind: str) -> Ways:
    """Insertions, then one edit of a row of this kind."""
    out = [[None] * 4 for _ in range(4)]
    for p in range(4):
        for m, before in _inserted(p):
            steps = [(m, COST["D"], "D")]
            if kind != "d":
                extra = LEFT_TRUNCATED if kind.isupper() else 0
                steps.append((NEXT[m][_turn(m)], COST["R"] + extra, "R"))
                if (q := NEXT[m].get(kind.lower())) is not None:
                    steps.append((q, COST["K"] + extra, "K"))
            for q, cost, letter in steps:
                way = (cost + COST["I"] * len(before), before + letter)
                out[p][q] = min(out[p][q] or way, way)
    return tuple(map(tuple, out))


def _joined(a: Ways, b: Ways) -> Ways:
    """One after the other. Of two audits of the same rows that cost the same, neither begins with the
    other (what is longer has more insertions), so the least first part makes the least whole."""
    return tuple(
        tuple(min(((a[p][m][0] + b[m][q][0], a[p][m][1] + b[m][q][1]) for m in range(4) if a[p][m] and b[m][q]), default=None) for q in range(4))
        for p in range(4)
    )


def ways(kinds: str) -> Ways:
    """Cheapest (cost, audit) from each state to each, ties ASCII-least; insertions after the last row are left to the caller."""
    return _remembered(kinds) if len(kinds) <= REMEMBERED else _halves(kinds)


def _halves(kinds: str) -> Ways:
    if len(kinds) == 1:
        return _single(kinds)
    half = 1 << (len(kinds) - 1).bit_length() - 1
    return _joined(ways(kinds[:half]), ways(kinds[half:]))


_remembered = lru_cache(maxsize=1 << 15)(_halves)


def solve(signature: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits that make the roles fit the grammar."""
    if not signature:
        return 0, ""
    found = ways(signature.translate(_KINDS))[0]
    return min((found[m][0] + COST["I"] * len(after), found[m][1] + after) for m in range(4) if found[m] for q, after in _inserted(m) if q in ACCEPT)


def _initials(signature: str) -> str:
    return signature.translate(str.maketrans(TRUNCATED + BLANK + DUPLICATE, FINE * 3))


def pieces_of(signature: str, audit: str, sizes: list[int]) -> list[tuple[str, int]]:
    """The audit cut by runs of rows: (letters, state before them) for each size; what is inserted after the last row ends the last."""
    cut, state, at, row = [], 0, 0, 0
    initials = _initials(signature)
    for k, size in enumerate(sizes):
        start, before, end = at, state, row + size
        while at < len(audit) and (row < end or k == len(sizes) - 1):
            if audit[at] == "K":
                state = NEXT[state][initials[row]]
            elif audit[at] != "D":
                state = NEXT[state][_turn(state)]
            row += audit[at] != "I"
            at += 1
        cut.append((audit[start:at], before))
    return cut


def ordered(rows: DataFrame) -> DataFrame:
    """(at, block, conv, turn, role, text, n, letters): different rows in order, how often each occurs, its part of the signature.

    ``conv`` is the id as text, a space for null. Rows go by turn (nulls first), then role and text. Null roles and texts are one space.
    """
    conv, initial = F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.left("role", F.lit(1))
    filled = rows.select(
        conv.alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    counted = filled.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("digest", F.md5("text"))
    place = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    counted = stored(counted.withColumn("place", place))
    first = counted.groupBy("conv", "role", "digest").agg(F.min("place").alias("first"))
    body = F.rtrim("text", F.lit(_SPACE))
    fault = (
        F.when(body == "", 2).when(F.col("place") != F.col("first"), 3)
        .when(F.right(body, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    )
    role = F.coalesce(F.when(initial != "", F.position(initial, F.lit("sua"))), F.lit(0))
    code = lambda f: F.substr(F.lit(FINE + TRUNCATED + BLANK + DUPLICATE), f * 4 + F.when(role == 0, 4).otherwise(role), F.lit(1))
    again = F.when(fault == 2, code(F.lit(2))).otherwise(code(F.lit(3)))
    marked = counted.join(first, ["conv", "role", "digest"]).select(
        "conv", "turn", "role", "text", "n", "digest", F.concat(code(fault), F.repeat(again, (F.col("n") - 1).cast("int"))).alias("letters")
    )
    keys = ["conv", "turn", "role", "digest"]
    dealt = marked.repartitionByRange(*keys).sortWithinPartitions("conv", "turn", "role", "text").drop("digest").withColumn("at", F.monotonically_increasing_id())
    return stored(dealt.withColumn("block", F.floor(F.col("at") / BLOCK)))


def signatures(rows: DataFrame) -> DataFrame:
    """(conv, signature, pieces) of rows in order; pieces are (at of the first row, letters), in order."""
    piece = rows.groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("at", "letters"))).alias("p"))
    piece = piece.select("conv", F.struct(F.get("p", F.lit(0))["at"].alias("at"), F.array_join(F.transform("p", lambda x: x["letters"]), "").alias("letters")).alias("piece"))
    whole = piece.groupBy("conv").agg(F.array_sort(F.collect_list("piece")).alias("p"))
    return whole.select(
        "conv", F.array_join(F.transform("p", lambda x: x["letters"]), "").alias("signature"),
        F.transform("p", lambda x: F.struct(x["at"].alias("at"), F.length(x["letters"]).alias("size"))).alias("pieces"),
    )


SOLVED = "signature string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def solved(found: DataFrame) -> DataFrame:
    """Every distinct signature with its counts, cost and audit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for signature in batch["signature"]:
                roles = _initials(signature)
                illegal = max(0, len(roles) - 1) - sum(x + y in ("su", "ua", "au") for x, y in zip(roles, roles[1:]))
                counts = [sum(map(signature.count, kind)) for kind in (BLANK, DUPLICATE, TRUNCATED)]
                out.append((signature, *counts, illegal, *solve(signature)))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in SOLVED.split(", ")])

    return found.select("signature").distinct().mapInPandas(run, SOLVED)


def replay(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv, at, k, role, text): the repaired rows, in the order of at and k.

    found has the conversations' signatures, pieces and audits. A piece of the audit
    meets its rows at the first of them; the rows of a piece then pass one after the other.
    """

    @F.pandas_udf("array<struct<at:long,edits:string,state:int>>")
    def cut(signature: pd.Series, audit: pd.Series, pieces: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [{"at": p["at"], "edits": e, "state": s} for p, (e, s) in zip(ps, pieces_of(sig, a, [p["size"] for p in ps]))]
                for sig, a, ps in zip(signature, audit, pieces)
            ],
            dtype=object,
        )

    edits = found.select(F.inline(cut("signature", "audit", "pieces")))
    dealt = rows.join(edits, "at", "left").repartition("conv", "block").sortWithinPartitions("conv", "at")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, n, end, state = "", 0, 0, 0
        for batch in batches:
            out = []
            for conv, at, role, text, count, e, s in zip(*(batch[c] for c in ("conv", "at", "role", "text", "n", "edits", "state"))):
                if isinstance(e, str):
                    letters, n, end, state = e, 0, len(e.rstrip("I")), int(s)
                k = 0
                while n < len(letters) and (count or n >= end):
                    letter = letters[n]
                    if letter == "K":
                        out.append((conv, at, k, role, text))
                        state = NEXT[state][role[:1]]
                    elif letter != "D":
                        initial = _turn(state)
                        out.append((conv, at, k, ROLES[initial], text if letter == "R" else ""))
                        state = NEXT[state][initial]
                    n, k, count = n + 1, k + 1, count - (letter != "I")
            yield pd.DataFrame(out, columns=["conv", "at", "k", "role", "text"])

    return dealt.mapInPandas(run, "conv string, at long, k long, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of repaired rows as role:text lines; a conversation passes row by row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, hashed = None, None
        for batch in batches:
            out = []
            for conv, line in zip(batch["conv"], batch["line"]):
                if conv != key:
                    if key is not None:
                        out.append((key, hashed.hexdigest()))
                    key, hashed = conv, hashlib.sha256()
                else:
                    hashed.update(b"\n")
                hashed.update(line.encode())
            yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])
        if key is not None:
            yield pd.DataFrame([(key, hashed.hexdigest())], columns=["conv", "repaired_sha256"])

    lines = repaired.select("conv", "at", "k", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.repartition("conv").sortWithinPartitions("conv", "at", "k").select("conv", "line").mapInPandas(run, "conv string, repaired_sha256 string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audits and repaired rows of conversations (conv_id, turn, role, text); other columns are not read.

    The first frame has a row per conversation: conv (the id as text; a space for
    null ids, which are one conversation), gaps, blank, duplicate, truncated, illegal, cost, audit. The second has
    the repaired rows: conv, at, k (their order), role, text.

    Rows go by turn, nulls first, then role and text where turns tie. Null roles and texts count as one
    space: such a text is blank, such a role none of the three. Repeated rows are duplicates. A row's first fault counts:
    blank, duplicate, truncated. Long texts pass row by row; an empty table gives no rows.
    """
    at = ordered(rows)
    found = signatures(at)
    answers = solved(found)
    found = stored(found.join(answers, "signature"))
    turns = at.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")).withColumn("gaps", F.coalesce("gaps", F.lit(0)))
    audits = found.drop("signature", "pieces").join(turns, "conv")
    return audits.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), replay(at, found)


def damage(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given another role by crc32 of ``conv_id:turn`` modulo 20, nulls as one space."""
    draw = F.crc32(F.concat(*(F.coalesce(x, F.lit(" ")) for x in (F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))))) % 20
    text = F.coalesce("text", F.lit(" "))
    return (
        rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), draw.alias("_draw")).where("_draw <> 0")
        .withColumn("text", F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("_draw") == 4, "user").otherwise(F.col("role")))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("_draw") == 3, 2).otherwise(1))))
        .select("conv_id", "turn", "role", "text")
    )


def _key(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(" "))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: what is wrong with every damaged conversation, its cheapest edits, and a digest of what they make of it."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    audits, repaired = repair(damage(rows))
    every = rows.select("conv_id").distinct().withColumn("conv", _key(F.col("conv_id")))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(audits, "conv", "left").join(digests(repaired), "conv", "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


_BITS = "list_reduce([{x}, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: xor(c >> 1, 3988292384 * (c & 1)))"
_CRC = "xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({s}, ''), lambda x: ascii(x)::BIGINT)), lambda r, x: " + _BITS.format(x="xor(r, x)") + "))"

ORACLE = rf"""
WITH RECURSIVE s AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format(s="coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k
  FROM conversations
), d AS (
  SELECT conv, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(generate_series(1, CASE WHEN k = 3 THEN 2 ELSE 1 END)) FROM s WHERE k <> 0)
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) AS seen
  FROM (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i FROM d)
), f AS (
  SELECT *, left(role, 1) AS x, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN seen > 1 THEN 'd'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) || left(role, 1) AS pair, i > 1 AS later
  FROM n
), ins AS (SELECT * FROM (VALUES (0,0,'',''), (0,2,'I','u'), (0,3,'II','ua'), (1,1,'',''), (1,2,'I','u'), (1,3,'II','ua'), (2,2,'',''), (2,3,'I','a'), (3,3,'',''), (3,2,'I','u')) AS t(p, m, a, r)),
step AS (SELECT * FROM (VALUES (0,'s',1), (0,'u',2), (1,'u',2), (2,'a',3), (3,'u',2)) AS t(m, x, q)),
lines AS (SELECT p, m, a, replace(replace(r, 'u', chr(10) || 'user:'), 'a' , chr(10) || 'assistant:') AS made FROM (SELECT p, m, a, replace(r, 'a', '') AS r FROM ins WHERE r NOT LIKE '%a')
  UNION ALL SELECT p, m, a, CASE WHEN r = 'a' THEN '' ELSE chr(10) || 'user:' END || chr(10) || 'assistant:' FROM ins WHERE r LIKE '%a'),
e AS (
  SELECT conv, i, m, m AS q, 4 AS c, 'D' AS l, '' AS made FROM f, (SELECT unnest([0, 1, 2, 3]) AS m)
  UNION ALL SELECT conv, i, m, q, CASE WHEN fault = 't' THEN 3 ELSE 0 END, 'K', chr(10) || role || ':' || text FROM f JOIN step USING (x) WHERE fault NOT IN ('b', 'd')
  UNION ALL SELECT conv, i, m, q, CASE WHEN fault = 't' THEN 6 ELSE 3 END, 'R', chr(10) || CASE s.x WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text
    FROM f, step s WHERE fault NOT IN ('b', 'd') AND s.x <> 's'
), z AS (
  SELECT conv, 0::BIGINT AS i, 0 AS q, {{'c': 0, 'a': '', 'o': ''}} AS w FROM (SELECT DISTINCT conv FROM f)
  UNION ALL
  SELECT e.conv, e.i, e.q, min({{'c': w.c + 3 * length(t.a) + e.c, 'a': w.a || t.a || l, 'o': w.o || t.made || e.made}})
  FROM z JOIN lines t ON t.p = z.q JOIN e ON e.conv = z.conv AND e.i = z.i + 1 AND e.m = t.m GROUP BY e.conv, e.i, e.q
), best AS (
  SELECT z.conv, min({{'c': w.c + 3 * length(t.a), 'a': w.a || t.a, 'o': w.o || t.made}}) AS w
  FROM z JOIN (SELECT conv, max(i) AS i FROM f GROUP BY conv) x ON x.conv = z.conv AND x.i = z.i JOIN lines t ON t.p = z.q AND t.m IN (0, 3) GROUP BY z.conv
), g AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (later AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(w.c, 0) AS BIGINT) AS cost, coalesce(w.a, '') AS audit, sha256(coalesce(substr(w.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv FROM conversations) LEFT JOIN g USING (conv) LEFT JOIN best USING (conv)
"""
