"""Substring dedup: every passage of WINDOW words that occurs again goes, found by matching statistics on sharded FM-indexes.

A shard of arbitrary documents would have to be searched by all others. Here the least hash among a
window's GRAM-word grams decides its shard, so equal windows always meet in one, and the work grows with the
corpus: neighbouring windows with the same least gram travel as one segment. Equal segments travel once, with their number as weight,
and a segment whose gram occurs nowhere else does not travel at all. Each shard builds an FM-index of its
segments, streams them through it, and reports the intervals that occur with a weight of two or more.

A gram in many different surroundings would fill a shard of its own. Windows of such grams are
dealt by their own hash instead, again without those that occur once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import stored, table
from scriptorium.llm.fm_index import FMIndex
from scriptorium.llm.textbytes import SPACE, Slice, _power, mix, slices

#: Words of a window, and of the grams of which the least places it.
WINDOW, GRAM = 35, 12
#: Words of one shard's index; what it takes of memory is some 150 bytes a word.
SHARD_WORDS = 1 << 19
#: Different segments of one gram beyond which its windows are dealt by their own hash: 1000 segments have at most 58,000 words.
CROWDED = 1000

U = np.uint64
_GRAM_BASE, _SPAN_BASE = 0xC2B2AE3D27D4EB4F, 0x9FB21C651E98DF25


def _spans(codes: np.ndarray, starts: np.ndarray, sizes, base: int) -> np.ndarray:
    """A 64-bit hash of the words at each start, by prefix sums of a polynomial."""
    n = len(codes)
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum(codes * _power(base, n + 1)[:n], out=sums[1:])
    back = _power(pow(base, -1, 2**64), n + 1)
    return mix((sums[starts + sizes] - sums[starts]) * back[starts] + U(1) * np.asarray(sizes).astype(U))


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Position of the least of every ``width`` neighbours, the leftmost of equals."""
    at, size = np.arange(len(hashes)), 1
    while size * 2 <= width:
        left, right = at[: len(at) - size], at[size:]
        at, size = np.where(hashes[left] <= hashes[right], left, right), size * 2
    if size < width:
        left, right = at[: len(at) - (width - size)], at[width - size :]
        at = np.where(hashes[left] <= hashes[right], left, right)
    return at


def segments_of(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, position in the row, windows, gram and content hash of each segment of a slice's rows (see Slice.words for first)."""
    none = np.zeros(0, dtype=np.int64)
    if len(codes) < WINDOW:
        return none, none, none, none, none
    grams = _spans(codes, np.arange(len(codes) - GRAM + 1), GRAM, _GRAM_BASE)
    at = _least(grams, WINDOW - GRAM + 1)
    row = np.searchsorted(first, np.arange(len(at)), side="right") - 1
    whole = np.arange(len(at)) + WINDOW <= first[row + 1]
    begins = whole.copy()
    begins[1:] &= ~whole[:-1] | (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(begins)
    if not len(start):
        return none, none, none, none, none
    windows = np.add.reduceat(whole.astype(np.int64), start)
    content = _spans(codes, start, windows + WINDOW - 1, _SPAN_BASE)
    return row[start], start - first[row[start]], windows, grams[at[start]].view(np.int64), content.view(np.int64)


def _text_key(text: Column) -> list[Column]:
    """What tells rows apart: the id (0 for null), and a hash of id and text; rows that are equal share it and their result."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc"), F.hash("doc_id", text).alias("check")]


_SEGMENT = "doc long, check int, pos int, windows int, gram long, content long"


def segments(docs: DataFrame) -> DataFrame:
    """_SEGMENT of all documents (doc, check, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, part in slices(batch.column(2)):
                starts, ends, first = part.words()
                row, pos, windows, gram, content = segments_of(part.hashes(starts, ends), first)
                taken = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(taken), batch.column(1).take(taken), *(pa.array(x.astype(np.int32)) for x in (pos, windows)), pa.array(gram), pa.array(content)],
                    names=[x.split()[0] for x in _SEGMENT.split(", ")],
                )

    return docs.select("doc", "check", "text").mapInArrow(run, _SEGMENT)


_SAID = "gram long, content long, times long, words binary"


def spelled(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """_SAID: the word hashes of wanted segments (doc, check, pos, windows, gram, content, times)."""
    lists = wanted.groupBy("doc", "check").agg(F.collect_list(F.struct("pos", "windows", "gram", "content", "times")).alias("s"))
    # Equal rows are one here: the segments of either spell the same.
    rows = docs.select("doc", "check", "text").dropDuplicates(["doc", "check"]).join(lists, ["doc", "check"]).select("text", *(F.col("s")[x].alias(x) for x in ("pos", "windows", "gram", "content", "times")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, part in slices(batch.column(0)):
                starts, ends, first = part.words()
                codes = part.hashes(starts, ends)
                lists = [batch.column(k).slice(i, j - i) for k in range(1, 6)]
                pos, windows, *rest = [x.flatten() for x in lists]
                row = np.repeat(np.arange(j - i), np.diff(lists[0].offsets.to_numpy()))
                start, size = first[row] + pos.to_numpy(), windows.to_numpy() + WINDOW - 1
                ends_at = np.cumsum(size)
                index = np.arange(ends_at[-1] if len(size) else 0) + np.repeat(start - (ends_at - size), size)
                offsets = np.concatenate([[0], ends_at * 8]).astype(np.int32)
                words = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(codes[index].tobytes())])
                yield pa.RecordBatch.from_arrays([*rest, words], names=[x.split()[0] for x in _SAID.split(", ")])

    return rows.mapInArrow(run, _SAID)


_WINDOWS = "window long, gram long, content long, i int, times long"


def windows_of(said: DataFrame) -> DataFrame:
    """_WINDOWS: every window of segments with words, by its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, sizes = _words(batch.column(3))
            n = sizes - WINDOW + 1
            row = np.repeat(np.arange(len(sizes)), n)
            i = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            hashes = _spans(codes, (np.cumsum(sizes) - sizes)[row] + i, WINDOW, _SPAN_BASE).view(np.int64) if len(row) else np.zeros(0, dtype=np.int64)
            gram, content, times = (batch.column(k).take(pa.array(row)) for k in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(hashes), gram, content, pa.array(i.astype(np.int32)), times], names=[x.split()[0] for x in _WINDOWS.split(", ")])

    return said.select("gram", "content", "times", "words").mapInArrow(run, _WINDOWS)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes of a binary column, and how many each row has."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, where, raw = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    return np.frombuffer(raw, dtype=U, offset=int(offsets[0]), count=int(offsets[-1] - offsets[0]) // 8), np.diff(offsets) // 8


_REPEATED = "gram long, content long, starts array<int>, ends array<int>"


def repeated(said: DataFrame, shards: int) -> DataFrame:
    """_REPEATED: the intervals of segments (_SAID), in words, of which every window occurs with a weight of two or more.

    One FM-index a shard; its own segments are streamed through it.
    """

    def run(rows: pa.Table) -> pa.Table:
        codes, sizes = _words(rows["words"])
        index = FMIndex(codes, sizes, rows["times"].to_numpy())
        reach = index.matching_statistics(codes, sizes, 2)
        row = np.repeat(np.arange(len(sizes)), sizes)
        start = np.flatnonzero(reach >= WINDOW)
        end, of = start + WINDOW, row[start]
        opens = np.append(True, (start[1:] > end[:-1]) | (of[1:] != of[:-1])) if len(start) else np.zeros(0, dtype=bool)
        closes = np.append(opens[1:], True) if len(start) else opens
        base = np.cumsum(sizes) - sizes
        at = of[opens]
        counts = np.bincount(at, minlength=len(sizes))
        kept = np.flatnonzero(counts)
        offsets = np.concatenate([[0], np.cumsum(counts[kept])]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(offsets, (x - base[at]).astype(np.int32)) for x in (start[opens], end[closes])]
        taken = pa.array(kept)
        return pa.table([rows["gram"].take(taken), rows["content"].take(taken), *lists], names=[x.split()[0] for x in _REPEATED.split(", ")])

    dealt = said.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
    return dealt.select("shard", "gram", "content", "times", "words").groupBy("shard").applyInArrow(run, _REPEATED)


def _shards(words: int | None) -> int:
    return max(1, -(-(words or 0) // SHARD_WORDS))


def sharing_grams(found: DataFrame) -> DataFrame:
    """The segments (_SEGMENT) whose gram places another segment too; only those can hold a window that occurs again."""
    # Stored, so that both sides of the join are shuffles of their own and a hot gram's rows can be split.
    grams = stored(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"))
    return found.join(grams, "gram", "left_semi")


def repeated_segments(docs: DataFrame, found: DataFrame) -> DataFrame:
    """_REPEATED of the segments found in docs (doc, check, text) that share their grams."""
    different = stored(found.groupBy("gram", "content").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("doc", "check", "pos", "windows")).alias("place")))
    grams = different.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"))
    chosen = stored(different.join(grams, "gram").select("gram", "content", "times", "place.*", (F.col("kinds") > CROWDED).alias("crowded")))
    crowded = not chosen.where("crowded").isEmpty()
    said = spelled(docs, chosen)
    if crowded:
        said = stored(said.join(chosen.select("gram", "content", "crowded"), ["gram", "content"]))
    calm = chosen.where("not crowded").agg(F.sum(F.col("windows") + (WINDOW - 1))).first()[0]
    out = repeated(said.where("not crowded") if crowded else said, _shards(calm))
    if not crowded:
        return out
    said = said.where("crowded")
    single = stored(windows_of(said))
    again = single.groupBy("window").agg(F.sum("times").alias("times"), F.min(F.struct("gram", "content", "i")).alias("p")).where("times > 1").select("window", "times", "p.*")
    again = stored(again)
    words = said.select("gram", "content", "words").join(again, ["gram", "content"])
    own = words.select(F.col("window").alias("gram"), F.lit(0).cast("long").alias("content"), "times", F.substr("words", F.col("i") * 8 + 1, F.lit(WINDOW * 8)).alias("words"))
    sure = repeated(own, _shards(again.count() * WINDOW)).select(F.col("gram").alias("window"))
    hits = single.join(sure, "window").groupBy("gram", "content").agg(F.array_sort(F.collect_list("i")).alias("starts"))
    return out.unionByName(hits.withColumn("ends", F.transform("starts", lambda i: i + WINDOW)))


_KEPT = "doc_id long, n_words long, n_removed long, kept string"


def without(rows: DataFrame) -> DataFrame:
    """_KEPT of rows (doc_id, text, starts, ends): what is left of the words outside the intervals, one space between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, part in slices(batch.column(1)):
                starts, ends, first = part.words()
                gone = np.zeros(len(starts) + 1, dtype=np.int64)
                lists = [batch.column(k).slice(i, j - i).fill_null([]) for k in (2, 3)]
                base = np.repeat(first[:-1], np.diff(lists[0].offsets.to_numpy()))
                for values, sign in zip(lists, (1, -1)):
                    np.add.at(gone, base + values.flatten().to_numpy(), sign)
                keep = np.cumsum(gone)[:-1] == 0
                offsets, data = _spelled_out(part, starts[keep], ends[keep], np.concatenate([[0], np.cumsum(keep)])[first])
                kept = pa.LargeStringArray.from_buffers(j - i, pa.py_buffer(offsets), pa.py_buffer(data))
                n_words, n_kept = np.diff(first), np.diff(np.concatenate([[0], np.cumsum(keep)])[first])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n_words), pa.array(n_words - n_kept), kept.cast(pa.string())], names=[x.split()[0] for x in _KEPT.split(", ")]
                )

    return rows.select("doc_id", "text", "starts", "ends").mapInArrow(run, _KEPT)


def _spelled_out(part: Slice, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of each row's words with one space between; first has each row's first word."""
    n = len(part.data)
    edges = np.zeros(n + 1, dtype=np.int8)
    edges[starts] += 1
    edges[ends] -= 1
    taken = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    between = np.ones(len(ends), dtype=bool)
    between[first[1:][first[1:] > first[:-1]] - 1] = False  # a row's last word
    data = part.data.copy()
    data[ends[between]] = 0x20
    taken[ends[between]] = True
    sums = np.concatenate([[0], np.cumsum(taken)])
    return sums[part.offsets].astype(np.int64), data[taken]


def dedup(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text; other columns are not read): doc_id, n_words, n_removed, kept.

    A word goes if it lies in a window of WINDOW words that also starts anywhere else, in the same row or
    another, whatever its id; windows are judged on the input. Words are runs of bytes but space and \\x09-\\x0D, unchanged. Null and empty
    texts have none; texts of fewer words than a window lose nothing; repeated rows lose every window of theirs. Texts of any length are
    taken whole. Null and repeated ids stay rows of their own. An empty table gives no rows.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = keyed.select("doc_id", *_text_key(F.col("text")), "text")
    found = stored(sharing_grams(stored(segments(keyed))))
    hits = stored(repeated_segments(keyed, found))
    spans = F.arrays_zip(F.transform("starts", lambda x: x + F.col("pos")).alias("start"), F.transform("ends", lambda x: x + F.col("pos")).alias("end"))
    places = found.join(hits, ["gram", "content"]).select("doc", "check", F.inline(spans)).toDF("doc", "check", "start", "end").distinct()
    cuts = places.groupBy("doc", "check").agg(F.collect_list(F.struct("start", "end")).alias("s"))
    cuts = cuts.select("doc", "check", F.col("s")["start"].alias("starts"), F.col("s")["end"].alias("ends"))
    return without(keyed.join(cuts, ["doc", "check"], "left"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: every document without the passages of 35 words that occur again, as a digest."""
    return dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = rf"""
WITH w AS (
  SELECT r, doc_id, unnest(l) AS word, unnest(range(len(l))) AS i, len(l) AS n
  FROM (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents)
), g AS (
  SELECT *, CASE WHEN i + {WINDOW} <= n THEN md5(string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)) END AS h FROM w
), c AS (SELECT *, CASE WHEN h IS NOT NULL THEN count(*) OVER (PARTITION BY h) ELSE 0 END AS k FROM g),
m AS (SELECT *, max(k) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) > 1 AS gone FROM c)
SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(x, 0) AS n_removed, coalesce(s, sha256('')) AS kept_sha256
FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) d
LEFT JOIN (SELECT r, count(*) AS n, count(*) FILTER (gone) AS x, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS s FROM m GROUP BY r) t USING (r)
"""
