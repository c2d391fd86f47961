"""Alignment of two tokenizers' outputs by union-find over overlapping tokens.

Tokens of either side are nodes; two overlap where their byte ranges do. The
connected components of that graph are the smallest groups of tokens that cover the same
bytes. A component's members are expanded into links, the pairs of tokens that end
together, and links are counted by their pair of ids over the corpus.

Texts are encoded once: what the counts need later (a document's different id pairs, how often each occurs)
is stored as two short lists of integers beside its digest.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import stored, table

#: Folder of the vocabulary files, on every machine.
FOLDER = "/opt/tokenizers"
#: Merge ranks of side A (the vocabulary of byte_bpe_50k.json, whose ids are these ranks), the same vocabulary for any text, and side B.
RANKS, VOCABULARY, PIECES = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Texts with a longer run without a space, or of spaces, are encoded from the JSON file: the other reader's time grows with the square of a run.
LONG_RUN = 400
_LONG = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")
#: Characters of text aligned at once, unless one text is longer.
SLICE_CHARS = 200_000
#: Pairs whose counts are broadcast (the most frequent ones, about 60 bytes each); the others are joined by shuffle.
BROADCAST_PAIRS = 100_000
#: A pair of ids as one number: a * SIDE + b. Vocabularies of 2**31 / SIDE and SIDE ids fit an int.
SIDE = 1 << 15


class Coder(NamedTuple):
    """The two tokenizers, the bytes of their tokens, and those bytes' lengths."""

    fast: object
    whole: object
    pieces: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    size_a: np.ndarray
    size_b: np.ndarray
    written: list[str]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; side A sees a space before each text, side B adds one itself."""
        a = [self.whole.encode(" " + x, add_special_tokens=False).ids if _LONG.search(x) else self.fast.encode_ordinary(" " + x) for x in texts]
        return a, self.pieces.encode(texts, num_threads=1)


def _byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable ones stand for themselves, the rest are numbered from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}


@lru_cache(maxsize=1)
def coder(folder: str) -> Coder:
    """Both tokenizers, once a worker."""
    import sentencepiece
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(f"{folder}/{VOCABULARY}")
    whole.encode_special_tokens = True
    alphabet = _byte_alphabet()
    bytes_a = [b""] * whole.get_vocab_size(with_added_tokens=True)
    for token, i in whole.get_vocab(with_added_tokens=True).items():
        bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
    with open(f"{folder}/{RANKS}", "rb") as lines:
        ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, lines)}
    pieces = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECES}")
    bytes_b = [_piece_bytes(pieces.id_to_piece(i)) for i in range(pieces.get_piece_size())]
    if len(bytes_b) > SIDE or len(bytes_a) > (1 << 31) // SIDE:
        raise ValueError("the vocabularies are too large for SIDE")
    written = [f"{i}{end}" for ids, ends in ((len(bytes_a), ",|"), (len(bytes_b), ",;")) for end in ends for i in range(ids)]
    return Coder(
        tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), whole, pieces,
        bytes_a, bytes_b, np.array([*map(len, bytes_a)]), np.array([*map(len, bytes_b)]), written,
    )


def _piece_bytes(piece: str) -> bytes:
    """A piece in UTF-8: U+2581 is a space, <0xHH> a byte."""
    return bytes([int(piece[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-Fa-f]{2}>", piece) else piece.replace("▁", " ").encode()


def components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component, by union-find on whole arrays: the greater root of
    every edge hooks under the smaller one, then paths are halved until they end at roots."""
    root = np.arange(n)
    while len(u):
        low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
        np.minimum.at(root, high, low)
        while not np.array_equal(up := root[root], root):
            root = up
        open_ = root[u] != root[v]
        u, v = u[open_], v[open_]
    return root


def groups(size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Component of each token of A and of B, numbered in order, and the links as positions in A and B.

    Both sides cover the same bytes without a gap, from their tokens' sizes. Between two neighbouring ends lies one
    token of either side: those overlap. A link is a pair of one component whose ranges end together.
    """
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
    ends = ends[np.append(ends[1:] != ends[:-1], True)]
    over_a, over_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
    n = len(end_a)
    root = components(n + len(end_b), over_a, over_b + n)
    number = (np.cumsum(root[:n] == np.arange(n)) - 1)[root]  # a component's smallest node is its first token of A
    same = (end_a[over_a] == ends) & (end_b[over_b] == ends) & (number[over_a] == number[over_b + n])
    return number[:n], number[n:], over_a[same], over_b[same]


class Aligned(NamedTuple):
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    digest: str
    pairs: np.ndarray
    times: np.ndarray


_NONE = Aligned(0, 0, 0, 0, "", np.zeros(0, np.int32), np.zeros(0, np.int32))


def align(texts: list[str | None], tools: Coder) -> list[Aligned]:
    """Both encodings of each text, aligned; texts whose tokens do not spell a space and the text have none."""
    out = [_NONE] * len(texts)
    filled = [i for i, x in enumerate(texts) if x]
    coded_a, coded_b = tools.encode([texts[i] for i in filled])
    kept = []
    for i, a, b in zip(filled, coded_a, coded_b):
        said = b" " + texts[i].encode()
        if b"".join([tools.bytes_a[x] for x in a]) == said and b"".join([tools.bytes_b[x] for x in b]) == said:
            kept.append((i, np.array(a), np.array(b)))
    if not kept:
        return out
    all_a, all_b = np.concatenate([a for _, a, _ in kept]), np.concatenate([b for _, _, b in kept])
    of_a, of_b, at_a, at_b = groups(tools.size_a[all_a], tools.size_b[all_b])  # texts end together, so no group spans two
    last_a, last_b = np.append(of_a[1:] != of_a[:-1], True), np.append(of_b[1:] != of_b[:-1], True)
    na, nb = len(tools.bytes_a), len(tools.bytes_b)
    before_a, before_b = (np.concatenate([[0], np.cumsum(np.bincount(x))]) for x in (of_a, of_b))
    spelled = np.empty(len(all_a) + len(all_b), dtype=np.int64)  # a group's tokens of A, then those of B
    spelled[np.arange(len(all_a)) + before_b[of_a]] = all_a + na * last_a
    spelled[np.arange(len(all_b)) + before_a[of_b + 1]] = 2 * na + all_b + nb * last_b
    ends_a, ends_b = (np.cumsum([len(x[k]) for x in kept]) for k in (1, 2))
    of_text = np.searchsorted(ends_a, at_a, side="right")
    keyed = np.sort((of_text << 31) + all_a[at_a] * SIDE + all_b[at_b])
    first = np.flatnonzero(np.append(True, keyed[1:] != keyed[:-1]))
    times = np.diff(np.append(first, len(keyed))).astype(np.int32)
    pairs, cuts = (keyed[first] & (1 << 31) - 1).astype(np.int32), np.searchsorted(keyed[first], np.arange(len(kept) + 1) << 31)
    n_links, written, a0, b0 = np.bincount(of_text, minlength=len(kept)), tools.written, 0, 0
    for k, (i, a, b) in enumerate(kept):
        a1, b1, at = int(ends_a[k]), int(ends_b[k]), slice(cuts[k], cuts[k + 1])
        line = "".join([written[x] for x in spelled[a0 + b0 : a1 + b1].tolist()])[:-1]
        out[i] = Aligned(len(a), len(b), int(of_a[a1 - 1] - of_a[a0] + 1), int(n_links[k]), hashlib.sha256(line.encode()).hexdigest(), pairs[at], times[at])
        a0, b0 = a1, b1
    return out


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"


def aligned(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """ALIGNED of every row of docs (doc_id, text): a row's different id pairs (see SIDE), and how many of its links hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = coder(folder)
        for batch in batches:
            ids, texts, done = batch.column(0), batch.column(1), 0
            sizes = np.array([len(x) if x else 0 for x in texts.to_pylist()])
            while done < len(sizes):
                take = max(1, int(np.searchsorted(np.cumsum(sizes[done:]), SLICE_CHARS, side="right")))
                found = align(texts[done : done + take].to_pylist(), tools)
                cols = list(zip(*found))
                lists = [pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([*map(len, c)])]).astype(np.int32), np.concatenate(c)) for c in cols[5:]]
                yield pa.RecordBatch.from_arrays(
                    [ids[done : done + take], *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()), *lists],
                    names=[x.split()[0] for x in ALIGNED.split(", ")],
                )
                done += take

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, links, best) over the stored rows of aligned(): the links of each pair of ids, and whether no other pair of its id of B has more."""
    links = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = stored(links.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.times").cast("long")).alias("links")))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(SIDE - 1))
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    # One row for each id of B, of which there are SIDE at most.
    return stored(counts.join(F.broadcast(most), "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best")))


def _frequent(counts: DataFrame) -> int:
    """The smallest power of two that at most BROADCAST_PAIRS pairs' links reach."""
    by = counts.groupBy(F.floor(F.log2("links")).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, least = 0, 64
    for k, n in sorted(((r.k, r.n) for r in by), reverse=True):
        total += n
        if total > BROADCAST_PAIRS:
            break
        least = k
    return 1 << min(least, 62)


def token_alignment(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """One row per row of docs (doc_id, text; other columns are not read): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and those whose tokens do not spell a space and the text (with U+2581, say), have no tokens:
    zeros and an empty digest. Repeated rows and repeated or null ids stay rows of their own, and their links count each time. Ties
    for an id's highest count all are best. A text is encoded whole, whatever its length. An empty table gives no rows.
    """
    rows = stored(aligned(docs, folder).withColumn("row", F.monotonically_increasing_id()))
    counts = pair_counts(rows)
    least = _frequent(counts)
    # Frequent pairs are few and broadcast; of the others none has so many links that one task would hold them.
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").cast("long").alias("times"))
    often = F.broadcast(counts.where(F.col("links") >= least))
    worth = lambda x: x.groupBy("row").agg(F.sum(F.col("times") * F.col("links")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"))
    some = worth(links.join(often, "pair")).unionByName(worth(links.join(often, "pair", "left_anti").join(counts.where(F.col("links") < least), "pair")))
    sums = some.groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: both tokenizers' groups and links of every document, with corpus-wide counts of the linked ids."""
    return token_alignment(table(spark, sf_dir, "documents"))
