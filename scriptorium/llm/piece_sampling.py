"""SentencePiece encoding by sampling segmentations without replacement, and decoding.

A text's segmentations are the paths of a lattice over its characters whose edges
are vocabulary pieces; a path's probability is proportional to the product
of its pieces' weights. Gumbel top-k draws k distinct paths: every prefix of a
path carries the largest perturbed log-probability of the paths that begin with it,
an agenda yields the prefix with the largest value first (A-star, the backward
sums of the lattice being an exact heuristic), its best child inherits the value and
the other children get Gumbels truncated at it (see Siblings). The next value, kappa, gives
each sample's inclusion score 1 - exp(-exp(log p - kappa)).

Pieces never cross from a word to the space before the next one, so the lattice
is a chain of one small lattice per word, or several where no piece crosses a place inside it,
as beside characters outside the vocabulary. Words are taken together in numpy: equal
words share a lattice, and all words draw their next piece in one step. Draws come
from a hash of row key, sample, word and step, so a row's result depends on nothing else.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import table
from scriptorium.llm.textbytes import U, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Segmentations of each text.
SAMPLES = 2
#: Exponent of the weights: smaller values flatten the distribution.
ALPHA = 1.0
#: Code points that are worked on together.
SLICE_CHARS = 200_000
#: Steps after which the sums of a lattice are scaled back.
RESCALE = 16
#: Pieces of a path that are looked at in one step for the place where the next sample leaves it.
WINDOW = 32

SPACE_PIECE = 0x2581
_LITERAL = 0x110000  # stands for a U+2581 of the text itself, which no piece may match
_BEGINNING = -2  # slot of a string that is no piece but begins one
_BASE = 0x2545F4914F6CDD1D


@dataclass
class Vocabulary:
    """Pieces to match, by length; weights; bytes of every id; ids of the 256 byte pieces."""

    longest: int
    keys: np.ndarray
    slots: np.ndarray
    weight: np.ndarray
    raw: list[bytes]
    byte_ids: np.ndarray
    byte_weight: float
    size: int


_INVERSE = pow(_BASE, -1, 2**64)
_TABLE_BITS = 19


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(2)
def vocabulary(path: str = MODEL, alpha: float = ALPHA) -> Vocabulary:
    """The pieces of a SentencePiece model. A merge model's scores are ranks; the weight of
    the piece of rank r is (r + 3) ** -alpha, after Zipf's law. A byte weighs less than any piece."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    weight = np.zeros(n)
    raw, entries = [b""] * n, {}
    byte_ids = np.zeros(256, dtype=np.int64)
    for i in range(n):
        if sp.is_byte(i):
            value = int(sp.id_to_piece(i)[3:5], 16)
            byte_ids[value], raw[i] = i, bytes([value])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            piece = sp.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError("pieces that cross words are not supported")
            weight[i] = (3.0 - sp.get_score(i)) ** -alpha
            raw[i] = piece.replace("▁", " ").encode()
            entries[piece] = i
    longest = max(map(len, entries))
    slots = np.full(1 << _TABLE_BITS, -1, dtype=np.int64)
    keys = np.zeros(1 << _TABLE_BITS, dtype=U)
    power = [pow(_BASE, k, 2**64) for k in range(longest)]
    beginnings = {p[:k] for p in entries for k in range(1, len(p))}
    for piece, i in {**dict.fromkeys(beginnings, _BEGINNING), **entries}.items():
        h = sum((ord(c) + 1) * power[k] for k, c in enumerate(piece)) % 2**64
        at = _slot(h)
        while slots[at] != -1:
            at = (at + 1) % len(slots)
        keys[at], slots[at] = h, i
    return Vocabulary(longest, keys, slots, weight, raw, byte_ids, float((2.0 + n) ** -alpha), n)


def _slot(h):
    if isinstance(h, int):
        return ((h * 0x9E3779B97F4A7C15) % 2**64) >> (64 - _TABLE_BITS)
    return ((h * U(0x9E3779B97F4A7C15)) >> U(64 - _TABLE_BITS)).astype(np.int64)


def utf8_length(code: np.ndarray) -> np.ndarray:
    code = np.where(code == _LITERAL, SPACE_PIECE, code)
    return 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)


class Lattices:
    """The lattices of distinct words, end to end, cut into parts between which no piece reaches.

    Part j of them begins at ``heads[j]``, and the parts of word i are ``parts[i]`` to ``parts[i+1] - 1``.
    For position p and length l, ``ids[p, l-1]`` is the piece (or vocabulary size +
    code point where a character has to be written in bytes, -1 for none) and
    ``share[p, l-1]`` its probability given that a path gets to p.
    """

    def __init__(self, vocab: Vocabulary, code: np.ndarray, heads: np.ndarray):
        n, longest = len(code), vocab.longest
        left = np.repeat(heads[1:], np.diff(heads)) - np.arange(n)
        sums = np.zeros(n + 1, dtype=U)
        np.cumsum((code.astype(U) + U(1)) * _powers(n + 1, _BASE)[:n], out=sums[1:])
        back = _powers(n + 1, _INVERSE)
        matches, reach = [], np.arange(1, n + 1)
        at = np.arange(n)
        for length in range(1, longest + 1):
            at = at[left[at] >= length]
            if not len(at):
                break
            h = (sums[at + length] - sums[at]) * back[at]
            slot = _slot(h)
            found = vocab.slots[slot]
            open_ = np.flatnonzero((found != -1) & (vocab.keys[slot] != h))
            while len(open_):
                slot[open_] = (slot[open_] + 1) % len(vocab.slots)
                here = vocab.slots[slot[open_]]
                found[open_] = here
                open_ = open_[(here != -1) & (vocab.keys[slot[open_]] != h[open_])]
            hit = found >= 0
            own, piece = at[hit], found[hit]
            matches.append((own, piece))
            reach[own] = own + length
            # Longer pieces begin with what is a piece or begins one.
            at = at[found != -1]
        # No piece of this slice is longer.
        while len(matches) > 1 and not len(matches[-1][0]):
            matches.pop()
        longest = max(1, len(matches))
        ids = np.full((n, longest), -1, dtype=np.int32)
        for k, (own, piece) in enumerate(matches):
            ids[own, k] = piece
        bare = np.flatnonzero(ids[:, 0] < 0)
        ids[bare, 0] = vocab.size + code[bare]
        # Words are cut where no piece crosses; what is left and right of a cut is independent.
        open_ = np.maximum.accumulate(reach) > np.arange(1, n + 1)
        self.starts = heads
        self.heads = heads = np.concatenate([[0], np.flatnonzero(~open_) + 1])
        sizes = np.diff(heads)
        self.left = np.repeat(heads[1:], sizes) - np.arange(n)
        #: The first part of each word, and one more.
        self.parts = np.searchsorted(heads, self.starts)
        # Places go by how far they are from the end of their part, then by falling length of the part: those that are as far are a run,
        # and the places before or after them in the same parts begin a run likewise.
        order = np.argsort(-sizes, kind="stable")
        live = np.searchsorted(-sizes[order], -np.arange(1, (sizes.max() if len(sizes) else 0) + 1), side="right")
        rank = np.empty(len(sizes), dtype=np.int64)
        rank[order] = np.arange(len(sizes))
        begin = np.concatenate([[0, 0], np.cumsum(live)])
        place = begin[self.left] + np.repeat(rank, sizes)
        # A constant factor for each character cancels out and keeps the sums near 1.
        factor = np.zeros(n)
        factor[bare] = utf8_length(code[bare]) * -math.log(vocab.byte_weight) - 1.5
        weight = np.zeros((longest, n))
        for k, (own, piece) in enumerate(matches):
            weight[k, place[own]] = vocab.weight[piece] * math.exp(1.5 * (k + 1))
        weight[0, place[bare]] = 1.0
        if len(bare):
            along, odd = np.concatenate([[0.0], np.cumsum(factor)]), np.zeros(n + 1, dtype=np.int64)
            np.cumsum(factor != 0, out=odd[1:])
            for k, (own, _) in enumerate(matches):
                over = own[odd[own + k + 1] > odd[own]]
                weight[k, place[over]] *= np.exp(along[over + k + 1] - along[over])
        totals = [np.ones(len(sizes))]
        for r, k in enumerate(live.tolist(), 1):
            lo = begin[r]
            m = min(r, longest)
            flows = weight[:m, lo : lo + k]
            whole = np.zeros(k)
            for j in range(m):
                flows[j] *= totals[-1 - j][:k]
                whole += flows[j]
            flows /= whole
            totals.append(whole)
            if r > longest and r % RESCALE == 0:
                scale = whole.copy()
                for j in range(longest):
                    totals[-1 - j][:k] /= scale
            del totals[: max(0, len(totals) - longest)]
        # What is no longer read goes before the tables are written, which take a column at a time instead of a copy of the whole.
        del matches, own, piece, sums, back, at, reach, open_, order, rank, factor, flows, totals
        self.ids, self.share, self.cumulated = ids, np.empty((n, longest)), np.empty((n, longest), dtype=np.float32)
        sums = np.zeros(n)
        for k in range(longest):
            self.share[:, k] = weight[k][place]
            sums += weight[k]
            along = sums.astype(np.float32)
            # The last piece with a share takes what rounding leaves.
            along[along > 1 - 3e-7] = 2.0
            self.cumulated[:, k] = along[place]


def _uniform(seed: np.ndarray, *parts) -> np.ndarray:
    """Numbers in (0, 1) from a hash of the arguments."""
    h = seed
    for k, part in enumerate(parts):
        h = mix(h ^ (np.asarray(part).astype(U) * U(0x9E3779B97F4A7C15) + U(k + 1)))
    return ((h >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


def draw(lat: Lattices, word: np.ndarray, seed: np.ndarray, ordinal: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pieces that every word draws, and the first of each word."""
    n = len(word)
    at, stop = lat.heads[word], lat.heads[word + 1]
    who = np.arange(n)
    steps, count = [], np.zeros(n, dtype=np.int64)
    own = mix(seed ^ (ordinal.astype(U) * U(0xD6E8FEB86659FD93) + U(sample + 1)))
    t = 0
    while len(who):
        u = _uniform(own[who], t)
        length = (lat.cumulated[at] < u[:, None]).sum(axis=1)
        steps.append((who, at * lat.ids.shape[1] + length))
        count[who] += 1
        at = at + length + 1
        more = at < stop[who]
        who, at = who[more], at[more]
        t += 1
    heads = np.concatenate([[0], np.cumsum(count)])
    flat = np.empty(heads[-1], dtype=np.int64)
    for t, (who, edge) in enumerate(steps):
        flat[heads[who] + t] = edge
    return flat, heads


@dataclass
class Path:
    """A sample of one row: edges as position * longest + length - 1, and the perturbed value."""

    edges: np.ndarray
    value: float


class Draws:
    """Scalar numbers in (0, 1) for one row, in a fixed order."""

    def __init__(self, seed: int):
        self.state = seed

    def __call__(self) -> float:
        self.state = x = (self.state + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
        return (((x ^ (x >> 31)) >> 11) + 0.5) * 2.0**-53


class Siblings:
    """The children that a path passed by, from its piece ``begin`` on, by falling perturbed value.

    Their Gumbels, truncated at the path's value, are not drawn one by one: the largest
    of them is a Gumbel at the log of their total mass, truncated likewise; it belongs to
    each with the odds of its mass; and the next one is the same again without
    it, truncated at it. That is the same law, and takes no look at the whole path.
    """

    def __init__(self, lat: Lattices, edges: np.ndarray, logs: np.ndarray, begin: int, phi: float, value: float, draws: Draws):
        self.lat, self.edges, self.logs, self.begin, self.phi, self.value, self.draws = lat, edges, logs, begin, phi, value, draws
        self.whole = -math.expm1(float(logs[begin:].sum()))
        self.gone: dict[tuple[int, int], float] = {}

    def pop(self) -> tuple[float, int, int, float] | None:
        """(value, index of the piece, other edge, log-probability of the prefix with it) of the next one."""
        mass = self.whole - sum(self.gone.values())
        if mass < max(1e-6, 0.1 * self.whole):
            # Little is left, and part of it may be rounding: add it up.
            left = self._listed()
            mass = sum(left.values())
            if not mass:
                return None
            u = self.draws() * mass
            for found, m in left.items():
                u -= m
                if u <= 0:
                    break
        else:
            found = self._picked()
            while found in self.gone:
                found = self._picked()
            m = self._mass(*found)
        self.gone[found] = m
        e = math.log(-math.log(self.draws())) - self.phi - math.log(mass)
        low = -self.value
        top = max(low, e)
        self.value = -(top + math.log1p(math.exp(min(low, e) - top)))
        return self.value, found[0], found[1], self.phi + math.log(m)

    def _mass(self, at: int, edge: int) -> float:
        return math.exp(float(self.logs[self.begin : at].sum())) * float(self.lat.share.reshape(-1)[edge])

    def _picked(self) -> tuple[int, int]:
        goal, sums, lo = self.draws() * self.whole, 0.0, self.begin
        while True:
            part = np.cumsum(self.logs[lo : lo + WINDOW]) + sums
            k = int(np.searchsorted(-part, -math.log1p(-goal), side="right")) if goal < 1 else len(part)
            if k < len(part):
                break
            if lo + WINDOW >= len(self.edges):
                # Rounding carried the goal past the end: the last place with a choice.
                k = len(part) - 1
                while self.logs[lo + k] == 0:
                    lo -= 1
                break
            sums, lo = part[-1], lo + WINDOW
        at = lo + k
        taken = int(self.edges[at])
        longest = self.lat.ids.shape[1]
        p, c = divmod(taken, longest)
        options = self.lat.share[p].tolist()
        options[c] = 0.0
        u = self.draws() * sum(options)
        last = 0
        for k, x in enumerate(options):
            if x > 0:
                last = k
                u -= x
                if u <= 0:
                    break
        return at, p * longest + last

    def _listed(self) -> dict[tuple[int, int], float]:
        longest = self.lat.ids.shape[1]
        edges = self.edges[self.begin :]
        before = np.exp(np.concatenate([[0.0], np.cumsum(self.logs[self.begin :])[:-1]])) if len(edges) else np.zeros(0)
        options = self.lat.share[edges // longest] * before[:, None]
        options[np.arange(len(edges)), edges % longest] = 0.0
        r, c = np.nonzero(options)
        found = {(int(i) + self.begin, int(edges[i] // longest * longest + k)): float(options[i, k]) for i, k in zip(r, c)}
        return {k: v for k, v in found.items() if k not in self.gone}


class Encoder:
    """Encodes slices of texts; see sample()."""

    def __init__(self, vocab: Vocabulary, k: int):
        self.vocab, self.k = vocab, k

    def slice(self, texts: list[str], seeds: np.ndarray) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """For each text up to k times (ids, log-probability, perturbed value, inclusion score), largest value first."""
        filled = [i for i, t in enumerate(texts) if t]
        if not filled:
            return [[(np.zeros(0, dtype=np.int32), 0.0, 0.0, 1.0)] for _ in texts]
        joined = " " + " ".join(texts[i] for i in filled)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        literal, space = code == SPACE_PIECE, code == 0x20
        code[literal], code[space] = _LITERAL, SPACE_PIECE
        rows = np.concatenate([[0], np.cumsum([len(texts[i]) + 1 for i in filled])])
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[rows[:-1]] = True
        cut = np.append(np.flatnonzero(first), len(code))
        sums = np.zeros(len(code) + 1, dtype=U)
        np.cumsum((code.astype(U) + U(1)) * _powers(len(code) + 1, _BASE)[:-1], out=sums[1:])
        h = mix((sums[cut[1:]] - sums[cut[:-1]]) * _powers(len(code) + 1, _INVERSE)[cut[:-1]] + np.diff(cut).astype(U))
        _, seen, word = np.unique(h, return_index=True, return_inverse=True)
        sizes = np.diff(cut)[seen]
        heads = np.concatenate([[0], np.cumsum(sizes)])
        own = np.repeat(cut[seen] - heads[:-1], sizes) + np.arange(heads[-1])
        lat = Lattices(self.vocab, code[own], heads)
        # From here on a word's parts count as words.
        runs = np.diff(lat.parts)[word]
        ends = np.concatenate([[0], np.cumsum(runs)])
        row_words = ends[np.searchsorted(cut, rows)]
        word = np.repeat(lat.parts[word] - ends[:-1], runs) + np.arange(ends[-1])
        row = np.repeat(np.arange(len(filled)), np.diff(row_words))
        ordinal = np.arange(len(word)) - row_words[row]
        seed = seeds[filled]
        drawn = []
        for k in range(self.k):
            edges, starts = draw(lat, word, seed[row], ordinal, k)
            drawn.append((edges, starts, np.log(lat.share.reshape(-1)[edges]) if k == 0 else None))
        out: list = [[(np.zeros(0, dtype=np.int32), 0.0, 0.0, 1.0)] for _ in texts]
        chosen: list[list[Path]] = []
        kappas = []
        for i in range(len(filled)):
            paths, kappa = self._row(lat, drawn, word, row_words[i], row_words[i + 1], int(seed[i]))
            chosen.append(paths)
            kappas.append(kappa)
        flat = np.concatenate([p.edges for paths in chosen for p in paths])
        lengths = [len(p.edges) for paths in chosen for p in paths]
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        logs = np.add.reduceat(np.log(lat.share.reshape(-1)[flat]), bounds[:-1])
        ids, ends = self._ids(lat.ids.reshape(-1)[flat], bounds)
        n = 0
        for i, paths, kappa in zip(filled, chosen, kappas):
            out[i] = []
            for p in paths:
                score = 1.0 if kappa == -math.inf else -math.expm1(-math.exp(min(50.0, logs[n] - kappa)))
                out[i].append((ids[ends[n] : ends[n + 1]], float(logs[n]), p.value, score))
                n += 1
        return out

    def _row(self, lat: Lattices, drawn: list, word: np.ndarray, lo: int, hi: int, seed: int) -> tuple[list[Path], float]:
        flat, heads, logs = drawn[0]
        draws = Draws(seed)
        value = -math.log(-math.log(draws()))
        own = slice(heads[lo], heads[hi])
        paths, agenda, groups = [Path(flat[own], value)], [], []

        def push(group: Siblings, s: int) -> None:
            found = group.pop()
            if found is not None:
                heapq.heappush(agenda, (-found[0], s, *found[1:]))

        groups.append(Siblings(lat, flat[own], logs[own], 0, 0.0, value, draws))
        push(groups[0], 0)
        while agenda and len(paths) < self.k:
            v, parent, at, edge, phi = heapq.heappop(agenda)
            push(groups[parent], parent)
            s = len(paths)
            edges = self._rest(lat, drawn[s], paths[parent].edges[:at], edge, word, lo, hi, seed, s)
            paths.append(Path(edges, -v))
            groups.append(Siblings(lat, edges, np.log(lat.share.reshape(-1)[edges]), at + 1, phi, -v, draws))
            push(groups[s], s)
        return paths, -agenda[0][0] if agenda else -math.inf

    def _rest(self, lat: Lattices, fresh: tuple, before: np.ndarray, edge: int, word: np.ndarray, lo: int, hi: int, seed: int, sample: int) -> np.ndarray:
        """A path that begins with the given pieces and draws the others: the rest of the word at hand here, later words as drawn."""
        longest = lat.ids.shape[1]
        now = lo
        done = np.append(before, edge)
        p = edge // longest + edge % longest + 1
        # The word that the edge belongs to: words end where a piece reaches the end of their lattice.
        past = before // longest + before % longest + 1
        now += int((lat.left[before // longest] == before % longest + 1).sum()) if len(before) else 0
        stop = lat.heads[word[now] + 1]
        extra, t = [], 0
        while p < stop:
            u = _uniform(np.array([seed], dtype=U), [sample + 201], [t])[0]
            length = int((lat.cumulated[p] < u).sum())
            extra.append(p * longest + length)
            p += length + 1
            t += 1
        flat, heads, _ = fresh
        return np.concatenate([done, np.array(extra, dtype=np.int64), flat[heads[now + 1] : heads[hi]]])

    def _ids(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids with characters outside the vocabulary written as byte pieces, and where each path begins."""
        size = self.vocab.size
        odd = np.flatnonzero(ids >= size)
        if not len(odd):
            return ids, bounds
        code = ids[odd] - size
        code = np.where(code == _LITERAL, SPACE_PIECE, code)
        counts = np.ones(len(ids), dtype=np.int64)
        counts[odd] = utf8_length(code)
        heads = np.concatenate([[0], np.cumsum(counts)])
        out = np.repeat(ids, counts)
        raw = np.frombuffer("".join(map(chr, code.tolist())).encode("utf-8", "surrogatepass"), dtype=np.uint8)
        out[np.repeat(counts > 1, counts) | (out >= size)] = self.vocab.byte_ids[raw]
        return out.astype(np.int32), heads[bounds]


@lru_cache(2)
def _raw(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all pieces end to end, and where each begins."""
    raw = vocabulary(path, ALPHA).raw
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def decode_lists(ids: pa.ListArray, path: str = MODEL) -> pa.Array:
    """The texts of lists of ids: pieces joined, without the space that encoding puts in front; null stays null."""
    data, begin = _raw(path)
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    sizes = begin[flat + 1] - begin[flat]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = data[np.arange(ends[-1]) + np.repeat(begin[flat] - ends[:-1], sizes)].tobytes()
    counts = pa.compute.fill_null(pa.compute.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    cuts = ends[np.concatenate([[0], np.cumsum(counts)])]
    valid = ids.is_valid().to_pylist()
    return pa.array([out[a + 1 : b].decode("utf-8", "surrogatepass") if ok else None for a, b, ok in zip(cuts, cuts[1:], valid)], pa.string())


SCHEMA = "sample int, ids array<int>, log_prob double, value double, inclusion double"


def sample(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = SAMPLES, model: str = MODEL, alpha: float = ALPHA) -> DataFrame:
    """Up to k distinct segmentations of every row: (key, sample, ids, log_prob, value, inclusion).

    Samples are numbered from 0 by falling perturbed value. A text with fewer than k
    segmentations gives them all, with inclusion 1. Null and empty texts give
    one empty segmentation. Rows of equal key and text give equal rows. Encoding is
    reversible for every text: characters outside the vocabulary, U+2581 among
    them, are written in byte pieces. The model's path must be readable on every executor.
    """
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(model, alpha), k)
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_CHARS, prepend=-1))
            for i, j in zip(cuts, [*cuts[1:], len(batch)]):
                texts = [t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]
                seeds = batch.column(2).slice(i, j - i).to_numpy(zero_copy_only=False).astype(np.int64).view(U)
                found = encoder.slice(texts, mix(seeds + U(0x632BE59BD9B4E019)))
                which = np.repeat(np.arange(j - i), [len(x) for x in found])
                rows = [x for one in found for x in one]
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])]).astype(np.int32)), pa.array(np.concatenate([r[0] for r in rows]).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i).take(pa.array(which)),
                        pa.array([s for one in found for s in range(len(one))], pa.int32()),
                        ids, *[pa.array([r[x] for r in rows], pa.float64()) for x in (1, 2, 3)],
                    ],
                    names=[key, "sample", "ids", "log_prob", "value", "inclusion"],
                )

    seed = F.xxhash64(F.col(key).cast("string")).alias("_seed")
    return df.select(key, text, seed).mapInArrow(run, f"`{key}` {kind}, {SCHEMA}")


def decode(df: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """df with the column ``decoded``: the text of its ids; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            for i in range(0, len(batch), 256):
                yield pa.RecordBatch.from_arrays([*[c.slice(i, 256) for c in batch.columns], decode_lists(column.slice(i, 256), model)], names=[*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, decoded string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: sampled segmentations of every document, as digests, and the digest of what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decode(sample(docs)).selectExpr(
        "doc_id", "sample", "cast(size(ids) as long) n_tokens", "xxhash64(ids) ids_hash", "log_prob", "value", "inclusion", "sha2(decoded, 256) decoded_sha256"
    )
