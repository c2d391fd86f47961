"""Embedding near-dedup with rotated binary codes.

A unit vector x is rotated at random and kept as the signs of its coordinates,
o = sign(Rx)/sqrt(D), with the correction factor f = <o, Rx>. For any y,
<o, Ry>/f is an unbiased estimate of <x, y>, and for a pair at or above the
threshold t it falls short of t by more than
sqrt(1-t^2) * sqrt(1-f^2)/f * EPSILON/sqrt(D-1) with the odds of an EPSILON-sigma
event. Pairs whose estimates clear that bound both ways are recomputed in
double precision; the others are settled by the codes.

Vectors meet in tables keyed by runs of sign bits (of as many rotations as it
takes). Number and width of the tables follow from the number of vectors,
so that a bucket holds about BUCKET vectors by chance, and a pair at the threshold
misses all tables with probability MISS.

Only sign bits are dealt to the tables. There the share of equal bits, which estimates
1 - angle / pi, tells which vectors of a bucket have any near one (again with EPSILON sigmas to spare); vectors
are fetched for those alone, and the correction factors and the exact cosines settle
their pairs. Tasks return counts and spanning links, never pairs, and a pair counts only in the first table it shares.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import stored, table
from scriptorium.llm.components import components
from scriptorium.llm.textbytes import row_sums

THRESHOLD = 0.95
EPSILON = 6.0
BUCKET = 400
MISS = 1e-5
#: Rows of a bucket that are compared in one piece, by sign bits and by vectors; larger buckets are cut into pairs of blocks.
CODE_BLOCK, BLOCK = 4096, 1024
#: Pairs that are looked at together.
STRIP = 500_000


def shape_of_tables(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(bits of a key, tables) for n vectors."""
    bits = min(30, max(6, round(math.log2(max(2, n) / BUCKET))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - meet))


_rotations: dict[tuple[int, int], np.ndarray] = {}


def rotations(dim: int, count: int) -> np.ndarray:
    """count random rotations of dim coordinates side by side (dim x dim * count)."""
    if (dim, count) not in _rotations:
        rng = np.random.default_rng(1000 + dim)
        _rotations[dim, count] = np.hstack([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(count)])
    return _rotations[dim, count]


def encode(units: np.ndarray, bits: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (rows x tables), all sign bits packed, those of the first rotation in front, and correction factors."""
    n, dim = units.shape
    turned = units @ rotations(dim, -(-bits * tables // dim))
    signs = turned > 0
    factor = np.abs(turned[:, :dim]).sum(axis=1) / math.sqrt(dim)
    return keys_of(signs, bits, tables), np.packbits(signs, axis=1), factor


def keys_of(signs: np.ndarray, bits: int, tables: int) -> np.ndarray:
    return (signs[:, : bits * tables].reshape(len(signs), tables, bits) * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def least_agreement(n_bits: int, threshold: float = THRESHOLD) -> float:
    """Share of equal sign bits that a pair at the threshold falls short of only by an EPSILON-sigma event."""
    p = 1 - math.acos(threshold) / math.pi
    return p - EPSILON * math.sqrt(p * (1 - p) / n_bits)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def usable(column: pa.Array) -> np.ndarray:
    """Which vectors have a direction: not null or empty, only finite components, not all zero."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.fill_null(column.flatten().cast(pa.float64()), math.nan).to_numpy(zero_copy_only=False)
    heads = np.concatenate([[0], np.cumsum(sizes)])
    return (sizes > 0) & (row_sums((~np.isfinite(values)).astype(np.int64), heads) == 0) & (row_sums((values != 0).astype(np.int64), heads) > 0)


def _units(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The usable vectors with a digest of their components, equal for equal numbers."""
    for batch in batches:
        batch = batch.filter(pa.array(usable(batch.column("embedding"))))
        sums = [hashlib.blake2b((v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0).tobytes(), digest_size=16).digest() for v in batch.column("embedding")]
        halves = np.frombuffer(b"".join(sums), dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=[*batch.schema.names, "same_a", "same_b"])


def _encoder(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 2048):
                batch = whole.slice(lo, 2048)
                dims = pc.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
                for dim in np.unique(dims).tolist():
                    part = batch.filter(pa.array(dims == dim))
                    keys, codes, factor = encode(_units(_matrix(part.column("embedding"), dim)), bits, tables)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("node"), part.column("m"), part.column("embedding"), pa.array(np.full(len(part), dim, dtype=np.int32)), pa.array(list(keys), pa.list_(pa.int32())), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factor)],
                        names=["node", "m", "embedding", "dim", "keys", "signs", "factor"],
                    )

    return run


def candidates(units: np.ndarray, signs: np.ndarray, factor: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Which pairs rows x cols the codes (signs of the first rotation) and their factors leave open."""
    dim = units.shape[1]
    turned = units @ rotations(dim, 1)
    codes = (signs[:, :dim] * 2.0 - 1.0) / math.sqrt(dim)
    slack = math.sqrt(1 - THRESHOLD**2) * np.sqrt(np.maximum(1 - factor**2, 0)) / factor * EPSILON / math.sqrt(max(dim - 1, 1)) + 1e-9
    forth = codes[rows] @ turned[cols].T / factor[rows, None] + slack[rows, None] >= THRESHOLD
    back = turned[rows] @ codes[cols].T / factor[None, cols] + slack[None, cols] >= THRESHOLD
    return forth & back


def _seen(keys: np.ndarray, t: int, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Which pairs rows x cols share a table before t."""
    out = np.zeros((len(rows), len(cols)), dtype=bool)
    for k in range(t):
        out |= keys[rows, k][:, None] == keys[cols, k][None, :]
    return out


def _strips(left: np.ndarray, n: int) -> Iterator[np.ndarray]:
    step = max(1, STRIP // max(1, n))
    for lo in range(0, len(left), step):
        yield left[lo : lo + step]


def _bits(rows: pa.Table, dim: int) -> np.ndarray:
    packed = np.frombuffer(b"".join(rows.column("signs").to_pylist()), dtype=np.uint8).reshape(rows.num_rows, -1)
    return np.unpackbits(packed, axis=1)[:, : packed.shape[1] * 8 // dim * dim]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows arrive sorted by (dim, t, key, i, j); each piece of more than one row."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        now = pa.Table.from_batches([batch])
        now = now if rest is None else pa.concat_tables([rest, now])
        marks = np.stack([now.column(c).to_numpy() for c in ("dim", "t", "key", "i", "j")])
        cut = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist()]
        for lo, hi in zip(cut, cut[1:]):
            if hi - lo > 1:
                yield now.slice(lo, hi - lo)
        rest = now.slice(cut[-1])
    if rest is not None and len(rest) > 1:
        yield rest


def _sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    block = rows.column("b").to_numpy()
    return np.flatnonzero(block == rows.column("i")[0].as_py()), np.flatnonzero(block == rows.column("j")[0].as_py())


def _near(bits: int, tables: int):
    """The rows of each bucket with a vector near by their sign bits that they meet here first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _pieces(batches):
            dim, t = rows.column("dim")[0].as_py(), rows.column("t")[0].as_py()
            signs = _bits(rows, dim)
            keys, plain = keys_of(signs, bits, tables), signs.astype(np.float32) * 2 - 1
            least = 2 * least_agreement(signs.shape[1]) * signs.shape[1] - signs.shape[1]
            left, right = _sides(rows)
            found = np.zeros(rows.num_rows, dtype=bool)
            for some in _strips(left, len(right)):
                near = plain[some] @ plain[right].T >= least
                near &= some[:, None] != right[None, :]
                if near.any():
                    near &= ~_seen(keys, t, some, right)
                    found[some[near.any(axis=1)]] = True
                    found[right[near.any(axis=0)]] = True
            if found.any():
                yield pa.RecordBatch.from_arrays([rows.filter(pa.array(found)).column(c).combine_chunks() for c in ("dim", "t", "key", "node")], names=["dim", "t", "key", "node"])

    return run


def _linked(units: np.ndarray, signs: np.ndarray, factor: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Which pairs rows x cols have a cosine at or above the threshold."""
    links = candidates(units, signs, factor, rows, cols) & (rows[:, None] != cols[None, :])
    a, b = np.nonzero(links)
    for lo in range(0, len(a), 50_000):
        x, y = a[lo : lo + 50_000], b[lo : lo + 50_000]
        links[x, y] = np.einsum("ij,ij->i", units[rows[x]], units[cols[y]]) >= THRESHOLD
    return links


def _stars(links: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows the first row of its component by the links left x right."""
    label = np.arange(n)
    while True:
        low = label.copy()
        for some in range(0, len(left), 256):
            part = links[some : some + 256]
            own = left[some : some + 256]
            np.minimum.at(low, own, np.where(part, label[right][None, :], n).min(axis=1))
            np.minimum.at(low, right, np.where(part, label[own][:, None], n).min(axis=0))
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def _compare(bits: int, tables: int):
    """Counts of links, and links (least node of the component, node) that connect what the pairs of a piece connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _pieces(batches):
            dim, t = rows.column("dim")[0].as_py(), rows.column("t")[0].as_py()
            rows = rows.sort_by("node")
            node, m, factor = (rows.column(c).to_numpy() for c in ("node", "m", "factor"))
            units, signs = _units(_matrix(rows.column("embedding").combine_chunks(), dim)), _bits(rows, dim)
            keys = keys_of(signs, bits, tables)
            left, right = _sides(rows)
            links, at = np.zeros((len(left), len(right)), dtype=bool), 0
            for some in _strips(left, len(right)):
                part = _linked(units, signs, factor, some, right)
                if part.any():
                    links[at : at + len(some)] = part & ~_seen(keys, t, some, right)
                at += len(some)
            if not links.any():
                continue
            count = np.zeros(len(node), dtype=np.int64)
            count[left] = links @ m[right]
            if left[0] != right[0]:
                count[right] = links.T @ m[left]
            label = _stars(links, left, right, len(node))
            far = np.flatnonzero(label != np.arange(len(node)))
            some = np.flatnonzero(count)
            none = [None] * len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([node[some], node[far]])), pa.array([*none, *node[label[far]].tolist()], pa.int64()), pa.array(np.concatenate([count[some], np.zeros(len(far), dtype=np.int64)]))],
                names=["node", "low", "n"],
            )

    return run


_PIECE = ["dim", "t", "key", "i", "j"]


def _dealt(rows: DataFrame, per: DataFrame, block: int, columns: list[str]) -> DataFrame:
    """Rows (dim, t, key, node, ...) of buckets with others, in pairs of blocks; per has the buckets (dim, t, key) once for each row."""
    sizes = per.groupBy("dim", "t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").selectExpr("dim", "t", "key", f"cast(ceil(n / {block}) as int) nb")
    placed = rows.join(sizes, ["dim", "t", "key"]).withColumn("b", F.expr("cast(pmod(xxhash64(node, t), nb) as int)"))
    pairs = placed.withColumn("o", F.explode(F.expr("sequence(0, nb - 1)")))
    return pairs.selectExpr("dim", "t", "key", "least(b, o) i", "greatest(b, o) j", "b", *columns).repartition(*_PIECE).sortWithinPartitions(*_PIECE)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Vectors without a direction (null, empty, all zero, null or non-finite
    components) link with nothing, and vectors of different lengths never link.
    Equal vectors are one while they are compared and count as many; a row with a
    null id links with nothing. Rows that repeat an id are vectors of their own, whose component is still the
    smallest id in it. Ids are taken as long; other columns are not read.
    """
    kind = dict(df.dtypes)[vector]
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("embedding"))
    good = rows.where("vec_id is not null and embedding is not null").mapInArrow(_read, f"vec_id long, embedding {kind}, same_a long, same_b long")
    # Numbers of rows, fixed once they are written.
    good = stored(good.withColumn("no", F.monotonically_increasing_id()))
    same = ["same_a", "same_b"]
    first = stored(good.groupBy(*same).agg(F.min("no").alias("node"), F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m")))
    reps = good.select("no", "embedding").join(first.select(F.col("node").alias("no"), "m"), "no").select(F.col("no").alias("node"), "m", "embedding")
    bits, tables = shape_of_tables(first.count())
    coded = stored(reps.mapInArrow(_encoder(bits, tables), f"node long, m long, embedding {kind}, dim int, keys array<int>, signs binary, factor double"))
    meet = coded.select("dim", F.posexplode("keys").alias("t", "key"), "node", "signs")
    pieces = _dealt(meet, meet.select("dim", "t", "key"), CODE_BLOCK, ["node", "signs"])
    near = stored(pieces.mapInArrow(_near(bits, tables), "dim int, t int, key int, node long").distinct())
    full = near.join(coded.select("node", "m", "embedding", "signs", "factor"), "node")
    pieces = _dealt(full, near, BLOCK, ["node", "m", "embedding", "signs", "factor"])
    found = stored(pieces.mapInArrow(_compare(bits, tables), "node long, low long, n long"))
    counts = found.where("low is null").groupBy("node").agg(F.sum("n").alias("n"))
    comp = components(found.where("low is not null").select("low", "node").distinct(), "low", "node")
    least = comp.join(first.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("least"))
    placed = comp.join(least, "component").select("node", "least")
    known = first.join(counts, "node", "left").join(placed, "node", "left").selectExpr(*same, "m - 1 + coalesce(n, 0) as n_links", "coalesce(least, rep) as component_id")
    known = good.select("vec_id", *same).join(known, same).select("vec_id", "n_links", "component_id")
    bad = rows.where("vec_id is null or embedding is null").select("vec_id").unionByName(
        rows.where("vec_id is not null and embedding is not null").mapInArrow(_rejected, "vec_id long")
    )
    alone = bad.selectExpr("vec_id", "cast(0 as bigint) n_links", "vec_id component_id")
    return known.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _rejected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(~usable(batch.column("embedding")))).select(["vec_id"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: near-duplicate groups of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
