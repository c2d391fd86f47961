"""N-gram Jaccard self-join on word shingles through count-vector R-trees.

A document's shingles are hashed to groups; the counts per group make it a
point, and the overlap of two sets is at most the sum over the groups of the
smaller count. Documents meet in minhash bands (the distribution step: no
document is compared with all others); there the bound prunes, and the pairs
left are decided on the whole shingle sets.

Steps, each over all documents:

1. One pass gives every document its set size, a 128-bit digest of the set,
   the band keys and the count vector. Equal sets collapse to one document.
2. Every document is dealt to the smallest document of each of its bands, its
   leads. Leads and their documents, many leads to a block, are indexed in R-trees
   that are packed lead by lead, so that near copies share tight nodes; each lead searches
   the tree for the documents dealt to it. The pairs found are verified; links give
   partial components. This settles groups of near copies of any size in linear work.
3. Bands that still hold two partial components are searched in full: their
   documents, in blocks, are indexed in R-trees, and pairs of different
   components that pass the bound are verified as well.

A pair at the threshold itself misses all bands with probability
(1 - t**ROWS)**BANDS, 4e-6 at 0.75, less above it; a component is lost only
if all its paths are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import stored, table
from scriptorium.llm.components import components
from scriptorium.llm.textbytes import U, mix, row_sums, slices

#: Words in a shingle, and the threshold as a fraction.
WORDS = 5
NUMERATOR, DENOMINATOR = 75, 100
#: Minhash bands and rows in a band.
BANDS, ROWS = 64, 6
#: Groups of the count vector by set size: (sizes below, groups).
GROUPS = ((32, 64), (128, 256), (512, 1024), (1 << 62, 4096))
#: Rows of a block in steps 2 and 3.
BLOCK = 512
#: Bytes of text that are hashed together.
SLICE = 1_000_000


def shingle_hashes(part, n_words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of every row of a Slice, repeats included, and the first of each row.

    A row with fewer words has its whole sequence as its only shingle.
    """
    part = part.lowered()
    starts, ends, first = part.words()
    words = part.hashes(starts, ends)
    counts = np.diff(first)
    sizes = np.where(counts == 0, 0, np.maximum(counts - n_words + 1, 1))
    heads = np.concatenate([[0], np.cumsum(sizes)])
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(heads[-1]) - heads[row] + first[row]
    out = np.zeros(heads[-1], dtype=U)
    end = first[row + 1]
    padded = np.concatenate([words, np.zeros(n_words, dtype=U)])
    for j in range(n_words):
        factor = U(pow(0xD1342543DE82EF95, j + 1, 2**64))
        out += np.where(at + j < end, (padded[at + j] | U(1)) * factor, U(j + 1))
    return mix(out), heads


def shingle_sets(part, n_words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every row."""
    hashes, heads = shingle_hashes(part, n_words)
    return [np.unique(hashes[heads[i] : heads[i + 1]]) for i in range(len(part))]


def groups_for(size: int) -> int:
    return next(g for below, g in GROUPS if size < below)


def count_vector(sets: np.ndarray) -> np.ndarray:
    """The set's point: members per group, the group being the hash modulo the number of groups."""
    g = groups_for(len(sets))
    return np.bincount((sets & U(g - 1)).astype(np.int64), minlength=g).astype(np.uint16)


def folded(vector: np.ndarray, groups: int) -> np.ndarray:
    """A point in fewer groups: groups that are equal modulo the new number add up."""
    return vector.reshape(-1, groups).sum(axis=0, dtype=np.int32)


def needed(n_a, n_b):
    """Least overlap of two sets of these sizes with Jaccard at the threshold."""
    return -((n_a + n_b) * -NUMERATOR // (NUMERATOR + DENOMINATOR))


class CountVectorRTree:
    """An R-tree over count vectors, packed in the order given or by sorting on size and heaviest groups.

    A node knows the largest count of each group below it and the range of set
    sizes; a query descends where the summed minima of its own counts and the
    node's reach the overlap that the smallest set there would need.
    """

    LEAF = FAN = 16

    def __init__(self, points: np.ndarray, sizes: np.ndarray, order: np.ndarray | None = None):
        self.points, self.sizes = points, sizes
        if order is None:
            spread = np.argsort(-points.var(axis=0), kind="stable")[:3] if len(points) else []
            order = np.lexsort((*[points[:, g] for g in spread], sizes)) if len(points) else np.zeros(0, dtype=int)
        self.order = order
        tops, low, high = points[self.order], sizes[self.order], sizes[self.order]
        self.levels = []
        width = self.LEAF
        while len(tops):
            cut = np.arange(0, len(tops), width)
            tops, low, high = np.maximum.reduceat(tops, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            self.levels.append((tops, low, high))
            if len(tops) == 1:
                break
            width = self.FAN

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Rows whose bound allows a link with the query."""
        if not self.levels:
            return np.zeros(0, dtype=int)
        at = np.zeros(1, dtype=int)
        for depth in range(len(self.levels) - 1, -1, -1):
            tops, low, high = self.levels[depth]
            fits = (low[at] * NUMERATOR <= size * DENOMINATOR) & (size * NUMERATOR <= high[at] * DENOMINATOR)
            at = at[fits]
            at = at[np.minimum(tops[at], point).sum(axis=1) >= needed(size, np.maximum(low[at], -(-size * NUMERATOR // DENOMINATOR)))]
            below = self.FAN if depth else self.LEAF
            limit = len(self.levels[depth - 1][0]) if depth else len(self.order)
            at = (at[:, None] * below + np.arange(below)).ravel()
            at = at[at < limit]
            if not len(at):
                return at
        at = self.order[at]
        return at[np.minimum(self.points[at], point).sum(axis=1) >= needed(size, self.sizes[at])]


def _randoms(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**32, n, dtype=np.uint32), rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1)


_XOR, _MUL = _randoms(BANDS * ROWS, 20240)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """The band keys (rows x BANDS) of non-empty sets."""
    flat = (np.concatenate(sets) >> U(32)).astype(np.uint32)
    cut = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    keys = np.zeros((len(sets), BANDS), dtype=U)
    scratch = np.empty_like(flat)
    for j in range(BANDS * ROWS):
        np.bitwise_xor(flat, _XOR[j], out=scratch)
        np.multiply(scratch, _MUL[j], out=scratch)
        low = np.minimum.reduceat(scratch, cut).astype(U)
        keys[:, j // ROWS] = mix(keys[:, j // ROWS] * U(0x2545F4914F6CDD1D) + low + U(j + 1))
    return keys


SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, vec binary"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, part in slices(batch.column("text"), SLICE):
            sets = shingle_sets(part)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            full = np.flatnonzero(n)
            a, b = np.zeros(len(sets), dtype=np.int64), np.zeros(len(sets), dtype=np.int64)
            bands: list = [[]] * len(sets)
            vecs: list = [b""] * len(sets)
            if len(full):
                kept = [sets[k] for k in full]
                heads = np.concatenate([[0], np.cumsum(n[full])])
                flat = np.concatenate(kept)
                a[full] = row_sums(mix(flat + U(0x5851F42D4C957F2D)), heads).view(np.int64)
                b[full] = row_sums(mix(flat ^ U(0xA0761D6478BD642F)), heads).view(np.int64)
                keys = band_keys(kept).view(np.int64)
                for k, row in enumerate(full):
                    bands[row], vecs[row] = keys[k], zlib.compress(count_vector(kept[k]).tobytes(), 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i).cast(pa.int64()), pa.array(n), pa.array(a), pa.array(b), pa.array(bands, pa.list_(pa.int64())), pa.array(vecs, pa.binary())],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "vec"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, part in slices(batch.column("text"), SLICE):
            rows = [s.view(np.int64) for s in shingle_sets(part)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i).cast(pa.int64()), pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "members"])


def _search_leads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows arrive sorted by (groups, lead, part), a lead's own row among those dealt to it; a tree takes
    whole parts until it has BLOCK rows."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        marks = batch[["groups", "lead", "part"]].to_numpy()
        cut = np.flatnonzero(np.any(marks[1:] != marks[:-1], axis=1)) + 1
        begin, groups = 0, marks[:, 0]
        for c in cut.tolist():
            if c - begin >= BLOCK or groups[c] != groups[c - 1]:
                yield _lead_pairs(batch.iloc[begin:c])
                begin = c
        rest = batch.iloc[begin:]
    if rest is not None and len(rest):
        yield _lead_pairs(rest)


def _lead_pairs(block: pd.DataFrame) -> pd.DataFrame:
    """The pairs of leads and documents dealt to them whose bound allows a link."""
    ids, leads, parts, sizes = (block[c].to_numpy() for c in ("rep", "lead", "part", "n"))
    groups = int(block["groups"].iloc[0])
    points = np.stack([folded(np.frombuffer(zlib.decompress(v), dtype=np.uint16), groups) for v in block["vec"]])
    tree = CountVectorRTree(points, sizes, np.arange(len(ids)))
    us, vs = [], []
    for q in np.flatnonzero(block["asks"].to_numpy()):
        hit = tree.search(points[q], int(sizes[q]))
        hit = hit[(leads[hit] == ids[q]) & (parts[hit] == parts[q]) & (hit != q)]
        us.append(np.full(len(hit), ids[q]))
        vs.append(ids[hit])
    none = np.zeros(0, dtype=np.int64)
    return pd.DataFrame({"u": np.concatenate([none, *us]), "v": np.concatenate([none, *vs])})


def lead_candidates(stars: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs (u, v) of stars (u, v, n_u, n_v), u being v's lead, that the trees leave open; points has (rep, n, vec)."""
    groups = lambda n: "case " + " ".join(f"when {n} < {below} then {g}" for below, g in GROUPS) + " end"
    # A lead of many documents searches several trees, one for each part of them.
    hot = stars.groupBy("u").agg(F.count(F.lit(1)).alias("k")).where(f"k > {BLOCK}").selectExpr("u", f"cast(ceil(k / {BLOCK}) as int) parts")
    dealt = stars.join(hot, "u", "left").selectExpr(
        f"least({groups('n_u')}, {groups('n_v')}) groups", "u lead", "cast(pmod(xxhash64(v), coalesce(parts, 1)) as int) part", "v rep", "false asks"
    )
    asking = dealt.select("groups", "lead", "part").distinct().selectExpr("groups", "lead", "part", "lead rep", "true asks")
    sort = ["groups", "lead", "part"]
    rows = dealt.unionByName(asking).join(points, "rep").repartition(*sort).sortWithinPartitions(*sort)
    return rows.select(*sort, "rep", "n", "vec", "asks").mapInPandas(_search_leads, "u long, v long")


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (u, v) whose whole shingle sets link."""
    ids = pairs.select(F.col("u").alias("doc_id")).union(pairs.select("v")).distinct()
    sets = stored(docs.join(ids, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, members array<long>"))
    left = sets.select(F.col("doc_id").alias("u"), F.col("members").alias("mu"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("members").alias("mv"))
    both = pairs.join(left, "u").join(right, "v").withColumn("same", F.size(F.array_intersect("mu", "mv")))
    return both.where(f"same * {NUMERATOR + DENOMINATOR} >= (size(mu) + size(mv)) * {NUMERATOR}").select("u", "v")


def _search_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks arrive sorted by (band, i, j); each block is indexed and searched for pairs of different components."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        marks = batch[["band", "i", "j"]].to_numpy()
        cut = np.flatnonzero(np.any(marks[1:] != marks[:-1], axis=1)) + 1
        bounds = [0, *cut.tolist()]
        for lo, hi in zip(bounds, bounds[1:]):
            yield _block_pairs(batch.iloc[lo:hi])
        rest = batch.iloc[bounds[-1] :]
    if rest is not None and len(rest):
        yield _block_pairs(rest)


def _block_pairs(block: pd.DataFrame) -> pd.DataFrame:
    ids, comps, sizes, asks = block["rep"].to_numpy(), block["comp"].to_numpy(), block["n"].to_numpy(), block["asks"].to_numpy()
    us, vs = [], []
    if asks.any() and len(ids) > 1 and (comps != comps[0]).any():
        vecs = [np.frombuffer(zlib.decompress(v), dtype=np.uint16) for v in block["vec"]]
        g = min(len(v) for v in vecs)
        points = np.stack([folded(v, g) for v in vecs])
        tree = CountVectorRTree(points, sizes)
        for q in np.flatnonzero(asks):
            hit = tree.search(points[q], int(sizes[q]))
            hit = hit[comps[hit] != comps[q]]
            us.append(np.minimum(ids[hit], ids[q]))
            vs.append(np.maximum(ids[hit], ids[q]))
    none = np.zeros(0, dtype=np.int64)
    return pd.DataFrame({"u": np.concatenate([none, *us]), "v": np.concatenate([none, *vs])}).drop_duplicates()


def residual_candidates(shared: DataFrame, comp: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs (u, v) of different components (rep, comp) in a common band of shared (band, rep) that the trees leave open."""
    placed = shared.select("band", "rep").join(comp, "rep")
    per = placed.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("k"))
    mixed = stored(
        per.groupBy("band").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.max("k").alias("n_main"), F.sum("k").alias("n_all"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
        .selectExpr("band", "main", f"cast(ceil(n_main / {BLOCK}) as int) b_main", f"cast(ceil((n_all - n_main) / {BLOCK}) as int) b_rest")
    )
    # Documents of the main component meet every block of the others; those meet each other, block by block.
    dealt = placed.join(mixed, "band").selectExpr(
        "band", "rep", "comp", "comp <> main other",
        "cast(pmod(xxhash64(rep, band), if(comp = main, b_main, b_rest)) as int) b", "b_main", "b_rest",
    )
    rows = dealt.selectExpr(
        "band", "rep", "comp",
        "explode(if(other, concat(transform(sequence(0, b_main - 1), x -> struct(x as i, b as j, true as asks)),"
        " transform(sequence(0, b_rest - 1), x -> struct(-1 - least(x, b) as i, greatest(x, b) as j, true as asks))),"
        " transform(sequence(0, b_rest - 1), x -> struct(b as i, x as j, false as asks)))) at",
    ).selectExpr("band", "rep", "comp", "at.i i", "at.j j", "at.asks asks")
    blocks = rows.join(points, "rep").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return blocks.select("band", "i", "j", "rep", "comp", "n", "vec", "asks").mapInPandas(_search_blocks, "u long, v long").distinct()


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document of df.

    Words are lower-cased A-Z and split at white space. Null and empty texts
    have no shingles and stay alone; equal sets are one group whatever their
    texts. Ids are taken as long; rows that repeat an id count as one more
    document with that id and give one more row. Other columns of df are not read.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sig = stored(docs.mapInArrow(_signatures, SIGNATURE))
    keys = ["set_a", "set_b", "n_shingles"]
    first = sig.where("n_shingles > 0 and doc_id is not null").groupBy(*keys).agg(F.min("doc_id").alias("rep"))
    member = stored(sig.select("doc_id", *keys).join(first, keys, "left").select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")))
    reps = stored(
        sig.where("n_shingles > 0")
        .join(first.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi")
        .select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "bands", "vec")
    )
    banded = reps.select("rep", F.explode("bands").alias("band"))
    leads = stored(banded.groupBy("band").agg(F.min("rep").alias("lead"), F.count(F.lit(1)).alias("size")).where("size > 1"))
    shared = stored(banded.join(leads, "band").select("band", "rep", "lead"))

    points, sizes = reps.select("rep", "n", "vec"), reps.select("rep", "n")
    stars = shared.where("rep <> lead").select(F.col("lead").alias("u"), F.col("rep").alias("v")).distinct()
    # Many chance meetings end at the sizes, before count vectors move.
    stars = stars.join(sizes.toDF("u", "n_u"), "u").join(sizes.toDF("v", "n_v"), "v")
    stars = stored(stars.where(f"n_u * {NUMERATOR} <= n_v * {DENOMINATOR} and n_v * {NUMERATOR} <= n_u * {DENOMINATOR}"))
    links = stored(_verified(stored(lead_candidates(stars, points)), docs))
    partial = components(links, "u", "v")

    comp = reps.select("rep").distinct().join(partial.withColumnRenamed("node", "rep"), "rep", "left").select("rep", F.coalesce("component", "rep").alias("comp"))
    found = residual_candidates(shared, comp, points)
    more = stored(_verified(stored(found.join(stars.select("u", "v"), ["u", "v"], "left_anti")), docs))
    if more.isEmpty():
        whole = comp
    else:
        nodes = comp.withColumnRenamed("rep", "u").withColumnRenamed("comp", "cu")
        joins = more.join(nodes, "u").join(comp.withColumnRenamed("rep", "v").withColumnRenamed("comp", "cv"), "v").select("cu", "cv")
        last = components(joins, "cu", "cv")
        whole = comp.join(last.withColumnRenamed("node", "comp"), "comp", "left").select("rep", F.coalesce("component", "comp").alias("comp"))
    return member.join(whole, "rep", "left").select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: near-duplicate groups of all documents by shingle Jaccard."""
    return jaccard_components(table(spark, sf_dir, "documents"))
