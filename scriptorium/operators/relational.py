"""Joins, aggregations, orderings, set operations and upserts with the reference semantics, as DataFrame operators."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions.text import fold_key, words
from scriptorium.sources.shared import stored

#: Rows of a block that meet others together in candidate_pairs.
RUN = 2048
#: Links of a cell of shared_neighbours, links that travel as one row, and pairs of links that are looked up at once.
CELL, PACK, WEDGES = 4_000_000, 500, 1_000_000


def nested(parent: DataFrame, child: DataFrame, on: str, order: list[str], fields: list[str], name: str) -> DataFrame:
    """parent with an ordered array of its children (JOIN1, AGG12): one join instead of a query for each parent."""
    item = F.struct(*order, *[f for f in fields if f not in order])
    lists = child.groupBy(on).agg(F.array_sort(F.collect_list(item)).alias(name))
    return parent.join(lists, on, "left")


def candidate_pairs(df: DataFrame, block: list[str], key: str, differ: str | None = None) -> DataFrame:
    """Pairs (key_1 < key_2) of rows that share the block columns and, if asked, differ in a column (JOIN5, JOIN8).

    The rows of a large block are dealt to runs by a hash of their key. Two runs, or a run with itself, are a cell, which is what a task
    gets; so each two rows meet once, a block is spread over tasks and a task holds a run at a time. Files and broadcasts would
    leave all pairs to as many tasks as the input has splits.
    """
    kept = df.select(*block, F.col(key).alias("_k"), *([F.col(differ).alias("_d"), F.xxhash64(differ).alias("_h")] if differ else []))
    for c in kept.columns:
        kept = kept.where(F.col(f"`{c}`").isNotNull())
    hot = kept.groupBy(*block).agg(F.count(F.lit(1)).alias("_n")).where(f"_n > {RUN}").selectExpr(*[f"`{c}`" for c in block], f"cast(ceil(_n / {RUN}) as int) _n")
    placed = kept.join(F.broadcast(hot), block, "left").withColumn("_n", F.coalesce("_n", F.lit(1))).withColumn("_r", F.expr("cast(pmod(xxhash64(_k), _n) as int)"))
    cell, parts = [*block, "_i", "_j"], int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a = placed.withColumn("_i", F.col("_r")).withColumn("_j", F.explode(F.expr("sequence(_r, _n - 1)"))).drop("_n", "_r").repartition(parts, *cell)
    b = placed.withColumn("_j", F.col("_r")).withColumn("_i", F.explode(F.expr("sequence(0, _r)"))).drop("_n", "_r").repartition(parts, *cell)
    both = a.hint("merge").join(b.select(*cell, *[F.col(c).alias(c + "2") for c in ("_k", "_d", "_h") if c in b.columns]), cell)
    # Equal keys are in one run. Hashes that differ save the look at the values.
    pairs = both.where("_i <> _j or _k < _k2")
    pairs = pairs.where("_h <> _h2 or _d <> _d2") if differ else pairs
    return pairs.select(*block, F.least("_k", "_k2").alias(f"{key}_1"), F.greatest("_k", "_k2").alias(f"{key}_2"))


def co_occurring(edges: DataFrame, group: str, member: str) -> DataFrame:
    """Distinct pairs of members that appear in one group, both ways round (JOIN7)."""
    pairs = _linked(edges, group, member)
    turns = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.select(F.explode(turns).alias("p")).select("p.a", "p.b")


def _linked(edges: DataFrame, group: str, member: str) -> DataFrame:
    """Distinct pairs a < b of members that appear in one group."""
    a = edges.select(group, F.col(member).alias("a")).distinct()
    return a.join(a.withColumnRenamed("a", "b"), group).where("a < b").select("a", "b").distinct()


def shared_neighbours(edges: DataFrame, group: str, member: str) -> DataFrame:
    """(a, b, shared), a < b, of all members that appear together, with the number of members that appear with both (SET1).

    Such a member closes a triangle. Members fall into buckets by a hash, and a link goes to every cell of three buckets that has
    its two, packed with others; so the buckets of a triangle's members name the one cell that has all its links and counts it. Buckets are as many as keep a cell at
    about CELL links. What is shuffled are links, times the number of buckets; two links that meet in a member, which are many more, are not.
    """
    near = stored(_linked(edges, group, member))
    n = near.count()
    buckets = max(4, math.ceil(math.sqrt(6 * n / CELL)))
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")
    placed = near.select(F.struct("a", "b").alias("l"), F.array_sort(F.array(bucket("a"), bucket("b"))).alias("p"), F.pmod(F.xxhash64("a", F.lit(1)), F.lit(n // (PACK * buckets) + 1)).alias("c"))
    packs = placed.groupBy("p", "c").agg(F.array_sort(F.collect_list("l")).alias("l")).select("p", F.col("l.a").alias("a"), F.col("l.b").alias("b"))
    third = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda z: F.array_sort(F.concat("p", F.array(z))))
    cells = packs.select(F.explode(third).alias("cell"), "p", "a", "b")
    kind = dict(near.dtypes)["a"]
    counts = cells.groupBy("cell").applyInArrow(_triangles, f"a {kind}, b {kind}, shared long")
    return near.withColumn("shared", F.lit(0).cast("long")).unionByName(counts).groupBy("a", "b").agg(F.sum("shared").alias("shared"))


def _triangles(cell: pa.Table) -> pa.Table:
    """The links (a, b) of a cell that are in triangles of its three buckets, with the number of these."""
    a, b = (pc.list_flatten(cell[c].combine_chunks()) for c in ("a", "b"))
    members = pa.chunked_array([a, b]).unique()
    u, v = (pc.index_in(x, members).to_numpy() for x in (a, b))
    size = np.array([len(x) for x in cell["a"]])
    pairs, three = np.array(cell["p"].to_pylist()), np.array(cell["cell"][0].as_py())
    degree = np.bincount(np.concatenate([u, v]), minlength=len(members))
    rank = np.empty(len(members), np.int64)
    rank[np.argsort(degree, kind="stable")] = np.arange(len(members))
    lo, hi = np.minimum(rank[u], rank[v]), np.maximum(rank[u], rank[v])
    order = np.lexsort((hi, lo))
    lo, hi, both = lo[order], hi[order], np.repeat(pairs.sum(1), size)[order]
    keys, end = lo * len(members) + hi, np.searchsorted(lo, lo, "right")
    del u, v, rank, degree
    later = end - np.arange(len(lo)) - 1  # links of the same lower member after this one
    total, found, first = np.cumsum(later), np.zeros(len(lo), np.int64), 0
    while first < len(lo):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + WEDGES, "right")))
        e = np.repeat(np.arange(first, last), later[first:last])
        f = np.arange(len(e)) - np.repeat(np.cumsum(later[first:last]) - later[first:last], later[first:last]) + e + 1
        asked = hi[e] * len(members) + hi[f]
        g = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        # Each member is in two of the three links, so their sums of buckets are twice the cell's if the triangle is the cell's.
        ok = (keys[g] == asked) & (both[e] + both[f] + both[g] == 2 * three.sum())
        for x in (e, f, g):
            found += np.bincount(x[ok], minlength=len(found))
        first = last
    hit = np.nonzero(found)[0]
    at = pa.array(order[hit])
    return pa.Table.from_arrays([a.take(at), b.take(at), pa.array(found[hit])], names=["a", "b", "shared"])


def first_prefix(df: DataFrame, text: Column, prefixes: list[tuple[str, str]], default: str | None = None) -> Column:
    """The value of the first prefix that a text begins with (JOIN6, PRJ4)."""
    out = F.lit(default)
    for prefix, value in reversed(prefixes):
        out = F.when(text.startswith(prefix), value).otherwise(out)
    return out


def latest_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key in the order given (WIN5, SORT4, DML3)."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def numbered(df: DataFrame, order: list[str], name: str, per: str | None = None, split: bool = False) -> DataFrame:
    """df with 1, 2, ... in order, within ``per`` if given.

    Without ``per``, and with ``split``, which is for keys that may hold a large share of all rows, rows are dealt by ranges and
    sorted in them; a range, or a key's part of it, begins where the rows of those before it end, which is known from one count
    for each, so that no task has all rows or all of a key. A null key counts as one.
    """
    if per and not split:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(per).orderBy(*order)).cast("long"))
    keys = [per, *order] if per else order
    # The number within a range is what the identifier of a row has in its lower 33 bits.
    dealt = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_id", 33)))
    parts = dealt.groupBy(F.col("_range").alias("_part"), *([F.col(per).alias("_per")] if per else [])).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    earlier = (Window.partitionBy("_per") if per else Window).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).drop("_n", "_first")
    same = F.col("_range") == F.col("_part")
    # Without a key there is one row for each range, which is few; with one there may be as many as keys.
    joined = dealt.join(starts, same & F.col(per).eqNullSafe(F.col("_per"))) if per else dealt.join(F.broadcast(starts), same)
    return joined.withColumn(name, F.col("_id") + F.col("_shift")).drop("_id", "_range", "_part", "_per", "_shift")


def positional_join(left: DataFrame, right: DataFrame, left_order: str, right_order: str, per: str | None = None) -> DataFrame:
    """The n-th row of one side with the n-th of the other, leftovers kept (JOIN12). Positions count
    within ``per``, or over all rows."""
    a, b = numbered(left, [left_order], "pos", per), numbered(right, [right_order], "pos", per)
    return a.join(b, [per, "pos"] if per else ["pos"], "full")


def reconciled(expected: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """(key, expected, observed, status) of two tables (key, n): ok, missing, empty, partial, duplicate or extra (JOIN18)."""
    both = expected.select(key, F.col("n").alias("expected")).join(observed.select(key, F.col("n").alias("observed")), key, "full")
    status = (
        F.when(F.col("expected").isNull(), "extra")
        .when(F.col("observed").isNull(), "missing")
        .when(F.col("observed") == F.col("expected"), "ok")
        .when(F.col("observed") == 0, "empty")
        .when(F.col("observed") < F.col("expected"), "partial")
        .otherwise("duplicate")
    )
    return both.withColumn("status", status)


def token_overlap(left: Column, right: Column, stop: list[str]) -> Column:
    """Distinct words that two texts share, without stop words (JOIN14, SET5)."""
    return F.array_except(F.array_intersect(words(fold_key(left)), words(fold_key(right))), F.array(*[F.lit(s) for s in stop]))


def replaced(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """new over old by key: the last load wins (DML3), partitions of keys that new has are replaced (DML2)."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def replaced_partitions(path: str, new: DataFrame, by: str) -> DataFrame:
    """A table in folders by a column, with those of the values that new has written anew and the others untouched (DML2): the rest is not read."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return new.sparkSession.read.parquet(path)


def orphans(dimension: DataFrame, links: DataFrame, key: str, foreign: str) -> DataFrame:
    """Rows of a dimension that no link names any more; a replacement leaves them where they are (DML2)."""
    return dimension.join(links.select(F.col(foreign).alias(key)), key, "left_anti")


def inserted(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """old, and of new the first row of each key that old lacks (DML4, DML9)."""
    fresh = latest_per_key(new, key, [F.col(order).asc()])
    return old.unionByName(fresh.join(old.select(key), key, "left_anti").select(*old.columns))


def filled(old: DataFrame, new: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """Empty columns of old take the first non-empty value of new in load order (DML6, ER10)."""
    given = lambda c: F.when(F.col(c) != "", F.col(order))
    first = new.groupBy(key).agg(*[F.min_by(F.col(c), given(c)).alias(f"_{c}") for c in columns])
    joined = old.join(first, key, "left")
    return joined.select(*[F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_{c}")).alias(c) if c in columns else F.col(c) for c in old.columns])


def with_missing_columns(df: DataFrame, **types: str) -> DataFrame:
    """df with null columns for the names that it lacks (DML12)."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns})


def end_pages(df: DataFrame, group: str, start: str, last: Column) -> DataFrame:
    """end = the next start less one, the last one's as given (WIN1)."""
    w = Window.partitionBy(group).orderBy(start)
    return df.withColumn("end_page", F.coalesce(F.lead(start).over(w) - 1, last))


def changed_headings(df: DataFrame, partition: str, order: list[str], heading: str) -> DataFrame:
    """Rows at which the heading differs from the row before (WIN7)."""
    w = Window.partitionBy(partition).orderBy(*order)
    return df.withColumn("_before", F.lag(heading).over(w)).where(~F.col(heading).eqNullSafe(F.col("_before"))).drop("_before")


def entries_from_lines(df: DataFrame, key: str, text: str, new_entry: str, shortest: int = 15, blank_closes: bool = True) -> DataFrame:
    """(key, entry_no, entry): lines folded to entries. A line begins one if it matches
    ``new_entry`` or, if blank lines close entries, follows a blank line (WIN4, REF15 to REF18)."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line")).withColumn("line", F.trim("line"))
    w = Window.partitionBy(key).orderBy("pos")
    begins = F.col("line").rlike(new_entry)
    if blank_closes:
        begins = begins | (F.lag("line", 1, "").over(w) == "")
    marked = lines.withColumn("begins", ((F.col("line") != "") & begins).cast("int"))
    grouped = marked.withColumn("no", F.sum("begins").over(w)).where("line <> '' and no > 0")
    joined = grouped.groupBy(key, "no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), " ").alias("entry"))
    return joined.where(F.length("entry") >= shortest).select(key, F.col("no").cast("long").alias("entry_no"), "entry")


def batches(df: DataFrame, per: str | None, order: str, size: int) -> DataFrame:
    """df with batch 1, 2, ... of so many rows each in order (SNK11)."""
    return numbered(df, [order], "batch", per).withColumn("batch", F.ceil(F.col("batch") / size).cast("long"))


def merge_targets(edges: DataFrame) -> DataFrame:
    """(removed, keep) with every chain removed -> keep followed to its end (ER6).

    Each removed id has one target, the least; chains halve in each round, so that after as many rounds as
    the number of ids has bits only those that lead into a cycle are still on their way. They have no end, and are reported as an error.
    """
    now = stored(edges.groupBy("removed").agg(F.min("keep").alias("keep")))
    for _ in range(now.count().bit_length() + 1):
        up = now.toDF("keep", "next")
        jumped = stored(now.join(up, "keep", "left").select("removed", F.coalesce("next", "keep").alias("keep"), F.col("next").isNotNull().alias("moved")))
        now = jumped.select("removed", "keep")
        left = jumped.where("moved").select("removed").limit(5).collect()
        if not left:
            return now
    raise ValueError(f"merges go round in a circle; among them {sorted(r.removed for r in left)}")


def merged_edges(links: DataFrame, targets: DataFrame, group: str, member: str) -> DataFrame:
    """Links re-pointed to the kept members, one for each group and member (ER6, DML7)."""
    moved = links.join(targets.toDF(member, "_keep"), member, "left")
    return moved.select(group, F.coalesce("_keep", member).alias(member)).distinct()


def without_positions(lists: DataFrame, key: str, items: str, removals: DataFrame) -> DataFrame:
    """lists without the items at the positions (key, pos) of removals, counted from 0; a position named by several
    sources goes once, one that a list lacks does nothing (SET3, REF14)."""
    gone = removals.groupBy(key).agg(F.array_sort(F.collect_set("pos")).alias("_gone"))
    left = F.filter(F.col(items), lambda x, i: ~F.coalesce(F.array_contains(F.col("_gone"), i.cast("long")), F.lit(False)))
    return lists.join(gone, key, "left").withColumn(items, left).drop("_gone")


def by_priority(sources: list[DataFrame], key: str) -> DataFrame:
    """The rows of all sources, of each key those of the last source that has it; the first in order of all columns if it has several (DML8)."""
    numbered = [s.withColumn("_rank", F.lit(k)) for k, s in enumerate(sources)]
    every = numbered[0]
    for other in numbered[1:]:
        every = every.unionByName(other)
    rest = [c for c in every.columns if c not in (key, "_rank")]
    best = every.groupBy(key).agg(F.min(F.struct((-F.col("_rank")).alias("r"), *rest)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in rest])


def kept_or_extracted(old: DataFrame, found: DataFrame, key: str, keep: list[str], overwrite: list[str] = ()) -> DataFrame:
    """old with found's values where it has none; fields of ``overwrite`` take found's where there are any (DML10)."""
    both = old.join(found.select(key, *[F.nullif(F.col(c), F.lit("")).alias(f"_{c}") for c in (*keep, *overwrite)]), key, "left")
    value = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_{c}")) if c in keep else F.coalesce(F.col(f"_{c}"), F.col(c)) if c in overwrite else F.col(c)
    return both.select(*[value(c).alias(c) for c in old.columns])


def changes(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, field, before, after) of what an update would change: its dry run (DML11, SNK13)."""
    both = old.select(key, *[F.col(c).cast("string").alias(f"a_{c}") for c in columns]).join(new.select(key, *[F.col(c).cast("string").alias(f"b_{c}") for c in columns]), key)
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"a_{c}").alias("before"), F.col(f"b_{c}").alias("after")) for c in columns])
    return both.select(key, F.explode(rows).alias("x")).select(key, "x.*").where("not (before <=> after)")
