"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates (FTRL-proximal), scored as sparse dot products.

A text's tokens are runs of word bytes and runs of other symbols. Features
are single tokens, pairs of neighbours, pairs of token shapes (case, digits, symbols) and
whether a token repeats one of the two before it, hashed to 2**BITS weights; a feature's value is its count
over the number of tokens, so that whole texts of any length compare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import crc32_of, table
from scriptorium.llm.textbytes import LOWER, U, Slice, mix, row_sums, slices

BITS = 18
#: Labelled rows to train on at most (in expectation; they are chosen by a hash of the id).
TRAIN_ROWS = 16_000
#: Shards that train side by side; their weights are averaged.
SHARDS = 4
EPOCHS = 3
#: FTRL: learning rate, smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.01
#: What a feature's share of the tokens is multiplied by.
SCALE = 20.0
THRESHOLD = 0.7

_KIND = np.full(256, 2, dtype=np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), 95, 39, *range(128, 256)]] = 1
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, dtype=np.int64)
_DIGIT[48:58] = 1


def features(part: Slice) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per kind of feature: its weight indexes over all rows, and the first of each row."""
    starts, ends, first = part.runs(_KIND)
    if not len(starts):
        return []
    lowered = Slice(LOWER[part.data], part.offsets)
    token = lowered.hashes(starts, ends)
    upper = row_sums(_UPPER[part.data], np.append(starts, len(part.data)))
    gap = np.append(starts, len(part.data))
    digits = row_sums(_DIGIT[part.data], gap)
    size = ends - starts
    head = part.data[starts].astype(np.int64)
    shape = np.where(
        _KIND[part.data[starts]] == 2,
        1000 + head * 4 + np.minimum(size, 3),
        np.where(digits > 0, 8, 0) + np.where(upper == 0, 0, np.where((upper == size) & (size > 1), 2, np.where(_UPPER[head] == 1, 1, 3))),
    ).astype(U)
    follows = np.ones(len(starts), dtype=bool)
    follows[first[:-1][first[:-1] < len(starts)]] = False
    at = np.flatnonzero(follows)
    pairs = np.searchsorted(at, first)
    cut = U(64 - BITS)
    again = np.zeros(len(token), dtype=U)
    again[1:] += token[1:] == token[:-1]
    again[2:] += U(2) * ((token[2:] == token[:-2]) & follows[2:] & follows[1:-1])
    index = lambda x: (mix(x) >> cut).astype(np.int64)
    return [
        (index(token + U(1)), first),
        (index(token[at - 1] * U(0x9E3779B97F4A7C15) + token[at] + U(2)), pairs),
        (index(shape[at - 1] * U(0xC2B2AE3D27D4EB4F) + shape[at] * U(0x165667B19E3779F9) + U(3)), pairs),
        (index(again[at] + U(0x27D4EB2F165667C5)), pairs),
    ]


def train(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept from FTRL-proximal over the rows in the order given."""
    z, n = np.zeros(2**BITS), np.zeros(2**BITS)
    zb = nb = bias = 0.0
    rows = []
    for _, _, part in slices(pa.array(texts, pa.large_string())):
        kinds = features(part)
        for r in range(len(part)):
            if not kinds or kinds[0][1][r] == kinds[0][1][r + 1]:
                rows.append((np.zeros(0, dtype=np.int64), np.zeros(0)))
                continue
            whole = np.concatenate([x[f[r] : f[r + 1]] for x, f in kinds])
            where, count = np.unique(whole, return_counts=True)
            rows.append((where, count * (SCALE / (kinds[0][1][r + 1] - kinds[0][1][r]))))

    def weights(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for (where, value), label in zip(rows, labels):
            zi, ni = z[where], n[where]
            w = weights(zi, ni)
            bias = -zb / ((BETA + np.sqrt(nb)) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w @ value + bias, -35, 35)))
            g = (p - label) * value
            z[where] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[where] = ni + g * g
            gb = p - label
            zb += gb - (np.sqrt(nb + gb * gb) - np.sqrt(nb)) / ALPHA * bias
            nb += gb * gb
    return weights(z, n), -zb / ((BETA + np.sqrt(nb)) / ALPHA)


def _train_shard(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values(["order", "text"], kind="stable")
    w, bias = train(shard["text"].fillna("").tolist(), shard["label"].to_numpy(dtype=float))
    at = np.flatnonzero(w)
    return pd.DataFrame({"feature": np.append(at, 2**BITS), "weight": np.append(w[at], bias)})


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """The weights (2**BITS, then the intercept) from texts of docs and labels (doc_id, label).

    Rows are joined on doc_id; several labels of one document count by their
    mean, null labels not at all; rows of docs that repeat an id are each learned from. The sample keeps labelled rows whose id hash
    lies below train_rows / their number, so it is bounded; shards train
    on the executors and the driver gets at most 2**BITS + 1 averaged weights.
    """
    known = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("label").alias("label"))
    total = known.count()
    share = min(1.0, train_rows / max(1, total))
    order = F.xxhash64(F.col("doc_id"), F.lit(11))
    chosen = known.withColumn("order", order).where(F.pmod("order", F.lit(1_000_000)) < int(share * 1_000_000))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("shard", F.pmod(F.xxhash64("order"), F.lit(SHARDS)))
    parts = rows.select("shard", "order", "text", "label").groupBy("shard").applyInPandas(_train_shard, "feature long, weight double")
    # Every shard that has rows gives an intercept.
    got = parts.groupBy("feature").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")).toPandas()
    at = got["feature"].to_numpy(dtype=np.int64)
    out = np.zeros(2**BITS + 1)
    out[at] = got["weight"].to_numpy() / max(1, got["n"].to_numpy()[at == 2**BITS].sum())
    return out


def scores(weights: np.ndarray, part: Slice) -> np.ndarray:
    """Probability of the label 1 for every row of a Slice."""
    logit = np.full(len(part), weights[-1])
    kinds = features(part)
    if kinds:
        n = np.maximum(np.diff(kinds[0][1]), 1)
        for index, first in kinds:
            logit += row_sums(weights[index], first) * (SCALE / n)
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) of every row; null and empty texts get the intercept's score."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, part in slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(scores(shared.value, part))], names=["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: quality of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(crc32_of(F.col("doc_id")), F.lit(4)) == 2
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
