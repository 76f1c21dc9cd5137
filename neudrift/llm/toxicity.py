"""Toxicity by a factorization machine over hashed terms.

Terms are the lower-cased words of a text and their beginnings of 4 and 6 bytes, hashed into `2**BITS`
buckets. The machine adds to the weights of a text's buckets the products of their factor vectors, so
that it can learn that two terms mean something together that neither means alone.

It is fitted on a bounded sample of labelled rows: the `per_class` rows of either label with the smallest
hash of their id, weighted back to the share that the label has. A bucket takes part if it says something about the
label in the sample, alone or together with another one, by chi-square tests: so terms that mean something only
in pairs are there for the machine to learn. Pairs are counted among the PAIRED most frequent buckets. This keeps
the model at `most_buckets` + PAIRED buckets however long texts are; every whole text is scored.
"""

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from neudrift.llm.common import map_arrow
from neudrift.llm.words import ALPHANUMERIC, blocks, hashes, spans, text_bytes

BITS = 22
PREFIXES = (4, 6)
# Rows of each label that the model is fitted on at most.
PER_CLASS = 8_000
# The buckets, by rows that hold them, whose pairs are tested, and the chi-square that a pair needs: a twentieth of
# a pair among all two million passes it by chance.
PAIRED, PAIR_CHI = 2_048, 31.0


def _terms(texts: pa.Array, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, bucket) of a batch, each once. With `chosen`, a place for each bucket or -1, only
    chosen buckets, as their places."""
    data, offsets = text_bytes(texts)
    starts, ends, bounds = spans(data, offsets, ALPHANUMERIC)
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    rows, buckets = [], []
    for k in (None, *PREFIXES):
        longer = slice(None) if k is None else np.flatnonzero(ends - starts > k)
        s = starts[longer]
        # The kind of term takes part in the bucket: a whole word is not the beginning of another.
        h = hashes(data, s, ends[longer] if k is None else s + k, lower=True)
        bucket = ((h + np.uint64(k or 0)) >> np.uint64(64 - BITS)).astype(np.int64)
        own = row[longer]
        if chosen is not None:
            bucket = chosen[bucket]
            own, bucket = own[bucket >= 0], bucket[bucket >= 0]
        rows.append(own)
        buckets.append(bucket)
    pairs = np.unique(np.concatenate(rows) << BITS | np.concatenate(buckets))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


class FactorizationMachine:
    """Logistic, on binary features; fitted by AdaGrad over mini-batches in a fixed order."""

    def __init__(self, features: int, factors: int, seed: int = 7):
        self.bias, self.weight = 0.0, np.zeros(features)
        self.factor = np.random.default_rng(seed).normal(0, 0.01, (features, factors))

    def logits(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        return self._forward(row, feature, rows)[0]

    def _forward(self, row, feature, rows):
        v = self.factor[feature]
        # Without any feature a count has whole numbers.
        sums = np.stack([np.bincount(row, v[:, f], rows) for f in range(v.shape[1])], 1).astype(float)
        squares = np.bincount(row, (v * v).sum(1), rows).astype(float)
        linear = np.bincount(row, self.weight[feature], rows).astype(float)
        return self.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums, v

    def fit(self, bounds, feature, label, importance, epochs=12, batch=256, step=0.1, shrink=1e-3, seed=7):
        """`bounds`: where each row's features begin in `feature`; rows are weighted by `importance`."""
        order = np.random.default_rng(seed)
        past = [1e-6, np.full(len(self.weight), 1e-6), np.full(self.factor.shape, 1e-6)]
        share = float(np.average(label, weights=importance))
        self.bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        for _ in range(epochs):
            shuffled = order.permutation(len(label))
            for at in range(0, len(label), batch):
                rows = shuffled[at:at + batch]
                sizes = bounds[rows + 1] - bounds[rows]
                row = np.repeat(np.arange(len(rows)), sizes)
                place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(bounds[rows], sizes)
                own = feature[place]
                logit, sums, v = self._forward(row, own, len(rows))
                error = importance[rows] * (1 / (1 + np.exp(-logit)) - label[rows]) / importance[rows].mean()
                some, index = np.unique(own, return_inverse=True)
                g = error[row]
                weight = np.bincount(index, g, len(some)).astype(float) + shrink * self.weight[some]
                pull = g[:, None] * (sums[row] - v)
                factor = np.stack([np.bincount(index, pull[:, f], len(some)) for f in range(v.shape[1])], 1).astype(float)
                factor += shrink * self.factor[some]
                past[0] += error.sum() ** 2
                past[1][some] += weight ** 2
                past[2][some] += factor ** 2
                self.bias -= step * error.sum() / np.sqrt(past[0])
                self.weight[some] -= step * weight / np.sqrt(past[1][some])
                self.factor[some] -= step * factor / np.sqrt(past[2][some])
        return self


class Model:
    """Chosen buckets and the machine over them."""

    def __init__(self, buckets: np.ndarray, machine: FactorizationMachine):
        self.buckets, self.machine = buckets, machine

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not hasattr(self, "chosen"):
            self.chosen = np.full(1 << BITS, -1, np.int64)
            self.chosen[self.buckets] = np.arange(len(self.buckets))
        row, feature = _terms(texts, self.chosen)
        return 1 / (1 + np.exp(-np.clip(self.machine.logits(row, feature, len(texts)), -50, 50)))


def chi_square(with1: np.ndarray, with0: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """How far the shares of `n1` and `n0` rows that have something lie apart."""
    share1, share0, pooled = with1 / n1, with0 / n0, (with1 + with0) / (n1 + n0)
    spread = pooled * (1 - pooled) * (1 / n1 + 1 / n0)
    return np.divide((share1 - share0) ** 2, spread, out=np.zeros(with1.shape), where=spread > 0)


def telling_pairs(bounds: np.ndarray, bucket: np.ndarray, label: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Buckets of pairs that say more about the label than either of their buckets does."""
    times = np.bincount(bucket, minlength=1 << BITS)
    common = np.argsort(-times, kind="stable")[:PAIRED]
    common = np.sort(common[times[common] > 1])
    place = np.full(1 << BITS, -1, np.int64)
    place[common] = np.arange(len(common))
    together = np.zeros((2, len(common), len(common)), np.float32)
    for at in range(0, len(label), 1_000):  # a thousand rows of the sample at a time
        last = min(at + 1_000, len(label))
        own = place[bucket[bounds[at]:bounds[last]]]
        row = np.repeat(np.arange(last - at), np.diff(bounds[at:last + 1]))
        held = np.zeros((last - at, len(common)), np.float32)
        held[row[own >= 0], own[own >= 0]] = 1
        for y in (0, 1):
            some = held[label[at:last] == y]
            together[y] += some.T @ some
    chi = chi_square(together[1].astype(float), together[0].astype(float), n1, n0)
    alone = np.diag(chi).copy()
    more = (chi > PAIR_CHI) & (chi > 2 * np.maximum(alone[:, None], alone[None, :]))
    return common[more.any(0)]


def fitted(bounds: np.ndarray, bucket: np.ndarray, label: np.ndarray, importance: np.ndarray,
           most_buckets: int, factors: int) -> Model:
    """A model from rows of buckets and their labels."""
    sizes = np.diff(bounds)
    positive = np.repeat(label == 1, sizes)
    n1, n0 = max(int((label == 1).sum()), 1), max(int((label == 0).sum()), 1)
    with1 = np.bincount(bucket[positive], minlength=1 << BITS).astype(float)
    with0 = np.bincount(bucket[~positive], minlength=1 << BITS).astype(float)
    chi = chi_square(with1, with0, n1, n0)
    # 10.83: a thousandth of the buckets that say nothing pass by chance.
    best = np.argsort(-chi, kind="stable")[:most_buckets]
    buckets = np.union1d(best[chi[best] > 10.83], telling_pairs(bounds, bucket, label, n1, n0))
    chosen = np.full(1 << BITS, -1, np.int64)
    chosen[buckets] = np.arange(len(buckets))
    feature = chosen[bucket]
    row = np.repeat(np.arange(len(label)), sizes)[feature >= 0]
    starts = np.searchsorted(row, np.arange(len(label) + 1))
    machine = FactorizationMachine(len(buckets), factors)
    if len(label):
        machine.fit(starts, feature[feature >= 0], label, importance)
    return Model(buckets, machine)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_buckets: int = 4096,
          factors: int = 8, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most `per_class` labelled ids of either class; `labels` has `doc_id` and `toxic`."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max("toxic").alias("toxic"))
    known = known.withColumn("order", F.xxhash64(F.lit("toxic"), "id"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    sample = [known.where(F.col("toxic") == y).orderBy("order").limit(per_class) for y in (0, 1)]
    sample = sample[0].unionByName(sample[1]).select("id", "toxic")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                row, bucket = _terms(part.column("text"))
                bounds = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(bounds), pa.array(bucket.astype(np.int32)))
                yield pa.record_batch([part.column("id"), part.column("toxic"), found], names=["id", "toxic", "buckets"])

    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("id"), docs[f"`{text_col}`"].cast("string").alias("text"))
    # One text for each id of the sample, so the sample stays within its bound.
    texts = rows.join(F.broadcast(sample), "id")
    pieces = map_arrow(texts, terms, "id long, toxic int, buckets array<int>").groupBy("id").agg(
        F.max("toxic").alias("toxic"), F.max("buckets").alias("buckets"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not sum(map(len, batches)):
            return
        table = pa.Table.from_batches(batches)
        order = np.argsort(table.column("id").to_numpy())
        table = table.take(pa.array(order))
        label = table.column("toxic").to_numpy().astype(float)
        buckets = table.column("buckets").combine_chunks()
        bounds = np.concatenate(([0], np.cumsum(buckets.value_lengths().to_numpy())))
        taken = {y: max(int((label == y).sum()), 1) for y in (0, 1)}
        importance = np.array([counts.get(int(y), 1) / taken[int(y)] for y in label])
        model = fitted(bounds, buckets.flatten().to_numpy().astype(np.int64), label, importance, most_buckets, factors)
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # The sample is bounded, so one task can hold it.
    found = map_arrow(pieces.repartition(1), fit, "model binary").first()
    return pickle.loads(found["model"]) if found else Model(np.zeros(0, np.int64), FactorizationMachine(0, factors))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id` and `score`, 0 to 1, of every row; nothing but the text is looked at, and nothing is shuffled.

    Null, empty and blank texts have no terms and get the score of the bias. Rows without an id and repeated
    rows are scored like any other. An empty table gives an empty table. A model fitted without rows scores
    everything 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                yield pa.record_batch([part.column("id"), pa.array(shared.value.scores(part.column("text")))],
                                      names=["id", "score"])

    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("id"), docs[f"`{text_col}`"].cast("string").alias("text"))
    return map_arrow(rows, run, "id long, score double")
