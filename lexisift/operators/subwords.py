"""Classes of texts by hashed words and character n-grams: a linear softmax, trained in shards whose weights are averaged."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisift.sources.shared import written

#: Odd multipliers of the hash, fixed so that a model means the same everywhere.
STEP, SPREAD = np.uint64(1_000_003), np.uint64(0x9E3779B97F4A7C15)
#: Weights are added up as whole numbers of this part of one, so that sums don't depend on the order of rows.
UNIT = 1 << 20


@dataclass(frozen=True)
class Features:
    """lengths of the n-grams inside a word that is marked < and >; 2 ** bits buckets."""

    lengths: Sequence[int] = (2, 3, 4)
    bits: int = 14


@dataclass
class Model:
    """labels in order, and the weights of each bucket: an array of 2 ** bits rows and a column for each label."""

    features: Features
    labels: list[str]
    weights: np.ndarray


def buckets_of(text: str | None, features: Features) -> tuple[np.ndarray, np.ndarray]:
    """A text's buckets, rising, and their values: how often each comes, the whole at length one.

    Every word in lower case counts as itself and by its n-grams. No words, no buckets.
    """
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.int32), np.empty(0)
    codes = np.frombuffer(f"<{'> <'.join(words)}>".encode("utf-32-le"), np.uint32).astype(np.uint64)
    gap = codes == 32
    gaps = np.concatenate([[0], np.cumsum(gap)])
    hashes = []
    for n in features.lengths:
        h = np.zeros(max(len(codes) - n + 1, 0), np.uint64)
        for i in range(n):
            h = h * STEP + codes[i : i + len(h)]
        hashes.append(h[gaps[n : n + len(h)] == gaps[: len(h)]])
    starts = np.concatenate([[0], np.flatnonzero(gap) + 1])
    ends = np.concatenate([np.flatnonzero(gap), [len(codes)]]) - 1
    left = np.maximum(np.repeat(ends, np.diff(np.concatenate([starts, [len(codes)]]))) - np.arange(len(codes)), 0)
    powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(left.max(), STEP)]))
    hashes.append(np.add.reduceat(np.where(gap, np.uint64(0), codes * powers[left]), starts))
    ids, counts = np.unique((np.concatenate(hashes) * SPREAD) >> np.uint64(64 - features.bits), return_counts=True)
    return ids.astype(np.int32), counts / np.sqrt(np.sum(counts.astype(float) ** 2))


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return (values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True))


def _probabilities(weights: np.ndarray, ids: np.ndarray, values: np.ndarray) -> np.ndarray:
    scores = values @ weights[ids]
    e = np.exp(scores - scores.max())
    return e / e.sum()


def step(weights: np.ndarray, rows: Sequence[tuple[int, np.ndarray, np.ndarray]], rate: float) -> None:
    """One step of gradient descent over rows (label, ids, values), in place."""
    errors = [_probabilities(weights, ids, values) for _, ids, values in rows]
    for e, (label, _, _) in zip(errors, rows, strict=True):
        e[label] -= 1
    for e, (_, ids, values) in zip(errors, rows, strict=True):
        weights[ids] -= rate / len(rows) * np.outer(values, e)


def train(df: DataFrame, key: str, text: str, label: str, features: Features | None = None, rounds: int = 4, shard_rows: int = 4096, batch: int = 16, rate: float = 4.0, most_labels: int = 256) -> Model:
    """A model from all rows with a label and words.

    Rows are dealt by their keys' hash into shards of shard_rows on average. In each round every shard starts from the common weights
    and takes steps over its rows in order of keys; the changes, weighted by rows, are averaged over shards. Shards and order follow
    from the data, so the same model comes out on any cluster. A shard's rows stream through its task; what the driver holds is
    the model: 2 ** bits rows by the labels, of which there may be most_labels. Keys are unique; rows without a key are left out.
    """
    features = features or Features()
    labelled = df.where(F.col(key).isNotNull() & F.col(text).isNotNull() & F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
    labels = sorted(r[0] for r in labelled.select("label").distinct().limit(most_labels + 1).collect())
    if len(labels) > most_labels:
        raise ValueError(f"more than {most_labels} labels")
    weights = np.zeros((1 << features.bits, len(labels)))
    place = {name: i for i, name in enumerate(labels)}

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [buckets_of(t, features) for t in b.column("text").to_pylist()]
            names = pa.array([place[x] for x in b.column("label").to_pylist()], pa.int32())
            lists = [pa.array([f[i] for f in found], pa.list_(kind)) for i, kind in ((0, pa.int32()), (1, pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column("key"), names, *lists], ["key", "label", "ids", "values"])

    kind = labelled.schema["key"].dataType.simpleString()
    rows = written(labelled.mapInArrow(featured, f"key {kind}, label int, ids array<int>, values array<double>").where(F.size("ids") > 0), "subwords")
    n = rows.count()
    shards = -(-n // shard_rows)
    dealt = rows.withColumn("shard", F.crc32(F.col("key").cast("string")) % max(shards, 1))
    for turn in range(rounds if n else 0):
        common = df.sparkSession.sparkContext.broadcast(weights)  # of the model's bounded size
        speed = rate / (1 + turn)

        def learn(batches: Iterator[pa.RecordBatch], common=common, speed=speed) -> Iterator[pa.RecordBatch]:
            def change(own: np.ndarray, seen: int) -> pa.RecordBatch:
                delta = np.rint((own - common.value).ravel() * UNIT).astype(np.int64) * seen
                cells = np.flatnonzero(delta)
                return pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(delta[cells], pa.int64())], ["cell", "delta"])

            shard, own, seen, waiting = None, None, 0, []
            for b in batches:
                for s, name, ids, values in zip(b.column("shard").to_pylist(), b.column("label").to_pylist(), _lists(b.column("ids")), _lists(b.column("values")), strict=True):
                    if s != shard:
                        if shard is not None:
                            if waiting:
                                step(own, waiting, speed)
                            yield change(own, seen)
                        shard, own, seen, waiting = s, common.value.copy(), 0, []
                    waiting.append((name, ids, values))
                    seen += 1
                    if len(waiting) == batch:
                        step(own, waiting, speed)
                        waiting = []
            if shard is not None:
                if waiting:
                    step(own, waiting, speed)
                yield change(own, seen)

        sums = dealt.repartition("shard").sortWithinPartitions("shard", "key").mapInArrow(learn, "cell long, delta long").groupBy("cell").agg(F.sum("delta").alias("delta")).toArrow()
        flat = weights.ravel().copy()
        flat[sums.column("cell").to_numpy()] += sums.column("delta").to_numpy() / UNIT / n
        weights = flat.reshape(weights.shape)
        common.unpersist()
    return Model(features, labels, weights)


def classify(df: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(key, label, score): the likeliest label and its probability, ties to the first label; null and 0 for texts without words."""
    known = df.sparkSession.sparkContext.broadcast((model.features, model.labels, model.weights))  # of the model's bounded size

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, labels, weights = known.value
        for b in batches:
            names, scores = [], []
            for t in b.column("text").to_pylist():
                ids, values = buckets_of(t, features)
                p = _probabilities(weights, ids, values) if len(ids) and labels else None
                names.append(None if p is None else labels[int(p.argmax())])
                scores.append(0.0 if p is None else float(p.max()))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], [key, "label", "score"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(told, f"`{key}` {rows.schema['key'].dataType.simpleString()}, label string, score double")
