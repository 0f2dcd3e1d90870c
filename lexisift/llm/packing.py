"""Packing documents into training windows by lexical retrieval.

Documents are encoded once, and what packing needs of them is kept in the shared folder: whole windows'
checksums, the ids of the tail that doesn't fill a window, and the document's distinct ids with counts. The
ids serve as terms; how many documents hold each, over the whole corpus, is a table of the vocabulary's size.

Tails are dealt by their terms into shards of about ``SHARD_DOCUMENTS``, so that lexical neighbours share one: the
weighted terms of a document are projected to ``DIMENSIONS`` random directions, and a tree of splits between
two means, learned from a sample, leads to the shard. What can't be split by terms (many copies) is dealt
by a hash of the row within its leaf. Neighbours that a split parts are not retrieved. Each shard is a BM25 inverted
index of its own. The longest unused tail seeds a window, its document is the query, and the unused
neighbours fill the window in order of score; the one that doesn't fit is cut, and its rest stays unused. So
every window of a shard but its last is full. No shard grows with the corpus, a source or a group of copies.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisift.llm.byte_bpe import Encoder, in_worker, share
from lexisift.llm.common import block_slices, materialise, small_batches, table
from lexisift.llm.jaccard_join import _runs

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WINDOW = 1024
END = 0
SHARD_DOCUMENTS = 1024
DIMENSIONS = 128
#: Sampled documents for each leaf of the tree that deals documents to shards, and of all leaves.
LEAF_SAMPLES, MOST_SAMPLES = 32, 1 << 17
LEAST_GAP = 1e-4
#: Seeds that are scored at once.
SEEDS = 64
K1, B = 1.2, 0.75
PIECES = "key {key}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encoded(docs: DataFrame, shared, text: str, key: str, window: int = WINDOW, end_id: int = END) -> DataFrame:
    """key, n tokens with the end id, checksums of whole windows, tail ids, distinct ids and their counts."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    end = np.array([end_id], dtype="<u2").tobytes()

    def run(batches):
        encoder = in_worker(shared, Encoder, "<u2")
        for batch in batches:
            texts = batch.column("text")
            for a, b in block_slices(pc.binary_length(texts).to_pylist(), 1 << 20):
                n, sums, tails, terms, counts = [], [], [], [], []
                for raw in encoder(texts.slice(a, b - a)):
                    ids = np.frombuffer(raw + end, dtype="<u2")
                    whole = len(ids) // window * window
                    wide = ids[:whole].astype("<u4").tobytes()
                    n.append(len(ids))
                    sums.append([zlib.crc32(wide[4 * i : 4 * (i + window)]) for i in range(0, whole, window)])
                    tails.append(ids[whole:].tobytes())
                    if whole == len(ids):  # no tail, so no part in the index
                        terms.append(b"")
                        counts.append(b"")
                        continue
                    known, times = np.unique(ids, return_counts=True)
                    terms.append(known.tobytes())
                    counts.append(times.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(a, b - a), pa.array(n, pa.int64()), pa.array(sums, pa.list_(pa.int64())), *[pa.array(x, pa.binary()) for x in (tails, terms, counts)]],
                    names=["key", "n", "sums", "tail", "terms", "counts"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n long, sums array<long>, tail binary, terms binary, counts binary")


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """How many indexed documents hold each id: 65,536 counts, summed in tasks and then in Spark."""

    def count(batches):
        total = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column("terms").to_pylist()), dtype="<u2")
            total += np.bincount(held, minlength=1 << 16)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": at, "n": total[at]})

    found = rows.select("terms").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << 16, dtype=np.int64)
    out[found["id"].to_numpy()] = found["n"].to_numpy()
    return out


def projected(terms: list[np.ndarray], counts: list[np.ndarray], idf: np.ndarray, mean_length: float, signs: np.ndarray) -> np.ndarray:
    """Unit vectors whose products are near those of the BM25-weighted terms; documents must have terms."""
    out = np.empty((len(terms), signs.shape[1]), dtype=np.float32)
    for i, (t, c) in enumerate(zip(terms, counts)):
        tf = c.astype(np.float64)
        weight = np.sqrt(idf[t] * tf / (tf + K1 * (1 - B + B * tf.sum() / mean_length)))
        out[i] = weight.astype(np.float32) @ signs[t]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def random_signs() -> np.ndarray:
    return np.random.default_rng(5).integers(0, 2, (1 << 16, DIMENSIONS), dtype=np.int8).astype(np.float32) * 2 - 1


def split(vectors: np.ndarray, rounds: int = 4) -> tuple[np.ndarray, float | None]:
    """A direction and a limit on it: two means from the principal direction, parted where the middle is thinnest.

    The limit is None where the vectors are equal.
    """
    if not len(vectors):
        return np.zeros(vectors.shape[1], np.float32), None
    own = vectors - vectors.mean(axis=0)
    direction = np.linalg.eigh((own.T @ own).astype(np.float64))[1][:, -1].astype(np.float32)
    for i in range(rounds):
        along = vectors @ direction
        order = np.sort(along)
        near, a, b = max(len(order) // 50, 1), int(len(order) * 0.3), int(len(order) * 0.7)
        at = np.arange(max(a, near), max(b, near) + 1)
        at = at[at + near - 1 < len(order)]
        best = at[np.argmax(order[at + near - 1] - order[at - near])] if len(at) else len(order) // 2
        gaps = np.diff(order)
        inner = gaps[max(best - near, 0) : best + near]
        cut = int(np.argmax(inner)) + max(best - near, 0) if len(inner) and inner.max() > LEAST_GAP else int(np.argmax(gaps)) if len(gaps) else 0
        if not len(gaps) or gaps[cut] <= LEAST_GAP:
            return direction, None
        limit = (order[cut] + order[cut + 1]) / 2  # never between copies
        right = along >= limit
        if i == rounds - 1:
            break
        direction = vectors[right].mean(axis=0) - vectors[~right].mean(axis=0)
    return direction, float(limit)


class Dealer:
    """A tree of splits of a sample's vectors, each side with leaves for its share; its leaves are shards, or several."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.direction, self.limit, self.child, self.depth = [], [], [], 0
        held = np.zeros(leaves, dtype=np.int64)
        open_ = [(np.arange(len(sample)), 0, leaves, 0, None)]  # sampled rows, first leaf, leaves, depth, slot in the parent
        while open_:
            rows, first, n, depth, slot = open_.pop()
            direction, limit = split(sample[rows]) if n > 1 else (None, None)
            if limit is None:
                held[first] = len(rows)
                name = -1 - first
            else:
                right = sample[rows] @ direction >= limit
                lower = min(max(round(n * float(np.mean(~right))), 1), n - 1)
                name = len(self.limit)
                self.direction.append(direction)
                self.limit.append(limit)
                self.child.append([0, 0])
                self.depth = max(self.depth, depth + 1)
                open_ += [(rows[~right], first, lower, depth + 1, (name, 0)), (rows[right], first + lower, n - lower, depth + 1, (name, 1))]
            if slot:
                self.child[slot[0]][slot[1]] = name
        self.direction, self.limit, self.child = (np.array(x) for x in (self.direction, self.limit, self.child))
        # a leaf that holds much more than its share of the sample, for equal vectors, is several shards
        self.pieces = np.maximum(np.rint(held * leaves / max(len(sample), 1)).astype(np.int64), 1)
        self.first = np.cumsum(self.pieces) - self.pieces
        self.shards = int(self.pieces.sum())

    def leaf(self, vectors: np.ndarray) -> np.ndarray:
        at = np.full(len(vectors), 0 if self.depth else -1)
        for _ in range(self.depth):
            inner = np.flatnonzero(at >= 0)
            node = at[inner]
            along = np.einsum("ij,ij->i", vectors[inner], self.direction[node])
            at[inner] = self.child[node, (along >= self.limit[node]).astype(int)]
        return -1 - at

    def shard(self, vectors: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        leaf = self.leaf(vectors)
        return self.first[leaf] + mixed % self.pieces[leaf]


def deal(rows: DataFrame, idf, mean: float, documents: int) -> DataFrame:
    """Add shard to rows of row, terms, counts; idf is broadcast, documents of the rows have terms."""
    leaves = max(1, -(-documents // SHARD_DOCUMENTS))
    made: dict = {}  # of a task

    def vectors(batch, at):
        terms, counts = ([np.frombuffer(x, dtype=t) for x in batch.column(c).take(at).to_pylist()] for c, t in (("terms", "<u2"), ("counts", "<u4")))
        if not made:
            made["signs"] = random_signs()
        return projected(terms, counts, idf.value, mean, made["signs"])

    def sampled(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"vector": pa.array([v.tobytes() for v in vectors(batch, pa.array(range(batch.num_rows)))], pa.binary())})

    if leaves > 1:
        share = min(leaves * LEAF_SAMPLES, MOST_SAMPLES) / documents
        chosen = rows.where(F.octet_length("terms") > 0).select("row", "terms", "counts")
        if share < 1:
            chosen = chosen.where(F.pmod(F.xxhash64("row", F.lit(3)), F.lit(1_000_000)) < int(share * 1_000_000))
        found = chosen.mapInArrow(sampled, "vector binary").collect()
        sample = np.frombuffer(b"".join(r["vector"] for r in found), dtype=np.float32).reshape(-1, DIMENSIONS)
    else:
        sample = np.zeros((0, DIMENSIONS), np.float32)
    dealer = rows.sparkSession.sparkContext.broadcast(Dealer(sample, leaves))

    def run(batches):
        for batch in batches:
            mixed = ((batch.column("row").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
            shard = mixed % dealer.value.shards
            some = np.flatnonzero(np.array(pc.binary_length(batch.column("terms")).to_pylist() or [0]) > 0) if batch.num_rows else []
            if len(some) and dealer.value.shards > 1:
                shard[some] = dealer.value.shard(vectors(batch, pa.array(some)), mixed[some])
            yield batch.append_column("shard", pa.array(shard, pa.int64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, shard long")


class ShardIndex:
    """The BM25 inverted index of one shard's documents; the lists of its commonest terms are dense rows."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.n, self.sizes = len(terms), np.array([len(t) for t in terms])
        flat, tf = np.concatenate(terms).astype(np.int64), np.concatenate(counts).astype(np.float64)
        owner = np.repeat(np.arange(self.n), self.sizes)
        length = np.array([c.sum(dtype=np.int64) for c in counts], dtype=np.float64)
        weight = idf[flat] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[owner] / mean_length))
        held = np.bincount(flat, minlength=1 << 16)
        common = np.flatnonzero(held >= max(8, self.n // 16))
        row = np.full(1 << 16, -1)
        row[common] = np.arange(len(common))
        dense = row[flat] >= 0
        self.common, self.has = np.zeros((len(common), self.n), np.float32), np.zeros((self.n, len(common)), np.float32)
        self.common[row[flat[dense]], owner[dense]] = weight[dense]
        self.has[owner[dense], row[flat[dense]]] = 1
        flat, owner, weight = flat[~dense], owner[~dense], weight[~dense]
        self.rare, self.rare_ends = flat, np.searchsorted(owner, np.arange(self.n), "right")  # in order of documents
        order = np.argsort(flat, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.ends = np.cumsum(np.bincount(flat, minlength=1 << 16))

    def scores_of(self, queries: np.ndarray) -> np.ndarray:
        """BM25 of every document of the shard for some of them as queries: (queries, documents)."""
        begins = np.where(queries > 0, self.rare_ends[queries - 1], 0)
        sizes = self.rare_ends[queries] - begins
        ids = self.rare[np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]
        b = self.ends[ids]
        n = b - np.where(ids > 0, self.ends[ids - 1], 0)
        at = np.repeat(b - np.cumsum(n), n) + np.arange(int(n.sum()))
        place = np.repeat(np.repeat(np.arange(len(queries)), sizes), n) * self.n + self.owner[at]
        return np.bincount(place, self.weight[at], minlength=len(queries) * self.n).reshape(len(queries), self.n) + self.has[queries] @ self.common

    def scores(self, query: int) -> np.ndarray:
        return self.scores_of(np.array([query]))[0]


def fill_windows(lengths: np.ndarray, index: ShardIndex, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (document, begin in its tail, length); every one but the last is full."""
    left, begin = lengths.astype(np.int64).copy(), np.zeros(len(lengths), dtype=np.int64)
    windows = []
    seeds = np.argsort(-lengths, kind="stable")
    remaining, scored = int(left.sum()), {}
    for place, seed in enumerate(seeds.tolist()):
        if not left[seed]:
            continue
        made, room = [(seed, int(begin[seed]), int(left[seed]))], window - int(left[seed])
        remaining -= int(left[seed])
        left[seed] = 0
        if room and remaining:
            if seed not in scored:  # the seeds that come next are scored with it
                next_ = seeds[place:]
                block = np.concatenate([[seed], next_[left[next_] > 0][: SEEDS - 1]])
                scored = dict(zip(block.tolist(), index.scores_of(block)))
            unused = np.flatnonzero(left)
            ranked = unused[np.argsort(-scored[seed][unused], kind="stable")]
            until = np.cumsum(left[ranked])
            k = int(np.searchsorted(until, room))
            for d in ranked[: k + 1].tolist():
                n = min(room, int(left[d]))
                made.append((d, int(begin[d]), n))
                begin[d] += n
                left[d] -= n
                room -= n
                remaining -= n
        windows.append(made)
    return windows


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str = VOCABULARY, window: int = WINDOW, end_id: int = END) -> DataFrame:
    """One row for each piece: the key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are followed by the end id; a null or empty text is that id alone. Each id lies in just one piece;
    a sequence's pieces are gapless from offset 0 and fill at most a window. Rows with equal keys or texts are packed
    each on its own; the column of an equal name is the key.
    """
    spark = docs.sparkSession
    rows = materialise(encoded(docs, share(spark, vocabulary), text, key, window, end_id).withColumn("row", F.monotonically_increasing_id()), "encoded")
    total = rows.agg(F.count("*").alias("rows"), F.count(F.when(F.octet_length("tail") > 0, 1)).alias("n"), F.avg(F.when(F.octet_length("tail") > 0, F.col("n"))).alias("mean")).first()
    frequency = document_frequencies(rows)
    idf = np.log(1 + (total["n"] - frequency + 0.5) / (frequency + 0.5))
    shared, mean = spark.sparkContext.broadcast(idf), float(total["mean"] or 1)
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        for some in _runs(batches, "shard"):
            if some is None:
                continue
            shard = some.column("shard").to_numpy()
            cuts = np.append(np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])), len(shard)).tolist()
            for s, e in zip(cuts[:-1], cuts[1:]):
                yield packed_shard(some.slice(s, e - s), int(shard[s]))

    def packed_shard(some, shard: int):
        n, sums = some.column("n").to_numpy(), some.column("sums").to_pylist()
        tails, terms, counts = ([np.frombuffer(x, dtype=t) for x in some.column(c).to_pylist()] for c, t in (("tail", "<u2"), ("terms", "<u2"), ("counts", "<u4")))
        pieces, sequence = [], shard << 32
        for i, own in enumerate(sums):
            for j, crc in enumerate(own):
                pieces.append((i, j * window, window, crc, sequence, 0))
                sequence += 1
        open_ = [i for i, t in enumerate(tails) if len(t)]
        if open_:
            index = ShardIndex([terms[i] for i in open_], [counts[i] for i in open_], shared.value, mean)
            for made in fill_windows(np.array([len(tails[i]) for i in open_]), index, window):
                offset = 0
                for d, begin, length in made:
                    i = open_[d]
                    crc = zlib.crc32(tails[i][begin : begin + length].astype("<u4").tobytes())
                    pieces.append((i, len(sums[i]) * window + begin, length, crc, sequence, offset))
                    offset += length
                sequence += 1
        who, start, length, crc, number, offset = (np.array(x, dtype=np.int64) for x in zip(*pieces))
        return pa.RecordBatch.from_arrays(
            [some.column("key").take(pa.array(who)).combine_chunks() if isinstance(some, pa.Table) else some.column("key").take(pa.array(who)), *[pa.array(x) for x in (start, length, crc, n[who], number, offset)]],
            names=["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )

    dealt = deal(rows, shared, mean, total["n"])
    packed = dealt.repartition("shard").sortWithinPartitions("shard", "row").mapInArrow(run, PIECES.format(key=kind))
    return packed.withColumnRenamed("key", key)


def sequence_ids(docs: DataFrame, pieces: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The token ids of every sequence, joined from its pieces (keys must be unique): sequence_id, ids_le binary."""
    from lexisift.llm.byte_bpe import encode

    ids = encode(docs.select(key, text), text).select(key, "ids_le")
    cut = pieces.join(ids, key).select("sequence_id", "offset", F.substring(F.concat("ids_le", F.lit(b"\0\0\0\0")), F.col("start").cast("int") * 4 + 1, F.col("length").cast("int") * 4).alias("part"))
    joined = cut.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "part"))).alias("parts"))
    return joined.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["part"])).alias("ids_le"))


def op6_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 1,024 ids."""
    small_batches(spark)
    return pack(table(spark, sf_dir, "documents"))
