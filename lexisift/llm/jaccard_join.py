"""N-gram Jaccard self-join by T-occurrence search, as components.

Two documents link when their sets of word shingles overlap enough. The unit of the search is a distinct set, named by
a 64-bit digest; copies are told apart again only in the result. The steps:

1. Short lists. Shingles are ordered by their hashes. Of a set of n whose partners share T with it at least, the first
   n - T + l go into inverted lists (l = n/16): two sets that link meet in l of those lists at least. That is
   DivideSkip's split; merging the short lists is Spark's shuffle by shingle. Lists of one set go, and so do the
   sets that are left in fewer than l lists, which are most.
2. The texts are read a second time for the sets left: a filter of fixed size finds them, then they are exact.
3. Links of hubs and neighbours. Each set is held against two others: of the sets that lead its lists, those that have
   least of their own, as what copies were made from has, the one that leads most of them; and the one that stands
   next to it by size in most of them. Pairs that survive a bitmap test are searched exactly (``InvertedLists``: heap
   merge of the short lists, binary probes into the long ones). Near copies are now joined in components. The test is by
   parity bitmaps: the bits in which two differ are no more than the elements in which the sets differ, so a pair with
   too many is out for certain.
4. What is left. Only lists that still hold several components matter, and of their sets only those in enough
   such lists. In each, pairs of different components are tested by bitmaps, and those that survive are searched exactly.
   A long list is split in pairs of blocks, so that no task grows with it.
5. The components of all exact links are the result.

Every step but 4 is linear in the sets' sizes; 4 tests pairs of a list only where its members are not joined yet, and
is quadratic in groups of sets that are near the threshold without being joined.
Shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import heapq
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisift.llm.common import block_slices, materialise, small_batches, table
from lexisift.llm.components import connected_components
from lexisift.llm.shingles import WORDS, mix, shingle_sets, text_buffer

PERCENT = 75
LEAST_BITS, MOST_BITS = 64, 4096
PAIRWISE = 8
#: A longer list of a shingle is tested in pairs of blocks of about so many members.
LIST_BLOCK = 4096
#: Sizes of long lists up to this many are broadcast, about 1 MB.
MOST_BROADCAST = 50_000
#: Bits of the filter by which the second reading finds the sets it needs: fuller at larger inputs, never wrong.
FILTER_BITS = 26


def least_overlap(n, percent: int = PERCENT):
    """T of a set of n: the overlap that any partner at the threshold has at least."""
    return -(-percent * n // 100)


def needed_overlap(total, percent: int = PERCENT):
    """The least overlap of two sets of this total size at the threshold."""
    return -(-percent * total // (100 + percent))


def least_lists(n):
    """How many short lists a set of n shares with any partner that is not smaller, at least."""
    return np.maximum(n // 16, 1)


def most_difference(total, percent: int = PERCENT):
    """The largest symmetric difference of two sets of this total size at the threshold."""
    return total - 2 * needed_overlap(total, percent)


def near_sizes(x, y, percent: int = PERCENT):
    return np.minimum(x, y) * 100 >= percent * np.maximum(x, y)


def parity_bitmap(hashes: np.ndarray) -> bytes:
    """The parity of the shingles in each cell, by the hash's low bits; as many cells as shingles, to a power of two."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << int(len(hashes) - 1).bit_length()))
    counts = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def fold(bitmaps: np.ndarray) -> np.ndarray:
    """Bitmaps of half the cells: the high bit of the cell is ignored."""
    half = bitmaps.shape[1] // 2
    return bitmaps[:, :half] ^ bitmaps[:, half:]


def survives(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of bitmaps of one width can belong to sets that link."""
    differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return (np.minimum(nx, ny) * 100 >= percent * np.maximum(nx, ny)) & (differ <= most_difference(nx + ny, percent))


class Bitmaps:
    """Bitmaps of several widths, as rows of 64-bit words by width."""

    def __init__(self, raw: list[bytes]):
        self.width = np.array([len(b) // 8 for b in raw])
        self.place = np.zeros(len(raw), dtype=np.int64)
        self.rows = {}
        for w in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == w)
            self.place[at] = np.arange(len(at))
            self.rows[w] = np.frombuffer(b"".join(raw[i] for i in at), dtype=np.uint64).reshape(-1, w)

    def take(self, at: np.ndarray, width: int, as_width: int) -> np.ndarray:
        rows = self.rows[width][self.place[at]]
        while width > as_width:
            rows, width = fold(rows), width // 2
        return rows

    def test(self, i: np.ndarray, j: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
        """Which of the pairs (i, j) survive."""
        out = np.zeros(len(i), dtype=bool)
        near = np.flatnonzero(np.minimum(n[i], n[j]) * 100 >= percent * np.maximum(n[i], n[j]))
        wi, wj = self.width[i[near]], self.width[j[near]]
        for a, b in set(zip(wi.tolist(), wj.tolist())):
            at = near[(wi == a) & (wj == b)]
            w = min(a, b)
            for s in range(0, len(at), 1 << 15):
                k = at[s : s + (1 << 15)]
                out[k] = survives(self.take(i[k], a, w), self.take(j[k], b, w), n[i[k]], n[j[k]], percent)
        return out


class InvertedLists:
    """The inverted lists of a few sets: which of them hold each shingle."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.n, self.percent = np.array([len(s) for s in sets], dtype=np.int64), percent
        values = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
        order = np.argsort(values, kind="stable")  # stable: each list is in order of its sets
        values, self.members = values[order], np.repeat(np.arange(len(sets)), self.n)[order].tolist()
        self.begins = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
        self.ends = np.append(self.begins[1:], len(values))
        self.keys = values[self.begins]

    def search(self, query: np.ndarray) -> list[int]:
        """The sets that link with the query, by DivideSkip.

        With T the least overlap of any that can, the longest lists, up to T/2, are set apart. The others are merged by a
        heap of their heads that skips what occurs too rarely; sets that occur often enough are probed by binary
        search in the long lists, shortest first, until they reach their overlap or can't any more.
        """
        if not len(query) or not len(self.keys):
            return []
        at = np.minimum(np.searchsorted(self.keys, query), len(self.keys) - 1)
        at = at[self.keys[at] == query]
        near = near_sizes(self.n, len(query), self.percent) & (self.n > 0)
        if not near.any():
            return []
        needs = needed_overlap(self.n + len(query), self.percent)
        least = int(needs[near].min())
        if len(at) < least:
            return []
        at = at[np.argsort(self.ends[at] - self.begins[at], kind="stable")]
        lists = list(zip(self.begins[at].tolist(), self.ends[at].tolist()))
        n_long = least // 2
        short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
        found = []
        for y, count in self.merge(short, least - n_long):
            if not near[y]:
                continue
            need = int(needs[y])
            for left, (p, q) in zip(range(len(long), 0, -1), long):
                if count >= need or count + left < need:
                    break
                i = bisect_left(self.members, y, p, q)
                count += i < q and self.members[i] == y
            if count >= need:
                found.append(y)
        return found

    def merge(self, lists: list[tuple[int, int]], least: int):
        """(set, count) of those in at least ``least`` of the lists, by a heap of heads with skips."""
        members = self.members
        heap = [(members[p], p, q) for p, q in lists]
        heapq.heapify(heap)
        while len(heap) >= least:
            head, popped = heap[0][0], []
            while heap and heap[0][0] == head:
                popped.append(heapq.heappop(heap))
            if len(popped) >= least:
                yield head, len(popped)
                to = head + 1
            else:  # what comes before the next head that can reach the count is skipped
                while heap and len(popped) < least - 1:
                    popped.append(heapq.heappop(heap))
                if not heap:
                    return
                to = max(heap[0][0], head + 1)
            for _, p, q in popped:
                p = bisect_left(members, to, p, q)
                if p < q:
                    heapq.heappush(heap, (members[p], p, q))


def t_occurrence(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """All links among a few sets of shingles: pairs of indices, smaller first. Empty sets link with nothing."""
    lists = InvertedLists(sets, percent)
    return [(y, x) for x, s in enumerate(sets) for y in lists.search(s) if y < x]


def _shingled(batch, k: int):
    """Sets of a batch in slices of about 1 MB of text."""
    texts = batch.column("text")
    sizes = np.array([s or 0 for s in pc.binary_length(texts).to_pylist()])
    groups = np.cumsum(sizes) >> 20
    at = 0
    while at < len(texts):
        to = max(int(np.searchsorted(groups, groups[at], "right")), at + 1)
        yield at, to, shingle_sets(*text_buffer(texts.slice(at, to - at)), k)
        at = to


def _runs(batches, key: str):
    """Batches cut where a sorted key changes: each yielded batch holds whole runs."""
    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        last = keys[-1].as_py()
        if held and held[0].column(key)[0].as_py() == last:  # one run so far
            held.append(batch)
            continue
        cut = pc.index(keys, keys[-1]).as_py()
        held.append(batch.slice(0, cut))
        yield pa.Table.from_batches([b for b in held if b.num_rows]).combine_chunks() if any(b.num_rows for b in held) else None
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def digest_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def short_lists(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """h, d, n: the first shingles of each set (d its digest, n its size); a task gives a set once."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, _, sets in _shingled(batch, k):
                digests = [digest_of(s) for s in sets]
                new = [i for i, (s, d) in enumerate(zip(sets, digests)) if len(s) and not (d in seen or seen.add(d))]
                if not new:
                    continue
                n = np.array([len(sets[i]) for i in new])
                keep = n - least_overlap(n, percent) + least_lists(n)
                yield pa.RecordBatch.from_pydict(
                    {
                        "h": np.concatenate([sets[i][:m] for i, m in zip(new, keep.tolist())]).view(np.int64),
                        "d": np.repeat(np.array([digests[i] for i in new]), keep), "n": np.repeat(n.astype(np.int32), keep),
                    }
                )

    return docs.mapInArrow(run, "h long, d long, n int")


def of_several_sets(entries: DataFrame) -> DataFrame:
    """The entries (h, d, n), once each, of the lists that hold several sets. A list streams through, however long it is."""

    def run(batches):
        last_h = last_d = held = None  # held: the first entry of a list in which nothing else came yet
        for batch in batches:
            if not batch.num_rows:
                continue
            h, d = batch.column("h").to_numpy(), batch.column("d").to_numpy()
            begins = np.concatenate([[h[0] != last_h], h[1:] != h[:-1]])
            at = np.flatnonzero(begins | np.concatenate([[d[0] != last_d], d[1:] != d[:-1]]))
            last_h, last_d = h[-1], d[-1]
            if not len(at):
                continue
            run_of = np.cumsum(begins[at])  # 0: the list that the last batch ended in
            counts = np.bincount(run_of)
            several = counts > 1
            several[0] = True
            if counts[0] and held is not None:
                yield held
                held = None
            if run_of[-1]:
                held = batch.slice(at[-1], 1) if counts[-1] == 1 else None
            out = at[several[run_of]]
            if len(out):
                yield batch.take(pa.array(out))

    return entries.select("h", "d", "n").repartition("h").sortWithinPartitions("h", "d").mapInArrow(run, "h long, d long, n int")


def of_several_components(entries: DataFrame) -> DataFrame:
    """The entries of the lists whose sets are of several components."""
    ends = entries.groupBy("h").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return entries.join(ends.where("least <> most").select("h"), "h", "left_semi")


def in_enough_lists(entries: DataFrame, percent: int, *more: str) -> DataFrame:
    """d, n, hs: the sets with all their lists (at most a set's own size), where these are enough for a partner of any size."""
    every = entries.groupBy("d").agg(F.first("n").alias("n"), *[F.first(c).alias(c) for c in more], F.collect_list("h").alias("hs"))
    smallest = F.ceil(F.col("n") * percent / 100).cast("int")
    return every.where(F.size("hs") >= F.greatest(F.expr("1"), F.floor(smallest / 16)))


def digest_filter(sets: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter of the digests in column d, 2**bits bits whatever the input, as 64-bit words."""

    def mark(batches):
        for batch in batches:
            at = np.unique(np.concatenate(_places(batch.column("d").to_numpy(), bits))) if batch.num_rows else np.zeros(0, np.uint64)
            word = (at >> np.uint64(6)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else []
            if len(first):
                value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_pydict({"word": word[first].astype(np.int32), "value": value.view(np.int64)})

    words = sets.select("d").mapInArrow(mark, "word int, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[words.column("word").to_numpy()] = words.column("value").to_numpy()
    return out.view(np.uint64)


def _places(digests: np.ndarray, bits: int) -> list[np.ndarray]:
    mixed = [mix(digests.view(np.uint64) + np.uint64(i)) for i in range(3)]
    return [m >> np.uint64(64 - bits) for m in mixed]


def read_again(docs: DataFrame, wanted, k: int, bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, n, d of each document; of sets that the filter may hold, once in a task, also bitmap and text."""

    def run(batches):
        words, seen = wanted.value, set()
        for batch in batches:
            for a, b, sets in _shingled(batch, k):
                digests = np.array([digest_of(s) for s in sets], dtype=np.int64)
                hit = np.ones(len(sets), dtype=bool)
                for at in _places(digests, bits):
                    hit &= (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
                hit = [bool(x) and len(s) > 0 and not (d in seen or seen.add(d)) for x, s, d in zip(hit, sets, digests.tolist())]
                texts = batch.column("text").slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a), pa.array([len(s) for s in sets], pa.int32()), pa.array(digests),
                        pa.array([parity_bitmap(s) if x else None for s, x in zip(sets, hit)], pa.binary()), texts.take(pa.array([i if x else None for i, x in enumerate(hit)], pa.int64())),
                    ],
                    names=["doc_id", "n", "d", "bitmap", "text"],
                )

    return docs.mapInArrow(run, "doc_id long, n int, d long, bitmap binary, text string")


def counted_pairs(pairs: list[np.ndarray]):
    """A batch a, b, c of pairs and how often each is there, if there are any."""
    pairs = [p for p in pairs if len(p)]
    if pairs:
        each, times = np.unique(np.concatenate(pairs), axis=0, return_counts=True)
        yield pa.RecordBatch.from_pydict({"a": each[:, 0].copy(), "b": each[:, 1].copy(), "c": times})


def near_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """a, b: for each set b at most two others: the hub that it shares most lists with, and its neighbour in most lists.

    entries: h, d, n and own, the share of a set's first shingles that no other set has. A list's hub is the set with
    the least of its own: what copies were made from lacks nothing that they share. Its neighbour stands next before it by size,
    among the entries of an Arrow batch; any choice is right here, and so no task holds a list.
    """

    def run(batches):
        last_h, hub = None, (0, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            h, d, n = (batch.column(c).to_numpy() for c in ("h", "d", "n"))
            n = n.astype(np.int64)
            begins = np.concatenate([[h[0] != last_h], h[1:] != h[:-1]])
            run_of, first = np.cumsum(begins), np.flatnonzero(begins)
            hub_d, hub_n = np.concatenate([[hub[0]], d[first]]), np.concatenate([[hub[1]], n[first]])  # of the list that goes on, and of those that begin
            last_h, hub = h[-1], (hub_d[-1], hub_n[-1])
            at = np.flatnonzero(~begins & near_sizes(n, hub_n[run_of], percent))
            found = [(0, hub_d[run_of[at]], d[at])]
            by_size = np.lexsort((d, n, run_of))
            one, two = by_size[:-1], by_size[1:]
            at = np.flatnonzero((run_of[one] == run_of[two]) & near_sizes(n[one], n[two], percent))
            found.append((1, d[one[at]], d[two[at]]))
            for kind, i, j in found:
                for pairs in counted_pairs([np.stack([i, j], axis=1)]):
                    yield pairs.append_column("kind", pa.array(np.full(pairs.num_rows, kind, np.int32)))

    pairs = entries.repartition("h").sortWithinPartitions("h", "own", "d").mapInArrow(run, "a long, b long, c long, kind int")
    often = pairs.groupBy("kind", "a", "b").agg(F.sum("c").alias("c"))
    best = often.groupBy("kind", "b").agg(F.max(F.struct("c", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def that_survive(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose bitmaps can belong to sets that link; members: d, n, bitmap."""

    def run(batches):
        for batch in batches:
            k = batch.num_rows
            n = np.concatenate([batch.column(c).to_numpy() for c in ("na", "nb")]).astype(np.int64)
            bitmaps = Bitmaps(batch.column("one").to_pylist() + batch.column("two").to_pylist())
            kept = np.flatnonzero(bitmaps.test(np.arange(k), np.arange(k, 2 * k), n, percent)) if k else []
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    one, two = (members.select(F.col("d").alias(x), F.col("n").alias(f"n{x}"), F.col("bitmap").alias(y)) for x, y in (("a", "one"), ("b", "two")))
    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInArrow(run, "a long, b long")


def exact_links(pairs: DataFrame, members: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that link; members: d, text. A pair is one row, so no task grows with a group."""

    def run(batches):
        for batch in batches:
            a, b, one, two = (batch.column(c) for c in ("a", "b", "one", "two"))
            sizes = (pc.binary_length(one).to_numpy(zero_copy_only=False) + pc.binary_length(two).to_numpy(zero_copy_only=False)).tolist()
            for s, e in block_slices(sizes, 4 << 20):
                others, asks = (shingle_sets(*text_buffer(x.slice(s, e - s)), k) for x in (one, two))
                who = b.slice(s, e - s).to_numpy()
                cuts = np.append(np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])), e - s).tolist()
                hits = [p + y for p, q in zip(cuts[:-1], cuts[1:]) for y in InvertedLists(others[p:q], percent).search(asks[p])]
                if hits:
                    yield pa.RecordBatch.from_arrays([x.slice(s, e - s).take(pa.array(hits)) for x in (a, b)], names=["a", "b"])

    one, two = (members.select(F.col("d").alias(x), F.col("text").alias(y)) for x, y in (("a", "one"), ("b", "two")))
    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInArrow(run, "a long, b long")


def prefix_lists(entries: DataFrame) -> DataFrame:
    """entries (h, d and more) with shingle and side; a list over LIST_BLOCK is one h for each pair of its blocks.

    Only the sizes of long lists are joined; they are broadcast where there are at most MOST_BROADCAST.
    """
    long = materialise(entries.groupBy("h").agg(F.count("*").alias("m")).where(F.col("m") > LIST_BLOCK), "long-lists")
    n = long.count()
    whole = entries.withColumn("shingle", F.col("h"))
    if not n:
        return whole.withColumn("side", F.lit(-1))
    marked = whole.join(F.broadcast(long) if n <= MOST_BROADCAST else long, "h", "left").withColumn("blocks", F.ceil(F.coalesce("m", F.lit(1)) / LIST_BLOCK).cast("int"))
    marked = marked.withColumn("block", F.pmod(F.xxhash64("d", "h"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("block") == F.col("other"), -1).otherwise((F.col("block") > F.col("other")).cast("int"))
    unit = F.when(F.col("m").isNull(), F.col("h")).otherwise(F.xxhash64("h", F.least("block", "other"), F.greatest("block", "other")))
    return marked.withColumn("side", side).withColumn("h", unit).drop("m", "blocks", "block", "other")


def crossing_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of different components that survive the bitmap test; entries: h, shingle, side, d, n, component, bitmap, one, two.

    Members of side 0 and 1 are tested only against the other side, those of side -1 against all. one and two are the
    first lists of a set: a pair that is known by them to meet in an earlier list is left to that one.
    """

    def run(batches):
        for some in _runs(batches, "h"):
            if some is None:
                continue
            h, shingle, d, n, side, component = (some.column(c).to_numpy() for c in ("h", "shingle", "d", "n", "side", "component"))
            n, firsts = n.astype(np.int64), [some.column(c).to_numpy() for c in ("one", "two")]
            bitmaps, pairs = Bitmaps(some.column("bitmap").to_pylist()), []

            def test(i, j):
                out = (component[i] != component[j]) & ((side[i] < 0) | (side[i] != side[j]))
                for x in firsts:
                    for y in firsts:
                        out &= (x[i] != y[j]) | (x[i] >= shingle[i])
                i, j = i[out], j[out]
                out = bitmaps.test(i, j, n, percent)
                i, j = d[i[out]], d[j[out]]
                pairs.append(np.stack([np.minimum(i, j), np.maximum(i, j)], axis=1))

            starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            sizes = np.diff(np.append(starts, len(h)))
            for m in range(2, PAIRWISE + 1):
                at = starts[sizes == m]
                i, j = np.triu_indices(m, 1)
                if len(at):
                    test((at[:, None] + i).ravel(), (at[:, None] + j).ravel())
            for s, m in zip(starts[sizes > PAIRWISE].tolist(), sizes[sizes > PAIRWISE].tolist()):
                for i in range(s, s + m - 1):
                    j = np.arange(i + 1, s + m)
                    test(np.full(len(j), i), j)
            for batch in counted_pairs(pairs):
                yield batch.select(["a", "b"])

    return entries.repartition("h").sortWithinPartitions("h").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row for each row of docs: the key, n_shingles and component_id, the smallest key reachable by links.

    Words are stretches between ASCII white space, A-Z lower-cased; a text of fewer than k words is one shingle; null
    texts, empty texts and texts without words have none and link with nothing. Keys are long; a row with a null key
    gets its own n_shingles and a null component. Rows that share a key count as one document per distinct set.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kept = materialise(in_enough_lists(of_several_sets(short_lists(rows.where("doc_id IS NOT NULL"), k, percent)), percent), "short-lists")
    wanted = docs.sparkSession.sparkContext.broadcast(digest_filter(kept))
    read = materialise(read_again(rows, wanted, k), "sets")
    members = materialise(read.where("text IS NOT NULL").groupBy("d").agg(F.first("n").alias("n"), F.first("bitmap").alias("bitmap"), F.first("text").alias("text")), "members")
    each = F.explode("hs").alias("h")
    size = F.col("n") - F.ceil(F.col("n") * percent / 100) + F.greatest(F.floor(F.col("n") / 16), F.lit(1))
    own = (1 - F.size("hs") / size).cast("float").alias("own")
    near = that_survive(near_pairs(kept.select(each, "d", "n", own), percent), members, percent)
    first = materialise(exact_links(near, members, k, percent), "links")
    joined = connected_components(first, "near-copies")
    labelled = kept.join(joined.withColumnRenamed("node", "d"), "d", "left").select("d", "n", F.coalesce("component", "d").alias("component"), "hs")
    left = materialise(in_enough_lists(of_several_components(labelled.select(each, "d", "n", "component")), percent, "component"), "crossing-lists")
    firsts = F.slice(F.array_sort("hs"), 1, 2)
    about = left.select("d", "n", "component", "hs", firsts.alias("firsts")).join(members.select("d", "bitmap"), "d")
    about = about.select("d", "n", "component", "bitmap", F.col("firsts")[0].alias("one"), F.get("firsts", F.size("firsts") - 1).alias("two"), each)
    tested = prefix_lists(about)
    second = exact_links(materialise(crossing_pairs(tested, percent), "pairs"), members, k, percent)
    found = connected_components(first.unionByName(second), "near-duplicates").withColumnRenamed("node", "d")
    one = read.where("n > 0 AND doc_id IS NOT NULL").groupBy("d").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    groups = one.join(found, "d", "left").withColumn("root", F.coalesce("component", "d"))
    least = groups.where("component IS NOT NULL").groupBy("root").agg(F.min("least").alias("component_id"))
    # only sets of several documents or of a component need an answer other than the document itself
    answers = groups.where("component IS NOT NULL OR copies > 1").join(least, "root", "left").select("d", F.coalesce("component_id", "least").alias("component_id"))
    every = read.select("doc_id", "n", "d").join(answers, "d", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return every.select(F.col("doc_id").alias(key), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    small_batches(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
), each AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM each a JOIN each b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 75 * (na + nb - c)),
reach(d, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.d, links.b FROM reach JOIN links ON reach.m = links.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(reach.m) AS component_id FROM s JOIN reach ON s.doc_id = reach.d GROUP BY s.doc_id, s.s
"""
