"""Fingerprints by context-triggered piecewise hashing, compared by edit distance.

A rolling hash over seven bytes ends a chunk wherever it meets a block size's condition, so that boundaries depend on what
stands around them and an edit changes the chunks near it only. Block sizes are 3, 6, 12, ...; a boundary of one is a boundary
of all smaller ones. A text's block size is the smallest that has at most 64 boundaries. Every chunk becomes one of 64
characters by a polynomial hash of its bytes; the fingerprint is ``size:signature:signature at twice the size``. What follows
the last boundary is a chunk, too, so the whole text counts, however long. Fingerprints are compared where their block sizes are
equal or one is twice the other: likeness is 1 less the edits as a share of the longer signature.

All texts of an Arrow batch are hashed as one array of bytes with gaps of zeros between them, in blocks of a megabyte; the
chunks' hashes are differences of a running polynomial.

Each document is also compared with the one that comes next by id, and with a copy of itself whose end is replaced by the
beginning of that one. Texts are range-partitioned by id and sorted, so that neighbours are met in one task; each partition's
first and last texts are written out and the pairs across partitions are made from those.

Documents that repeat an id come in order of a hash of their texts and then of the texts; one without an id comes last. A null text is an empty
one, with the fingerprint ``3::``; two empty signatures are alike (1). A single document is its own next one. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexisift.llm.common import block_slices, materialise, small_batches, table

WINDOW = 7
SMALLEST = 3
MOST_BOUNDARIES = 64
BLOCK = 1 << 20
#: Bytes of text that are hashed at once.
AT_ONCE = 16 << 20
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
#: Odd multipliers of the two hashes and of the last mixing, and the inverse of the polynomial's, modulo 2^64.
TURN, RATIO, MIX = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xBF58476D1CE4E5B9
INVERSE = pow(RATIO, -1, 1 << 64)
_MASK = (1 << 64) - 1
_powers: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of RATIO and of its inverse for a block's places."""
    if not _powers:
        for base in (RATIO, INVERSE):
            each = np.full(BLOCK + 1, base, np.uint64)
            each[0] = 1
            _powers.append(np.multiply.accumulate(each))
    return _powers[0], _powers[1]


def _levels(data: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Places from start to end, after which a chunk of the smallest size may end, and how often their size can be doubled."""
    low = max(0, start - WINDOW + 1)
    rows = np.concatenate([np.zeros(WINDOW - 1 - (start - low), np.uint8), data[low:end]]).astype(np.uint32)
    n, rolled = end - start, np.zeros(end - start, np.uint32)
    for j in range(WINDOW):  # a byte j places back has been turned j times
        rolled ^= rows[WINDOW - 1 - j : WINDOW - 1 - j + n] << np.uint32(5 * j % 32)
        rolled += rows[WINDOW - 1 - j : WINDOW - 1 - j + n] * np.uint32(2 * (WINDOW - j) + 1)
    mixed = (((rolled.astype(np.uint64) + np.uint64(1)) * np.uint64(TURN)) >> np.uint64(34)).astype(np.uint32)  # 30 well mixed bits
    at = np.flatnonzero(mixed % np.uint32(SMALLEST) == 0)
    third = (mixed[at] // np.uint32(SMALLEST)).astype(np.int64) | (1 << 30)
    return at + start, np.log2(third & -third).astype(np.int8)


def _prefixes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The running polynomial before each place (ascending), times the inverse power of it: (P(place) * RATIO^-place, as two arrays)."""
    powers, inverses = _tables()
    sums, scales = np.zeros(len(places), np.uint64), np.ones(len(places), np.uint64)
    done, scale, unscale = 0, 1, 1
    for start in range(0, max(len(data), 1), BLOCK):
        part = data[start : start + BLOCK].astype(np.uint64) + np.uint64(1)
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * powers[: len(part)], dtype=np.uint64)])
        last = start + BLOCK >= len(data)
        own = slice(np.searchsorted(places, start), len(places) if last else np.searchsorted(places, start + BLOCK))
        inside = places[own] - start
        sums[own] = np.uint64(done) + np.uint64(scale) * run[inside]
        scales[own] = np.uint64(unscale) * inverses[inside]
        done = (done + scale * int(run[-1])) & _MASK
        scale, unscale = scale * int(powers[-1]) & _MASK, unscale * int(inverses[-1]) & _MASK
    return np.stack([sums, scales])


def _signatures(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, boundaries: np.ndarray) -> list[str]:
    """A signature for each text from its boundaries: ascending places after which a chunk ends, and the texts that own them."""
    filled = ends > starts
    open_end = filled.copy()  # texts whose last chunk isn't ended by a boundary
    if len(boundaries):
        last = np.full(len(starts), -1)
        last[owner] = boundaries  # the last one of each stays
        open_end &= last != ends - 1
    stops = np.concatenate([boundaries + 1, ends[open_end]])
    whose = np.concatenate([owner, np.flatnonzero(open_end)])
    order = np.lexsort((stops, whose))
    stops, whose = stops[order], whose[order]
    begins = np.empty_like(stops)
    begins[1:] = stops[:-1]
    first = np.ones(len(stops), bool)
    first[1:] = whose[1:] != whose[:-1]
    begins[first] = starts[whose[first]]
    places, back = np.unique(np.concatenate([begins, stops]), return_inverse=True)
    sums, scales = _prefixes(data, places)
    at, to = back[: len(stops)], back[len(stops) :]
    hashed = (sums[to] - sums[at]) * scales[at]
    mixed = hashed ^ (hashed >> np.uint64(31))
    letters = ALPHABET[((mixed * np.uint64(MIX)) >> np.uint64(58)).astype(np.int64)].tobytes().decode()
    cuts = np.searchsorted(whose, np.arange(len(starts) + 1))
    return [letters[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _hash_together(texts: Sequence[bytes]) -> list[str]:
    gap = bytes(WINDOW - 1)
    data = np.frombuffer(gap + gap.join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + WINDOW - 1) - sizes
    ends = starts + sizes
    found = [_levels(data, a, min(a + BLOCK, len(data))) for a in range(0, len(data), BLOCK)]
    at, level = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]).astype(np.int64)
    owner = np.searchsorted(starts, at, "right") - 1
    inside = (owner >= 0) & (at < ends[owner])
    at, level, owner = at[inside], level[inside], owner[inside]
    counts = np.bincount(owner * 32 + level, minlength=32 * len(texts)).reshape(-1, 32)
    above = counts[:, ::-1].cumsum(1)[:, ::-1]  # boundaries of each size
    size = np.argmax(above <= MOST_BOUNDARIES, axis=1)
    size[above[:, 31] > MOST_BOUNDARIES] = 31
    one, two = level >= size[owner], level >= np.minimum(size[owner] + 1, 31)
    first = _signatures(data, starts, ends, owner[one], at[one])
    second = _signatures(data, starts, ends, owner[two], at[two])
    return [f"{SMALLEST << int(s)}:{a}:{b}" for s, a, b in zip(size, first, second, strict=True)]


def fingerprints(texts: Sequence[str]) -> list[str]:
    """A fingerprint for each text; it depends on the text alone."""
    data, out = [t.encode("utf-8", "surrogatepass") for t in texts], []
    for a, b in block_slices([len(d) for d in data], AT_ONCE):
        out += _hash_together(data[a:b])
    return out


def _alike(a: Column, b: Column) -> Column:
    longer = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longer)


def likeness(a: Column, b: Column) -> Column:
    """How alike two fingerprints are, 0 to 1; 0 if their block sizes aren't compatible."""
    part = lambda c, i: F.split_part(c, F.lit(":"), F.lit(i))
    size, other = part(a, 1).cast("long"), part(b, 1).cast("long")
    return (
        F.when(size == other, F.greatest(_alike(part(a, 2), part(b, 2)), _alike(part(a, 3), part(b, 3))))
        .when(size == 2 * other, _alike(part(a, 2), part(b, 3)))
        .when(2 * size == other, _alike(part(a, 3), part(b, 2)))
        .otherwise(0.0)
    )


def edited(text: str, following: str) -> str:
    """A text whose last quarter of code points is replaced by the first as many of another."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_SEEN = "part int, kind string, key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string, text string"
_NAMES = [c.split()[0] for c in _SEEN.split(", ")]


def _of_chain(chain: Sequence[tuple]) -> list[tuple]:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint) of each (key, text) but the last, with its next one."""
    own = fingerprints([t for _, t in chain])
    made = [edited(a, b) for (_, a), (_, b) in zip(chain, chain[1:], strict=False)]
    hashes = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in made]
    return [(key, len(t), *r) for (key, t), *r in zip(chain, hashes, own, fingerprints(made), own[1:], strict=False)]


def _rows(rows: Sequence[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _NAMES)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted partition: a row for each document but the last, with its next one, and the first and last texts."""
    before = None
    for batch in batches:
        part = batch.column(2)[0].as_py() if batch.num_rows else None
        keys, texts = batch.column(0).to_pylist(), batch.column(1)
        for a, b in block_slices([len(t.as_buffer() or b"") if t.is_valid else 0 for t in texts], AT_ONCE // 4):
            own = [(k, t.as_py() or "") for k, t in zip(keys[a:b], texts[a:b], strict=True)]
            if before is None:
                yield _rows([(part, "first", None, None, None, None, None, None, own[0][1])])
            chain = ([before] if before else []) + own
            if len(chain) > 1:
                yield _rows([(part, "row", *r, None) for r in _of_chain(chain)])
            before = own[-1]
    if before:
        yield _rows([(part, "last", before[0], None, None, None, None, None, before[1])])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text, following in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            yield _rows([(None, "row", *r, None) for r in _of_chain([(key, text), (None, following)])])


def with_next(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """For every document: the key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    key: a whole number; the next document is that with the next larger one, after the last comes the first.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.asc_nulls_last("key"), F.xxhash64("text"), F.col("text")]
    sorted_rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    seen = materialise(sorted_rows.mapInArrow(_neighbours, _SEEN), "neighbours")
    ends = seen.where("kind <> 'row'")
    parts = ends.where("kind = 'last'").select("part")  # as many rows as partitions
    following = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"))
    pairs = ends.where("kind = 'last'").select("part", "key", "text").join(following, "part").join(ends.where("kind = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text")), "next_part")
    every = seen.where("kind = 'row'").unionByName(pairs.select("key", "text", "next_text").mapInArrow(_across, _SEEN))
    return every.select(
        F.col("key").cast(df.schema[key].dataType).alias(key), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op13_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprints of all documents and of their edited texts, and how alike they are."""
    small_batches(spark)
    return with_next(table(spark, sf_dir, "documents"))
