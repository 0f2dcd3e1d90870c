"""Byte-level BPE encoding and decoding over Arrow batches with the tokenizers library.

``encode`` and ``decode`` are mapInArrow stages: no shuffle, one pass, memory bounded by a slice of a
batch. The rank file is read on the driver and broadcast (its size is that of the vocabulary); each
Python worker builds one tokenizer from it.

A match of the split pattern never crosses the place before a space that follows a non-space, or between a letter and
a mark. So texts are cut there, and each worker remembers the ids of the pieces it met: a table of 64-bit hashes in numpy
finds the known ones of a slice at once, only the others reach the library. Those that are one match for certain (a space
or none, and then Latin letters, digits or marks) are mapped to byte characters here and go to the merges as words; all
others are joined to one text. Ids are cut again by the lengths of their tokens. The ids found are decoded and
compared with the slice's bytes, so equal hashes of different pieces can't go unseen; a text that differs is encoded
whole, as all are with any other pattern.
"""

from __future__ import annotations

import base64
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexisift.llm.common import block_slices, small_batches, unused, without
from lexisift.llm.shingles import stretch_hashes, text_buffer

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SLICE_BYTES = 1 << 20
#: Pieces that a worker remembers; when there are more it begins anew.
REMEMBERED = 1_000_000
#: A byte that no UTF-8 text has.
SEPARATOR = 0xFF
#: Kinds of bytes: ASCII letters, digits and marks, first bytes of letters from U+00C0 to U+027F, further bytes of a character.
LETTER, DIGIT, MARK, LEAD, TAIL = range(1, 6)
KIND = np.zeros(256, dtype=np.uint8)
KIND[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = LETTER
KIND[[*b"0123456789"]] = DIGIT
KIND[[b for b in range(33, 127) if not chr(b).isalnum()]] = MARK
KIND[0xC3:0xCA] = LEAD
KIND[0x80:0xC0] = TAIL
#: Second bytes by which a character of that range may be none: those of the signs of times and division.
NO_LETTER = np.zeros(256, dtype=bool)
NO_LETTER[[0x97, 0xB7]] = True


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves; the others get the code points from 256 on, in order.
    """
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts that the merges of lower rank leave of a token."""
    parts, most = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], most), i) for i in range(len(parts) - 1))
        if rank >= most:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], b"".join(parts[1:])


class Vocabulary:
    """Ranks, split pattern and merges, packed: tokens by id, and for each merge the ids of its two parts."""

    def __init__(self, path: str = RANKS, pattern: str = public_tokenizers.PATTERN):
        ranks = read_ranks(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.path, self.pattern, self.flat = path, pattern, b"".join(tokens)
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int32)
        self.merges = np.array([[ranks[x] for x in last_merge(t, ranks)] for t in tokens if len(t) > 1], dtype=np.int32)

    def tokenizer(self):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        shown, ends = byte_characters(), np.cumsum(self.lengths).tolist()
        names = ["".join(shown[b] for b in self.flat[e - n : e]) for e, n in zip(ends, self.lengths.tolist())]
        vocab = {name: i for i, name in enumerate(names) if name}
        made = Tokenizer(models.BPE(vocab=vocab, merges=[(names[i], names[j]) for i, j in self.merges.tolist()]))
        made.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(self.pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        return made


class FileVocabulary:
    """A byte-level vocabulary file of the tokenizers library, as its text; special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            self.path, self.text = path, f.read()
        self.pattern = file_pattern(json.loads(self.text))
        value = {c: b for b, c in enumerate(byte_characters())}
        names = sorted(Tokenizer.from_str(self.text).get_vocab().items(), key=lambda x: x[1])
        tokens = [b""] * (names[-1][1] + 1)
        for name, i in names:
            tokens[i] = bytes([value[c] for c in name]) if all(c in value for c in name) else name.encode()
        self.flat, self.lengths = b"".join(tokens), np.array([len(t) for t in tokens], dtype=np.int32)

    def tokenizer(self):
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.text)
        made.encode_special_tokens = True
        return made


def file_pattern(made: dict) -> str | None:
    """The split pattern of a tokenizer's file, if it is one pattern with nothing before it; else None."""
    steps = made.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    if made.get("normalizer") or any(s.get("add_prefix_space") for s in steps):
        return None
    splits = [s for s in steps if s.get("type") == "Split"]
    levels = [s for s in steps if s.get("type") == "ByteLevel"]
    if len(steps) == 1 and levels and levels[0].get("use_regex", True):
        return public_tokenizers.PATTERN  # what the library splits by where it is told to split by itself
    if len(steps) == 2 and splits and levels and not levels[0].get("use_regex", True):
        return splits[0]["pattern"].get("Regex")
    return None


def grown(array: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
    """The array, or a longer one, with more written at a place."""
    if at + len(more) > len(array):
        array = np.concatenate([array[:at], np.zeros(at + 2 * len(more), array.dtype)])
    array[at : at + len(more)] = more
    return array


class Remembered:
    """Ids of pieces by their hashes: an open table with flat ids, of bounded size."""

    def __init__(self, most: int, dtype: np.dtype):
        self.most, self.dtype = most, dtype
        self.clear(0)

    def clear(self, least: int) -> None:
        size = 1 << int(2 * max(self.most, least)).bit_length()
        self.keys, self.value = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int32)
        self.count, self.used = 0, 0
        self.offset, self.size, self.ids = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32), np.zeros(1 << 16, self.dtype)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1."""
        out, todo = np.full(len(hashes), -1, dtype=np.int32), np.arange(len(hashes))
        mask = np.uint64(len(self.keys) - 1)
        slot = hashes & mask
        while len(todo):
            there = self.keys[slot]
            hit = there == hashes[todo]
            out[todo[hit]] = self.value[slot[hit]]
            on = ~hit & (there != 0)
            todo, slot = todo[on], (slot[on] + np.uint64(1)) & mask
        return out

    def add(self, hashes: np.ndarray, ids: list[bytes]) -> None:
        """Distinct hashes that aren't known yet."""
        sizes = np.array([len(x) for x in ids], dtype=np.int64) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(ids), dtype=self.dtype)
        self.ids = grown(self.ids, self.used, flat)
        self.offset = grown(self.offset, self.count, self.used + np.cumsum(sizes) - sizes)
        self.size = grown(self.size, self.count, sizes)
        numbers = np.arange(self.count, self.count + len(hashes), dtype=np.int32)
        self.used, self.count = self.used + len(flat), self.count + len(hashes)
        mask = np.uint64(len(self.keys) - 1)
        todo, slot = np.arange(len(hashes)), hashes & mask
        while len(todo):
            free = np.flatnonzero(self.keys[slot] == 0)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.value[slot[won]] = hashes[todo[won]], numbers[todo[won]]
            on = np.ones(len(todo), dtype=bool)
            on[won] = False
            todo, slot = todo[on], (slot[on] + np.uint64(1)) & mask


class Encoder:
    """Encodes texts to little-endian unsigned ids as bytes, remembering the ids of pieces met lately."""

    def __init__(self, vocabulary: Vocabulary | FileVocabulary, dtype: str = "<u4", remembered: int = REMEMBERED):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype = vocabulary.tokenizer(), np.dtype(dtype)
        self.merges = Tokenizer(self.tokenizer.model)  # without a split: each word given is one match
        self.by_piece = vocabulary.pattern == public_tokenizers.PATTERN
        self.shown = {**dict(enumerate(byte_characters())), SEPARATOR: " "}
        self.flat, self.lengths = np.frombuffer(vocabulary.flat, dtype=np.uint8), vocabulary.lengths.astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.known = Remembered(remembered, self.dtype)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def cut_again(self, found, pieces: list[bytes]) -> list[bytes] | None:
        """The ids of each of the pieces that were encoded one after another, by the lengths of their tokens."""
        ids = np.array(found.ids, dtype=self.dtype)
        ends, stops = np.cumsum(self.lengths[ids]), np.cumsum([len(p) for p in pieces])
        if not len(ends) or ends[-1] != stops[-1] or (ends[last := np.searchsorted(ends, stops)] != stops).any():
            return None
        raw, cuts = ids.tobytes(), ((last + 1) * self.dtype.itemsize).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]

    def pieces(self, pieces: list[bytes], single: np.ndarray) -> list[bytes]:
        """The ids of each piece; single: which are one match of the split pattern."""
        found, single = [b""] * len(pieces), single.tolist()
        words = [p for p, x in zip(pieces, single) if x]
        joined = [i for i, (p, x) in enumerate(zip(pieces, single)) if not x and p[0] == 32 and not p.decode()[-1].isspace()]
        took = set(joined)
        alone = [i for i, x in enumerate(single) if not x and i not in took]
        if words:
            shown = bytes([SEPARATOR]).join(words).decode("latin-1").translate(self.shown).split(" ")
            ids = self.cut_again(self.merges.encode_batch_fast([shown], is_pretokenized=True, add_special_tokens=False)[0], words) or self.whole([p.decode() for p in words])
            for i, x in zip([i for i, x in enumerate(single) if x], ids):
                found[i] = x
        if joined:
            own = [pieces[i] for i in joined]
            ids = self.cut_again(self.tokenizer.encode_batch_fast([b"".join(own).decode()], add_special_tokens=False)[0], own) or self.whole([p.decode() for p in own])
            for i, x in zip(joined, ids):
                found[i] = x
        for i, x in zip(alone, self.whole([pieces[i].decode() for i in alone])):
            found[i] = x
        return found

    def cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where pieces begin: each text, each space after what is no white space for certain, each mark after a letter."""
        kind = KIND[data]
        before = kind[:-1]
        space, mark = np.flatnonzero(data[1:] == 32) + 1, np.flatnonzero((kind[1:] == MARK) & ((before == LETTER) | (before == TAIL))) + 1
        sure = (kind[space - 1] == LETTER) | (kind[space - 1] == DIGIT) | (kind[space - 1] == MARK)
        wide = np.flatnonzero(kind[space - 1] == TAIL)
        if len(wide):
            at = space[wide]
            # all white space beyond ASCII is two bytes after 0xC2, or three after 0xE1 to 0xE3
            sure[wide] = (data[at - 2] != 0xC2) & ~((data[np.maximum(at - 3, 0)] >= 0xE1) & (data[np.maximum(at - 3, 0)] <= 0xE3))
        tail = kind[mark - 1] == TAIL
        if tail.any():
            mark = mark[~tail | (kind[mark - 2] == LEAD) & ~NO_LETTER[data[mark - 1]]]
        out = np.concatenate([bounds[:-1][np.diff(bounds) > 0], space[sure], mark])
        out.sort()
        return out[np.concatenate([[True], out[1:] != out[:-1]])]

    def single(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Which stretches are a space or none and then only letters, only digits or only marks."""
        kind = KIND[data]
        inner = starts + (data[starts] == 32)
        letter = kind == LETTER
        pair = (kind[:-1] == LEAD) & (kind[1:] == TAIL) & ~NO_LETTER[data[1:]]
        letter[:-1] |= pair
        letter[1:] |= pair
        out = np.zeros(len(starts), dtype=bool)
        for flags in (letter, kind == DIGIT, kind == MARK):
            sums = np.concatenate([[0], np.cumsum(flags)])
            out |= sums[stops] - sums[inner] == stops - inner
        return out & (stops > inner)

    def encoded(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of consecutive pieces, and how many each has."""
        hashes = np.maximum(stretch_hashes(data, cuts, np.append(cuts[1:], len(data))), np.uint64(1))
        at = self.known.find(hashes)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            first = missing[first]
            if self.known.count + len(new) > self.known.most:
                new, first = np.unique(hashes, return_index=True)
                self.known.clear(len(new))
            raw, starts, stops = data.tobytes(), cuts[first], np.append(cuts[1:], len(data))[first]
            self.known.add(new, self.pieces([raw[s:e] for s, e in zip(starts.tolist(), stops.tolist())], self.single(data, starts, stops)))
            at = self.known.find(hashes)
        n = self.known.size[at].astype(np.int64)
        stops = np.cumsum(n)
        return self.known.ids[np.repeat(self.known.offset[at] - stops + n, n) + np.arange(stops[-1])], n

    def __call__(self, texts: pa.Array | list[str]) -> list[bytes]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        if not self.by_piece:
            return self.whole(column.to_pylist())
        data, bounds = text_buffer(column)
        if not len(data):
            return [b""] * len(column)
        cuts = self.cuts(data, bounds)
        parts, s = [], 0
        while s < len(cuts):  # a long text is taken in stretches of pieces
            e = max(int(np.searchsorted(cuts, cuts[s] + SLICE_BYTES)), s + 1)
            end = int(cuts[e]) if e < len(cuts) else len(data)
            parts.append(self.encoded(data[cuts[s] : end], cuts[s:e] - cuts[s]))
            s = e
        ids, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        cut_at = np.searchsorted(cuts, bounds)
        id_at = np.concatenate([[0], np.cumsum(counts)])[cut_at].tolist()
        raw, w = ids.tobytes(), self.dtype.itemsize
        out = [raw[a * w : b * w] for a, b in zip(id_at[:-1], id_at[1:])]
        if not self.same(ids, data):
            ends = [b""] * len(column)
            for i, x in enumerate(out):
                own = data[bounds[i] : bounds[i + 1]]
                ends[i] = x if self.same(np.frombuffer(x, dtype=self.dtype), own) else self.whole([own.tobytes().decode()])[0]
            return ends
        return out

    def same(self, ids: np.ndarray, data: np.ndarray) -> bool:
        """Whether ids decode to the bytes."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        if (ends[-1] if len(ends) else 0) != len(data):
            return False
        for a in range(0, len(ids), 1 << 20):
            b = min(a + (1 << 20), len(ids))
            begin, part = ends[a] - n[a], n[a:b]
            if not np.array_equal(self.flat[np.repeat(self.starts[ids[a:b]] - (ends[a:b] - begin) + part, part) + np.arange(ends[b - 1] - begin)], data[begin : ends[b - 1]]):
                return False
        return True


class Decoder:
    """Reverses the byte table: ids to the bytes of their tokens, by flat lookups."""

    def __init__(self, vocabulary: Vocabulary):
        value, shown = {c: b for b, c in enumerate(byte_characters())}, byte_characters()
        names = "".join(shown[b] for b in vocabulary.flat)  # tokens as the vocabulary shows them
        self.flat = np.frombuffer(bytes(value[c] for c in names), dtype=np.uint8)
        self.lengths = vocabulary.lengths.astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        n = self.lengths[ids]
        ends = np.cumsum(n)
        return self.flat[np.repeat(self.starts[ids] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]

    def offsets(self, ids: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of the characters that each token touches; parts of one character share it."""
        begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        return np.maximum(begun[np.minimum(starts + 1, len(data))] - 1, 0), begun[ends]


_made: dict = {}


def in_worker(shared, kind, *args):
    """One encoder or decoder for each broadcast vocabulary and Python worker."""
    key = (shared.value.path, shared.value.pattern, kind, *args)
    if key not in _made:
        _made[key] = kind(shared.value, *args)
    return _made[key]


def share(spark: SparkSession, path: str = RANKS, pattern: str = public_tokenizers.PATTERN):
    """Broadcast a vocabulary, from ranks or from a .json file of the tokenizers library, which has its own pattern."""
    return spark.sparkContext.broadcast(FileVocabulary(path) if path.endswith(".json") else Vocabulary(path, pattern))


def encode(df: DataFrame, text: str = "text", ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN, shared=None) -> DataFrame:
    """Add ``n_tokens`` long and ``ids_le`` binary (little-endian unsigned 32-bit ids) of a text column.

    No special token is known: their strings are ordinary text. A null text counts as empty: no ids.
    Columns of df named like an output are replaced; all others, repeated rows and ties are kept.
    """
    shared = shared or share(df.sparkSession, ranks, pattern)
    whole = unused(df, "text")
    rows = without(df.withColumn(whole, F.coalesce(df[text].cast("string"), F.lit(""))), ["n_tokens", "ids_le"])
    kept = [f for f in rows.schema.fields if f.name != whole]
    out = T.StructType([*kept, T.StructField("n_tokens", T.LongType()), T.StructField("ids_le", T.BinaryType())])

    def run(batches):
        encoder = in_worker(shared, Encoder)
        for batch in batches:
            texts = batch.column(whole)
            for a, b in block_slices(pc.binary_length(texts).to_pylist(), SLICE_BYTES):
                ids = encoder(texts.slice(a, b - a))
                cols = [batch.column(f.name).slice(a, b - a) for f in kept]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=out.names
                )

    return rows.mapInArrow(run, out)


def decode(df: DataFrame, ids: str = "ids_le", ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN, shared=None, offsets: bool = False) -> DataFrame:
    """Add ``decoded`` binary, the bytes of the ids, and with offsets ``char_starts`` and ``char_ends`` array<int>.

    Decoding is by bytes, so a character whose bytes are split over tokens is whole again; cast ``decoded``
    to string for text. Null ids give empty bytes. Columns of df named like an output are replaced.
    """
    shared = shared or share(df.sparkSession, ranks, pattern)
    rows = without(df, ["decoded", "char_starts", "char_ends"])
    more = [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("char_starts", "char_ends")] if offsets else []
    out = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType()), *more])

    def run(batches):
        decoder = in_worker(shared, Decoder)
        for batch in batches:
            values = batch.column(ids)
            for a, b in block_slices([x or 0 for x in pc.binary_length(values).to_pylist()], SLICE_BYTES):
                each = [np.frombuffer(x or b"", dtype="<u4") for x in values.slice(a, b - a).to_pylist()]
                data = [decoder(x) for x in each]
                cols = [batch.column(c).slice(a, b - a) for c in batch.schema.names] + [pa.array([x.tobytes() for x in data], pa.binary())]
                if offsets:
                    pairs = [decoder.offsets(x, d) for x, d in zip(each, data)]
                    cols += [pa.array([p[i] for p in pairs], pa.list_(pa.int32())) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(cols, names=out.names)

    return rows.mapInArrow(run, out)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests: one pass, no shuffle."""
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    shared = share(spark)
    rows = decode(encode(docs, shared=shared).select("doc_id", "n_tokens", "ids_le"), shared=shared)
    return rows.select("doc_id", "n_tokens", F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
