"""Media columns: baseline JPEG in a binary column, written and read with numpy.

Writing: every byte of a payload becomes one 8x8 block of a grey image whose DC coefficient, at quantiser 8,
is that byte less 128. Such a block is flat, with exactly the byte's value, so the picture's 1/8 thumbnail
is the payload: the format's unit is the block. A picture is 192 blocks wide, a row of blocks is a restart
interval, and a payload longer than a picture may be high continues in another picture right after it.

Reading: a general decoder of baseline Huffman scans down to the DC-only luminance thumbnail. Markers are
parsed picture by picture; the scans of a whole slice of rows are decoded together, one lane for each
restart interval, all lanes of one layout in step. AC codes are read to keep place and discarded.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexisift.llm.common import block_slices, materialise, small_batches, table, without

WIDTH = 192
HIGHEST = 8191  # rows of blocks: 65,528 pixels, the most below the format's 65,535
SLICE_BYTES = 2 << 20

#: The DC luminance code lengths of the JPEG standard's Annex K, table K.3; symbols 0 to 11.
DC_COUNTS = [0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]


def canonical(counts: list[int], symbols: list[int]) -> list[tuple[int, int, int]]:
    """(code, length, symbol) of a Huffman table."""
    codes, code, at = [], 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            codes.append((code, length, symbols[at]))
            code, at = code + 1, at + 1
        code <<= 1
    return codes


_DC = canonical(DC_COUNTS, list(range(12)))
_CODE, _LENGTH = (np.array([c[i] for c in _DC], dtype=np.uint32) for i in (0, 1))
_SIZE = np.array([int(x).bit_length() for x in range(256)], dtype=np.uint8)


def _head(rows: int) -> bytes:
    def segment(marker: int, body: bytes) -> bytes:
        return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body

    return b"".join(
        [
            b"\xff\xd8",
            segment(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0"),
            segment(0xDB, b"\0" + bytes([8] + [1] * 63)),
            segment(0xC0, struct.pack(">BHHB", 8, rows * 8, WIDTH * 8, 1) + b"\x01\x11\0"),
            segment(0xC4, b"\0" + bytes(DC_COUNTS) + bytes(range(12))),
            segment(0xC4, b"\x10" + bytes([1] + [0] * 15) + b"\0"),  # one AC code: "0" ends a block
            segment(0xDD, struct.pack(">H", WIDTH)),
            segment(0xDA, b"\x01\x01\0\0\x3f\0"),
        ]
    )


def write_pictures(payloads: list[bytes]) -> list[bytes]:
    """Each payload, a multiple of 192 bytes, as one JPEG stream; an empty one as empty bytes."""
    rows_of = [len(p) // WIDTH for p in payloads]
    if not sum(rows_of):
        return [b"" for _ in payloads]
    grid = np.frombuffer(b"".join(payloads), dtype=np.uint8).reshape(-1, WIDTH).astype(np.int16) - 128
    step = np.diff(grid, axis=1, prepend=np.zeros((len(grid), 1), np.int16))
    size = _SIZE[np.abs(step)]
    extra = np.where(step < 0, step + (1 << size.astype(np.int16)) - 1, step).astype(np.uint32)
    value = ((_CODE[size] << size) | extra) << 1  # the last bit is the AC code
    length = _LENGTH[size].astype(np.int64) + size + 1
    ends = np.cumsum(length, axis=1)
    n_bytes = (ends[:, -1] + 7) >> 3
    first = np.cumsum(n_bytes) - n_bytes
    at = (first[:, None] << 3) + ends - length
    word = value << (32 - (at & 7) - length).astype(np.uint32)
    total = int(n_bytes.sum())
    data = np.zeros(total + 4, dtype=np.float64)
    where = (at >> 3).ravel()
    for i in range(3):
        data += np.bincount(where + i, weights=((word >> (24 - 8 * i)) & 0xFF).ravel(), minlength=total + 4)[: total + 4]
    data = data[:total].astype(np.uint8)
    last = first + n_bytes - 1
    data[last] |= ((1 << (n_bytes * 8 - ends[:, -1])) - 1).astype(np.uint8)  # ones fill the last byte
    # a zero after each 255, and two bytes for a restart marker after each row
    full = data == 0xFF
    row = np.repeat(np.arange(len(grid)), n_bytes)
    place = np.arange(total) + np.cumsum(full) - full + 2 * row
    out = np.zeros(total + int(full.sum()) + 2 * len(grid), dtype=np.uint8)
    out[place] = data
    after = place[last] + full[last] + 1
    out[after] = 0xFF
    row_in = np.concatenate([np.arange(n) for n in rows_of]) % HIGHEST
    out[after + 1] = 0xD0 + row_in % 8
    bounds = np.concatenate([[0], after + 2])
    stream, made, r = out.tobytes(), [], 0
    for n in rows_of:
        parts = []
        for a in range(0, n, HIGHEST):
            k = min(HIGHEST, n - a)
            parts += [_head(k), stream[bounds[r + a] : bounds[r + a + k] - 2], b"\xff\xd9"]
        made.append(b"".join(parts))
        r += n
    return made


class Picture:
    """What the markers say of one picture; raises ValueError where it isn't baseline."""

    def __init__(self, data: bytes, at: int):
        self.restart, self.quant, self.tables, self.components, at = 0, {}, {}, None, at + 2
        while True:
            if at + 4 > len(data) or data[at] != 0xFF:
                raise ValueError("broken markers")
            marker = data[at + 1]
            if marker == 0xFF:
                at += 1
                continue
            size = struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.quant[body[0] & 15] = struct.unpack_from(">H" if wide else ">B", body, 1)[0]
                    body = body[65 + 64 * wide :]
            elif marker == 0xC0:
                bits, self.height, self.width, n = struct.unpack_from(">BHHB", body)
                if bits != 8 or not self.height or not self.width or len(body) < 6 + 3 * n:
                    raise ValueError("not 8 bits a sample")
                self.components = {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)}
                self.order = list(self.components)
            elif 0xC1 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                raise ValueError("not baseline")
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    self.tables[body[0]] = (bytes(body[1:17]), bytes(body[17 : 17 + n]))
                    body = body[17 + n :]
            elif marker == 0xDD:
                self.restart = struct.unpack(">H", body)[0]
            elif marker == 0xDA:
                break
        n = body[0]
        if self.components is None or n != len(self.components):
            raise ValueError("not one interleaved scan")
        used = [(body[1 + 2 * i], body[2 + 2 * i]) for i in range(n)]
        single = n == 1
        h_max, v_max = (1, 1) if single else (max(c[0] for c in self.components.values()), max(c[1] for c in self.components.values()))
        h_luma, v_luma, q = self.components[used[0][0]]
        if single:
            h_luma = v_luma = 1
        self.luma, self.q = (h_luma, v_luma), self.quant[q]
        self.mcus = (-(-self.width // (8 * h_max)), -(-self.height // (8 * v_max)))
        # the thumbnail at the luminance component's own resolution
        self.blocks = (-(-self.width * h_luma // (8 * h_max)), -(-self.height * v_luma // (8 * v_max)))
        #: A block of an MCU: its component, DC table and AC table.
        self.layout = tuple(
            (i, self.tables[t >> 4], self.tables[16 | t & 15]) for i, (c, t) in enumerate(used) for _ in range(1 if single else self.components[c][0] * self.components[c][1])
        )
        self.scan = at


def _lookup(spec: tuple[bytes, bytes]) -> np.ndarray:
    """For each 16 bits: the code's length times 256 plus its symbol; 0 where no code begins so."""
    table = np.zeros(1 << 16, dtype=np.int64)
    for code, length, symbol in canonical(list(spec[0]), list(spec[1])):
        table[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
    return table


def _extend(bits: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where((size > 0) & (bits < (1 << np.maximum(size - 1, 0))), bits - (1 << size) + 1, bits)


def _decode_lanes(words: np.ndarray, at: np.ndarray, count: np.ndarray, layout) -> np.ndarray:
    """DC values of the first component, lanes x (MCUs x its blocks); words: the 64 bits from each byte on."""
    tables = {spec: _lookup(spec) for _, *specs in layout for spec in specs}
    lanes, most = len(at), int(count.max())
    luma = sum(c == 0 for c, *_ in layout)
    out = np.zeros((lanes, most * luma), dtype=np.int32)
    predicted = {c: np.zeros(lanes, dtype=np.int64) for c, *_ in layout}
    order = np.argsort(-count, kind="stable")
    at, alive_at = at[order].astype(np.int64), np.searchsorted(-count[order], -np.arange(most), side="left")
    last = len(words) - 1

    def peek(pos):
        return words[np.minimum(pos >> 3, last)] << (pos & 7).astype(np.uint64)

    for m in range(most):
        n, k = int(alive_at[m]), 0
        pos = at[:n]
        for c, dc, ac in layout:
            bits = peek(pos)
            found = tables[dc][(bits >> np.uint64(48)).astype(np.int64)]
            length, size = found >> 8, found & 15
            raw = ((bits << length.astype(np.uint64)) >> np.uint64(48)).astype(np.int64) >> (16 - size)
            predicted[c][:n] += _extend(raw, size)
            if c == 0:
                out[:n, m * luma + k] = predicted[c][:n]
                k += 1
            pos = pos + length + size
            # all lanes' AC codes in step, those that have ended wait
            found = tables[ac][(peek(pos) >> np.uint64(48)).astype(np.int64)]
            pos = pos + (found >> 8)
            symbol = found & 255
            going = np.flatnonzero(symbol)
            if len(going):
                symbol = symbol[going]
                place = 1 + (symbol >> 4)
                pos[going] += symbol & 15
                while True:
                    left = place < 63
                    going, place = going[left], place[left]
                    if not len(going):
                        break
                    found = tables[ac][(peek(pos[going]) >> np.uint64(48)).astype(np.int64)]
                    symbol = found & 255
                    pos[going] += (found >> 8) + (symbol & 15)
                    place = np.where(symbol == 0, 63, place + 1 + (symbol >> 4))
        at[:n] = pos
    back = np.empty_like(order)
    back[order] = np.arange(lanes)
    return out[back]


def read_pictures(streams: list[bytes]) -> list[list[tuple[Picture, np.ndarray]] | None]:
    """For each stream its pictures and DC-only thumbnails; None where one isn't a baseline JPEG."""
    pictures: list[tuple[int, Picture]] = []
    parts, where, total = [], [], 0
    result: list = [[] for _ in streams]
    for i, data in enumerate(streams):
        at, own = 0, []
        flat = np.frombuffer(data, dtype=np.uint8)
        marks = np.flatnonzero((flat[:-1] == 0xFF) & (flat[1:] != 0) & ((flat[1:] < 0xD0) | (flat[1:] > 0xD7))) if len(data) > 1 else []
        try:
            while at < len(data):
                if data[at : at + 2] != b"\xff\xd8":
                    raise ValueError("no picture")
                p = Picture(data, at)
                j = int(np.searchsorted(marks, p.scan))
                end = int(marks[j]) if j < len(marks) else len(data)
                own.append((p, data[p.scan : end]))
                at = end + 2
        except (ValueError, KeyError, IndexError, struct.error):
            result[i] = None
            continue
        for p, scan in own:
            pictures.append((i, p))
            parts.append(scan)
            where.append(total)
            total += len(scan)
    if not pictures:
        return result
    raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
    before = np.concatenate([[0], raw[:-1]]) == 0xFF
    before[np.array(where)[np.array(where) < len(raw)]] = False
    mark = before & (raw >= 0xD0) & (raw <= 0xD7)
    gone = (before & (raw == 0)) | mark
    gone[:-1] |= mark[1:]
    kept = np.concatenate([[0], np.cumsum(~gone)])
    data = np.concatenate([raw[~gone], np.zeros(8, np.uint8)])
    words = np.zeros(len(data) - 7, dtype=np.uint64)
    for k in range(8):
        words |= data[k : k + len(words)].astype(np.uint64) << np.uint64(56 - 8 * k)
    restarts = np.flatnonzero(mark) + 1
    groups: dict = {}
    for x, (i, p) in enumerate(pictures):
        a, b = where[x], where[x] + len(parts[x])
        mcus = p.mcus[0] * p.mcus[1]
        lanes = -(-mcus // p.restart) if p.restart else 1
        starts = np.concatenate([[a], restarts[np.searchsorted(restarts, a, "right") : np.searchsorted(restarts, b, "right")]])
        if len(starts) < lanes:
            result[i] = None
            continue
        count = np.full(lanes, p.restart or mcus)
        count[-1] = mcus - (lanes - 1) * (p.restart or mcus)
        groups.setdefault(p.layout, []).append((x, kept[starts[:lanes]] * 8, count))
    thumbs: dict[int, np.ndarray] = {}
    for layout, members in groups.items():
        dc = _decode_lanes(words, np.concatenate([m[1] for m in members]), np.concatenate([m[2] for m in members]), layout)
        luma, a = sum(c == 0 for c, *_ in layout), 0
        for x, starts, count in members:
            p = pictures[x][1]
            own = dc[a : a + len(starts)]
            a += len(starts)
            values = own[:, : int(count[0]) * luma].reshape(-1)[: p.mcus[0] * p.mcus[1] * luma]
            h, v = p.luma
            grid = values.reshape(p.mcus[1], p.mcus[0], v, h).transpose(0, 2, 1, 3).reshape(p.mcus[1] * v, p.mcus[0] * h)
            pixels = np.clip(np.rint(grid[: p.blocks[1], : p.blocks[0]] * (p.q / 8)) + 128, 0, 255).astype(np.uint8)
            thumbs[x] = pixels
    for x, (i, p) in enumerate(pictures):
        if result[i] is not None:
            result[i].append((p, thumbs[x]))
    return result


def thumbnail_hash(pixels: np.ndarray) -> str:
    """64 bits: whether each cell of an 8x8 reduction is brighter than the mean of all, as hexadecimal."""
    h, w = pixels.shape
    sums = np.zeros((h + 1, w + 1))
    sums[1:, 1:] = pixels.cumsum(0, dtype=np.float64).cumsum(1)
    y0, x0 = np.arange(8) * h // 8, np.arange(8) * w // 8
    y1, x1 = np.maximum((np.arange(8) + 1) * h // 8, y0 + 1), np.maximum((np.arange(8) + 1) * w // 8, x0 + 1)
    cells = sums[np.ix_(y1, x1)] - sums[np.ix_(y0, x1)] - sums[np.ix_(y1, x0)] + sums[np.ix_(y0, x0)]
    cells /= np.outer(y1 - y0, x1 - x0)
    return f"{int(''.join('1' if c else '0' for c in (cells > pixels.mean()).ravel()), 2):016x}"


def write_media(df: DataFrame, payload: str, media: str = "media") -> DataFrame:
    """Add a binary column of JPEG streams for a binary column of payloads (multiples of 192 bytes).

    Null and empty payloads give an empty stream; other lengths raise. A column named like the output is replaced.
    """
    rows = without(df, [media])
    out = T.StructType([*rows.schema.fields, T.StructField(media, T.BinaryType())])

    def run(batches):
        for batch in batches:
            values = batch.column(payload)
            for a, b in block_slices([n or 0 for n in pc.binary_length(values).to_pylist()], SLICE_BYTES):
                own = [x or b"" for x in values.slice(a, b - a).to_pylist()]
                if any(len(x) % WIDTH for x in own):
                    raise ValueError(f"payloads must be multiples of {WIDTH} bytes")
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(write_pictures(own), pa.binary())], names=out.names)

    return rows.mapInArrow(run, out)


def read_media(df: DataFrame, media: str = "media") -> DataFrame:
    """Add what a binary column of JPEG streams holds: width, height, n_pictures, thumbnail, thumbnail_hash, status.

    width is that of the widest picture and height that of all below each other, in pixels; thumbnail is the DC-only
    luminance, row by row, of all pictures in turn; the hash is that of each, joined by "-". status is ok, empty (null or no bytes) or unsupported (progressive,
    broken: all else null). Columns named like an output are replaced.
    """
    fields = [("width", T.IntegerType()), ("height", T.IntegerType()), ("n_pictures", T.IntegerType()), ("thumbnail", T.BinaryType()), ("thumbnail_hash", T.StringType()), ("status", T.StringType())]
    rows = without(df, [n for n, _ in fields])
    out = T.StructType([*rows.schema.fields, *[T.StructField(n, t) for n, t in fields]])

    def describe(pictures):
        if pictures is None:
            return None, None, None, None, None, "unsupported"
        if not pictures:
            return None, None, 0, b"", None, "empty"
        width, height = max(p.width for p, _ in pictures), sum(p.height for p, _ in pictures)
        return width, height, len(pictures), b"".join(x.tobytes() for _, x in pictures), "-".join(thumbnail_hash(x) for _, x in pictures), "ok"

    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.string()]

    def run(batches):
        for batch in batches:
            values = batch.column(media)
            for a, b in block_slices([n or 0 for n in pc.binary_length(values).to_pylist()], SLICE_BYTES):
                found = [describe(x) for x in read_pictures([x or b"" for x in values.slice(a, b - a).to_pylist()])]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)]], names=out.names)

    return rows.mapInArrow(run, out)


def op5_jpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as a JPEG media column, stored in the shared folder and read back: sizes, digests,
    dimensions and thumbnail hash."""
    small_batches(spark)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    padded = F.greatest(F.ceil(F.octet_length(data) / WIDTH), F.lit(1)) * WIDTH
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(data).cast("long").alias("n_bytes"), F.rpad(data, padded.cast("int"), F.lit(b" ")).alias("payload")
    )
    # pages of several pictures, since texts repeat each other more than themselves
    media = materialise(write_media(docs, "payload").drop("payload"), "media", **{"parquet.page.size": str(8 << 20)})
    back = read_media(media)
    return back.select(
        "doc_id", "n_bytes", F.octet_length("thumbnail").cast("long").alias("payload_bytes"), F.sha2("thumbnail", 256).alias("payload_sha256"),
        F.crc32(F.substring("thumbnail", -16, 16)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), F.concat_ws(":", F.concat_ws("x", "width", "height"), "n_pictures", "thumbnail_hash").alias("feature"),
    )
