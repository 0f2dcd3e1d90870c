import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexisift.llm import jpeg_media as J

#: A small complete Huffman table of the test's own: every symbol has eight bits, all ones is unused.
SYMBOLS = bytes([0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 0x11, 0x81, 0xE1, 0xF0])
COUNTS = bytes([0] * 7 + [len(SYMBOLS)] + [0] * 8)


def bits_of(value, size):
    return "" if not size else format(value if value > 0 else value + (1 << size) - 1, f"0{size}b")


def picture(coefficients, sampling, width, height, restart=0, comments=True):
    """A baseline JPEG of the test's own writing: coefficients[m][b] = (component, 64 values in zigzag order)."""
    code = {s: format(i, "08b") for i, s in enumerate(SYMBOLS)}
    scans, run, last = [], "", {}
    for m, blocks in enumerate(coefficients):
        if restart and m and m % restart == 0:
            scans.append(run)
            run, last = "", {}
        for c, values in blocks:
            diff = values[0] - last.get(c, 0)
            last[c] = values[0]
            size = abs(diff).bit_length()
            run += code[size] + bits_of(diff, size)
            zeros = 0
            end = max([i for i in range(1, 64) if values[i]], default=0)
            for i in range(1, end + 1):
                if values[i] == 0:
                    zeros += 1
                    continue
                while zeros > 15:
                    run += code[0xF0]
                    zeros -= 16
                run += code[zeros << 4 | abs(values[i]).bit_length()] + bits_of(values[i], abs(values[i]).bit_length())
                zeros = 0
            if end < 63:
                run += code[0]
    scans.append(run)
    data = b""
    for i, r in enumerate(scans):
        raw = int((r + "1" * (-len(r) % 8)), 2).to_bytes((len(r) + 7) // 8, "big") if r else b""
        data += raw.replace(b"\xff", b"\xff\0") + (bytes([0xFF, 0xD0 + i % 8]) if i + 1 < len(scans) else b"")
    seg = lambda marker, body: struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body
    n = len(sampling)
    head = b"\xff\xd8" + (seg(0xFE, b"a comment") if comments else b"") + seg(0xDB, b"\0" + bytes([16] + [1] * 63))
    head += seg(0xC0, struct.pack(">BHHB", 8, height, width, n) + b"".join(bytes([i + 1, h << 4 | v, 0]) for i, (h, v) in enumerate(sampling)))
    head += seg(0xC4, b"\0" + COUNTS + SYMBOLS) + seg(0xC4, b"\x10" + COUNTS + SYMBOLS) + (seg(0xDD, struct.pack(">H", restart)) if restart else b"")
    return head + seg(0xDA, bytes([n]) + b"".join(bytes([i + 1, 0]) for i in range(n)) + b"\0\x3f\0") + data + b"\xff\xd9"


@pytest.mark.parametrize("restart", [0, 1, 3])
def test_general_baseline_scans(restart):
    random = np.random.default_rng(3)

    def block():
        values = [0] * 64
        values[0] = int(random.integers(-60, 60))
        for i, v in ((1, 1), (3, -1), (60, 1)) if random.random() < 0.5 else ((63, -1),):
            values[i] = v
        return values

    # luminance sampled 2x2, two colours: a picture of 3x2 MCUs of 16 pixels, cut at the edges
    mcus = [[(0, block()) for _ in range(4)] + [(1, block()), (2, block())] for _ in range(6)]
    data = picture(mcus, [(2, 2), (1, 1), (1, 1)], 41, 30, restart)
    ((p, pixels),) = J.read_pictures([data])[0]
    assert (p.width, p.height, pixels.shape) == (41, 30, (4, 6))
    for y in range(4):
        for x in range(6):
            dc = mcus[(y // 2) * 3 + x // 2][(y % 2) * 2 + x % 2][1][0]
            assert pixels[y, x] == np.clip(dc * 2 + 128, 0, 255)


def test_what_is_not_baseline():
    fine = picture([[(0, [5] + [0] * 63)]], [(1, 1)], 8, 8)
    assert J.read_pictures([fine.replace(b"\xff\xc0", b"\xff\xc2"), b"", b"nonsense", fine[:20], fine])[:4] == [None, [], None, None]
    assert J.read_pictures([fine])[0][0][1].tolist() == [[138]]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.binary(max_size=900), min_size=1, max_size=6))
def test_payloads_come_back(payloads):
    padded = [p + b" " * (-len(p) % J.WIDTH) for p in payloads]
    assert [b"".join(x.tobytes() for _, x in own) for own in J.read_pictures(J.write_pictures(padded))] == padded


def test_more_rows_than_a_picture_holds():
    payload = bytes(np.random.default_rng(1).integers(0, 256, J.WIDTH * (J.HIGHEST + 3), dtype=np.uint8))
    (own,) = J.read_pictures(J.write_pictures([payload]))
    assert len(own) == 2 and b"".join(x.tobytes() for _, x in own) == payload


def test_query(spark, tmp_path):
    texts = [None, "", "a", "é" * 500, "x" * 192, "x" * 193, "a", "\0\xff" * 10]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in J.op5_jpeg_media(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b" " * (max(1, -(-len(raw) // 192)) * 192 - len(raw))
        r = rows[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    assert rows[2]["media_sha256"] == rows[6]["media_sha256"] and rows[2]["feature"] == rows[6]["feature"] and rows[0]["media_sha256"] == rows[1]["media_sha256"]


def test_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, bytearray(b"z" * 192), "old"), (2, None, "old")], "k int, payload binary, Media string")
    got = J.read_media(J.write_media(df, "payload"))
    assert sorted((r["k"], r["status"]) for r in got.collect()) == [(1, "ok"), (2, "empty")] and "Media" not in got.columns
    assert J.read_media(J.write_media(df.where("false"), "payload")).count() == 0


def test_feature_covers_all_pictures(spark, tmp_path):
    first, most = "a" * (J.WIDTH * J.HIGHEST), J.WIDTH * 8
    texts = [first + "b" * most + "c" * most, first + "c" * most + "b" * most, first + "b" * most]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    features = [r["feature"] for r in J.op5_jpeg_media(spark, str(tmp_path)).orderBy("doc_id").collect()]
    assert len(set(features)) == 3
    assert [f.split(":")[0] for f in features] == [f"{8 * J.WIDTH}x{8 * (J.HIGHEST + rows)}" for rows in (16, 16, 8)]
