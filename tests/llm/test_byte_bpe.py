import base64
import hashlib
from pathlib import Path

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexisift.llm import byte_bpe, token_counts

TEXTS = [None, "", " ", "  a  b ", "a\n b", "a \n\nb", "don't stop", "<|endoftext|> x", "été 東京 🙂🙂", "x" * 3000, "1234 !!! ??", "\t\tq\r\n", "a  b", "a  b"]
VOCABULARY = byte_bpe.Vocabulary()
ENCODERS = [byte_bpe.Encoder(VOCABULARY), byte_bpe.Encoder(byte_bpe.FileVocabulary(public_tokenizers.path("byte_bpe_50k.json")))]
RANKS = byte_bpe.read_ranks(byte_bpe.RANKS)
REFERENCE = tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_ranks_file_is_read_whole():
    with open(byte_bpe.RANKS, "rb") as f:
        assert len(RANKS) == sum(1 for _ in f) and base64.b64encode(b"a") == b"YQ=="


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t aZé'1.,東🙂s"), max_size=40))
def test_ids_equal_those_of_the_rank_library(text):
    for encoder in ENCODERS:
        assert np.frombuffer(encoder([text])[0], "<u4").tolist() == REFERENCE.encode_ordinary(text)


def test_ids_equal_those_of_the_vocabulary_file():
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    for t in TEXTS[1:]:
        assert np.frombuffer(ENCODERS[0]([t])[0], "<u4").tolist() == other.encode(t, add_special_tokens=False).ids


def test_forgotten_pieces_give_the_same_ids():
    encoder = byte_bpe.Encoder(VOCABULARY, remembered=20)
    texts = [" ".join(f"w{(i * 7 + j) % 31}{'yé'[i % 2] * (i % 40)}{'.,!'[: i % 4]}" for j in range(9)) + " " * (i % 2) + "\n" * (i % 3) for i in range(200)]
    for a in range(0, len(texts), 5):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder(texts[a : a + 5])] == [REFERENCE.encode_ordinary(t) for t in texts[a : a + 5]]


def test_equal_hashes_of_different_pieces_are_seen(monkeypatch):
    encoder = byte_bpe.Encoder(VOCABULARY)
    monkeypatch.setattr(byte_bpe, "stretch_hashes", lambda data, starts, stops: np.ones(len(starts), np.uint64))
    assert np.frombuffer(encoder(["one two three"])[0], "<u4").tolist() == REFERENCE.encode_ordinary("one two three")


def test_pattern_of_a_file():
    own = {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}}
    assert byte_bpe.file_pattern(own) == public_tokenizers.PATTERN
    assert byte_bpe.file_pattern({"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}) is byte_bpe.file_pattern({"pre_tokenizer": {"type": "Whitespace"}}) is None
    split = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": "x+"}}, {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}]}
    assert byte_bpe.file_pattern({"pre_tokenizer": split}) == "x+"


def test_long_texts_in_stretches(monkeypatch):
    monkeypatch.setattr(byte_bpe, "SLICE_BYTES", 10)
    text = " ".join(f"word{i}, é{i}!" for i in range(200))
    assert np.frombuffer(byte_bpe.Encoder(VOCABULARY)(["", text, "x"])[1], "<u4").tolist() == REFERENCE.encode_ordinary(text)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = byte_bpe.op10_byte_bpe(spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = REFERENCE.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_token_counts_query(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r["doc_id"]: (r["n_tokens"], r["terminated"]) for r in token_counts.op1_token_counts(spark, folder).collect()}
    assert got == {k: (len(REFERENCE.encode_ordinary(t)), True) for k, t in texts.items()}
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert token_counts.op1_token_counts(spark, str(tmp_path)).count() == 0


def test_blocks_of_one_file_are_searched_by_several_tasks(spark, tmp_path):
    (tmp_path / "one").write_bytes(np.array([7, 9] * 500, "<u2").tobytes())
    files = spark.createDataFrame([("one",)], "file string")
    counted = token_counts.scan_token_files(files, str(tmp_path), end_id=9, block_tokens=10)
    assert counted.where("n_tokens = 1").count() == 500
    parts = [f for f in (Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))).glob("separators-*") for f in f.glob("part-*")]
    assert max(sum(1 for _ in d.glob("part-*")) for d in {p.parent for p in parts}) >= 20


def test_round_trip_with_offsets(spark):
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)] + [(1, "", "kept")], "doc_id long, text string, N_Tokens string")
    rows = byte_bpe.decode(byte_bpe.encode(df), offsets=True)
    assert rows.columns == ["doc_id", "text", "n_tokens", "ids_le", "decoded", "char_starts", "char_ends"]
    got = rows.collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        text = r["text"] or ""
        assert bytes(r["decoded"]).decode() == text and r["n_tokens"] == len(r["ids_le"]) // 4 == len(REFERENCE.encode_ordinary(text))
        assert all(0 <= a < b <= len(text) for a, b in zip(r["char_starts"], r["char_ends"]))
        covered = {i for a, b in zip(r["char_starts"], r["char_ends"]) for i in range(a, b)}
        assert covered == set(range(len(text)))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(df)).count() == 0


def test_separator_scan_over_small_blocks(spark, tmp_path):
    folder = f"file://{tmp_path}"
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(99, None)], "doc_id long, text string").coalesce(2)
    placed = token_counts.write_token_files(df, folder)
    for block in (1, 2, 7, 1 << 20):
        counted = token_counts.scan_token_files(placed, folder, block_tokens=block)
        got = {r["doc_id"]: r["n_tokens"] for r in placed.join(counted, ["file", "ordinal"]).collect()}
        assert got == {**{i: len(REFERENCE.encode_ordinary(t or "")) for i, t in enumerate(TEXTS)}, 99: 0}
        assert counted.where("NOT terminated").count() == 0


def test_scan_of_ids_without_an_end(spark, tmp_path):
    for name, ids in {"a": [5, 6], "b": [9, 1, 9, 9, 2, 3], "c": [], "d": [9]}.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    files = spark.createDataFrame([(x,) for x in "abcd"], "file string")
    got = token_counts.scan_token_files(files, str(tmp_path), end_id=9, block_tokens=2)
    assert sorted((r["file"], r["ordinal"], r["start"], r["n_tokens"], r["terminated"]) for r in got.collect()) == [
        ("a", 0, 0, 2, False), ("b", 0, 0, 0, True), ("b", 1, 1, 1, True), ("b", 2, 3, 0, True), ("b", 3, 4, 2, False), ("d", 0, 0, 0, True),
    ]
