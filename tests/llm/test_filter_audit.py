import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from lexisift.llm import filter_audit as A


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        f
        for f, bad in zip(
            "ABCD", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text))), strict=True
        )
        if bad
    }


def brute(docs, labels):
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    each = [(i, part or "", fails(text or "") | ({"E"} if i is not None and i > least[text or ""] else set())) for i, text, part in docs]
    rows = {}
    for part in {p for _, p, _ in each}:
        own, shapley = [(i, f) for i, p, f in each if p == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                here, kept = [(i, x) for i, x in left if f in x], [(i, x) for i, x in left if f not in x]
                shapley[f] += len(here)
                all_failing = sum(f in x for _, x in own)
                rows[part, "".join(order), step] = [len(kept), len(here), all_failing - len(here), sum(x == {f} for _, x in own), sum(i in good for i, _ in here), sum(i in toxic for i, _ in here)]
                left = kept
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                rows[part, "".join(order), step].append(shapley[f])
    return rows


def got(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in df.collect()}


def table(spark, docs, folder, files):
    """A table whose files hold the rows in the order given, so that smaller ids come in later batches."""
    for n in range(files):
        rows = spark.createDataFrame([(*d, "x", 1) for d in docs[n::files]], "doc_id long, text string, lang string, part string, id int")
        rows.coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_micro_batches_take_back_what_smaller_ids_change(spark, tmp_path):
    rng = random.Random(3)
    long = " ".join(f"w{i}" for i in range(220))
    texts = [long, long + " #", long.upper(), "a " * 300, "Short text", "", None, long + " A", "\x1c\x85 a b"]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(60)]
    docs += [(5, docs[5][1], "fr"), (None, long, "en"), (None, None, None), (3, "Short text", "en"), (61, "word " * 50_000, "de")]
    rng.shuffle(docs)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 60, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1)]
    of = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = brute(docs, labels)
    for files, batches in ((6, 6), (1, 4)):
        path = table(spark, docs, str(tmp_path / f"docs{files}"), files)
        assert got(A.audit(spark, path, of, micro_batches=batches)) == want


def test_a_single_file_and_an_empty_table(spark, tmp_path):
    of = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = table(spark, [(2, "a", "en"), (1, "a", "en")], str(tmp_path / "one"), 1)
    (file,) = (tmp_path / "one").glob("*.parquet")
    assert got(A.audit(spark, str(file), of)) == got(A.audit(spark, path, of)) == brute([(2, "a", "en"), (1, "a", "en")], [])
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(empty)
    assert A.audit(spark, empty, of).collect() == []


def test_counters_are_right_after_every_batch(spark, tmp_path):
    """The same checkpoint goes on where it ended: a second run takes only what came since."""
    of = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    folder, root = str(tmp_path / "in"), str(tmp_path / "audit")
    schema = "doc_id long, text string, lang string"

    def run():
        A.keep_counters(spark.readStream.schema(schema).parquet(folder), of, root)
        return {(r["part"], r["mask"]): r["n"] for r in A.counters(spark, root).collect()}

    spark.createDataFrame([(9, "b", "de"), (8, "c", "en")], schema).write.mode("append").parquet(folder)
    assert run() == {("de", 1): 1, ("en", 1): 1}
    spark.createDataFrame([(4, "b", "en")], schema).write.mode("append").parquet(folder)
    assert run() == {("de", 17): 1, ("en", 1): 2}
    assert run() == {("de", 17): 1, ("en", 1): 2}
    assert A.counters(spark, root).agg(F.sum("n")).first()[0] == 3


def test_a_hot_text_is_a_row_for_each_task():
    import pyarrow as pa

    n = 5000
    batch = pa.RecordBatch.from_arrays([pa.array([b"d"] * n), pa.array(["en"] * n), pa.array([False] * n), pa.array([False] * n), pa.array([1] * n, pa.int32()), pa.array(list(range(n, 0, -1)))], ["digest", "part", "good", "toxic", "mask", "id"])
    (rows,) = list(A._reduced(iter([batch])))
    assert rows.num_rows == 1 and rows.column("id").to_pylist() == [1] and rows.column("n_over").to_pylist() == [n - 1]
