import numpy as np
import pytest

from lexisift.llm import additive_ann as A
from lexisift.llm.common import materialise

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20):
    fine = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    out = {}
    for q, x in fine:
        if q % 20 == 0:
            out.setdefault(q, sorted(((-float(np.cumsum(x * y)[-1]), i) for i, y in fine if i != q))[:k])
    return out


def test_small_tables_are_exact_with_ties_and_odd_vectors(spark, tmp_path):
    random = np.random.default_rng(2)
    vectors = random.normal(size=(40, 8)).round(3)
    rows = [(i, [float(x) for x in vectors[i % 40]], 0) for i in range(300)]  # every vector seven times or more
    rows += [(400, None, 0), (420, [0.0] * 8, 0), (440, [float("nan")] * 8, 0), (460, [None] + [1.0] * 7, 0), (480, [float("inf")] + [1.0] * 7, 0), (None, [1.0] * 8, 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {}
    for r in A.op9_additive_ann(spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert got == brute(rows)


def test_recall_where_candidates_are_few(spark):
    random = np.random.default_rng(4)
    x = random.normal(size=(4000, 32)).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    vectors = A.usable(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding").repartition(4)
    quantiser = A.train(vectors, 2000)
    indexed = materialise(A.index(vectors, quantiser, 20, 2048), "index-test")
    found = A.search(indexed, vectors.where("vec_id % 100 = 0"), quantiser, 20, candidates=200, block=2048)
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = {q: {i for _, i in own} for q, own in brute(rows).items() if q % 100 == 0}
    assert sum(len(got[q] & want[q]) for q in want) / (20 * len(want)) >= 0.9


def test_codes_lookup_and_norms():
    random = np.random.default_rng(1)
    x = random.normal(size=(600, 16))
    q = A.Quantiser.fit(x, books=4, words=16, rounds=4)
    codes = q.encode(x)
    rebuilt = sum(book[codes[:, m]] for m, book in enumerate(q.books))
    assert np.allclose(q.scores(x[:5], codes), x[:5] @ rebuilt.T, atol=1e-4) and np.allclose(q.reconstruction_norms(codes), (rebuilt**2).sum(1))
    error = lambda c: ((x - sum(b[c[:, m]] for m, b in enumerate(q.books))) ** 2).sum()
    assert error(q.encode(x, beam=8)) <= error(q.encode(x, beam=1)) < (x**2).sum() * 0.6


@pytest.mark.parametrize("rows", [[], [(20, None, 1)], [(20, [1.0, 2.0], 1)], [(20, [1.0, 2.0], 1), (21, [1.0], 1), (40, [2.0, 1.0], 1)]])
def test_tiny_tables(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted((r["query_id"], r["vec_id"], r["score"]) for r in A.op9_additive_ann(spark, str(tmp_path)).collect())
    assert got == ([(20, 40, 4.0), (40, 20, 4.0)] if len(rows) == 3 else [])


def test_distances_by_stored_norms(spark):
    random = np.random.default_rng(7)
    x = random.normal(size=(1500, 16)) * random.uniform(0.5, 2, size=(1500, 1))
    vectors = A.usable(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int"), "vec_id", "embedding")
    quantiser = A.train(vectors, 1500)
    indexed = materialise(A.index(vectors, quantiser, 10, 400), "index-test")
    found = A.search(indexed, vectors.where("vec_id % 100 = 0"), quantiser, 10, candidates=300, measure="l2", block=400).collect()
    hits = 0
    for q in range(0, 1500, 100):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        gaps = ((x - x[q]) ** 2).sum(1)
        gaps[q] = np.inf
        assert all(abs(s + gaps[i]) < 1e-9 for _, i, s in own) and [s for _, _, s in own] == sorted((s for _, _, s in own), reverse=True)
        hits += len({i for _, i, _ in own} & set(np.argsort(gaps)[:10].tolist()))
    assert hits >= 0.9 * 150
    with pytest.raises(ValueError):
        A.search(vectors, vectors, quantiser, 1, measure="other")


@pytest.mark.parametrize(("clusters", "share"), [(0, 1.0), (15, 0.35)])
def test_shipped_parameters_over_several_blocks(spark, clusters, share):
    """Recall with the query's own parameters; queries of clustered vectors go to few blocks, vectors to none but theirs."""
    random = np.random.default_rng(6)
    x = random.normal(size=(18_000, 32))
    if clusters:
        x = x * 0.3 + random.normal(size=(clusters, 32))[random.integers(clusters, size=len(x))] * 3
    vectors = A.usable(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), "vec_id", "embedding").repartition(4)
    quantiser, copies = A.train(vectors), []
    block = A.DATA_BLOCK if not clusters else 1024
    indexed = materialise(A.index(vectors, quantiser, 20, block), "index-test")
    asked = vectors.where("vec_id % 300 = 0")
    got = {}
    for r in A.search(indexed, asked, quantiser, 20, block=block, copies=copies).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, len(x), 300):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-score)[:20].tolist()))
    assert hits >= 0.9 * 20 * 60
    blocks = sum(-(-r["count"] // block) for r in indexed.groupBy("cell").count().collect())
    assert copies[0].count() <= share * 60 * blocks
