"""Searches over registers of many copies: the answers of their SQL, from no more rows than the register grew by."""

import duckdb
import pytest

from lexisift.plans import registry
from lexisift.plans import search as P

QUERIES = ["Q21_echo_counts", "Q4_boost", "Q20_without_self", "Q1_match", "Q15_keyword_fuzzy", "T3_exact_name_and_address", "Q5_fuzzy", "T4_exact_name_and_point"]
FEW, MANY = 3, 15


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    """Folders by how many times they hold the parts, copies with keys of their own."""
    out = {}
    for n in (FEW, MANY):
        out[n] = tmp_path_factory.mktemp(f"copies{n}")
        duckdb.sql(f"COPY (SELECT p.* REPLACE (p_partkey + i * 1000 AS p_partkey) FROM range({n}) t(i), '/root/testdata/sf0.001/part.parquet' p) TO '{out[n]}/part.parquet' (FORMAT parquet)")
    return out


def shuffled(spark):
    """Rows that all stages so far have shuffled."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


@pytest.mark.parametrize("name", QUERIES)
def test_copies_are_answered_alike_and_shuffled_once(spark, folders, name, monkeypatch):
    rows, pairs, plain = {}, [], P.S.keyword_fuzzy
    monkeypatch.setattr(P.S, "keyword_fuzzy", lambda *a, **b: (pairs.append(hits := plain(*a, **b)), hits)[1])
    for n, folder in folders.items():
        before = shuffled(spark)
        got = sorted(map(tuple, registry.queries()[name](spark, str(folder)).collect()))
        rows[n] = shuffled(spark) - before
        db = duckdb.connect()
        db.execute(f"CREATE VIEW part AS SELECT * FROM '{folder}/part.parquet'")
        want = sorted(db.execute(registry.oracle_sql()[name]).fetchall())
        assert len(got) > 0 and [r[:2] for r in got] == [r[:2] for r in want]
        assert all(a == pytest.approx(b, abs=2e-6) if isinstance(b, float) else a == b for x, y in zip(got, want, strict=True) for a, b in zip(x, y, strict=True))
    assert rows[MANY] <= rows[FEW] * MANY / FEW
    if pairs:  # of whole names: listed inside a task, where nothing is shuffled
        few, many = (hits.count() for hits in pairs)
        assert many <= few * MANY / FEW
