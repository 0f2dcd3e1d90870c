"""Vector measures as column functions, and searches in blocks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexisift.sources.shared import written

#: Rows of a block of vectors.
DATA_BLOCK = 8192
#: Vectors for each pivot, and pivots at most: they're held by the driver and every task.
CELL, MOST_PIVOTS = 1024, 4096
#: Rows of an area: blocks that a query is sent to at once.
AREA = 65_536
#: Queries of a block that are compared with one copy of its vectors, at most and, where there are few groups of them for the cores, at least.
QUERY_CHUNK, LEAST_CHUNK = 65_536, 2048
#: Rows that are compared with all pivots, or a block, at once.
ROWS_AT_ONCE = 512
#: Scores are compared when rounded to six digits.
MARGIN = 2e-6
#: Vectors and queries of a tile that all pairs are measured in.
TILE, TILE_QUERIES = 1024, 2048
#: Rows of a tile's result that are handed over at once.
ROWS_BACK = 65_536


def doubles(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where a vector is zero."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def weighted_cosine(a: Column, b: Column, w: Column) -> Column:
    over = lambda x, y: dot(F.zip_with(doubles(x), doubles(w), lambda p, q: p * q), y)
    return over(a, b) / F.nullif(F.sqrt(over(a, a)) * F.sqrt(over(b, b)), F.lit(0.0))


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - cosine(a, b)


def normalised(a: Column) -> Column:
    """The vector at length one; null where it is zero."""
    n = norm(a)
    return F.when(n > 0, F.transform(doubles(a), lambda x: x / n))


def overlap(a: Column, b: Column) -> Column:
    """Sum over distinct items of a of the smaller of its counts in a and b, over the size of b; 0 for an empty b."""
    times = lambda items, x: F.size(F.filter(items, lambda y: y == x))
    shared = F.aggregate(F.array_distinct(a), F.lit(0), lambda s, x: s + F.least(times(a, x), times(b, x)))
    return F.when(F.size(b) > 0, shared / F.size(b)).otherwise(F.lit(0.0))


def multi_signal(cosine_score: str, found: str, activity: str, beta: float, gamma: float) -> Column:
    return F.col(cosine_score) + beta * F.col(found) + gamma * F.col(activity)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def manhattan(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)


def chebyshev(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(doubles(a), doubles(b), lambda x, y: F.abs(x - y)))


#: Measures by name; any function of two columns will do where a measure is asked for.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "cosine": cosine, "cosine_distance": cosine_distance, "dot": dot, "euclidean": euclidean, "manhattan": manhattan, "chebyshev": chebyshev,
}


def _cosines(x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    wx, wy = (x, y) if weights is None else (x * weights, y * weights)
    sizes = np.outer(np.sqrt((wx * x).sum(1)), np.sqrt((wy * y).sum(1)))
    return (wx @ y.T) / sizes, sizes == 0


def _by_row(f: Callable[[np.ndarray], np.ndarray]) -> Callable[..., tuple[np.ndarray, np.ndarray | None]]:
    """Measures that f makes of the differences of a row and all of y."""
    return lambda x, y: (np.stack([f(y - row) for row in x]), None)


def _cosine_distances(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    values, missing = _cosines(x, y)
    return 1 - values, missing


#: MEASURES between all rows of two matrices, with those pairs that have none.
MATRICES: dict[str, Callable[..., tuple[np.ndarray, np.ndarray | None]]] = {
    "cosine": _cosines, "cosine_distance": _cosine_distances, "dot": lambda x, y: (x @ y.T, None), "euclidean": _by_row(lambda d: np.sqrt((d * d).sum(1))),
    "manhattan": _by_row(lambda d: np.abs(d).sum(1)), "chebyshev": _by_row(lambda d: np.abs(d).max(1)),
}


def measured(
    queries: DataFrame, vectors: DataFrame, key: str, vector: str, measure: str | Callable[[Column, Column], Column], block: int = DATA_BLOCK, weights: Sequence[float] | None = None,
) -> DataFrame:
    """query_id, key, value: a measure of a stated set of queries (one row makes it vector x matrix) with all vectors.

    A measure by name is taken between tiles of vectors and of queries, as matrices (weights: of a cosine's dimensions). Pairs with a null, empty or
    incomplete vector, or of another than the commonest length, and measures that are column functions, are compared row by row: vectors are dealt into
    blocks of about so many rows, each of which gets every query once. Keys may repeat; null vectors have null values.
    """
    if not isinstance(measure, str):
        return _by_pair(queries, vectors, key, vector, measure, block)
    f = MEASURES[measure] if weights is None else lambda x, y: weighted_cosine(x, y, F.array(*[F.lit(float(w)) for w in weights]))
    length = F.when(~F.exists(vector, lambda v: v.isNull()) & (F.size(vector) > 0), F.size(vector)).alias("length")
    counts = vectors.select(length, F.lit(0).alias("asks")).unionByName(queries.select(length, F.lit(1).alias("asks"))).groupBy("length").agg(F.count("*").alias("n"), F.sum("asks").alias("asks"))
    common = counts.orderBy(F.col("length").isNull(), F.desc("n"), "length").limit(2).collect()
    if not common or common[0]["length"] is None:
        return _by_pair(queries, vectors, key, vector, f, block)
    plain = F.coalesce(length == common[0]["length"], F.lit(False))
    found = _by_tile(queries.where(plain), vectors.where(plain), key, vector, measure, common[0]["n"] - common[0]["asks"], common[0]["asks"], weights)
    if len(common) == 1:
        return found
    odd = _by_pair(queries.where(~plain), vectors, key, vector, f, block).unionByName(_by_pair(queries.where(plain), vectors.where(~plain), key, vector, f, block))
    return found.unionByName(odd)


def _by_pair(queries: DataFrame, vectors: DataFrame, key: str, vector: str, f: Callable[[Column, Column], Column], block: int) -> DataFrame:
    blocks = max(1, -(-vectors.count() // block))
    there = vectors.select(F.col(key).alias("key"), F.col(vector).alias("y")).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"))
    asked = queries.select(F.col(key).alias("query_id"), F.col(vector).alias("x"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    return there.join(asked, "block").select("query_id", F.col("key").alias(key), f(F.col("x"), F.col("y")).alias("value"))


def _by_tile(queries: DataFrame, vectors: DataFrame, key: str, vector: str, measure: str, n: int, asks: int, weights: Sequence[float] | None) -> DataFrame:
    """measured, of n vectors and so many queries of one length, all of them complete."""
    f, more = MATRICES[measure], () if weights is None else (np.array(weights, float),)

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asked = group.column("asks")
        own, there = group.filter(asked), group.filter(pc.invert(asked))
        a, b = len(own), len(there)
        keys = own.column("key").take(pa.array(np.repeat(np.arange(a), b))), there.column("key").take(pa.array(np.tile(np.arange(b), a)))
        if a and b:
            with np.errstate(all="ignore"):
                values, missing = f(*(_matrix(side.column("v").combine_chunks()) for side in (own, there)), *more)
            values = pa.array(values.ravel(), pa.float64(), mask=None if missing is None else missing.ravel())
        else:
            values = pa.array([], pa.float64())
        out = pa.table([*keys, values], ["query_id", key, "value"])
        return pa.Table.from_batches(out.to_batches(max_chunksize=ROWS_BACK), out.schema)

    tiles, chunks = max(1, -(-n // TILE)), max(1, -(-asks // TILE_QUERIES))
    columns = lambda df, is_asked: df.select(F.lit(is_asked).alias("asks"), F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    dealt = lambda among: F.pmod(F.xxhash64("v", "key"), F.lit(among)).cast("int")
    every = lambda among: F.explode(F.sequence(F.lit(0), F.lit(among - 1)))
    there, asked = columns(vectors, False), columns(queries, True)
    there = there.withColumn("tile", dealt(tiles)).withColumn("chunk", every(chunks))
    asked = asked.withColumn("chunk", dealt(chunks)).withColumn("tile", every(tiles))
    return there.unionByName(asked).groupBy("tile", "chunk").applyInArrow(compare, f"query_id {queries.schema[key].dataType.simpleString()}, `{key}` {vectors.schema[key].dataType.simpleString()}, value double")


def pairwise(queries: DataFrame, vectors: DataFrame, key: str, vector: str, measure: str | Callable[[Column, Column], Column]) -> DataFrame:
    """query_id, key, value of each pair once: of the queries with all vectors of smaller keys."""
    return measured(queries, vectors, key, vector, measure).where(F.col(key) < F.col("query_id"))


def _points(df: DataFrame, key: str, vector: str, within: str | None) -> DataFrame:
    """(kind, key, v) of a table of vectors."""
    kind = F.coalesce(F.col(within).cast("string"), F.lit("")) if within else F.lit("")
    return df.select(kind.alias("kind"), F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T), 0))


def _in_space(x: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as points between which distances are taken, and which rows of x those are: zero (by cosine) and non-finite ones go."""
    length = np.sqrt((x * x).sum(1)) if metric == "cosine" else np.ones(len(x))
    fine = np.isfinite(x).all(1) & np.isfinite(length) & (length > 0)
    return x[fine] / length[fine][:, None], np.flatnonzero(fine)


def _in_cells(points: DataFrame, pivots: np.ndarray, metric: str) -> DataFrame:
    """Points with the cell of their nearest pivot and how far that is."""

    def place(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                x, rows = _in_space(_matrix(part.column("v")), metric)
                if len(x):
                    far = _distances(x, pivots)
                    cell = far.argmin(1)
                    kept = part.take(pa.array(rows))
                    v = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
                    yield pa.RecordBatch.from_arrays([kept.column("kind"), kept.column("key"), v, pa.array(cell, pa.int32()), pa.array(far[np.arange(len(cell)), cell])], ["kind", "key", "v", "cell", "far"])

    return points.mapInArrow(place, "kind string, key long, v array<double>, cell int, far double")


def _searched(sent: DataFrame, data: DataFrame, chunks: DataFrame | None, k: int, digits: int, metric: str) -> DataFrame:
    """sent's queries (block, kind, key, v, parts, home, reached) with near: their k best (score, key) of the data (block, part, ...) of their block, best first.

    parts: which parts of the block a query searches; null for all but its home. reached: a score that k others have; lower ones are left out. By cosine,
    single precision tells which scores can be among the best, and only those are taken in double precision. Data are sent once, or once for
    each chunk of a block's queries (block, chunks), where those are many.
    """

    def search(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        keys, x = group.column("key").to_numpy(), _matrix(group.column("v").combine_chunks())
        order = np.argsort(keys[~asks], kind="stable")
        names, there = keys[~asks][order], x[~asks][order]
        parts, owns = np.unique(group.column("part").to_numpy()[~asks][order], return_inverse=True)
        number = {p: i for i, p in enumerate(parts.tolist())}
        own = group.filter(pa.array(asks))
        wants, homes = own.column("parts"), own.column("home").to_numpy()
        reached = own.column("reached").fill_null(-np.inf).to_numpy()
        most = max(1, ROWS_AT_ONCE * DATA_BLOCK // max(len(names), DATA_BLOCK))
        asking, cosine = np.flatnonzero(asks), metric == "cosine"
        off = 10.0**-digits + (x.shape[1] + 8) * 2.0**-22 if cosine else 10.0**-digits  # rounding, and single precision on vectors of length one
        single = there.astype(np.float32) if cosine else None
        scores, others, sizes = [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
        for at in range(0, len(asking) if len(names) else 0, most):
            rows, some = asking[at : at + most], slice(at, at + most)
            rough = x[rows].astype(np.float32) @ single.T if cosine else -_exact(x[rows], there)
            least = reached[some] - off
            free = np.isneginf(least)
            if free.any() and len(names) > k:
                ends = rough if free.all() else rough[free]
                least[free] = np.partition(ends, len(names) - k - 1, axis=1)[:, len(names) - k - 1] - 2 * off  # k others, and the query itself
            allowed = np.ones((len(rows), len(parts)), bool)
            for i, (part, home) in enumerate(zip(wants[some].to_pylist(), homes[some].tolist(), strict=True)):
                if part is not None:
                    allowed[i] = False
                    allowed[i, [number[p] for p in part]] = True
                elif home in number:
                    allowed[i, number[home]] = False
            if not allowed.all():
                free &= ~allowed.all(1)
                least[free] = -np.inf  # the best may be of parts that it doesn't search
            i, j = np.divmod(np.flatnonzero(rough >= least.astype(rough.dtype)[:, None]), len(names))
            kept = allowed[i, owns[j]] & (keys[rows[i]] != names[j])
            i, j = i[kept], j[kept]
            exact = np.concatenate([np.zeros(0), *[(x[rows[i[a : a + ROWS_BACK]]] * there[j[a : a + ROWS_BACK]]).sum(1) for a in range(0, len(i), ROWS_BACK)]]) if cosine else rough[i, j]
            score = np.round(exact, digits)
            best = np.lexsort((j, -score, i))
            i, j, score = i[best], j[best], score[best]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            kept = (place < k) & (score >= reached[some][i])
            scores.append(score[kept])
            others.append(names[j[kept]])
            sizes.append(np.bincount(i[kept], minlength=len(rows)))
        if not len(names):
            sizes.append(np.zeros(len(asking), np.int64))
        pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(scores)), pa.array(np.concatenate(others))], ["score", "key"])
        near = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes)), pa.int32()), pairs)
        return pa.table([own.column("block"), own.column("kind"), own.column("key"), own.column("v"), near], ["block", "kind", "key", "v", "near"])

    one = F.lit(0).cast("long")
    if chunks is None:
        sent, data = sent.withColumn("chunk", one), data.withColumn("chunk", one)
    else:
        sent = sent.join(F.broadcast(chunks), "block").withColumn("chunk", F.pmod(F.xxhash64("key"), "chunks")).drop("chunks")  # a row for each block
        data = data.join(F.broadcast(chunks), "block").withColumn("chunk", F.explode(F.sequence(one, F.col("chunks") - 1))).drop("chunks")
    columns = ["block", "chunk", "kind", "key", "v"]
    nothing = [F.lit(None).cast("array<int>").alias("parts"), F.lit(-1).alias("home"), F.lit(None).cast("double").alias("reached")]
    both = sent.select(F.lit(True).alias("asks"), *columns, F.lit(-1).alias("part"), "parts", "home", "reached").unionByName(data.select(F.lit(False).alias("asks"), *columns, "part", *nothing))
    return both.groupBy("block", "chunk").applyInArrow(search, "block int, kind string, key long, v array<double>, near array<struct<score: double, key: bigint>>")


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances from differences: equal rows are at 0 exactly."""
    return np.stack([np.sqrt(((y - row) ** 2).sum(1)) for row in x])


def nearest(
    queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int, digits: int = 6, metric: str = "cosine", within: str | None = None,
    cell: int = CELL, block: int = DATA_BLOCK, copies: list | None = None,
) -> DataFrame:
    """query_id, key, similarity, rank: each query's k nearest by cosine, itself excluded, ties by key; exact.

    metric "euclidean" gives distance instead of similarity. within: a column that a query and its neighbours agree in, with few
    values. Vectors have one length.

    Pivots, a sample of up to MOST_PIVOTS vectors, split the vectors into cells, and large cells into blocks. A query is first
    compared with a block of its own cell, which gives a radius that holds k vectors. It's then sent to just the blocks of cells
    that the radius reaches, by the triangle inequality through a cell's pivot and radius, and through the plane
    between the query's pivot and the cell's. Vectors stay in their blocks. In data without structure all cells are within
    reach, and the search is between all blocks. A query is sent once to an area of blocks, with the list of those it is to search there. copies, if given, gets the DataFrame of (key, block) that are sent.
    """
    spark = vectors.sparkSession
    points = _points(vectors, key, vector, within)
    n = points.count()
    wanted = min(MOST_PIVOTS, max(1, -(-n // cell), min(spark.sparkContext.defaultParallelism, n // 256)))
    sample = [r[0] for r in points.orderBy(F.xxhash64("key"), "key").limit(wanted).select("v").collect()]
    value = "similarity" if metric == "cosine" else "distance"
    if not n:
        return spark.createDataFrame([], f"query_id long, key long, {value} double, rank int").withColumnRenamed("key", key)
    pivots = _in_space(np.array(sample, float), metric)[0]
    pivots = pivots if len(pivots) else np.zeros((1, len(sample[0])))
    placed = written(_in_cells(points, pivots, metric), "cells")
    asked = placed if queries.sameSemantics(vectors) else written(_in_cells(_points(queries, key, vector, within), pivots, metric), "asked")
    there = placed.groupBy("kind", "cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).orderBy("kind", "cell").collect()  # a row for each kind and pivot at most
    blocks, places, sizes = [], {}, {(kind, c): size for kind, c, size, _ in there}
    for kind, c, size, radius in there:
        parts = -(-size // block)
        places.setdefault(kind, []).append((c, radius, len(blocks), parts))
        blocks += [(kind, c, len(blocks), parts)]
        blocks += [None] * (parts - 1)
    areas, held = [], 0
    for b in blocks:  # a cell's blocks are about equal
        if b:
            size = -(-sizes[b[0], b[1]] // b[3])
        if not areas or held + size > AREA or b and b[0] != kind_of_area:
            areas.append((areas[-1] + 1) if areas else 0)
            held = 0
        else:
            areas.append(areas[-1])
        kind_of_area = b[0] if b else kind_of_area
        held += size
    area_of = np.array(areas, int)
    starts = F.broadcast(spark.createDataFrame([b for b in blocks if b], "kind string, cell int, first int, parts int"))
    own = (F.col("first") + F.pmod(F.xxhash64("key"), "parts")).cast("int").alias("block")
    data = placed.join(starts, ["kind", "cell"]).select(own, "kind", "key", "v")
    home = asked.join(starts, ["kind", "cell"], "left").select(own, "kind", "key", "v")
    asking = n if asked is placed else asked.count()
    chunk = min(QUERY_CHUNK, max(LEAST_CHUNK, -(-asking * (int(area_of.max(initial=0)) + 1) // (4 * spark.sparkContext.defaultParallelism))))  # some groups for each core
    many = asked is not placed and asking > chunk

    def chunks(sent: DataFrame) -> DataFrame:
        return sent.groupBy("block").agg(F.ceil(F.count("*") / chunk).cast("long").alias("chunks"))

    at_home = home.where("block IS NOT NULL")
    first = written(_searched(at_home.withColumns({"parts": F.lit(None).cast("array<int>"), "home": F.lit(-1), "reached": F.lit(None).cast("double")}), data.withColumn("part", F.lit(0)), chunks(at_home) if many else None, k, digits, metric).unionByName(home.where("block IS NULL").withColumn("near", F.lit(None).cast("array<struct<score: double, key: bigint>>"))), "at-home")

    def reach(batches):
        apart, cells_of = _distances(pivots, pivots), {}
        for kind, cells in places.items():
            c, radius, firsts, parts = (np.array(column) for column in zip(*cells, strict=True))
            cells_of[kind] = c, radius, np.repeat(np.arange(len(c)), parts), np.concatenate([np.arange(f, f + p) for f, p in zip(firsts, parts, strict=True)])
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                of_kind = np.array(part.column("kind").to_pylist(), object)
                for kind in set(of_kind) & cells_of.keys():
                    own = part.take(pa.array(np.flatnonzero(of_kind == kind)))
                    c, radius, cell_of, block_no = cells_of[kind]
                    far = _distances(_matrix(own.column("v")), pivots)
                    nearest_pivot, to = far.argmin(1), far[:, c]
                    gap, nearer = apart[nearest_pivot][:, c], far.min(1)[:, None]
                    reached = own.column("reached").to_numpy(zero_copy_only=False).astype(float)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        plane = np.where(gap > 0, (to**2 - nearer**2) / (2 * gap), 0)
                    within_reach = np.sqrt(np.maximum(2 - 2 * (reached - MARGIN), 0)) if metric == "cosine" else MARGIN - reached
                    within_reach = np.where(np.isnan(reached), np.inf, within_reach)
                    at_home = own.column("block").fill_null(-1).to_numpy()[:, None] == block_no
                    hit = (np.maximum(to - radius, plane) <= within_reach[:, None] + 1e-7)[:, cell_of] & ~at_home
                    for area in np.unique(area_of[block_no]).tolist():
                        there = area_of[block_no] == area
                        rows, whole = np.flatnonzero(hit[:, there].any(1)), (hit | at_home)[:, there].all(1)
                        parts = [None if whole[i] else block_no[there & hit[i]].tolist() for i in rows]
                        sent_on = own.take(pa.array(rows))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([area] * len(rows), pa.int32()), *(sent_on.column(n) for n in ("kind", "key", "v")), pa.array(parts, pa.list_(pa.int32())), sent_on.column("block").fill_null(-1), sent_on.column("reached")],
                            ["block", "kind", "key", "v", "parts", "home", "reached"],
                        )

    kth = F.when(F.size("near") >= k, F.get("near", F.lit(k - 1))["score"])
    sent = first.select("block", "kind", "key", "v", kth.alias("reached")).mapInArrow(reach, "block int, kind string, key long, v array<double>, parts array<int>, home int, reached double")
    if copies is not None:
        in_area = F.filter(F.array(*[F.array(*[F.lit(b) for b in np.flatnonzero(area_of == a).tolist()]) for a in range(int(area_of.max()) + 1)])[F.col("block")], lambda b: b != F.col("home"))
        copies.append(sent.select("key", F.explode(F.coalesce("parts", in_area)).alias("block")))
    many = many or asking > chunk
    in_areas = data.join(F.broadcast(spark.createDataFrame([(b, int(a)) for b, a in enumerate(area_of)], "part int, area int")), F.col("part") == F.col("block"))  # a row for each block
    rest = _searched(sent, in_areas.select(F.col("area").alias("block"), "kind", "key", "v", "part"), chunks(sent) if many else None, k, digits, metric)
    found = first.select(F.col("key").alias("query_id"), F.inline("near")).unionByName(rest.select(F.col("key").alias("query_id"), F.inline("near")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "key"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", F.col("key").alias(key), (F.col("score") if metric == "cosine" else -F.col("score")).alias(value), "rank")


def label_targets(a: Column, b: Column) -> Column:
    """1 where two rows have one label, else 0."""
    return (a == b).cast("int")


def projected(df: DataFrame, columns: Sequence[str], weights: Sequence[Sequence[float]], out: str) -> DataFrame:
    """A linear model's projection of numeric columns, one output a row of weights."""
    return df.withColumn(out, F.array(*[sum((F.col(c) * w for c, w in zip(columns, row)), F.lit(0.0)) for row in weights]))
