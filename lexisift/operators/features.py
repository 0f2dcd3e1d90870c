"""Vocabularies, encodings, phrases and TF-IDF."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexisift.operators.relational import numbered
from lexisift.sources.shared import written

PAD = 0
#: Keys of rows with equal items that are kept in one list.
KEYS_TOGETHER = 1024
#: Multisets of a tile that overlaps are counted in, and those that are asked of it.
OVERLAP_TILE, OVERLAP_CHUNK = 4096, 2048


def _tokens(df: DataFrame, key: str, items: Column) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.posexplode(items).alias("at", "token"))


def first_seen_vocabulary(df: DataFrame, key: str, items: Column) -> DataFrame:
    """(token, id) from 1 in the order of first sight by key and place; 0 is for padding, the last id + 1 for null.

    Only distinct tokens are numbered, so the ordering is over the vocabulary, not the corpus.
    """
    first = _tokens(df, key, items).groupBy("token").agg(F.min(F.struct("key", "at")).alias("first"))
    return numbered(first, ["first.key", "first.at"], "id").select("token", "id")


def frequent_vocabulary(df: DataFrame, key: str, items: Column, first_id: int = 2) -> DataFrame:
    """(token, id) by falling frequency, ties by token; 1 is for unknown tokens."""
    counts = _tokens(df, key, items).groupBy("token").agg(F.count("*").alias("n"))
    return numbered(counts, [F.desc("n"), F.col("token")], "id", first_id).select("token", "id")


def encode(df: DataFrame, key: str, items: Column, vocabulary: DataFrame, unknown: int | None = None) -> DataFrame:
    """(key, ids): documents as arrays of ids; unknown tokens are dropped or given an id of their own."""
    joined = _tokens(df, key, items).join(vocabulary, "token", "left").withColumn("id", F.coalesce("id", F.lit(unknown)) if unknown is not None else F.col("id")).where("id IS NOT NULL")
    lists = joined.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "id"))).alias("p"))
    found = lists.select(F.col("key").alias(key), F.transform("p", lambda x: x["id"]).alias("ids"))
    return df.select(key).join(found, key, "left").select(key, F.coalesce("ids", F.array().cast("array<bigint>")).alias("ids"))


def padded_matrix(df: DataFrame, key: str, fields: Sequence[tuple[str, int]]) -> DataFrame:
    """Id arrays of several columns cut and filled to their lengths, one after another."""
    parts = [F.slice(F.concat(F.col(c), F.array_repeat(F.lit(PAD).cast("bigint"), n)), 1, n) for c, n in fields]
    return df.select(key, F.concat(*parts).alias("ids"))


def document_terms(df: DataFrame, key: str, items: Column) -> DataFrame:
    """(key, term, tf)."""
    return df.select(F.col(key).alias("key"), F.explode(items).alias("term")).groupBy("key", "term").agg(F.count("*").alias("tf"))


def tf_idf(df: DataFrame, key: str, items: Column, most_terms: int | None = None) -> DataFrame:
    """(key, term, tfidf), smoothed: tf * (ln((1 + n) / (1 + df)) + 1), each document at length one.

    most_terms keeps the terms of the highest counts in the corpus, ties by term (the feature's own size).
    """
    terms = document_terms(df, key, items)
    n = df.agg(F.count("*").alias("n"))
    stats = terms.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    if most_terms is not None:
        stats = stats.orderBy(F.desc("total"), "term").limit(most_terms)
    weighted = terms.join(stats, "term").join(F.broadcast(n)).withColumn("w", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    norms = weighted.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, "key").select("key", "term", (F.col("w") / F.col("norm")).alias("tfidf"))


def bigrams(df: DataFrame, key: str, items: Column) -> DataFrame:
    """(first, second, n): how often two tokens follow each other."""
    return _followed(df, items).where("second IS NOT NULL")


def _followed(df: DataFrame, items: Column) -> DataFrame:
    """(first, second, n): how often a token is followed by another, or, with a null second, ends a document."""
    own = df.select(items.alias("w")).where(F.size("w") > 0)
    pairs = F.arrays_zip(F.col("w").alias("first"), F.slice("w", 2, F.size("w")).alias("second"))
    return own.select(F.inline(pairs).alias("first", "second")).groupBy("first", "second").agg(F.count("*").alias("n"))


def phrases(df: DataFrame, key: str, items: Column, least: int = 5, threshold: float = 10.0) -> DataFrame:
    """(first, second, score) of token pairs that stand together: (n - least) * vocabulary / (n1 * n2) above a threshold.

    Texts are split once; single tokens are counted from the counts of pairs.
    """
    followed = written(_followed(df, items), "pairs")
    pairs = followed.where("second IS NOT NULL")
    singles = followed.groupBy(F.col("first").alias("token")).agg(F.sum("n").alias("c"))
    size = singles.agg(F.count("*").alias("v")).join(pairs.agg(F.count("*").alias("p"))).select((F.col("v") + F.col("p")).alias("v"))
    one, two = (singles.select(F.col("token").alias(n), F.col("c").alias(f"c_{n}")) for n in ("first", "second"))
    score = (F.col("n") - least) * F.col("v") / (F.col("c_first") * F.col("c_second"))
    return pairs.where(F.col("n") >= least).join(one, "first").join(two, "second").join(F.broadcast(size)).select("first", "second", score.alias("score")).where(F.col("score") > threshold)


def with_phrases(df: DataFrame, key: str, items: Column, pairs: DataFrame, out: str, glue: str = "_", space: str = " ") -> DataFrame:
    """df with its tokens as a text in which pairs (first, second) are one token; from left to right, each token in one pair at most.

    Only places where a pair stands are shuffled. Of places that follow each other without a gap every second one counts,
    from the first: that is what reading from the left gives. Keys are unique; a null text stays null, an empty one empty.
    """
    rows = df.select(F.col(key).alias("key"), items.alias("w"))
    at = rows.where(F.size("w") > 1).select("key", F.posexplode(F.arrays_zip(F.slice("w", 1, F.size("w") - 1).alias("first"), F.slice("w", 2, F.size("w") - 1).alias("second"))).alias("at", "pair"))
    places = at.select("key", "at", "pair.first", "pair.second").join(pairs.select("first", "second"), ["first", "second"], "left_semi")
    own = Window.partitionBy("key").orderBy("at")
    run = places.withColumn("run", F.col("at") - F.row_number().over(own))
    run = run.withColumn("start", F.min("at").over(Window.partitionBy("key", "run")))
    taken = run.where((F.col("at") - F.col("start")) % 2 == 0).groupBy("key").agg(F.array_sort(F.collect_list("at")).alias("taken"))
    joined = df.withColumn("_w", items).join(taken.withColumnRenamed("key", "_key"), F.col(key) == F.col("_key"), "left")
    ends = F.transform(F.col("taken"), lambda t: t + 2)
    before = F.arrays_zip(F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size("taken") - 1)).alias("a"), F.col("taken").alias("b"))
    pieces = F.transform(before, lambda x: F.concat(F.slice("_w", x["a"] + 1, x["b"] - x["a"]), F.array(F.concat(F.get("_w", x["b"]), F.lit(glue), F.get("_w", x["b"] + 1)))))
    last = F.element_at(ends, -1)
    every = F.concat(F.flatten(pieces), F.slice("_w", last + 1, F.size("_w")))
    return joined.withColumn(out, F.array_join(F.when(F.col("taken").isNull(), F.col("_w")).otherwise(every), space)).drop("_w", "_key", "taken")


def _tiles_of_overlaps(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """(a, b, overlap) of rows (a, sorted) and (b, sorted) of sorted items, between tiles of both: counted along the tile's lists of rows that have an item."""

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        items, asks = group.column("items").combine_chunks(), group.column("asks").to_numpy()
        sizes, place = pc.list_value_length(items).to_numpy(), np.arange(len(items.flatten()))
        row, ends_of = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes)
        codes = items.flatten().dictionary_encode().indices.fill_null(-1).to_numpy()
        first = np.append(True, (row[1:] != row[:-1]) | (codes[1:] != codes[:-1]))
        nth = place - np.maximum.accumulate(np.where(first, place, 0))
        codes = np.where(codes < 0, -1, codes.astype(np.int64) * (nth.max() + 1) + nth)
        there = ~asks[row] & (codes >= 0)
        order = np.argsort(codes[there], kind="stable")
        listed, held = codes[there][order], (np.cumsum(~asks) - 1)[row[there]][order]
        starts, ends = (np.searchsorted(listed, np.maximum(codes, 0), side) for side in ("left", "right"))
        ends[codes < 0] = starts[codes < 0]
        hits, shares, found = [np.zeros(0, int)], [np.zeros(0)], [0] * int(asks.sum())
        for i, at in enumerate(np.flatnonzero(asks)):
            own = range(ends_of[at] - sizes[at], ends_of[at])
            n = np.bincount(np.concatenate([held[starts[p] : ends[p]] for p in own]), minlength=1)
            hit = np.flatnonzero((n > 0) & (n / sizes[at] >= least - 1e-9))
            hits.append(hit)
            shares.append(n[hit] / sizes[at])
            found[i] = len(hit)
        keys_a, keys_b = group.column("a").filter(pa.array(~asks)), group.column("b").filter(pa.array(asks))
        out = [keys_a.take(pa.array(np.concatenate(hits))), keys_b.take(pa.array(np.repeat(np.arange(len(found)), found))), pa.array(np.concatenate(shares))]
        return pa.table(out, ["a", "b", "overlap"])

    spark = a.sparkSession
    tile = max(256, min(OVERLAP_TILE, -(-a.count() // (2 * spark.sparkContext.defaultParallelism))))
    tiles, chunks = max(1, -(-a.count() // tile)), max(1, -(-b.count() // OVERLAP_CHUNK))
    dealt = lambda key, among: F.pmod(F.xxhash64(key), F.lit(among)).cast("int")
    every = lambda among: F.explode(F.sequence(F.lit(0), F.lit(among - 1)))
    items, kinds = F.col("sorted").cast("array<string>").alias("items"), (a.schema["a"].dataType.simpleString(), b.schema["b"].dataType.simpleString())
    there = a.select("a", F.lit(None).cast(kinds[1]).alias("b"), items, F.lit(False).alias("asks"), dealt("a", tiles).alias("tile"), every(chunks).alias("chunk"))
    asked = b.select(F.lit(None).cast(kinds[0]).alias("a"), "b", items, F.lit(True).alias("asks"), every(tiles).alias("tile"), dealt("b", chunks).alias("chunk"))
    return there.unionByName(asked).groupBy("tile", "chunk").applyInArrow(compare, f"a {kinds[0]}, b {kinds[1]}, overlap double")


def overlap_join(left: DataFrame, left_key: str, left_items: Column, right: DataFrame, right_key: str, right_items: Column, least: float, digits: int | None = None) -> DataFrame:
    """(a, b, overlap): pairs whose multiset overlap over the size of b is at least so much, rounded to digits if given.

    An item's second, third, ... occurrence counts as another item, which makes multisets sets. Rows with equal multisets are
    compared once, in tiles, by counting along lists of what has an item, so the work is that of the shared items. Their keys are put in
    at the end, without a shuffle of the pairs of keys and without work on each. Empty lists overlap with nothing, nor do null items. Keys are
    unique; 0 < least <= 1.
    """

    def classes(df: DataFrame, key: str, items: Column, name: str) -> tuple[DataFrame, DataFrame]:
        """(name, sorted) of each different multiset, named by its smallest key, and lists (name, keys) of up to KEYS_TOGETHER keys that have it."""
        dealt = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)  # a small file is one task, and its items are work
        rows = written(dealt.select(F.col(key).alias("key"), F.sort_array(items).alias("sorted")), f"{name}-rows").where(F.size("sorted") > 0)  # made once, not for the test too
        firsts = written(rows.groupBy("sorted").agg(F.min("key").alias(name)), f"{name}-classes")
        members = rows.join(firsts, "sorted").select(name, "key", F.pmod(F.xxhash64("key"), F.lit(1 << 16)).alias("_part"))
        sizes = members.groupBy(name).agg(F.ceil(F.count("*") / KEYS_TOGETHER).alias("_parts"))
        keys = members.join(sizes, name).groupBy(name, F.pmod("_part", "_parts").alias("_part")).agg(F.collect_list("key").alias("keys")).select(name, "keys")
        return firsts, written(keys, f"{name}-keys")

    (a, keys_a), (b, keys_b) = classes(left, left_key, left_items, "a"), classes(right, right_key, right_items, "b")
    met = _tiles_of_overlaps(a, b, least)
    met = written(met if digits is None else met.withColumn("overlap", F.round("overlap", digits)), "overlaps")
    met = met.repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")  # few rows, of which many come
    listed = met.join(keys_a, "a").select("b", F.col("keys").alias("as"), "overlap").join(keys_b, "b").select("as", "keys", "overlap")
    return listed.select(F.explode("as").alias("a"), "keys", "overlap").select("a", F.explode("keys").alias("b"), "overlap")


def one_hot(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.select("*", *[(F.coalesce(F.col(column) == v, F.lit(False))).cast("long").alias(f"{column}_{v}") for v in values])
