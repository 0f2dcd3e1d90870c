"""Full-text search as joins: postings, BM25, boolean and dis-max combinations, decay and distance.

An index is two tables, postings (field, term, key, tf, length) and terms (field, term, idf), with the number
of documents and mean length of each field; lexisift.operators.search_index writes, opens and grows them. A clause is a table (q, key, score); a query combines clauses by
one aggregation over their union, so that many queries and clauses cost one shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexisift.functions.arrays import EARTH_METRES, haversine
from lexisift.operators.fuzzy import near_words
from lexisift.operators.relational import all_pairs

K1, B = 1.2, 0.75
EXPANSIONS = 50


@dataclass
class Index:
    """blocks and replaced are what lexisift.operators.search_index keeps beside the postings, if anything."""

    postings: DataFrame
    terms: DataFrame
    fields: DataFrame
    blocks: DataFrame | None = None
    replaced: DataFrame | None = None


def postings_of(df: DataFrame, key: str, fields: Mapping[str, Column]) -> DataFrame:
    """(field, term, key, length, tf) of analyzed fields; documents without terms in a field have none."""
    each = df.select(F.col(key).alias("key"), F.inline(F.array(*[F.struct(F.lit(n).alias("field"), a.alias("items")) for n, a in fields.items()]))).where(F.size("items") > 0)
    return each.select("key", "field", F.size("items").alias("length"), F.explode("items").alias("term")).groupBy("field", "term", "key", "length").agg(F.count("*").alias("tf"))


def inverse_frequency() -> Column:
    """BM25's weight of a term that df of so many documents hold."""
    return F.log(1 + (F.col("documents") - F.col("df") + 0.5) / (F.col("df") + 0.5))


def term_part(tf: Column, length: Column, norms: bool = True) -> Column:
    """What a term's frequency gives in a document of a length, before the term's weight; without norms lengths don't count."""
    scale = K1 * ((1 - B) + B * length / F.col("mean_length")) if norms else F.lit(K1)
    return tf * (K1 + 1) / (tf + scale)


def build_index(df: DataFrame, key: str, fields: Mapping[str, Column]) -> Index:
    """An index of analyzed fields; documents without terms in a field don't count for it."""
    each = df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("field"), F.size(a).alias("length")) for n, a in fields.items()]))).where("length > 0")
    postings = postings_of(df, key, fields)
    sizes = each.groupBy("field").agg(F.count("*").alias("documents"), F.avg("length").alias("mean_length"))
    counts = postings.groupBy("field", "term").agg(F.count("*").alias("df"))
    terms = counts.join(F.broadcast(sizes), "field").select("field", "term", inverse_frequency().alias("idf"))  # as many rows as fields
    return Index(postings, terms, sizes)


def of_few_terms(index: Index, terms: DataFrame, most: int = 1000) -> Index:
    """The index narrowed to the terms that are asked for, where they are few: a filter that reaches the scan."""
    asked = [r[0] for r in terms.select("term").distinct().limit(most + 1).collect()]
    if len(asked) > most:
        return index
    few = F.col("term").isin(asked)
    return Index(index.postings.where(few), index.terms.where(few), index.fields, None if index.blocks is None else index.blocks.where(few), index.replaced)


def query_terms(df: DataFrame, q: str, items: Column) -> DataFrame:
    """(q, term, weight): a query's terms, each once."""
    return df.select(F.col(q).alias("q"), F.explode(F.array_distinct(items)).alias("term"), F.lit(1.0).alias("weight"))


def match(index: Index, terms: DataFrame, field: str, boost: float = 1.0, norms: bool = True) -> DataFrame:
    """BM25 of the documents that hold any of a query's terms; without norms lengths don't count."""
    rated = terms.join(index.terms.where(F.col("field") == field), "term").drop("field")
    postings = index.postings.where(F.col("field") == field)
    mean = index.fields.where(F.col("field") == field).select("mean_length")
    hits = rated.join(postings, "term").join(F.broadcast(mean))  # one row
    part = F.col("weight") * F.col("idf") * term_part(F.col("tf"), F.col("length"), norms)
    return hits.groupBy("q", "key").agg((F.sum(part) * boost).alias("score"))


def edit_allowance(term: Column) -> Column:
    """0, 1 or 2 edits for terms of up to 2, up to 5, and more characters."""
    return F.when(F.char_length(term) <= 2, 0).when(F.char_length(term) <= 5, 1).otherwise(2)


def fuzzy_terms(index: Index, terms: DataFrame, field: str, prefix: int = 1, expansions: int = EXPANSIONS) -> DataFrame:
    """Query terms expanded to near terms of a field's vocabulary, nearest first, with a weight that falls by distance.

    prefix is how many first characters must be equal; it may be 0. The cap on expansions is the search feature itself.
    """
    wanted = terms.select("term").where("term <> ''").distinct()
    vocabulary = index.terms.where((F.col("field") == field) & (F.col("term") != ""))
    found = near_words(wanted, "term", vocabulary, "term", 2, prefix, edit_allowance(F.col("term"))).select(F.col("word").alias("term"), F.col("candidate").alias("near"), F.col("distance").alias("edits"))
    rank = F.row_number().over(Window.partitionBy("term").orderBy("edits", "near"))
    kept = found.withColumn("rank", rank).where(F.col("rank") <= expansions)
    weight = 1 - F.col("edits") / F.least(F.char_length("term"), F.char_length("near"))
    expanded = terms.join(kept.select("term", "near", weight.alias("by")), "term")
    return expanded.groupBy("q", F.col("near").alias("term")).agg(F.max(F.col("weight") * F.col("by")).alias("weight"))


def zero_terms(queries: DataFrame, q: str, terms: DataFrame, documents: DataFrame, key: str, boost: float = 1.0) -> DataFrame:
    """Every document, at a constant score, for the queries that analysis left without terms (a stated query set)."""
    empty = queries.select(F.col(q).alias("q")).distinct().join(terms.select("q").distinct(), "q", "left_anti")
    return all_pairs(empty, documents.select(F.col(key).alias("key")), "key").select("q", "key", F.lit(float(boost)).alias("score"))


def term(queries: DataFrame, q: str, documents: DataFrame, key: str, pairs: Sequence[tuple[str, str]], boost: float = 1.0) -> DataFrame:
    """A constant score where columns are exactly equal: pairs of a query's and a document's column."""
    left = queries.select(F.col(q).alias("q"), *[F.col(a).alias(f"v{i}") for i, (a, _) in enumerate(pairs)])
    right = documents.select(F.col(key).alias("key"), *[F.col(b).alias(f"v{i}") for i, (_, b) in enumerate(pairs)])
    return left.join(right, [f"v{i}" for i in range(len(pairs))]).select("q", "key", F.lit(float(boost)).alias("score"))


def prefix(queries: DataFrame, q: str, value: str, documents: DataFrame, key: str, field: str, length: int, boost: float = 1.0) -> DataFrame:
    """A constant score where a document's field begins with a query's value, cut to a length so that it is an equality."""
    left = queries.select(F.col(q).alias("q"), F.left(value, F.lit(length)).alias("v")).where(F.char_length("v") == length)
    right = documents.select(F.col(key).alias("key"), F.left(field, F.lit(length)).alias("v"))
    return left.join(right, "v").select("q", "key", F.lit(float(boost)).alias("score"))


def graded_codes(queries: DataFrame, q: str, value: str, documents: DataFrame, key: str, field: str, boosts: Mapping[int, float]) -> DataFrame:
    """Sums of boosts for each length at which two codes agree; joined at the shortest."""
    least = min(boosts)
    left = queries.select(F.col(q).alias("q"), F.col(value).alias("v"), F.left(value, F.lit(least)).alias("head"))
    right = documents.select(F.col(key).alias("key"), F.col(field).alias("w"), F.left(field, F.lit(least)).alias("head"))
    score = sum((F.when(F.left("v", F.lit(n)) == F.left("w", F.lit(n)), float(b)).otherwise(0.0) for n, b in boosts.items()), F.lit(0.0))
    return left.join(right, "head").select("q", "key", score.alias("score"))


def keyword_fuzzy(queries: DataFrame, q: str, value: str, documents: DataFrame, key: str, field: str, boost: float = 1.0, prefix: int = 1) -> DataFrame:
    """Whole values within the edit allowance and with equal first characters; distinct values are compared, empty ones with nothing."""
    left = queries.select(F.col(q).alias("q"), F.col(value).alias("v")).where("v <> ''")
    right = documents.select(F.col(key).alias("key"), F.col(field).alias("w")).where("w <> ''")
    found = near_words(left, "v", right, "w", 2, prefix, edit_allowance(F.col("v"))).select(F.col("word").alias("v"), F.col("candidate").alias("w"), F.col("distance").alias("edits"))
    score = boost * (1 - F.col("edits") / F.least(F.char_length("v"), F.char_length("w")))
    return left.join(found, "v").join(right, "w").select("q", "key", score.alias("score"))


def contains_any(documents: DataFrame, key: str, items: Column, words: Sequence[str]) -> DataFrame:
    """Keys of documents that hold one of a fixed list of words."""
    return documents.where(F.arrays_overlap(items, F.array(*[F.lit(w) for w in words]))).select(F.col(key).alias("key"))


def near(queries: DataFrame, q: str, documents: DataFrame, key: str, lat: str, lon: str, metres: float, block: int = 4096) -> DataFrame:
    """(q, key, distance) of points within a distance, by cells of about that size instead of all pairs.

    Bands of latitude are at least as high as the distance, and a band's cells at least as wide as the distance is anywhere in it,
    so a query looks into three bands and three cells of each; cells go round the date line, and a band that touches a pole is
    one cell. Cells of over block documents or queries (or a 4,096th of all, whichever is more) are dense: their documents and
    queries are dealt into blocks that meet pair by pair, so no key is larger and there are a few thousand dense cells at
    most. Points without finite coordinates, or with latitudes outside -90 to 90, are not found.
    """
    radius = metres / EARTH_METRES
    degrees = min(math.degrees(radius) * 1.001, 180.0)
    bands = max(1, math.floor(180 / degrees)) if degrees > 0 else 1 << 20
    height = 180 / bands

    def columns(band: Column) -> Column:
        low = band * height - 90
        farthest = F.greatest(F.abs(low), F.abs(low + height))
        width = F.degrees(F.asin(math.sin(radius) / F.cos(F.radians(farthest)))) * 1.001 + 1e-9
        return F.when(farthest + degrees >= 89.99, 1).otherwise(F.greatest(F.floor(360 / width), F.lit(1))).cast("long")

    def at(o: str, n: Column) -> Column:
        return F.least(F.floor(F.pmod(F.col(o), F.lit(360.0)) / 360 * n), n - 1).cast("long")

    def points(df: DataFrame, name: str, own: str, a: str, o: str) -> DataFrame:
        rows = df.select(F.col(own).alias(name), F.col(lat).cast("double").alias(a), F.col(lon).cast("double").alias(o))
        rows = rows.where(F.col(a).between(-90.0, 90.0) & (F.abs(o) <= 1e9))
        return rows.withColumn("y", F.least(F.floor((F.col(a) + 90) / height), F.lit(bands - 1)).cast("long"))

    right = points(documents, "key", key, "b", "p").withColumn("x", at("p", columns(F.col("y"))))
    left = points(queries, "q", q, "a", "o").withColumn("y", F.explode(F.sequence(F.greatest(F.col("y") - 1, F.lit(0)), F.least(F.col("y") + 1, F.lit(bands - 1))))).withColumn("n", columns(F.col("y")))
    here = at("o", F.col("n"))
    left = left.withColumn("x", F.explode(F.array_distinct(F.array(*[F.pmod(here + i, F.col("n")) for i in (-1, 0, 1)])))).drop("n")

    def dense(df: DataFrame, parts: str) -> DataFrame:
        counts = df.groupBy("y", "x").agg(F.count("*").alias("n"))
        size = counts.agg(F.greatest(F.lit(block), F.ceil(F.sum("n") / 4096)).alias("size"))
        return counts.join(F.broadcast(size)).where(F.col("n") > F.col("size")).select("y", "x", F.ceil(F.col("n") / F.col("size")).cast("int").alias(parts))

    split = F.broadcast(dense(right, "right").join(dense(left, "left"), ["y", "x"], "full"))  # at most 4,096 cells of each side

    def dealt(df: DataFrame, own: str, mine: str, others: str) -> DataFrame:
        each = df.join(split, ["y", "x"], "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in (mine, others)})
        return each.withColumn(mine, F.pmod(F.xxhash64(own), F.col(mine))).withColumn(others, F.explode(F.sequence(F.lit(0).cast("long"), F.col(others).cast("long") - 1)))

    left, right = dealt(left, "q", "left", "right"), dealt(right, "key", "right", "left")
    distance = haversine(F.col("a"), F.col("o"), F.col("b"), F.col("p"))
    return left.join(right, ["y", "x", "left", "right"]).select("q", "key", distance.alias("distance")).where(F.col("distance") <= metres)


def gauss(clause: DataFrame, distances: DataFrame, scale: float, decay: float = 0.5) -> DataFrame:
    """Scores times a bell curve of the distance that is decay at scale; documents without a distance are left out."""
    factor = F.exp(math.log(decay) * F.pow(F.col("distance") / scale, 2))
    return clause.join(distances, ["q", "key"]).select("q", "key", (F.col("score") * factor).alias("score"))


def beside(hits: DataFrame, queries: DataFrame, q: str, documents: DataFrame, key: str) -> DataFrame:
    """Hits as q, _key and _score with the query's columns, named q_..., and the document's.

    Documents are joined first: where hits are a table that Spark knows to be small, documents are then not shuffled.
    """
    asked = queries.select(F.col(q).alias("q"), *[F.col(c).alias(f"q_{c}") for c in queries.columns])
    return hits.select("q", F.col("key").alias("_key"), F.col("score").alias("_score")).join(documents, F.col("_key") == F.col(key)).join(asked, "q")


def on_candidates(
    hits: DataFrame, queries: DataFrame, q: str, documents: DataFrame, key: str, should: Sequence[tuple[Column, float]] = (), filters: Sequence[Column] = (), minimum: int = 0,
    decay: tuple[Column, float] | None = None,
) -> DataFrame:
    """Clauses on what other clauses have found already: conditions on a query's columns, named q_..., and a document's.

    Every hit that meets all filters and so many of should stays, with should's scores added and a bell curve of a distance
    that is a half at its scale. Cheap clauses (equal values, distances) then list no pairs of their own. Hits whose distance is
    unknown are left out.
    """
    rows = beside(hits, queries, q, documents, key)
    holds = [F.coalesce(c, F.lit(False)) for c, _ in should]
    score = sum((F.when(h, float(b)).otherwise(0.0) for h, (_, b) in zip(holds, should, strict=True)), F.col("_score"))
    if decay:
        score = score * F.exp(math.log(0.5) * F.pow(decay[0] / decay[1], 2))
        filters = [*filters, decay[0].isNotNull()]
    n = sum((h.cast("int") for h in holds), F.lit(0))
    kept = rows.where(n >= minimum)
    for f in filters:
        kept = kept.where(f)
    return kept.select("q", F.col("_key").alias("key"), score.alias("score"))


def first_keys(df: DataFrame, group: Sequence[str], k: int) -> DataFrame:
    """The rows with the k smallest keys of each group; nulls are one value."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("key"))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def first_equals(queries: DataFrame, q: str, documents: DataFrame, key: str, values: Sequence[tuple[Column, Column]], k: int = 10) -> DataFrame:
    """(q, key, score 0) of what equal values can bring into a query's best k, without listing all pairs of equal value.

    values: pairs of a query's and a document's column. For each choice of them, the k smallest keys of a combination of values
    are joined to the queries that have it. A document beyond these, found by nothing else, stands behind k others that match
    at least as much and have smaller keys: so with these and the hits of all other clauses as candidates, on_candidates and
    top give the best k exactly, as long as each clause only adds to the score and nothing else filters. Nulls equal nothing. There
    should be few values: a row is made for each choice of them, of documents that are among the k first of those equal in
    all values (no other is among the k first by some).
    """
    names = [f"v{i}" for i in range(len(values))]
    choices = F.array(*[F.lit(c) for c in range(1, 1 << len(values))])

    def valued(df: DataFrame, own: str, name: str, side: int) -> DataFrame:
        return df.select(F.col(own).alias(name), *[v[side].alias(n) for n, v in zip(names, values, strict=True)])

    def chosen(rows: DataFrame, name: str) -> DataFrame:
        rows = rows.withColumn("choice", F.explode(choices))
        inside = [F.col("choice").bitwiseAND(F.lit(1 << i)) > 0 for i in range(len(names))]
        for n, i in zip(names, inside, strict=True):
            rows = rows.where(~i | F.col(n).isNotNull())
        return rows.select(name, "choice", *[F.when(i, F.col(n)).alias(n) for n, i in zip(names, inside, strict=True)])

    firsts = first_keys(valued(documents, key, "key", 1), names, k)
    firsts = first_keys(chosen(firsts, "key"), ["choice", *names], k).alias("d")
    asked = chosen(valued(queries, q, "q", 0), "q").alias("a")
    same = F.col("a.choice") == F.col("d.choice")
    for n in names:
        same = same & F.col(f"a.{n}").eqNullSafe(F.col(f"d.{n}"))
    return asked.join(firsts, same).select("q", "key", F.lit(0.0).alias("score")).distinct()


def _tagged(kinds: Mapping[str, Sequence[DataFrame]]) -> DataFrame:
    out = None
    for kind, clauses in kinds.items():
        for i, c in enumerate(clauses):
            rows = c.select("q", "key", (F.col("score") if "score" in c.columns else F.lit(0.0)).alias("score"), F.lit(kind).alias("kind"), F.lit(i).alias("clause"))
            out = rows if out is None else out.unionByName(rows)
    return out


def boolean(must: Sequence[DataFrame] = (), should: Sequence[DataFrame] = (), filters: Sequence[DataFrame] = (), minimum: int | None = None) -> DataFrame:
    """All of must and filters, at least minimum of should; scores of must and should are added.

    A clause has at most one row for a query and document. Without a minimum, one of should is needed where there is
    neither must nor filter, and none otherwise.
    """
    least = minimum if minimum is not None else (0 if must or filters else 1)
    rows = _tagged({"must": must, "should": should, "filter": filters})
    n = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    score = F.sum(F.when(F.col("kind") != "filter", F.col("score")).otherwise(0.0))
    return rows.groupBy("q", "key").agg(score.alias("score"), n("must").alias("m"), n("should").alias("s"), n("filter").alias("f")).where((F.col("m") == len(must)) & (F.col("f") == len(filters)) & (F.col("s") >= least)).select("q", "key", "score")


def dis_max(clauses: Sequence[DataFrame], tie_breaker: float = 0.0) -> DataFrame:
    """The best score, and a share of the others."""
    best, total = F.max("score"), F.sum("score")
    return _tagged({"should": clauses}).groupBy("q", "key").agg((best + tie_breaker * (total - best)).alias("score"))


def multi_match(index: Index, terms: DataFrame, boosts: Mapping[str, float], kind: str = "best_fields") -> DataFrame:
    """The best (best_fields) or the sum (most_fields) of a query's scores over fields."""
    each = [match(index, terms, f, b) for f, b in boosts.items()]
    return dis_max(each, 0.0 if kind == "best_fields" else 1.0)


def without_self(hits: DataFrame) -> DataFrame:
    return hits.where("q <> key")


def top(hits: DataFrame, k: int = 10, digits: int = 6) -> DataFrame:
    """Each query's best, by score rounded to so many digits and then by key."""
    rounded = hits.withColumn("score", F.round("score", digits))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "key"))
    return rounded.withColumn("rank", rank).where(F.col("rank") <= k).select("q", "key", "score", "rank")


def echoes(templates: Mapping[str, DataFrame]) -> DataFrame:
    """What several templates found: (q, key, template, score)."""
    out = None
    for name, hits in templates.items():
        rows = hits.select("q", "key", F.lit(name).alias("template"), "score")
        out = rows if out is None else out.unionByName(rows)
    return out


def echo_counts(found: DataFrame) -> DataFrame:
    """How often each document was found for a query; scores don't count."""
    return found.groupBy("q", "key").agg(F.count("*").alias("nb"))


def highlight(c: Column, words: Column, before: str = "<em>", after: str = "</em>") -> Column:
    """A text with the words that a query holds marked."""
    marked = F.transform(F.split(c, " "), lambda w: F.when(F.array_contains(words, F.lower(w)), F.concat(F.lit(before), w, F.lit(after))).otherwise(w))
    return F.array_join(marked, " ")


def fragments(c: Column, words: Sequence[str], size: int = 20, most: int = 5, before: str = "<em>", after: str = "</em>") -> Column:
    """The best fragments of a text, each of so many words and with those of a fixed list marked: array of struct(marks, at, text).

    Fragments with more marked words come first, then earlier ones; those without any are left out. at is the place of a fragment's
    first word, from 0; null for a null text. Words stand between single spaces and are compared in lower case. The number is the feature's own cap.
    """
    items = F.split(c, " ")
    starts = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(size))
    hit = lambda w: F.lower(w).isin(*words)
    cut = F.transform(starts, lambda i: F.struct(F.size(F.filter(F.slice(items, i + 1, size), hit)).alias("marks"), i.alias("at")))
    best = F.slice(F.sort_array(F.transform(F.filter(cut, lambda f: f["marks"] > 0), lambda f: F.struct((-f["marks"]).alias("fewer"), f["at"].alias("at")))), 1, most)
    marked = lambda w: F.when(hit(w), F.concat(F.lit(before), w, F.lit(after))).otherwise(w)
    found = F.transform(best, lambda f: F.struct((-f["fewer"]).alias("marks"), f["at"].alias("at"), F.array_join(F.transform(F.slice(items, f["at"] + 1, size), marked), " ").alias("text")))
    return F.when(c.isNotNull(), found)
