"""Secret scans by corpus-wide ownership frequency, with DataFrame functions only.

Candidates come from three patterns. What a pattern finds is turned into code-point spans without any
Python: splitting a text by a pattern gives the stretches between its matches, and running sums of the
lengths of stretches and matches are the positions.

A candidate's value is then hashed and counted over the whole corpus by distinct repositories and distinct
owners. A value that many owners have is a copied example; one that stays with few owners looks live. A
repository is named by one column or several: documents have ``source`` for the owner and, as an owner's repositories, its
parts by ``lang``. Live values get a span of their own kind, ``live``, on the value itself. Counting first reduces to distinct
(hash, owner, repository), so a value that a third of all rows carry is reduced before it is shuffled, and
only rows with candidates, without their texts, are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisift.llm.common import materialise, table, unused, without

#: The kinds in the order in which spans at one place are listed, their patterns, the group that
#: holds the value and the least length that counts (of that group).
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: A text without this can't hold the kind; the other patterns then don't run on it.
PRESENT = {
    "assign": PATTERNS["assign"][0],
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
}
#: What splits a text for positions. Runs of 24 or more are just the runs that count, with the same spans.
CUTS = {"assign": PATTERNS["assign"][0], "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
MAX_OWNERS = 3
MAX_REPOSITORIES = 3


def _found(text: Column, kind: str) -> Column:
    """The kind's candidates in a text: array of struct(start, rank, end, kind, value), in order."""
    cut, (_, group, least) = CUTS[kind], PATTERNS[kind]
    # the limit -1 keeps empty stretches, so there is one stretch more than matches
    between, matches = F.split(text, cut, -1), F.regexp_extract_all(text, F.lit(cut), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(cut), F.lit(group)) if group else matches
    pieces = F.arrays_zip(between.alias("gap"), matches.alias("match"), values.alias("value"))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")

    def step(acc, x):
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.coalesce(F.char_length(x["match"]), F.lit(0))
        spot = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))
        counts = F.coalesce(F.char_length(x["value"]), F.lit(0)) >= least
        return F.struct(end.alias("at"), F.when(counts, F.concat(acc["spots"], F.array(spot))).otherwise(acc["spots"]).alias("spots"))

    run = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("spots")), step)["spots"]
    return F.when(text.rlike(PRESENT[kind]), run).otherwise(empty)


def find_candidates(df: DataFrame, text: str = "text", found: str = "candidates") -> DataFrame:
    """Add an array of candidates, struct(start, rank, end, kind, value), ordered by start and then kind.

    start and end count code points, end exclusive. A null text has none. A column named like the output is replaced.
    """
    rows = without(df, [found])
    whole = F.coalesce(F.col(text), F.lit(""))
    return rows.withColumn(found, F.array_sort(F.concat(*[_found(whole, k) for k in KINDS])))


def named_by(columns: str | tuple[str, ...]) -> Column:
    """One text for a column or several; a null counts as an empty one."""
    each = (columns,) if isinstance(columns, str) else columns
    return F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(str(i)) for i, c in enumerate(each)]))


def ownership(candidates: DataFrame, owner: str, repository: str, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """For each value hash: n_rows, n_owners, n_repositories and whether it is live (held by few of both).

    candidates: value_hash and the owner and repository columns. A null owner or repository counts as one of its own.
    """
    named = candidates.select("value_hash", F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("o"), F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("r"))
    pairs = named.groupBy("value_hash", "o", "r").agg(F.count("*").alias("n"))
    by_owner = pairs.groupBy("value_hash", "o").agg(F.sum("n").alias("n"), F.lit(0).alias("k")).groupBy("value_hash").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_owners"))
    by_repository = pairs.groupBy("value_hash", "r").agg(F.lit(0).alias("k")).groupBy("value_hash").agg(F.count("*").alias("n_repositories"))
    return by_owner.join(by_repository, "value_hash").withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories))


def scan(
    df: DataFrame, text: str = "text", key: str = "doc_id", owner: str = "source", repository: str | tuple[str, ...] = ("source", "lang"),
    max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row for each row of df: the key, ``base`` (its candidates), ``live`` (those judged live, spans of the value).

    live: array of struct(start, rank, end, kind, value) with kind ``live``, in order. Rows with the same key are
    told apart, each keeps its own spans. No candidates, or an empty or null text: both arrays are empty.
    A value may occur in any number of rows; none are dropped or capped.
    """
    base = materialise(
        find_candidates(df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(owner).alias("owner"), named_by(repository).alias("repository")), "text", "base")
        .drop("text").withColumn("row", F.monotonically_increasing_id()), "secret-candidates",
    )
    each = base.where(F.size("base") > 0).select("row", "owner", "repository", F.explode("base").alias("c")).withColumn("value_hash", F.sha2("c.value", 256))
    judged = ownership(each, "owner", "repository", max_owners, max_repositories).where("live").select("value_hash")
    # the value stands at the end of what matched
    spot = F.struct((F.col("c.end") - F.char_length("c.value")).alias("start"), F.lit(len(KINDS)).alias("rank"), F.col("c.end").alias("end"), F.lit("live").alias("kind"), F.col("c.value").alias("value"))
    live = each.join(judged, "value_hash", "left_semi").groupBy("row").agg(F.array_sort(F.collect_set(spot)).alias("live"))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")
    with_any = base.where(F.size("base") > 0).join(live, "row", "left")
    rest = base.where(F.size("base") == 0).withColumn("live", empty)
    return with_any.unionByName(rest).select(F.col("key").alias(key), "base", F.coalesce("live", empty).alias("live"))


def _listed(spots: Column) -> Column:
    return F.array_join(F.transform(spots, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(
    df: DataFrame, text: str = "text", key: str = "doc_id", owner: str = "source", repository: str | tuple[str, ...] = ("source", "lang"),
    length: str = "n_chars", live_mask: str = "[SECRET]", example_mask: str = "[EXAMPLE]", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """df with every candidate in its text masked, live ones and copied examples by masks of their own.

    Overlapping spans get one mask, that of the first. Rows without candidates, null and empty texts are as they were;
    no row is added or dropped, and the columns are those of df; a column of text lengths follows the change. Texts are
    scanned once, and only rows with candidates are joined, each by a number of its own.
    """
    spots, spans, row, found = unused(df, "spots"), unused(df, "spans"), unused(df, "row"), unused(df, "found_in")
    marked = materialise(find_candidates(df, text, spots).withColumn(row, F.monotonically_increasing_id()), "secret-candidates")
    hit = marked.where(F.size(spots) > 0)
    each = hit.select(F.col(row).alias(found), F.col(owner).alias("owner"), named_by(repository).alias("repository"), F.explode(spots).alias("c")).withColumn("value_hash", F.sha2("c.value", 256))
    judged = ownership(each, "owner", "repository", max_owners, max_repositories).select("value_hash", "live")
    spot = F.struct(F.col("c.start").alias("start"), F.col("c.rank").alias("rank"), F.col("c.end").alias("end"), "live")
    joined = hit.join(each.join(judged, "value_hash").groupBy(found).agg(F.array_sort(F.collect_set(spot)).alias(spans)), F.col(row) == F.col(found))

    def step(acc, s):
        gap = F.substring(F.col(text), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mask = F.when(s["live"], F.lit(live_mask)).otherwise(F.lit(example_mask))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["done"], gap, mask)).otherwise(acc["done"]).alias("done"),
        )

    made = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("done")), step)
    masked = F.concat(made["done"], F.substring(F.col(text), made["at"] + 1, F.char_length(text)))
    made_columns = {text: masked, **({length: F.char_length(masked).cast(df.schema[length].dataType)} if length in df.columns else {})}
    changed = joined.select(*[made_columns.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])
    return marked.where(F.size(spots) == 0).select(*[F.col(f"`{c}`") for c in df.columns]).unionByName(changed)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and spans of every document, and all spans with those judged live."""
    found = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.array_sort(F.concat("base", "live"))
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(every).alias("spans"))


def _sql_spots(kind: str) -> str:
    """SQL for a kind's candidates as a list of struct(s, r, e, k, v)."""
    pattern, group, least = PATTERNS[kind]
    quoted = pattern.replace("'", "''")
    size = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)"
    start = size.format("g[1:i]") + " + " + size.format("m[1:i - 1]")
    spot = f"{{'s': CAST({start} AS INTEGER), 'r': {KINDS.index(kind)}, 'e': CAST({start} + length(m[i]) AS INTEGER), 'k': '{kind}', 'v': v[i]}}"
    found = f"SELECT string_split_regex(t, '{quoted}') AS g, regexp_extract_all(t, '{quoted}') AS m, regexp_extract_all(t, '{quoted}', {group}) AS v"
    return f"(SELECT list_filter(list_transform(range(1, len(m) + 1), lambda i: {spot}), lambda x: length(x.v) >= {least}) FROM ({found}))"


OP3_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS o, coalesce(lang, '') AS l, coalesce("text", '') AS t, row_number() OVER () AS n FROM documents),
b AS (SELECT doc_id, o, l, n, list_sort(list_concat({", ".join(_sql_spots(k) for k in KINDS)})) AS base FROM d),
x AS (SELECT n, o, l, unnest(base) AS c FROM b),
live AS (SELECT c.v AS v FROM x GROUP BY c.v HAVING count(DISTINCT o) <= {MAX_OWNERS} AND count(DISTINCT {{'o': o, 'l': l}}) <= {MAX_REPOSITORIES}),
f AS (SELECT n, list(DISTINCT {{'s': CAST(c.e - length(c.v) AS INTEGER), 'r': {len(KINDS)}, 'e': c.e, 'k': 'live', 'v': c.v}}) AS live FROM x JOIN live ON c.v = live.v GROUP BY n),
a AS (SELECT doc_id, base, list_sort(list_concat(base, coalesce(f.live, []))) AS every FROM b LEFT JOIN f ON b.n = f.n)
SELECT doc_id, {", ".join(f"CAST(len(list_filter(base, lambda s: s.k = '{k}')) AS BIGINT) AS n_{k}" for k in KINDS)},
sha256(array_to_string(list_transform(base, lambda s: s.k || ':' || s.s || ':' || s.e), ',')) AS base_sha256,
array_to_string(list_transform(every, lambda s: s.k || ':' || s.s || ':' || s.e), ',') AS spans FROM a
"""
