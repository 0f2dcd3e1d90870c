"""Search clauses, combinations and templates, with parts as the register and the parts with keys divisible by 100 as returns."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexisift.functions import analyzers as X
from lexisift.functions.arrays import haversine
from lexisift.operators import relational
from lexisift.operators import search as S
from lexisift.operators import search_classes as C
from lexisift.operators import search_index as SI
from lexisift.plans.registry import query
from lexisift.sources.shared import fresh_path, written
from lexisift.streaming import publication

FIELDS = {"name": "p_name", "type": "p_type", "every": "p_name || ' ' || p_type"}
ASKED = "p_partkey % 100 = 0"
LAT, LON = "45 + p_partkey % 50 / 10.0", "1 + p_size / 10.0"


def _field(f: str) -> str:
    w = f"list_filter(string_split(lower({FIELDS[f]}), ' '), lambda w: w <> '')"
    return f"""d_{f} AS (SELECT p_partkey AS k, {w} AS w FROM part), m_{f} AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM d_{f}),
p_{f} AS (SELECT k, term, count(*) AS tf, any_value(dl) AS dl FROM (SELECT k, len(w) AS dl, unnest(w) AS term FROM d_{f}) GROUP BY k, term),
t_{f} AS (SELECT term, ln(1 + (any_value(n) - count(*) + 0.5e0) / (count(*) + 0.5e0)) AS idf FROM p_{f}, m_{f} GROUP BY term),
q_{f} AS (SELECT DISTINCT k AS q, unnest(w) AS term, 1e0 AS weight FROM d_{f} WHERE k % 100 = 0),
a_{f} AS (SELECT DISTINCT term, CASE WHEN length(term) <= 2 THEN 0 WHEN length(term) <= 5 THEN 1 ELSE 2 END AS allowed FROM q_{f}),
x_{f} AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY edits, near) AS r FROM (SELECT a.term, t.term AS near, levenshtein(a.term, t.term) AS edits FROM a_{f} a JOIN t_{f} t ON left(a.term, 1) = left(t.term, 1) AND levenshtein(a.term, t.term) <= allowed)),
f_{f} AS (SELECT q, near AS term, max(1 - edits / CAST(least(length(x.term), length(near)) AS DOUBLE)) AS weight FROM q_{f} JOIN x_{f} x USING (term) WHERE r <= 50 GROUP BY q, near),
s_{f} AS (SELECT q, p.k, sum(weight * idf * tf * 2.2e0 / (tf + 1.2e0 * (0.25e0 + 0.75e0 * dl / mean))) AS score FROM q_{f} JOIN p_{f} p USING (term) JOIN t_{f} USING (term), m_{f} GROUP BY q, p.k),
z_{f} AS (SELECT q, p.k, sum(weight * idf * tf * 2.2e0 / (tf + 1.2e0 * (0.25e0 + 0.75e0 * dl / mean))) AS score FROM f_{f} JOIN p_{f} p USING (term) JOIN t_{f} USING (term), m_{f} GROUP BY q, p.k)"""


HAVERSINE = "2 * 6371008.8e0 * asin(sqrt(power(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * power(sin(radians(b.lon - a.lon) / 2), 2)))"
CTES = f"""WITH {", ".join(_field(f) for f in FIELDS)},
g AS (SELECT p_partkey AS k, CAST({LAT} AS DOUBLE) AS lat, CAST({LON} AS DOUBLE) AS lon FROM part),
dist AS (SELECT a.k AS q, b.k, {HAVERSINE} AS distance FROM g a JOIN g b ON a.k % 100 = 0),
pairs AS (SELECT a.p_partkey AS q, b.p_partkey AS k, a.p_brand AS qb, b.p_brand AS kb, a.p_size AS qs, b.p_size AS ks, a.p_type AS qt, b.p_type AS kt, lower(a.p_name) AS qn, lower(b.p_name) AS kn FROM part a JOIN part b ON a.{ASKED}),
brand AS (SELECT q, k, 1e0 AS score FROM pairs WHERE qb = kb), size AS (SELECT q, k, 1e0 AS score FROM pairs WHERE qs = ks), kind AS (SELECT q, k, 1e0 AS score FROM pairs WHERE left(qt, 3) = left(kt, 3)),
kw AS (SELECT q, k, 1 - levenshtein(qn, kn) / CAST(least(length(qn), length(kn)) AS DOUBLE) AS score FROM pairs WHERE left(qn, 1) = left(kn, 1) AND levenshtein(qn, kn) <= CASE WHEN length(qn) <= 2 THEN 0 WHEN length(qn) <= 5 THEN 1 ELSE 2 END),
code AS (SELECT q, k, CASE WHEN left(qb, 7) = left(kb, 7) THEN 2e0 ELSE 0e0 END + CASE WHEN qb = kb THEN 3e0 ELSE 0e0 END AS score FROM pairs WHERE left(qb, 7) = left(kb, 7)),
acro AS (SELECT a.k AS q, b.k, 1e0 AS score FROM (SELECT k, array_to_string(list_transform(w, lambda x: left(x, 1)), '') AS l FROM d_every) a JOIN (SELECT k, array_to_string(list_transform(w, lambda x: left(x, 1)), '') AS l FROM d_every) b ON a.k % 100 = 0 AND a.l = b.l AND length(a.l) >= 3)"""


def _boosted(c: str, boost: float) -> str:
    return f"SELECT q, k, score * {boost}e0 AS score FROM {c}"


def _bool(must=(), should=(), filters=(), minimum=None) -> str:
    least = minimum if minimum is not None else (0 if must or filters else 1)
    rows = [f"SELECT q, k, score, '{kind}' AS kind FROM ({c})" for kind, cs in (("m", must), ("s", should), ("f", [f"SELECT q, k, 0e0 AS score FROM ({x})" for x in filters])) for c in cs]
    return f"SELECT q, k, sum(CASE WHEN kind = 'f' THEN 0e0 ELSE score END) AS score FROM ({' UNION ALL '.join(rows)}) GROUP BY q, k HAVING count(*) FILTER (kind = 'm') = {len(must)} AND count(*) FILTER (kind = 'f') = {len(filters)} AND count(*) FILTER (kind = 's') >= {least}"


def _max(clauses, tie: float) -> str:
    return f"SELECT q, k, max(score) + {tie}e0 * (sum(score) - max(score)) AS score FROM ({' UNION ALL '.join(f'SELECT q, k, score FROM ({c})' for c in clauses)}) GROUP BY q, k"


def _gauss(c: str, scale: float) -> str:
    return f"SELECT c.q, c.k, score * exp(ln(0.5e0) * power(distance / {scale}e0, 2)) AS score FROM ({c}) c JOIN dist ON c.q = dist.q AND c.k = dist.k"


def _within(metres: float) -> str:
    return f"SELECT q, k, 0e0 AS score FROM dist WHERE distance <= {metres}"


def _top(c: str, k: int = 10) -> str:
    return f"{CTES} SELECT q, k AS key, score, CAST(rank AS INTEGER) AS rank FROM (SELECT q, k, round(score, 6) AS score, row_number() OVER (PARTITION BY q ORDER BY round(score, 6) DESC, k) AS rank FROM ({c})) WHERE rank <= {k}"


#: Where the register's index was written, by session, folder of tables and version of the register.
_indexes: dict[tuple[str, ...], str] = {}


def _written_index(t, build) -> str:
    """The path of an index that is built once for a version of the register and then searched by every clause and query."""
    key = t.spark.sparkContext.applicationId, t.folder, SI.table_version(t.spark, f"{t.folder}/part.parquet")
    if key not in _indexes or not SI.exists(t.spark, f"{_indexes[key]}/fields/_SUCCESS"):
        path = fresh_path(t.spark, "register-index")
        build(path)
        _indexes[key] = path
    return _indexes[key]


def _words(c):
    return F.filter(F.split(F.lower(c), " "), lambda w: w != "")


ITEMS = {"name": "p_name", "type": "p_type", "every": "every"}


def _distance():
    return haversine(F.col("q_lat"), F.col("q_lon"), F.col("lat"), F.col("lon"))


def _same_brand():
    return F.col("q_p_brand") == F.col("p_brand")


def _same_size():
    return F.col("q_p_size") == F.col("p_size")


def _same_kind():
    return F.left("q_p_type", F.lit(3)) == F.left("p_type", F.lit(3))


def _same_acronym():
    return F.col("q_sigle") == F.col("sigle")


def _codes():
    """A code's beginning and the whole of it, as conditions on candidates."""
    return [(F.left("q_p_brand", F.lit(7)) == F.left("p_brand", F.lit(7)), 2), (_same_brand(), 3)]


KIND_OF = "left(p_type, 3)"


def _found():
    """That other clauses have found a candidate, as one of on_candidates' conditions."""
    return F.col("_score") > 0


#: Classes of records by what clauses read of them; a text is all of it.
CLASSES = {"c_name": ["w_name"], "c_type": ["w_type"], "c_every": ["w_every"], "c_lname": ["lname"], "text": ["p_name", "p_type"]}


class Register:
    """The register's index and the clauses of every return; hits of clauses are those of classes of equal records."""

    def __init__(self, t):
        parts = t.part.withColumns({"lat": F.expr(LAT).cast("double"), "lon": F.expr(LON).cast("double")})
        self.items = {f: _words(F.col(c)) for f, c in ITEMS.items()}
        path = _written_index(t, lambda path: self._write(parts, path))
        self.parts = t.spark.read.parquet(f"{path}/documents")
        self.texts = t.spark.read.parquet(f"{path}/texts")
        self.asked = self.parts.where(ASKED)
        self.asked_texts = self.asked.select(*self.texts.columns).distinct()
        self.index = SI.open_index(t.spark, path)
        self.terms = {f: S.query_terms(self.asked, "p_partkey", c) for f, c in self.items.items()}
        self.class_terms = {f: S.query_terms(self.asked.select(f"c_{f}", c.alias("w")).distinct(), f"c_{f}", F.col("w")) for f, c in self.items.items()}
        self.narrowed = {}

    def _write(self, parts, path):
        """All words and classes follow from a text, so they are found among the distinct texts; records are read for their counts and joined once."""
        counted = parts.groupBy(*CLASSES["text"]).agg(F.min("p_partkey").alias("p_partkey"), F.count("*").alias("n"))
        texts = written(counted, "texts").withColumns({"lname": F.lower("p_name"), "every": F.concat_ws(" ", "p_name", "p_type")})
        texts = texts.withColumns({"sigle": F.get(X.acronym(F.col("every")), F.lit(0)), **{f"w_{f}": c for f, c in self.items.items()}})
        texts = written(C.with_classes(texts, "p_partkey", CLASSES), "text-classes")
        C.joined(parts, texts.drop("p_partkey", "n", *[f"w_{f}" for f in self.items]), CLASSES["text"]).write.parquet(f"{path}/documents")
        texts.select(*CLASSES).write.parquet(f"{path}/texts")
        SI.write_index(C.build_class_index(texts, {f: (f"c_{f}", F.col(f"w_{f}")) for f in self.items}, "n"), path)

    def of(self, f):
        """The index of the terms that are asked of a field."""
        if f not in self.narrowed:
            self.narrowed[f] = S.of_few_terms(self.index, self.class_terms[f])
        return self.narrowed[f]

    def _of_texts(self, hits, by):
        return C.widened(hits, self.asked_texts.select(by, "text").distinct(), self.texts.select(by, "text").distinct(), by, "text")

    def names(self, boost=1.0):
        """Hits of classes by name."""
        return S.match(self.of("name"), self.class_terms["name"], "name", boost)

    def fuzzy_names(self):
        return S.match(self.index, S.fuzzy_terms(self.index, self.class_terms["name"], "name"), "name")

    def match(self, f, boost=1.0):
        """Hits of texts by a field."""
        return self._of_texts(S.match(self.of(f), self.class_terms[f], f, boost), f"c_{f}")

    def fuzzy(self, f, boost=1.0):
        return self._of_texts(S.match(self.index, S.fuzzy_terms(self.index, self.class_terms[f], f), f, boost), f"c_{f}")

    def keyword(self):
        """Hits of classes by whole names in lower case."""
        names = lambda df: df.select("c_lname", "lname").distinct()
        return S.keyword_fuzzy(names(self.asked), "c_lname", "lname", names(self.parts), "c_lname", "lname")

    def top(self, hits, by="text", **clauses):
        return C.top(hits, by, self.asked, "p_partkey", self.parts, "p_partkey", **clauses)

    def top_near(self, hits, scale, by="c_name", **clauses):
        return C.top_near(hits, by, self.asked, "p_partkey", self.parts, "p_partkey", _distance(), scale, **clauses)

    def best(self, f, boost=1.0, k=10, norms=True):
        return self.top(SI.top_match(self.of(f), self.class_terms[f], f, k, boost, norms).drop("rank"), f"c_{f}", k=k)

    def best_fuzzy(self, f, k=10):
        return self.top(SI.top_match(self.index, S.fuzzy_terms(self.index, self.class_terms[f], f), f, k).drop("rank"), f"c_{f}", k=k)

    def _same(self, equal, metres):
        """Queries and records by class and equal values, and by the query's point where they are to be near."""
        asked, there = C.named(self.asked, "p_partkey", "q", "text", equal, "lat", "lon"), C.named(self.parts, "p_partkey", "key", "text", equal, "lat", "lon")
        return (asked, there, []) if metres is None else (*C.near_queries(asked, there, metres), ["here"])

    def candidates(self, hits, equal, metres=None):
        asked, there, always = self._same(equal, metres)
        return C.candidates(hits, asked, there, [f"e{i}" for i in range(len(equal))], always)

    def alone(self, equal, metres):
        """What equal values bring within a distance, whatever the texts."""
        asked, there, always = self._same(equal, metres)
        return C.alone(asked, there, [f"e{i}" for i in range(len(equal))], always)

    def once(self, *columns):
        """Search one of the queries that are equal by columns; returns what gives the others its best."""
        asked = self.asked.select(F.col("p_partkey").alias("q"), *columns)
        firsts = asked.groupBy(*columns).agg(F.min("q").alias("one"))
        self.asked = self.asked.join(firsts.select(F.col("one").alias("p_partkey")), "p_partkey", "left_semi")
        return lambda best: C.shared(best, asked, firsts, columns)

    def beside(self, hits):
        return S.beside(hits, self.asked, "p_partkey", self.parts, "p_partkey")

    def on(self, hits, **clauses):
        return S.on_candidates(hits, self.asked, "p_partkey", self.parts, "p_partkey", **clauses)

    def equal(self, column, boost=1.0):
        """All pairs of equal value: for values that few records share."""
        return S.term(self.asked, "p_partkey", self.parts, "p_partkey", [(column, column)], boost)

    def codes(self):
        """What the best ten by graded codes can have."""
        return self.on(self.firsts("left(p_brand, 7)", "p_brand"), should=_codes())

    def firsts(self, *columns):
        """What the best ten can have by equal values alone."""
        return S.first_equals(self.asked, "p_partkey", self.parts, "p_partkey", [(F.expr(c), F.expr(c)) for c in columns])

    def near(self, metres):
        return S.near(self.asked, "p_partkey", self.parts, "p_partkey", "lat", "lon", metres)


def _search(name: str, sql: str, f, k: int = 10):
    query(name, _top(sql, k))(lambda t: S.top(f(Register(t)), k))


def _best(name: str, sql: str, f):
    """A search whose hits are its best ten already."""
    query(name, _top(sql))(lambda t: f(Register(t)))


def _dis_max_of_three(r):
    """An equal brand is a third clause: records that have it are scored with it, and all without it, which is never more."""
    texts = [r.match("name"), r.match("type")]
    found = S.dis_max(texts, 0.5)
    branded = S.dis_max([*texts, found.withColumn("score", F.lit(1.0))], 0.5)
    alone = r.on(r.firsts("p_brand"), should=[(_same_brand(), 1)], minimum=1)
    tops = [r.top(found), r.top(branded, equal=["p_brand"], filters=[_same_brand()]), alone]
    return S.top(S.dis_max([x.select("q", "key", "score") for x in tops]))


def _candidate_pairs(r):
    """All pairs that have a word of their names in common: of classes, then of their records, which get lists of what asks for their class."""
    hits = r.names().select(F.col("q").alias("asked"), F.col("key").alias("c_name"))
    asked = r.asked.select(F.col("p_partkey").alias("q"), F.col("c_name").alias("asked"))
    lists = relational.in_lists(written(hits.join(asked, "asked").select("c_name", "q"), "asked-of-classes"), ["c_name"], "asked")
    return relational.with_lists(r.parts.select("c_name", F.col("p_partkey").alias("key")), lists, ["c_name"], "asked", "key").select("q", "key")


NAME, TYPE, EVERY = "SELECT * FROM s_name", "SELECT * FROM s_type", "SELECT * FROM s_every"
FUZZY = "SELECT * FROM z_name"

_best("Q1_match", NAME, lambda r: r.best("name"))
_best("Q2_best_fields", _max([_boosted("s_name", 2), TYPE], 0), lambda r: r.top(S.dis_max([r.match("name", 2), r.match("type")])))
_best("Q3_most_fields", _max([_boosted("s_name", 2), TYPE], 1), lambda r: r.top(S.dis_max([r.match("name", 2), r.match("type")], 1.0)))
_best("Q4_boost", _boosted("s_type", 3), lambda r: r.best("type", 3))
_best("Q5_fuzzy", FUZZY, lambda r: r.best_fuzzy("name"))


@query("Q6_zero_terms", f"SELECT a.p_partkey AS q, b.p_partkey AS key, 1e0 AS score FROM part a JOIN part b ON a.{ASKED} AND a.p_partkey % 1000 = 0")
def _(t):
    r = Register(t)
    some = r.terms["name"].where("q % 1000 <> 0")
    return S.zero_terms(r.asked, "p_partkey", some, r.parts, "p_partkey")


_best("Q7_must", _bool(must=[NAME, TYPE]), lambda r: r.top(S.boolean(must=[r.match("name"), r.match("type")])))
_best("Q8_should_minimum", _bool(should=[NAME, "SELECT * FROM brand", "SELECT * FROM size"], minimum=2), lambda r: r.top(r.names(), "c_name", equal=["p_brand", "p_size"], should=[(_found(), 0), (_same_brand(), 1), (_same_size(), 1)], minimum=2, bare=True))
_best("Q9_filter", _bool(must=[NAME], filters=["SELECT * FROM brand"]), lambda r: r.top(r.names(), "c_name", equal=["p_brand"], filters=[_same_brand()]))
_best("Q10_dis_max", _max([NAME, TYPE, "SELECT * FROM brand"], 0.5), _dis_max_of_three)
_search("Q11_term", _boosted("brand", 4), lambda r: r.on(r.firsts("p_brand"), should=[(_same_brand(), 4)]))
_search("Q12_wildcard", "SELECT * FROM kind", lambda r: r.on(r.firsts(KIND_OF), should=[(_same_kind(), 1)]))
_best("Q13_gauss_decay", _gauss(NAME, 100000), lambda r: r.top_near(r.names(), 100000))
query("Q14_geo_distance", f"{CTES} SELECT q, k AS key, round(distance, 3) AS distance FROM dist WHERE distance <= 30000")(lambda t: Register(t).near(30000).withColumn("distance", F.round("distance", 3)))
_best("Q15_keyword_fuzzy", "SELECT * FROM kw", lambda r: r.top(r.keyword(), "c_lname"))
_search("Q16_graded_codes", "SELECT * FROM code", lambda r: r.codes())
query("Q17_fixed_keywords", "SELECT p_partkey AS key FROM part WHERE list_has_any(string_split(lower(p_name), ' '), ['anvil', 'gear'])")(lambda t: S.contains_any(t.part, "p_partkey", F.split(F.lower("p_name"), " "), ["anvil", "gear"]))
query("Q18_highlight", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: CASE WHEN lower(w) IN ('anvil', 'gear') THEN '<em>' || w || '</em>' ELSE w END), ' ') AS marked FROM part")(
    lambda t: t.part.select("p_partkey", S.highlight(F.col("p_name"), F.array(F.lit("anvil"), F.lit("gear"))).alias("marked"))
)


MARKED = ("the", "der", "les", "que")
_HITS = "list_contains([" + ", ".join(f"'{w}'" for w in MARKED) + "], lower(x))"
query(
    "Q18_fragments",
    f"""WITH w AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents), f AS (SELECT doc_id, unnest(list_transform(range(0, len(w), 20), lambda i: {{'at': i, 'w': w[i + 1:i + 20]}})) AS f FROM w),
n AS (SELECT doc_id, f.at AS place, len(list_filter(f.w, lambda x: {_HITS})) AS marks, array_to_string(list_transform(f.w, lambda x: CASE WHEN {_HITS} THEN '<em>' || x || '</em>' ELSE x END), ' ') AS text FROM f)
SELECT doc_id, CAST(rank AS INTEGER) AS rank, CAST(marks AS INTEGER) AS marks, CAST(place AS INTEGER) AS place, text FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY marks DESC, place) AS rank FROM n WHERE marks > 0) WHERE rank <= 5""",
)(lambda t: t.documents.select("doc_id", F.posexplode(S.fragments(F.col("text"), MARKED)).alias("i", "f")).select("doc_id", (F.col("i") + 1).alias("rank"), "f.marks", F.col("f.at").alias("place"), "f.text"))


def _templates(r):
    return {"name": r.best("name"), "type": r.best("type"), "code": S.top(r.codes())}


def _union(*parts) -> str:
    return " UNION ALL ".join(f"SELECT q, key, '{n}' AS template, score FROM ({_top(c).removeprefix(CTES)})" for n, c in parts)


ECHOES = _union(("name", NAME), ("type", TYPE), ("code", "SELECT * FROM code"))
query("Q19_multi_search", f"{CTES} {ECHOES}")(lambda t: S.echoes(_templates(Register(t))))
_search("Q20_without_self", f"SELECT * FROM ({NAME}) WHERE q <> k", lambda r: S.without_self(r.best("name", k=11)))
query("Q21_echo_counts", f"{CTES} SELECT q, key, count(*) AS nb FROM ({ECHOES}) GROUP BY q, key")(lambda t: S.echo_counts(S.echoes(_templates(Register(t)))))
NORMLESS = "SELECT q, p.k, sum(weight * idf * tf * 2.2e0 / (tf + 1.2e0)) AS score FROM q_every JOIN p_every p USING (term) JOIN t_every USING (term) GROUP BY q, p.k"
_best("X14_without_norms", NORMLESS, lambda r: r.best("every", norms=False))
query("J17_candidate_join", f"{CTES} SELECT q, k AS key FROM s_name")(lambda t: _candidate_pairs(Register(t)))
query("J18_geo_join", f"{CTES} SELECT q, k AS key FROM dist WHERE distance <= 100000")(lambda t: Register(t).near(100000).select("q", "key"))

BRAND, SIZE, KIND, ACRO = "SELECT * FROM brand", "SELECT * FROM size", "SELECT * FROM kind", "SELECT * FROM acro"
_best("T1_fuzzy_name_and_address", _bool(must=[_max([FUZZY, "SELECT * FROM z_type"], 0)], should=[BRAND, SIZE, KIND], minimum=2), lambda r: r.top(S.dis_max([r.fuzzy("name"), r.fuzzy("type")]), equal=["p_brand", "p_size"], should=[(_same_brand(), 1), (_same_size(), 1), (_same_kind(), 1)], minimum=2))
_best("T2_fuzzy_name_and_point", _gauss(_bool(must=[FUZZY], filters=[_within(50000)]), 10000), lambda r: r.top_near(r.fuzzy_names(), 10000, metres=50000))
_best("T3_exact_name_and_address", _bool(must=["SELECT * FROM kw"], should=[BRAND, SIZE, KIND], minimum=2), lambda r: r.top(r.keyword(), "c_lname", equal=["p_brand", "p_size", KIND_OF], should=[(_same_brand(), 1), (_same_size(), 1), (_same_kind(), 1)], minimum=2))
_best("T4_exact_name_and_point", _gauss(_bool(must=["SELECT * FROM kw"], filters=[_within(80000)]), 20000), lambda r: r.top_near(r.keyword(), 20000, "c_lname", metres=80000))
_best("T5_shoulds_with_acronym", _bool(should=[NAME, TYPE, ACRO, KIND]), lambda r: r.top(S.boolean(should=[r.match("name"), r.match("type")]), equal=["sigle", KIND_OF], should=[(_same_acronym(), 1), (_same_kind(), 1)], bare=True))
_best("T6_catch_all", _bool(should=[_boosted("s_every", 10), _boosted("brand", 7), _boosted("kind", 5), SIZE]), lambda r: r.top(r.match("every", 10), equal=["p_brand", KIND_OF, "p_size"], should=[(_same_brand(), 7), (_same_kind(), 5), (_same_size(), 1)], bare=True))
_best("T7_filtered_domain", _bool(should=[_boosted("acro", 5), _boosted("brand", 10), _boosted("kind", 5), TYPE], filters=[NAME]), lambda r: r.top(S.boolean(should=[r.match("type")], filters=[r.match("name")]), equal=["p_brand"], should=[(_same_acronym(), 5), (_same_brand(), 10), (_same_kind(), 5)]))
_best("T8_catch_all_and_point", _gauss(_bool(should=[_boosted("s_every", 10), _boosted("size", 20)], filters=[_within(100000)], minimum=1), 10000), lambda r: r.top_near(r.match("every", 10), 10000, "text", metres=100000, equal=["p_size"], should=[(_found(), 0), (_same_size(), 20)], minimum=1, bare=True))
_best("T9_name_near", _gauss(_bool(must=[NAME], should=[KIND], filters=[_within(200000)]), 50000), lambda r: r.top_near(r.names(), 50000, metres=200000, equal=[KIND_OF], should=[(_same_kind(), 1)]))
_best("T10_catch_all_near", _gauss(_bool(must=[EVERY], filters=[_within(200000)]), 50000), lambda r: r.top_near(r.match("every"), 50000, "text", metres=200000))


def _robust(tie):
    sql = _max([_bool(should=[NAME, BRAND, KIND], filters=[_within(50000)], minimum=2), _bool(should=[NAME, TYPE, BRAND, SIZE, KIND], filters=[KIND], minimum=4)], tie)

    def search(r):
        """A score never falls where more of brand, size, kind and nearness agrees, so choices of these bring all that can be best; a text's class tells its kind."""
        zero, for_all = F.lit(0.0), r.once("text", "p_brand", "p_size", "lat", "lon")
        each = r.match("name").select("q", "key", F.col("score").alias("name"), zero.alias("type")).unionByName(r.match("type").select("q", "key", zero.alias("name"), F.col("score").alias("type")))
        texts = each.groupBy("q", "key").agg(F.struct(F.sum("name").alias("name"), F.sum("type").alias("type")).alias("score"))
        found = r.candidates(texts, ["p_brand", "p_size"]).unionByName(r.candidates(texts, ["p_brand", "p_size"], 50000))
        none = F.struct(zero.alias("name"), zero.alias("type")).alias("score")
        found = found.unionByName(r.alone(["p_brand", KIND_OF], 50000).select("q", "key", none)).groupBy("q", "key").agg(F.max("score").alias("score"))
        holds = lambda c: F.coalesce(c, F.lit(False)).cast("int")
        by, near = F.col("_score.name"), holds(_distance() <= 50000) == 1
        brand, size, kind = holds(_same_brand()), holds(_same_size()), holds(_same_kind())
        text = by + F.col("_score.type")
        first = F.when(near & (holds(by > 0) + brand + kind >= 2), by + brand + kind)
        second = F.when((kind == 1) & (holds(by > 0) + holds(F.col("_score.type") > 0) + brand + size + kind >= 4), text + brand + size + kind)
        rows = r.beside(found).select("q", F.col("_key").alias("key"), first.alias("first"), second.alias("second"))
        best = F.greatest("first", "second")
        return for_all(S.top(rows.where(best.isNotNull()).select("q", "key", (best + tie * (F.coalesce("first", zero) + F.coalesce("second", zero) - best)).alias("score"))))

    return sql, search


_best("T11_robust_return", *_robust(0.5))
_best("T12_robust_register", *_robust(0.7))
query("T13_by_id", "SELECT p_partkey AS q, p_partkey AS key FROM part WHERE p_partkey % 100 = 0")(lambda t: Register(t).equal("p_partkey").select("q", "key"))
_best("T14_simple", _bool(must=[NAME], should=[BRAND]), lambda r: r.top(r.names(), "c_name", equal=["p_brand"], should=[(_same_brand(), 1)]))
_best("T14_three_musts", _bool(must=[NAME, TYPE, EVERY]), lambda r: r.top(S.boolean(must=[r.match("name"), r.match("type"), r.match("every")])))
_best("T14_best_name_and_place", _bool(must=[_max([NAME, EVERY], 0), TYPE], filters=[BRAND]), lambda r: r.top(S.boolean(must=[S.dis_max([r.match("name"), r.match("every")]), r.match("type")]), equal=["p_brand"], filters=[_same_brand()]))
_best("T14_best_name_boosted_place", _bool(must=[_max([_boosted("s_name", 2), EVERY], 0)], should=[_boosted("brand", 3)]), lambda r: r.top(S.dis_max([r.match("name", 2), r.match("every")]), equal=["p_brand"], should=[(_same_brand(), 3)]))
_best("T15_graded_variant", _bool(must=[NAME], should=["SELECT * FROM code"]), lambda r: r.top(r.names(), "c_name", equal=["left(p_brand, 7)", "p_brand"], should=_codes()))
_best(
    "T15_fuzzy_with_graded_codes", _bool(must=[_max([_boosted("z_every", 10), _boosted("z_name", 4)], 1)], should=[_boosted("brand", 7), _boosted("kind", 5), _boosted("size", 2)]),
    lambda r: r.top(S.dis_max([r.fuzzy("every", 10), r.fuzzy("name", 4)], 1.0), equal=["p_brand", "p_size"], should=[(_same_brand(), 7), (_same_kind(), 5), (_same_size(), 2)]),
)
_best("T16_legacy_variant", _gauss(_bool(must=[NAME], filters=[_within(300000)]), 10000), lambda r: r.top_near(r.names(), 10000, metres=300000))


@query("R1_search_after_publication", _top(NAME))
def _(t):
    """The best ten by name after the register was published in three batches, with replaced records and one that came too late."""
    r = Register(t)
    records = r.parts.select("p_partkey", "p_name", F.lit(2).alias("published"))
    draft = records.select("p_partkey", F.concat(F.lit("draft "), F.col("p_name")).alias("p_name"), F.lit(1).alias("published"))
    third = lambda n: F.col("p_partkey") % 3 == n
    batches = [draft.where(~third(2)), records.where(~third(0)), records.where(third(0)).union(draft.where(third(1)))]
    folder = fresh_path(t.spark, "returns")
    for b in batches:  # a file each, taken in this order
        b.coalesce(1).write.mode("append").parquet(folder)
    index = SI.SegmentedIndex(t.spark, fresh_path(t.spark, "published-index"), {"name": _words(F.col("p_name"))}, "p_partkey")
    publication.publish_to_index(publication.file_stream(t.spark, folder, records.schema), index, fresh_path(t.spark, "index-state"), compact_every=2).awaitTermination()
    best = SI.top_match(index.open(), r.class_terms["name"], "name").withColumnRenamed("q", "c_name")
    return r.asked.select("c_name", F.col("p_partkey").alias("q")).join(best, "c_name").select("q", "key", "score", "rank")


@query("S25_random_document", "SELECT c_custkey FROM customer ORDER BY c_custkey * 7919 % 10007, c_custkey LIMIT 1")
def _(t):
    return relational.sample_at_most(t.customer, "c_custkey", 1).select("c_custkey")


_best("T16_legacy_five_kilometres", _gauss(_bool(must=[NAME], should=[BRAND, SIZE], filters=[_within(60000)], minimum=0), 5000), lambda r: r.top_near(r.names(), 5000, metres=60000, equal=["p_brand", "p_size"], should=[(_same_brand(), 1), (_same_size(), 1)]))
