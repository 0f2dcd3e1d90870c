"""String functions, analyzers, dates, numbers and arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexisift.functions import analyzers as X
from lexisift.functions import arrays as M
from lexisift.functions import stemming as S
from lexisift.functions import text as T
from lexisift.plans.registry import query
from lexisift.sources import tables as IO

PUNCTUATED = "translate(text, '!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~’—°€', '                                    ')"


def _docs(t):
    return t.documents.select("doc_id", "text")


def _one(name, sql, column, out="text", table="documents", key="doc_id"):
    query(name, f"SELECT {key}, {sql} AS {out} FROM {table}")(lambda t: getattr(t, table).select(key, column().alias(out)))


_one("F1_trim", "trim(text)", lambda: F.trim("text"))
_one("F2_lower", "lower(text)", lambda: F.lower("text"))
_one("F3_keep_alphanumeric", r"regexp_replace(text, '[^\pL\pN\pM]+', ' ', 'g')", lambda: T.keep_alphanumeric(F.col("text")))
_one("F4_letters_only", "regexp_replace(text, '[^a-zA-Z]+', ' ', 'g')", lambda: T.letters_only(F.col("text")))
_one("F5_remove_punctuation", PUNCTUATED, lambda: T.remove_punctuation(F.col("text")))
_one("F6_remove_accents", "replace(strip_accents(text), 'ß', 'ss')", lambda: T.remove_accents(F.col("text")))
_one("F7_remove_digits", "regexp_replace(text, '[0-9]', ' ', 'g')", lambda: T.remove_digits(F.col("text")))
_one("F8_tokens", r"len(regexp_extract_all(text, '[\pL\pN\pM_]+|[^\pL\pN\pM_\s]'))", lambda: F.size(T.tokens(F.col("text"))).cast("long"), "n")
_one("F9_clean", f"lower(replace(strip_accents({PUNCTUATED}), 'ß', 'ss'))", lambda: T.clean(F.col("text")))
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in T.STOPWORDS) + "]"
_one("F10_remove_stopwords", f"array_to_string(list_filter(string_split(lower(text), ' '), lambda w: w <> '' AND NOT list_contains({STOP_SQL}, w)), ' ')", lambda: F.array_join(T.remove_stopwords(T.words(F.lower("text"))), " "))


def _stem_sql(w: str) -> str:
    return "CASE " + " ".join(f"WHEN ends_with({w}, '{e}') AND length({w}) - {len(e)} >= 4 THEN left({w}, length({w}) - {len(e)}) || '{i}'" for e, i in T.ENDINGS) + f" ELSE {w} END"


CLEANED = f"list_filter(string_split(lower(replace(strip_accents({PUNCTUATED}), 'ß', 'ss')), ' '), lambda w: w <> '' AND NOT list_contains({STOP_SQL}, w))"


def _ends(endings: str) -> str:
    return "'(?:" + "|".join(endings.split()) + ")$'"


def _snowball_sql(items: str) -> str:
    """SQL for the stems of the documents' words, step by step over the distinct words: doc_id and stems in order."""
    v, kinds = S.VOWELS, {k: _ends(e) for k, e in S.STANDARD.items()}
    is_v = lambda x: f"({x} <> '' AND contains('{v}', {x}))"
    here, after, before = "c[CAST(i AS INTEGER)]", is_v("c[CAST(i AS INTEGER) + 1]"), is_v("right(acc, 1)")
    letter = f"CASE WHEN {here} = 'u' AND ({before} AND {after} OR right(acc, 1) = 'q') THEN 'U' WHEN {here} = 'i' AND {before} AND {after} THEN 'I' WHEN {here} = 'y' AND ({before} OR {after}) THEN 'Y' ELSE {here} END"
    places = "list_prepend('', list_transform(range(1, len(c) + 1), lambda n: CAST(n AS VARCHAR)))"
    cut = lambda s, n: f"left({s}, length({s}) - {n})"
    off = lambda s, e, instead=None: f"CASE WHEN ends_with({s}, '{e}') THEN CASE WHEN length({s}) - {len(e)} >= r2 THEN {cut(s, len(e))} ELSE {s if instead is None else cut(s, len(e)) + f" || '{instead}'"} END ELSE {s} END"
    twice = lambda s, e, then: f"CASE WHEN ends_with({s}, '{e}') AND length({s}) - {len(e)} >= r2 THEN (SELECT {then.format(x='x')} FROM (SELECT {cut(s, len(e))} AS x)) ELSE {s} END"
    ement = (
        f"CASE WHEN ends_with(s, 'iv') THEN {twice('s', 'iv', off('{x}', 'at'))} WHEN ends_with(s, 'eus') THEN CASE WHEN length(s) - 3 >= r2 THEN {cut('s', 3)} WHEN length(s) - 3 >= r1 THEN {cut('s', 1)} || 'x' ELSE s END "
        f"WHEN ends_with(s, 'abl') OR ends_with(s, 'iqU') THEN CASE WHEN length(s) - 3 >= r2 THEN {cut('s', 3)} ELSE s END WHEN (ends_with(s, 'ièr') OR ends_with(s, 'Ièr')) AND length(s) - 3 >= rv THEN {cut('s', 3)} || 'i' ELSE s END"
    )
    ite = f"CASE WHEN ends_with(s, 'abil') THEN {off('s', 'abil', 'abl')} WHEN ends_with(s, 'ic') THEN {off('s', 'ic', 'iqU')} ELSE {off('s', 'iv')} END"
    vowel_last = is_v("right(s, 1)")
    rules = [
        ("delete", "far", "s"), ("ation", "far", off("s", "ic", "iqU")), ("log", "far", "s || 'log'"), ("u", "far", "s || 'u'"), ("ent", "far", "s || 'ent'"), ("ement", "cut >= rv", ement), ("ité", "far", ite),
        ("if", "far", twice("s", "at", off("{x}", "ic", "iqU"))), ("eau", "true", "s || 'eau'"), ("al", "cut >= r1", "s || 'al'"), ("eux", "cut >= r1 OR far", "CASE WHEN far THEN s ELSE s || 'eux' END"),
        ("issement", f"cut >= r1 AND s <> '' AND NOT {vowel_last}", "s"), ("amment", "cut >= rv", "s || 'ant'"), ("emment", "cut >= rv", "s || 'ent'"), ("ment", f"cut - 1 >= rv AND {vowel_last}", "s"),
    ]
    exact = lambda k: f"regexp_matches(e, '^(?:{'|'.join(S.STANDARD[k].split())})$')"
    a_verbs = f"regexp_matches(e2, '^(?:{'|'.join(S.A_VERBS.split())})$')"
    i_ends, other_ends, last_ends = _ends(S.I_VERBS), _ends(f"ions {S.E_VERBS} {S.A_VERBS}"), _ends("ion ier ière Ier Ière e ë")
    return f"""WITH d AS (SELECT doc_id, {items} AS items FROM documents), each AS (SELECT doc_id, unnest(items) AS word, generate_subscripts(items, 1) AS place FROM d),
w0 AS (SELECT DISTINCT word, string_split(word, '') AS c FROM each),
m AS (SELECT word, list_reduce({places}, lambda acc, i: acc || {letter}) AS w FROM w0),
r AS (SELECT word, w, CASE WHEN length(w) > 2 AND regexp_matches(w, '^[{v}][{v}]') OR left(w, 3) IN ('par', 'col', 'tap') THEN 3 WHEN regexp_matches(w, '(?s)^.[^{v}]*[{v}]') THEN length(regexp_extract(w, '(?s)^.[^{v}]*[{v}]')) ELSE length(w) END AS rv,
CASE WHEN regexp_matches(w, '[{v}][^{v}]') THEN length(regexp_extract(w, '(?s)^.*?[{v}][^{v}]')) ELSE length(w) END AS r1 FROM m),
q AS (SELECT *, CASE WHEN regexp_matches(substring(w, r1 + 1), '[{v}][^{v}]') THEN r1 + length(regexp_extract(substring(w, r1 + 1), '(?s)^.*?[{v}][^{v}]')) ELSE length(w) END AS r2, regexp_extract(w, {_ends(' '.join(S.KINDS))}) AS e FROM r),
p AS (SELECT *, length(w) - length(e) AS cut, left(w, length(w) - length(e)) AS s, length(w) - length(e) >= r2 AS far FROM q),
one AS (SELECT word, w, rv, r1, r2, CASE WHEN e = '' THEN w {' '.join(f"WHEN {exact(k)} THEN CASE WHEN {test} THEN {then} ELSE w END" for k, test, then in rules)} END AS s1,
e <> '' AND CASE {' '.join(f"WHEN {exact(k)} THEN {test}" for k, test, _ in rules[:12])} ELSE false END AS done FROM p),
i AS (SELECT *, regexp_extract(substring(s1, rv + 1), {i_ends}) AS ie FROM one),
j AS (SELECT *, ie <> '' AND length(s1) - length(ie) - 1 >= rv AND NOT contains('{v}', substring(s1, length(s1) - length(ie), 1)) AS off_i, regexp_extract(substring(s1, rv + 1), {other_ends}) AS e2 FROM i),
two AS (SELECT *, CASE WHEN done THEN s1 WHEN off_i THEN left(s1, length(s1) - length(ie)) WHEN e2 = '' OR e2 = 'ions' AND length(s1) - 4 < r2 THEN s1
WHEN {a_verbs} AND substring(s1, length(s1) - length(e2), 1) = 'e' AND length(s1) - length(e2) - 1 >= rv THEN left(s1, length(s1) - length(e2) - 1) ELSE left(s1, length(s1) - length(e2)) END AS s2 FROM j),
k AS (SELECT *, CASE WHEN length(s2) > 1 AND ends_with(s2, 's') AND NOT contains('aiouès', substring(s2, length(s2) - 1, 1)) THEN left(s2, length(s2) - 1) ELSE s2 END AS s3 FROM two),
l AS (SELECT *, regexp_extract(substring(s3, rv + 1), {last_ends}) AS e4 FROM k),
f AS (SELECT word, CASE WHEN s2 <> w THEN CASE right(s2, 1) WHEN 'Y' THEN left(s2, length(s2) - 1) || 'i' WHEN 'ç' THEN left(s2, length(s2) - 1) || 'c' ELSE s2 END
WHEN e4 = '' THEN s3 WHEN e4 = 'ion' THEN CASE WHEN length(s3) - 3 >= r2 AND length(s3) - 4 >= rv AND contains('st', substring(s3, length(s3) - 3, 1)) THEN left(s3, length(s3) - 3) ELSE s3 END
WHEN e4 = 'e' THEN left(s3, length(s3) - 1) WHEN e4 = 'ë' THEN CASE WHEN length(s3) - 3 >= rv AND ends_with(s3, 'guë') THEN left(s3, length(s3) - 1) ELSE s3 END ELSE left(s3, length(s3) - length(e4)) || 'i' END AS s4 FROM l),
g AS (SELECT word, CASE WHEN regexp_matches(s4, '(?:enn|onn|ett|ell|eill)$') THEN left(s4, length(s4) - 1) ELSE s4 END AS s5 FROM f),
st AS (SELECT word, translate(regexp_replace(s5, '[éè]([^{v}]+)$', 'e\\1'), 'IUY', 'iuy') AS stem FROM g),
stems AS (SELECT doc_id, list(stem ORDER BY place) AS stems FROM each JOIN st USING (word) GROUP BY doc_id)"""


SPLIT = "list_filter(string_split(lower(text), ' '), lambda w: w <> '')"
query("F11_stem", f"{_snowball_sql(SPLIT)} SELECT d.doc_id, array_to_string(coalesce(stems, []), ' ') AS text FROM d LEFT JOIN stems USING (doc_id)")(
    lambda t: IO.spread(t.documents).select("doc_id", F.array_join(T.stemmed_words(T.words(F.lower("text"))), " ").alias("text"))
)
query("F12_preprocess", f"{_snowball_sql(CLEANED)} SELECT d.doc_id, nullif(array_to_string(stems, ' '), '') AS text FROM d LEFT JOIN stems USING (doc_id)")(lambda t: IO.spread(t.documents).select("doc_id", T.preprocess(F.col("text")).alias("text")))
_one("F13_clean_field", f"nullif(array_to_string({CLEANED}, ' '), '')", lambda: T.preprocess(F.col("text"), stem=False))
_one("F14_concat_null_propagating", "c_name || ' ' || nullif(c_mktsegment, 'BUILDING')", lambda: F.concat("c_name", F.lit(" "), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))), "joined", "customer", "c_custkey")
_one("F15_join_as_text", "c_name || ' ' || CAST(c_nationkey AS VARCHAR) || ' ' || c_mktsegment", lambda: T.join_as_text("c_name", "c_nationkey", "c_mktsegment"), "joined", "customer", "c_custkey")
NAME = "c_name"
_one("F16_ngrams", f"array_to_string(list_transform(generate_series(1, greatest(length({NAME}) - 2, 1)), lambda i: substring(lpad({NAME}, CAST(greatest(length({NAME}), 3) AS INTEGER), ' '), i, 3)), '|')", lambda: F.array_join(T.ngrams(F.col("c_name"), 3), "|"), "grams", "customer", "c_custkey")
_one("F17_padded_ngrams", "array_to_string(list_transform(generate_series(1, length(n_name) + 2), lambda i: substring('##' || replace(n_name, ' ', '#') || '##', i, 3)), '|')", lambda: F.array_join(T.padded_ngrams(F.col("n_name"), 3), "|"), "grams", "nation", "n_nationkey")
_one("F18_words", "array_to_string(list_filter(string_split(p_type, ' '), lambda w: w <> ''), '|')", lambda: F.array_join(T.words(F.col("p_type")), "|"), "words", "part", "p_partkey")
_one("F19_slices", "substring(c_name, 6) || '/' || substring(c_name, 3)", lambda: F.concat(F.substr("c_name", F.lit(6)), F.lit("/"), F.substr("c_name", F.lit(3))), "cut", "customer", "c_custkey")
_one("F20_identity", "c_name", lambda: F.col("c_name"), "c_name", "customer", "c_custkey")
query("F21_special_characters", f"{_snowball_sql(CLEANED)} SELECT d.doc_id, coalesce(nullif(array_to_string(stems, ' '), ''), 'textinconnue') AS text FROM d LEFT JOIN stems USING (doc_id)")(
    lambda t: t.documents.select("doc_id", F.coalesce(T.preprocess(F.col("text")), F.lit("textinconnue")).alias("text"))
)
_one("F22_acronym", f"(SELECT CASE WHEN len(w) > 1 THEN upper(array_to_string(list_transform(w, lambda x: x[1]), '')) END FROM (SELECT list_filter(string_split(regexp_replace(replace(lower(p_name), '-', ' '), '[^a-z0-9 ]', '', 'g'), ' '), lambda x: x <> '' AND NOT list_contains({STOP_SQL}, x)) AS w))", lambda: T.acronym(F.col("p_name")), "sigle", "part", "p_partkey")

WORDS_SQL = "SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS word FROM part"


def _vocabulary(t):
    return t.part.select(F.explode(F.split(F.lower("p_name"), " ")).alias("word")).distinct()


@query("F23_nearest_words", f"WITH v AS ({WORDS_SQL}) SELECT a.word, b.word AS candidate, levenshtein(a.word, b.word) AS distance FROM v a JOIN v b ON left(a.word, 1) = left(b.word, 1) AND abs(length(a.word) - length(b.word)) <= 2 AND levenshtein(a.word, b.word) <= 2")
def _(t):
    v = _vocabulary(t)
    return T.nearest_words(v, "word", v, "word", 2).select("word", "candidate", F.col("distance").cast("long").alias("distance"))


@query(
    "F24_spell_correction",
    f"""WITH v AS ({WORDS_SQL}), d AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN lower(p_name) ELSE left(lower(p_name), length(p_name) - 1) END AS name FROM part),
e AS (SELECT p_partkey, unnest(list_filter(string_split(name, ' '), lambda w: w <> '')) AS w, generate_subscripts(list_filter(string_split(name, ' '), lambda w: w <> ''), 1) AS i FROM d),
u AS (SELECT DISTINCT w FROM e WHERE w NOT IN (SELECT word FROM v)), n AS (SELECT w, count(*) AS n, min(word) AS near FROM u JOIN v ON left(w, 1) = left(word, 1) AND abs(length(w) - length(word)) <= 1 AND levenshtein(w, word) <= 1 GROUP BY w),
f AS (SELECT p_partkey, i, CASE WHEN e.w IN (SELECT word FROM v) THEN e.w WHEN n.n = 1 THEN near END AS c FROM e LEFT JOIN n ON e.w = n.w)
SELECT d.p_partkey, coalesce(CASE WHEN count(*) = count(c) THEN string_agg(c, ' ' ORDER BY i) END, any_value(name)) AS corrected FROM d LEFT JOIN f ON d.p_partkey = f.p_partkey GROUP BY d.p_partkey""",
)
def _(t):
    name = F.when(F.col("p_partkey") % 2 == 0, F.lower("p_name")).otherwise(F.left(F.lower("p_name"), F.char_length("p_name") - 1))
    return T.spell_correct(t.part.select("p_partkey", name.alias("name")), "p_partkey", "name", _vocabulary(t), "word")


@query("F25_dictionary", "SELECT DISTINCT word FROM (SELECT unnest(string_split(regexp_replace(lower(n), '[^a-z0-9 ]', ' ', 'g'), ' ')) AS word FROM (SELECT p_name AS n FROM part UNION ALL SELECT c_name FROM customer)) WHERE word <> ''")
def _(t):
    names = t.part.select(F.col("p_name").alias("n")).union(t.customer.select("c_name"))
    return names.select(F.explode(T.words(F.regexp_replace(F.lower("n"), "[^a-z0-9 ]", " "))).alias("word")).distinct()


@query("F26_house_number", "SELECT c_custkey, nullif(regexp_extract(a, '^([0-9]*)', 1), '') AS number, trim(substring(a, length(regexp_extract(a, '^([0-9]*)', 1)) + 1)) AS street FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END || ' ' || c_mktsegment AS a FROM customer)")
def _(t):
    line = F.concat(F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_nationkey").cast("string")), F.lit(" "), "c_mktsegment")
    number, street = T.house_number(F.col("a"))
    return t.customer.select("c_custkey", line.alias("a")).select("c_custkey", number.alias("number"), street.alias("street"))


STREETS_SQL = "CASE n_nationkey % 8 WHEN 0 THEN 'Avenue' WHEN 1 THEN 'Boulevard' WHEN 2 THEN 'Place' WHEN 3 THEN 'Rue' WHEN 4 THEN 'Route nationale' WHEN 5 THEN 'Chemin vicinal' WHEN 6 THEN 'Chemin rural' ELSE 'xyz' END"


@query("F27_street_types", f"SELECT n_nationkey, {STREETS_SQL} AS kind FROM nation")
def _(t):
    short = F.element_at(F.array(*[F.lit(x) for x in ("AV", "bd", "PL", "R", "RN", "VC", "CR", "xyz")]), (F.col("n_nationkey") % 8 + 1).cast("int"))
    return t.nation.select("n_nationkey", T.street_type(short).alias("kind"))


@query("F28_garbage_addresses", "SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN n_name WHEN 1 THEN n_name ELSE '' END AS cleaned FROM nation")
def _(t):
    dirty = F.concat(F.element_at(F.array(F.lit("inconnue "), F.lit("--/ "), F.lit("idem ")), (F.col("n_nationkey") % 3 + 1).cast("int")), "n_name")
    return t.nation.select("n_nationkey", T.drop_garbage(dirty).alias("cleaned"))


@query("F29_address_line", "SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) || 'B Avenue ' || s_name || ' ' || n_name AS line FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def _(t):
    both = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return both.select("s_suppkey", T.address_line(F.col("s_nationkey"), F.lit("B"), F.lit("AV"), F.col("s_name"), F.lit(None), F.col("n_name")).alias("line"))


@query("F30_split_name", "SELECT n_nationkey, n_name AS first, CASE WHEN n_nationkey % 3 < 2 THEN 'X' || CAST(n_nationkey AS VARCHAR) END AS second FROM nation")
def _(t):
    key = F.concat(F.lit("X"), F.col("n_nationkey").cast("string"))
    name = F.when(F.col("n_nationkey") % 3 == 0, F.concat("n_name", F.lit(" ("), key, F.lit(")"))).when(F.col("n_nationkey") % 3 == 1, F.concat("n_name", F.lit(", "), key)).otherwise(F.col("n_name"))
    first, second = T.split_name(name)
    return t.nation.select("n_nationkey", first.alias("first"), second.alias("second"))


_one("F31_strip_suffix", r"regexp_replace(url, '\..*$', '')", lambda: T.strip_type_suffix(F.col("url")), "url", "pages", "page_id")

# analyzers: terms joined, so that engines agree on the type


def _terms(name, sql, analyzer, table="documents", key="doc_id"):
    query(name, f"SELECT {key}, array_to_string({sql}, ' ') AS terms FROM {table}")(lambda t: getattr(t, table).select(key, F.array_join(analyzer(), " ").alias("terms")))


_terms("X1_standard", r"regexp_extract_all(lower(text), '[\pL\pN\pM_]+')", lambda: X.standard(F.col("text")))
_terms("X2_keyword", "CASE WHEN length(text) <= 256 THEN [text] ELSE [] END", lambda: X.keyword(F.col("text")))
_terms("X3_edge_ngrams", "flatten(list_transform(regexp_extract_all(lower(p_name), '[a-z0-9_]+'), lambda w: list_transform(range(2, least(length(w), 8) + 1), lambda n: left(w, n))))", lambda: X.edge_ngrams(F.col("p_name")), "part", "p_partkey")
STEM_CHAIN = f"list_transform(list_filter(regexp_extract_all(replace(strip_accents(lower(text)), 'ß', 'ss'), '[\\pL]+'), lambda w: NOT list_contains({STOP_SQL}, w)), lambda w: {_stem_sql('w')})"
query("X4_stemmed", f"SELECT doc_id, string_agg(s, ' ' ORDER BY s) AS terms FROM (SELECT doc_id, unnest(list_distinct({STEM_CHAIN})) AS s FROM documents) GROUP BY doc_id")(
    lambda t: IO.spread(t.documents).select("doc_id", F.array_join(F.sort_array(X.stemmed(F.col("text"))), " ").alias("terms")).where("terms <> ''")
)
_terms("X5_synonyms", "flatten(list_transform(string_split(lower(p_type), ' '), lambda w: CASE WHEN w = 'promo' THEN ['promo', 'offer', 'sale'] ELSE [w] END))", lambda: X.with_synonyms(F.split(F.lower("p_type"), " "), {"promo": ["offer", "sale"]}), "part", "p_partkey")
RULES = {"promo": ["offer", "sale"], "small ring": ["ringlet"], "bolt": ["screw"], "old bolt": ["antique screw"], "old bolt promo": ["antique sale", "clearance"], "new": ["fresh"]}
_RULES_SQL = ", ".join(f"('{run}', {len(run.split())}, '{a}')" for run, every in RULES.items() for a in every)
query(
    "X5_synonym_graph",
    f"""WITH RECURSIVE r(run, n, alt) AS (VALUES {_RULES_SQL}), w AS (SELECT p_partkey AS k, string_split(lower(p_name || ' ' || p_type), ' ') AS w FROM part),
m AS (SELECT k, i, max(n) AS n FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM w), r WHERE array_to_string(w[i:i + n - 1], ' ') = run GROUP BY k, i),
go AS (SELECT k, CAST(1 AS BIGINT) AS i FROM w UNION ALL SELECT go.k, go.i + coalesce(m.n, 1) FROM go JOIN w ON w.k = go.k LEFT JOIN m ON m.k = go.k AND m.i = go.i WHERE go.i + coalesce(m.n, 1) <= len(w.w)),
t AS (SELECT k, i - 1 AS p, 1 AS n, w[i] AS term FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM w) UNION ALL SELECT go.k, go.i - 1, m.n, alt FROM go JOIN m ON m.k = go.k AND m.i = go.i JOIN w ON w.k = go.k JOIN r ON r.n = m.n AND array_to_string(w.w[go.i:go.i + m.n - 1], ' ') = run)
SELECT k AS p_partkey, string_agg(term || '@' || p || '+' || n, ' ' ORDER BY p, n, term) AS terms FROM t GROUP BY k""",
)(lambda t: t.part.select("p_partkey", _graph_terms().alias("terms")))


def _graph_terms():
    graph = X.synonym_graph(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " "), RULES)
    return F.array_join(F.transform(F.sort_array(graph), lambda g: F.concat(g["term"], F.lit("@"), g["at"].cast("string"), F.lit("+"), g["length"].cast("string"))), " ")


_terms("X6_acronym", "(SELECT CASE WHEN length(l) >= 3 THEN [l] ELSE [] END FROM (SELECT array_to_string(list_transform(list_filter(string_split(lower(p_type || ' ' || p_brand), ' '), lambda w: w <> ''), lambda w: left(w, 1)), '') AS l))", lambda: X.acronym(F.concat_ws(" ", "p_type", "p_brand")), "part", "p_partkey")
_terms("X7_folding", "[replace(strip_accents(text), 'ß', 'ss')]", lambda: F.array(X.fold(F.col("text"))))
_terms("X8_elision", "['eau ' || n_name]", lambda: F.array(F.concat(X.elide(F.lit("l'eau ")), "n_name")), "nation", "n_nationkey")
_terms("X9_stop", f"list_filter(string_split(lower(text), ' '), lambda w: NOT list_contains({STOP_SQL}, w))", lambda: X.stop(F.split(F.lower("text"), " ")))
_terms("X10_light_stemmer", f"list_transform(string_split(lower(text), ' '), lambda w: {_stem_sql('w')})", lambda: T.light_stemmed_words(F.split(F.lower("text"), " ")))
_terms("X11_truncated", "[left(lower(p_type), 2), left(lower(p_type), 5)]", lambda: F.concat(X.truncated(2)(F.col("p_type")), X.truncated(5)(F.col("p_type"))), "part", "p_partkey")
_terms("X12_dotted", "[CASE WHEN n_nationkey % 2 = 0 THEN 'abc' ELSE lower(n_name) END]", lambda: X.dotted(F.when(F.col("n_nationkey") % 2 == 0, "A.B.C.").otherwise(F.col("n_name"))), "nation", "n_nationkey")
_terms("X13_composite_field", "[c_name || ' ' || c_mktsegment]", lambda: F.array(X.copy_to("c_name", "c_mktsegment")), "customer", "c_custkey")
_terms("X14_long_terms", "list_filter(string_split(lower(text), ' '), lambda w: length(w) >= 3)", lambda: X.long_enough(F.split(F.lower("text"), " ")))
_terms("X15_unmapped_field", "CAST([] AS VARCHAR[])", lambda: F.array().cast("array<string>"), "nation", "n_nationkey")

# dates, numbers, arrays

query("M1_week_and_duration", "SELECT event_id, CAST(week(ts) AS INTEGER) AS week, round(epoch_us(ts) / 1e6 - epoch_us(date_trunc('day', ts)) / 1e6, 3) AS seconds FROM events")(
    lambda t: t.events.select("event_id", F.weekofyear("ts").alias("week"), F.round(M.seconds_between(F.date_trunc("day", "ts"), F.col("ts")), 3).alias("seconds"))
)
_one("M2_rounding", "round(l_extendedprice / 7, 6)", lambda: F.round(F.col("l_extendedprice") / 7, 6), "r", "lineitem", "l_orderkey")
query("M3_midpoint", "SELECT s_suppkey, round((48 + s_suppkey % 90 / 10.0 + 49) / 2, 6) AS lat, round((0.5 + s_acctbal / 10000) / 2, 8) AS score FROM supplier")(
    lambda t: t.supplier.select("s_suppkey", F.round(M.midpoint(48 + F.col("s_suppkey") % 90 / 10.0, F.lit(49.0)), 6).alias("lat"), F.round(M.midpoint(F.lit(0.5), F.col("s_acctbal") / 10000), 8).alias("score"))
)
query("M4_grid", "SELECT round(i / 100.0, 6) AS x FROM range(0, 101) r(i)")(lambda t: M.grid(t.spark, 0.0, 1.0, 101).select(F.round("x", 6).alias("x")))
_one("M5_argmax", "CASE WHEN l_discount >= l_tax THEN 0 ELSE 1 END", lambda: M.argmax(F.array("l_discount", "l_tax")), "best", "lineitem", "l_orderkey")
query("M6_standard_scaler", "SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS z FROM customer")(lambda t: M.standardise(t.customer, ["c_acctbal"]).select("c_custkey", F.round("c_acctbal", 6).alias("z")))
TOKENS = "list_transform(string_split(p_name, ' '), lambda w: length(w))"
query("M7_padded", f"SELECT p_partkey, array_to_string(list_resize({TOKENS}, 6, 0), ',') AS ids FROM part")(lambda t: t.part.select("p_partkey", M.text_of(M.pad(M.lengths("p_name"), 6)).alias("ids")))
query("M8_truncated_and_padded", f"SELECT p_partkey, array_to_string(list_concat(list_resize({TOKENS}, 2, 0), list_resize(list_transform(string_split(p_type, ' '), lambda w: length(w)), 4, 0)), ',') AS ids FROM part")(
    lambda t: t.part.select("p_partkey", M.text_of(F.concat(M.pad(M.lengths("p_name"), 2), M.pad(M.lengths("p_type"), 4))).alias("ids"))
)
query("M9_fields", "SELECT p_partkey, array_to_string(list_concat(list_transform(string_split(p_name, ' '), lambda w: 1), list_transform(string_split(p_type, ' '), lambda w: 2)), ',') AS fields FROM part")(
    lambda t: t.part.select("p_partkey", M.text_of(M.field_numbers(F.split("p_name", " "), F.split("p_type", " "))).alias("fields"))
)
query("M10_positions", "SELECT p_partkey, array_to_string(list_concat(generate_series(1, len(string_split(p_name, ' '))), generate_series(1, len(string_split(p_type, ' ')))), ',') AS positions FROM part")(
    lambda t: t.part.select("p_partkey", M.text_of(M.positions(F.split("p_name", " "), F.split("p_type", " "))).alias("positions"))
)
query("M11_formatted_input", f"SELECT p_partkey, array_to_string(list_resize({TOKENS}, 5, 0), ',') || ';' || array_to_string(list_resize(list_transform(string_split(p_name, ' '), lambda w: 1), 5, 0), ',') || ';' || array_to_string(list_resize(generate_series(1, len(string_split(p_name, ' '))), 5, 0), ',') AS input FROM part")(
    lambda t: t.part.select("p_partkey", F.concat_ws(";", *[M.text_of(M.pad(x, 5)) for x in (M.lengths("p_name"), M.field_numbers(F.split("p_name", " ")), M.positions(F.split("p_name", " ")))]).alias("input"))
)
query("M12_flattened", "SELECT l_orderkey, CAST(sum(l_suppkey + l_partkey) AS BIGINT) AS total FROM lineitem GROUP BY 1")(
    lambda t: t.lineitem.groupBy("l_orderkey").agg(F.flatten(F.collect_list(F.array("l_suppkey", "l_partkey"))).alias("a")).select("l_orderkey", F.aggregate("a", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("total"))
)
query("M13_map_lookup", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 0 END AS id FROM customer")(
    lambda t: t.customer.select("c_custkey", M.lookup(F.col("c_mktsegment"), {"BUILDING": 1, "MACHINERY": 2}, 0).alias("id"))
)
query("M14_haversine", "SELECT s_suppkey, round(2 * 6371008.8 * asin(sqrt(power(sin(radians(48.85 - (45 + s_suppkey % 50 / 10.0)) / 2), 2) + cos(radians(45 + s_suppkey % 50 / 10.0)) * cos(radians(48.85)) * power(sin(radians(2.35 - (1 + s_nationkey / 10.0)) / 2), 2))), 3) AS metres FROM supplier")(
    lambda t: t.supplier.select("s_suppkey", F.round(M.haversine(45 + F.col("s_suppkey") % 50 / 10.0, 1 + F.col("s_nationkey") / 10.0, F.lit(48.85), F.lit(2.35)), 3).alias("metres"))
)
