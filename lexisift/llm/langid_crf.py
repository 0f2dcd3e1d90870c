"""Language of every word by a linear-chain conditional random field, and of texts by its marginals.

A word's features are its affixes of one to three bytes, its byte trigrams with word ends, and itself (the
lexicon), hashed into one table of weights per language; transitions between languages are learned with
them. Training sequences are stretches of labelled texts, a part of them spliced from two languages, so that
switching inside a text has a cost that is learned rather than none or an infinite one.

Features, emissions and forward-backward are numpy over a whole slice of texts. Chains are cut into blocks:
the transfer matrices of all blocks are formed in step, messages go from block to block, and then the
marginals of all blocks are formed in step; the result is that of forward-backward over the whole chain,
whatever its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexisift.llm.common import small_batches, table, unused, without
from lexisift.llm.shingles import _SPACE, mix, text_buffer

BITS = 17
BLOCK = 64
#: The training sample: so many texts of each language, none longer than so many characters (whole texts, never parts).
TEXTS_PER_LANGUAGE = 120
LONGEST_TEXT = 20_000
ROUNDS = 24
STRETCH = 48
UNKNOWN = "und"
_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes in lower case, for ASCII and the Latin-1 letters."""
    low = _LOWER[data]
    if len(low) > 1:
        after = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        low[after] += 0x20
    return low


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end, and where each text's words begin (one more at the end)."""
    space = _SPACE[data]
    begins, ends = ~space, ~space
    begins[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = ~space[inner]
    ends[inner - 1] = ~space[inner - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, bounds)


def word_features(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature cells of all words, one after another, and where each word's begin; a word has its length plus 7 of them."""
    low = lower_bytes(data).astype(np.uint64)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = stops - starts
    padded = np.concatenate([[_U(0)], low, [_U(0), _U(0), _U(0)]])
    # the trigram around each byte, 1 standing for a word's ends
    before, after = padded[: len(low)].copy(), padded[2 : len(low) + 2].copy()
    before[starts], after[stops - 1] = _U(1), _U(1)
    grams = before << _U(16) | low << _U(8) | after
    at = np.cumsum(size + 7) - (size + 7)
    total = int((size + 7).sum())
    cells = np.empty(total, dtype=np.uint64)
    inside = np.repeat(starts - at, size + 7) + np.arange(total)
    of_word = np.arange(total) - np.repeat(at, size + 7) < np.repeat(size, size + 7)
    cells[of_word] = grams[inside[of_word]] | _U(1 << 40)
    for k in (1, 2, 3):
        first, last = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
        for i in range(k):
            first = first << _U(8) | np.where(i < size, padded[np.minimum(starts + i, stops - 1) + 1], _U(2))
            last = last << _U(8) | np.where(i < size, padded[np.maximum(stops - 1 - i, starts) + 1], _U(2))
        cells[at + size + 2 * (k - 1)] = first | _U((2 + k) << 40)
        cells[at + size + 2 * (k - 1) + 1] = last | _U((6 + k) << 40)
    place = np.arange(len(low), dtype=np.uint64) - _offsets(starts, len(low))
    whole = np.add.reduceat(mix(low + _U(257) * place) * ~_SPACE[data], starts)
    cells[at + size + 6] = mix(whole) | _U(1 << 62)
    return (mix(cells) >> _U(64 - bits)).astype(np.int64), at


def _offsets(starts: np.ndarray, n: int) -> np.ndarray:
    """For each byte the begin of the last word before it."""
    out = np.zeros(n, dtype=np.uint64)
    out[starts[0] :] = np.repeat(starts, np.diff(np.append(starts, n)))
    return out


def emissions(weights: np.ndarray, cells: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Scores of each word for each language: sums of its features' weights, (words, languages)."""
    if not len(at):
        return np.zeros((0, weights.shape[1]))
    return np.stack([np.add.reduceat(column[cells], at) for column in np.ascontiguousarray(weights.T)], axis=1).astype(np.float64)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(scores: np.ndarray, bounds: np.ndarray, transitions: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Each word's probability of each language; bounds cut the words into chains."""
    alpha, beta = forward_backward(scores, bounds, transitions, begin)
    return _scaled(alpha * beta)


def pair_counts(scores: np.ndarray, alpha: np.ndarray, beta: np.ndarray, transitions: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Expected number of each transition into the words ``follows``, from forward and backward messages."""
    step = np.exp(transitions - transitions.max())
    before, after = alpha[follows - 1], np.exp(scores - scores.max(axis=1, keepdims=True))[follows] * beta[follows]
    return step * ((before / ((before @ step) * after).sum(axis=1, keepdims=True)).T @ after)


def forward_backward(scores: np.ndarray, bounds: np.ndarray, transitions: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward messages (with a word's own score) and backward messages (without it), each scaled to sum to 1."""
    n, k = scores.shape
    if not n:
        return np.zeros((0, k)), np.zeros((0, k))
    e = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
    step, first = np.exp(transitions - transitions.max()), np.exp(begin - begin.max())
    sizes = np.diff(bounds)
    chains = np.flatnonzero(sizes)
    n_blocks = -(-sizes[chains] // BLOCK)
    chain_of = np.repeat(np.arange(len(chains)), n_blocks)
    head = np.cumsum(n_blocks) - n_blocks
    number = np.arange(len(chain_of)) - head[chain_of]
    start = bounds[chains][chain_of] + number * BLOCK
    length = np.minimum(BLOCK, bounds[chains + 1][chain_of] - start)
    order = np.argsort(-length, kind="stable")
    s, alive = start[order], np.searchsorted(-length[order], -np.arange(BLOCK), side="left")
    alpha, beta = np.empty((n, k)), np.empty((n, k))
    # transfer matrices: from a message before a block to the one after it
    moved = np.broadcast_to(np.eye(k), (len(order), k, k)).copy()
    for t in range(BLOCK):
        m = alive[t]
        if not m:
            break
        x = (moved[:m].reshape(-1, k) @ step).reshape(m, k, k) * e[s[:m] + t][:, None, :]
        moved[:m] = x / x.sum(axis=(1, 2), keepdims=True)
    block = np.empty_like(moved)
    block[order] = moved
    into, back = np.empty((len(order), k)), np.ones((len(order), k))
    by_blocks = np.argsort(-n_blocks, kind="stable")
    going = np.searchsorted(-n_blocks[by_blocks], -np.arange(int(n_blocks.max())), side="left")
    for j in range(int(n_blocks.max())):
        c = by_blocks[: going[j]]
        b = head[c] + j
        if j == 0:
            into[b] = first  # begin weights stand for the step into the first word
        else:
            previous = b - 1
            if j == 1:
                into[b] = _scaled(_first_block(e, start[previous], length[previous], step, first))
            else:
                into[b] = _scaled(np.einsum("bi,bij->bj", into[previous], block[previous]))
    for j in range(int(n_blocks.max()) - 2, -1, -1):
        c = by_blocks[: going[j + 1]]
        b = head[c] + j
        back[b] = _scaled(np.einsum("bij,bj->bi", block[b + 1], back[b + 1]))
    at_begin = (number == 0)[order]
    message = into[order]
    for t in range(BLOCK):
        m = alive[t]
        if not m:
            break
        moved_on = message[:m] @ step
        if t == 0:
            moved_on[at_begin[:m]] = message[:m][at_begin[:m]]
        message[:m] = _scaled(moved_on * e[s[:m] + t])
        alpha[s[:m] + t] = message[:m]
    message = back[order]
    for t in range(BLOCK - 1, -1, -1):
        m = alive[t]
        if not m:
            continue
        beta[s[:m] + t] = message[:m]
        message[:m] = _scaled((message[:m] * e[s[:m] + t]) @ step.T)
    return alpha, beta


def _first_block(e, start, length, step, first):
    """The message after first blocks, which are always full where another follows."""
    message = _scaled(first * e[start])
    for t in range(1, int(length.max()) if len(length) else 0):
        message = _scaled((message @ step) * e[start + t])
    return message


class Model:
    """Weights (cells, languages), transitions, begin weights and the languages in order."""

    def __init__(self, languages: list[str], weights: np.ndarray, transitions: np.ndarray, begin: np.ndarray):
        self.languages, self.weights, self.transitions, self.begin = languages, weights, transitions, begin

    def label(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words' begins and ends, texts' first words, and the words' marginals."""
        starts, stops, at = words_of(data, bounds)
        scores = emissions(self.weights, *word_features(data, starts, stops))
        return starts, stops, at, marginals(scores, at, self.transitions, self.begin)


def fit(texts: list[str], labels: list[str], bits: int = BITS, rounds: int = ROUNDS, seed: int = 7) -> Model:
    """Learn weights and transitions by adaptive gradient steps on the likelihood of labelled stretches of words."""
    languages = sorted(set(labels))
    k = len(languages)
    if k < 2:
        return Model(languages, np.zeros((1 << bits, max(k, 1)), np.float32), np.zeros((max(k, 1),) * 2), np.zeros(max(k, 1)))
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    starts, stops, at = words_of(data, bounds)
    cells, first = word_features(data, starts, stops, bits)
    sizes = np.diff(np.append(first, len(cells)))
    gold = np.repeat([languages.index(x) for x in labels], np.diff(at))
    # stretches of one language; every third is spliced with the next of another
    random = np.random.default_rng(seed)
    pieces = [np.arange(a, min(a + STRETCH, e)) for s, e in zip(at[:-1], at[1:]) for a in range(s, e, STRETCH)]
    random.shuffle(pieces)
    chains, i = [], 0
    while i < len(pieces):
        if i % 3 == 0 and i + 1 < len(pieces) and gold[pieces[i][0]] != gold[pieces[i + 1][0]]:
            chains.append(np.concatenate([pieces[i][: STRETCH // 2], pieces[i + 1]]))
            i += 2
        else:
            chains.append(pieces[i])
            i += 1
    order, cuts = np.concatenate(chains), np.concatenate([[0], np.cumsum([len(c) for c in chains])])
    truth = gold[order]
    inner = np.ones(len(order), bool)
    inner[cuts[:-1]] = False
    follows = np.flatnonzero(inner)
    weights, transitions, begin = np.zeros((1 << bits, k)), np.zeros((k, k)), np.zeros(k)
    squares = [np.full_like(x, 1e-6) for x in (weights, transitions, begin)]
    total = len(order)
    spread = np.repeat(np.arange(len(first)), sizes)
    for _ in range(rounds):
        scores = emissions(weights, cells, first)[order]
        alpha, beta = forward_backward(scores, cuts, transitions, begin)
        p = _scaled(alpha * beta)
        off = -p
        off[np.arange(total), truth] += 1
        by_word = np.stack([np.bincount(order, off[:, j], minlength=len(first)) for j in range(k)], axis=1)
        g_weights = np.stack([np.bincount(cells, by_word[spread, j], minlength=1 << bits) for j in range(k)], axis=1) / total - 1e-7 * weights
        expected = pair_counts(scores, alpha, beta, transitions, follows)
        seen = np.zeros((k, k))
        np.add.at(seen, (truth[follows - 1], truth[follows]), 1)
        g_transitions = (seen - expected) / total - 1e-4 * transitions
        g_begin = off[cuts[:-1]].sum(axis=0) / total
        for x, g, sq, rate in zip((weights, transitions, begin), (g_weights, g_transitions, g_begin), squares, (0.3, 0.3, 0.1)):
            sq += g * g * (1e6 if x is weights else 1)
            x += rate * g / np.sqrt(sq / (1e6 if x is weights else 1) + 1e-16)
    return Model(languages, weights.astype(np.float32), transitions, begin)


def training_sample(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = TEXTS_PER_LANGUAGE, longest: int = LONGEST_TEXT) -> tuple[list[str], list[str]]:
    """Up to so many labelled texts of each language, those whose keys hash lowest; ties keep whichever comes first.

    Texts up to the longest length are taken; a language that has none is learned from the shortest of its longer ones,
    each cut to that length from its first letter on.
    """
    size = F.char_length(text)
    usable = df.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(lang).alias("lang"), F.col(key).alias("key"), F.col(text).alias("text"), F.greatest(size - longest, F.lit(0)).alias("over"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("over", F.xxhash64("key", F.lit(11)), "key"))
    # the limit by rank is applied in each task before the shuffle, so no task gets all texts of a language
    first = usable.select("lang", "key", "over").withColumn("rank", rank).where(F.col("rank") <= per_language)
    least = usable.groupBy("lang").agg(F.min("over").alias("least"))  # a row for each language
    chosen = first.join(F.broadcast(least), "lang").where((F.col("over") == 0) | (F.col("least") > 0))
    # the sample's keys are bounded by the number of languages, so they go to every task
    rows = usable.join(F.broadcast(chosen.select("lang", "key", "over").distinct()), ["lang", "key", "over"], "left_semi")
    cut = F.when(F.col("over") == 0, F.col("text")).otherwise(F.substring(F.regexp_replace("text", r"^\P{L}+", ""), 1, longest))
    rows = rows.select("lang", cut.alias("text"), F.xxhash64("key").alias("k")).orderBy("k", "text").collect()
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def identify(df: DataFrame, model: Model, text: str = "text", segments: bool = False, confidence: bool = False) -> DataFrame:
    """Add ``lang_pred`` and ``score``, with segments the stretches of words of one language, and with confidence that.

    confidence is the mean over a text's words of the largest probability of each, whatever its language; 0 for ``und``.

    score is the mean over a text's words of the probability of the predicted language. A null text, and a text
    without letters, gets ``und`` and 0. segments: array of struct(start, stop, label), in words, end exclusive; empty
    for ``und``. Columns of df named like an output are replaced; repeated rows get equal values.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)
    words = unused(df, "words")
    rows = without(df.withColumn(words, F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).otherwise(F.lit(""))), ["lang_pred", "score", "segments", *["confidence"] * confidence])
    kept = [f for f in rows.schema.fields if f.name != words]
    more = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    spans = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("label", T.StringType())]))
    if segments:
        more.append(T.StructField("segments", spans))
    if confidence:
        more.append(T.StructField("confidence", T.DoubleType()))
    out = T.StructType([*kept, *more])
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("label", pa.string())]))

    def run(batches):
        found = shared.value
        names = np.array([*found.languages, UNKNOWN], dtype=object)
        for batch in batches:
            column = batch.column(words)
            groups = np.cumsum(np.array(pc.binary_length(column).to_pylist() or [0])) >> 20
            a = 0
            while a < batch.num_rows:
                b = max(int(np.searchsorted(groups, groups[a], "right")), a + 1)
                _, _, at, p = found.label(*text_buffer(column.slice(a, b - a)))
                n = np.diff(at)
                some = (n > 0) & (len(found.languages) > 0)
                sums = np.zeros((b - a, p.shape[1]))
                if some.any():
                    sums[some] = np.add.reduceat(p, at[:-1][some], axis=0) / n[some, None]
                best = np.where(some, sums.argmax(axis=1), len(found.languages))
                score = np.where(some, np.clip(sums.max(axis=1), 0, 1), 0.0)
                cols = [batch.column(f.name).slice(a, b - a) for f in kept] + [pa.array(names[best], pa.string()), pa.array(score, pa.float64())]
                if segments:
                    labels = p.argmax(axis=1)
                    listed = []
                    for i in range(b - a):
                        own = labels[at[i] : at[i + 1]]
                        cuts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]]).tolist() if len(own) else [0]
                        listed.append([{"start": x, "stop": y, "label": found.languages[own[x]]} for x, y in zip(cuts[:-1], cuts[1:])] if some[i] else [])
                    cols.append(pa.array(listed, span_type))
                if confidence:
                    sure = np.zeros(b - a)
                    if some.any():
                        sure[some] = np.add.reduceat(p.max(axis=1), at[:-1][some]) / n[some]
                    cols.append(pa.array(np.clip(sure, 0, 1), pa.float64()))
                yield pa.RecordBatch.from_arrays(cols, names=out.names)
                a = b

    return rows.mapInArrow(run, out)


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def train(df: DataFrame, **names) -> Model:
    return fit(*training_sample(df, **names))


def op8_langid_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that aren't held out."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
