"""Analyzers: a text column to the array of terms that is indexed or searched."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexisift.functions import text as T

LONGEST_KEYWORD = 256


def standard(c: Column) -> Column:
    """Words of letters, digits and underscores, in lower case."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"(?U)[\w]+"), F.lit(0))


def simple(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"(?U)[\p{IsAlphabetic}]+"), F.lit(0))


def keyword(c: Column) -> Column:
    """The whole text as one term; none for a longer one than can be indexed."""
    return F.when(F.char_length(c) <= LONGEST_KEYWORD, F.array(c)).otherwise(F.array().cast("array<string>"))


def fold(c: Column) -> Column:
    return T.remove_accents(c)


def elide(c: Column) -> Column:
    """Words without an elided article or pronoun before them."""
    return F.regexp_replace(c, r"(?i)\b(" + "|".join(T.ELIDED) + r")['’]", "")


def edge_ngrams(c: Column, least: int = 2, most: int = 8) -> Column:
    """All beginnings of each word, from the least length to the most."""
    grams = F.transform(standard(c), lambda w: F.transform(F.filter(F.array(*[F.lit(i) for i in range(least, most + 1)]), lambda n: n <= F.char_length(w)), lambda n: F.left(w, n)))
    return F.flatten(grams)


def stop(items: Column, words: Sequence[str] = T.STOPWORDS) -> Column:
    return T.remove_stopwords(items, words)


def stemmed(c: Column) -> Column:
    """Letters only, folded, elided, lower case, without stopwords, stemmed, each term once."""
    return T.light_stems(c)


def with_synonyms(items: Column, synonyms: Mapping[str, Sequence[str]]) -> Column:
    """Terms followed by their synonyms."""
    table = F.create_map(*[x for k, v in synonyms.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))])
    return F.flatten(F.transform(items, lambda w: F.concat(F.array(w), F.coalesce(F.try_element_at(table, w), F.array().cast("array<string>")))))


def synonym_graph(items: Column, rules: Mapping[str, Sequence[str]]) -> Column:
    """Words and what stands for runs of them, as array of struct(at, length, term): places from 0, words covered, and term.

    rules: runs of words, between single spaces, with their alternatives, which may be of several words. Texts are read from the
    left; at each place the longest run that has a rule counts, and reading goes on after it. All words stay, each with length 1.
    Null words match nothing and give no terms; a null array stays null.
    """
    trie: dict = {}
    for run, alternatives in rules.items():
        node = trie
        for word in run.split(" "):
            node = node.setdefault(word, {})
        node[None] = tuple(alternatives)  # no word is None

    @F.arrow_udf("array<struct<at: int, length: int, term: string>>")
    def graph(batch: pa.Array) -> pa.Array:
        out = []
        for words in batch.to_pylist():
            if words is None:
                out.append(None)
                continue
            found = [{"at": i, "length": 1, "term": w} for i, w in enumerate(words) if w is not None]
            i = 0
            while i < len(words):
                node, longest = trie, (1, ())
                for n, w in enumerate(words[i:], 1):
                    node = node.get(w) if w is not None else None
                    if node is None:
                        break
                    if None in node:
                        longest = n, node[None]
                found += [{"at": i, "length": longest[0], "term": a} for a in longest[1]]
                i += longest[0]
            out.append(found)
        return pa.array(out, pa.list_(pa.struct([("at", pa.int32()), ("length", pa.int32()), ("term", pa.string())])))

    return graph(items)


def acronym(c: Column, least: int = 3) -> Column:
    """The first letters of a name's words without articles, as one term of at least so many letters."""
    plain = F.regexp_replace(F.lower(fold(c)), r"\b(le|la|les|de|des|du|en)\b|\b[ld]['’]", " ")
    letters = F.array_join(F.transform(F.filter(F.split(F.regexp_replace(plain, r"[-.]", " "), " +"), lambda w: w != ""), lambda w: F.left(w, F.lit(1))), "")
    return F.when(F.char_length(letters) >= least, F.array(letters)).otherwise(F.array().cast("array<string>"))


def dotted(c: Column) -> Column:
    """The whole text in lower case, an acronym's dots taken out."""
    return F.array(F.when(F.lower(c).rlike(r"^(\p{L}\.)+\p{L}?$"), F.replace(F.lower(c), F.lit("."), F.lit(""))).otherwise(F.lower(c)))


def truncated(n: int) -> Callable[[Column], Column]:
    """The first n characters of the whole text, as one term."""
    return lambda c: F.array(F.left(F.lower(c), F.lit(n)))


def long_enough(items: Column, least: int = 3) -> Column:
    return F.filter(items, lambda w: F.char_length(w) >= least)


def copy_to(*columns: str) -> Column:
    """A composite field: columns one after another, nulls left out."""
    return F.concat_ws(" ", *[F.col(c) for c in columns])


ANALYZERS: dict[str, Callable[[Column], Column]] = {
    "standard": standard, "simple": simple, "keyword": keyword, "edge_ngrams": edge_ngrams, "stemmed": stemmed, "acronym": acronym, "dotted": dotted,
    **{f"first{n}": truncated(n) for n in (2, 3, 4, 5)},
}
