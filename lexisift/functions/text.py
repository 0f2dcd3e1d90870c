"""Cleaning of short noisy texts, as column functions.

All but the stemmers are built-in expressions; whole pipelines with stems are one Arrow pass over the texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisift.functions.stemming import each_text, each_word, french_stem
from lexisift.operators.fuzzy import near_words

#: The signs that cleaning turns into spaces, each into one.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" + "’—°€"

#: French words without meaning of their own, in the order of their kinds.
STOPWORDS = (
    "au aux avec ce ces dans de des du elle en et eux il ils je la le les leur lui ma mais me même mes moi mon ne nos notre nous "
    "on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos votre vous c d j l à m n s t y"
).split()

#: Ligatures and letters that don't decompose into a letter and a mark.
FOLDED = {"œ": "oe", "Œ": "OE", "æ": "ae", "Æ": "AE", "ß": "ss", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L"}

#: French elided articles and pronouns.
ELIDED = "l m t qu n s j d c".split()

#: Street types and what they stand for.
STREET_TYPES = {
    "ALL": "Allée", "AV": "Avenue", "BD": "Boulevard", "CAR": "Carrefour", "CD": "Chemin départemental", "CHE": "Chemin", "CHS": "Chaussée", "CITE": "Cité", "CIT": "Cité",
    "COR": "Corniche", "CRS": "Cours", "CR": "Chemin rural", "DOM": "Domaine", "DSC": "Descente", "ECA": "Ecart", "ESP": "Esplanade", "FG": "Faubourg", "GR": "Grande Rue",
    "HAM": "Hameau", "HLE": "Halle", "IMP": "Impasse", "LD": "Lieu-dit", "LOT": "Lotissement", "MAR": "Marché", "MTE": "Montée", "PAS": "Passage", "PLN": "Plaine",
    "PLT": "Plateau", "PL": "Place", "PRO": "Promenade", "PRV": "Parvis", "QUAI": "Quai", "QUA": "Quartier", "QU": "Quai", "RES": "Résidence", "RLE": "Ruelle", "ROC": "Rocade",
    "RPT": "Rond-point", "RTE": "Route", "RN": "Route nationale", "R": "Rue", "RUE": "Rue", "SEN": "Sentier", "SQ": "Square", "TPL": "Terre-plein", "TRA": "Traverse",
    "VC": "Chemin vicinal", "VLA": "Villa", "VLGE": "Village",
}


def _accented() -> tuple[str, str]:
    """All Latin letters of two bytes that are a plain letter and marks, and those letters."""
    pairs = [(chr(i), unicodedata.normalize("NFD", chr(i))) for i in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]]
    pairs = [(c, d[0]) for c, d in pairs if len(d) > 1 and d[0].isascii()]
    return "".join(c for c, _ in pairs), "".join(d for _, d in pairs)


ACCENTED, PLAIN = _accented()


def remove_accents(c: Column) -> Column:
    """Latin letters without their marks."""
    c = F.translate(c, ACCENTED, PLAIN)
    for letter, plain in FOLDED.items():
        c = F.replace(c, F.lit(letter), F.lit(plain))
    return c


def remove_punctuation(c: Column) -> Column:
    """Each sign becomes one space; runs of spaces stay."""
    return F.translate(c, PUNCTUATION, " " * len(PUNCTUATION))


def remove_digits(c: Column) -> Column:
    return F.translate(c, "0123456789", " " * 10)


def keep_alphanumeric(c: Column) -> Column:
    r"""Runs of what is neither letter nor digit become one space."""
    return F.regexp_replace(c, r"(?U)[\W_]+", " ")


def letters_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^a-zA-Z]+", " ")


def words(c: Column) -> Column:
    """Pieces between single spaces that aren't empty."""
    return F.filter(F.split(c, " "), lambda w: w != "")


def tokens(c: Column) -> Column:
    """Words and signs: runs of letters and digits, and every other sign but white space on its own."""
    return F.regexp_extract_all(c, F.lit(r"(?U)[\w]+|[^\w\s]"), F.lit(0))


def clean(c: Column) -> Column:
    """Punctuation to spaces, accents off, lower case."""
    return F.lower(remove_accents(remove_punctuation(c)))


def clean_keeping_case(c: Column) -> Column:
    return remove_punctuation(remove_accents(remove_punctuation(c)))


def remove_stopwords(items: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    return F.filter(items, lambda w: ~w.isin(*stopwords))  # a set, where they are more than a few


#: Endings that the light stemmer takes off, the longest that fits first, with what replaces it.
ENDINGS = (
    ("issements", "ir"), ("issement", "ir"), ("atrices", "at"), ("atrice", "at"), ("ateurs", "at"), ("ateur", "at"), ("ations", "at"), ("ation", "at"), ("ements", "e"), ("ement", "e"),
    ("euses", "eu"), ("euse", "eu"), ("ières", "i"), ("ieres", "i"), ("ière", "i"), ("iere", "i"), ("iers", "i"), ("ier", "i"), ("eurs", "eur"), ("ives", "if"), ("ive", "if"),
    ("eaux", "eau"), ("aux", "al"), ("ées", "e"), ("ée", "e"), ("és", "e"), ("er", "e"), ("ez", "e"), ("es", ""), ("s", ""), ("x", ""), ("e", ""), ("é", ""),
)


def light_stem(word: str, least: int = 4) -> str:
    """A light French stem of one word: an ending off where at least so many letters stay; shorter words are kept."""
    for ending, instead in ENDINGS:
        if word.endswith(ending) and len(word) - len(ending) >= least:
            return word[: len(word) - len(ending)] + instead
    return word


def stemmed_words(items: Column) -> Column:
    """Words by their stems of the Snowball rules."""
    return each_word(items, french_stem)


def light_stemmed_words(items: Column) -> Column:
    return each_word(items, light_stem)


def _folding(signs: str) -> dict[int, str]:
    """What Python's translate makes of signs (spaces) and Latin letters with marks (the letters)."""
    return {**{ord(a): b for a, b in zip(ACCENTED, PLAIN, strict=True)}, **{ord(a): b for a, b in FOLDED.items()}, **{ord(c): " " for c in signs}}


def preprocess(c: Column, stem: bool = True) -> Column:
    """Clean, drop stopwords, stem, and join again; null where nothing stays. One pass over whole texts."""
    table, stopped = _folding(PUNCTUATION), frozenset(STOPWORDS)
    return each_text(c, lambda text: [w for w in text.translate(table).lower().split(" ") if w], lambda w: None if w in stopped else french_stem(w) if stem else w, joined=True)


def light_stems(c: Column) -> Column:
    """Words of letters of a folded, lower-case text without elided articles and stopwords, by their light stems, each once."""
    table, stopped = _folding(""), frozenset(STOPWORDS)
    elided = re.compile(rf"\b(?:{'|'.join(ELIDED)})['’]")
    runs = re.compile(r"[^\W\d_]+")  # letters, and numbers that aren't digits

    def split(text: str) -> list[str]:
        text = text.translate(table)
        found = runs.findall(elided.sub("", text) if "'" in text or "’" in text else text)
        return [w for run in found for w in ((run,) if run.isalpha() else "".join(x if x.isalpha() else " " for x in run).split())]

    return each_text(F.lower(c), split, lambda w: None if w in stopped else light_stem(w), once=True)


def concatenate(*columns: str, separator: str = " ") -> Column:
    """Columns joined by a separator; null if one is null."""
    parts = [x for c in columns for x in (F.lit(separator), F.col(c))][1:]
    return F.concat(*parts)


def join_as_text(*columns: str, separator: str = " ", missing: str = "nan") -> Column:
    """Columns as text joined by a separator, a null as the given word."""
    return F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in columns])


def ngrams(c: Column, n: int) -> Column:
    """Character n-grams; a shorter text is padded on the left with spaces to one n-gram."""
    padded = F.when(F.char_length(c) < n, F.lpad(c, n, " ")).otherwise(c)
    return F.transform(F.sequence(F.lit(1), F.char_length(padded) - (n - 1)), lambda i: F.substr(padded, i, F.lit(n)))


def padded_ngrams(c: Column, n: int, pad: str = "#") -> Column:
    """n-grams of a text between n - 1 pads on either side, its spaces as pads too."""
    padded = F.concat(F.lit(pad * (n - 1)), F.replace(c, F.lit(" "), F.lit(pad)), F.lit(pad * (n - 1)))
    return F.transform(F.sequence(F.lit(1), F.char_length(padded) - (n - 1)), lambda i: F.substr(padded, i, F.lit(n)))


def acronym(c: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """First letters of a name's words without stopwords; null for persons and where there are fewer than two."""
    plain = F.regexp_replace(F.replace(F.lower(remove_accents(c)), F.lit("-"), F.lit(" ")), r"\b[a-z]'", "")
    items = remove_stopwords(F.filter(F.split(F.regexp_replace(plain, r"[^a-z0-9 ]", ""), " "), lambda w: w != ""), stopwords)
    person = F.coalesce(F.get(F.split(plain, " "), F.lit(0)).isin("monsieur", "madame"), F.lit(False))
    return F.when(~person & (F.size(items) > 1), F.upper(F.array_join(F.transform(items, lambda w: F.left(w, F.lit(1))), "")))


def house_number(c: Column) -> tuple[Column, Column]:
    """The digits a street begins with (null if none), and the rest of it."""
    number = F.regexp_extract(c, "^([0-9]*)", 1)
    return F.nullif(number, F.lit("")), F.trim(F.substr(c, F.char_length(number) + 1))


def street_type(c: Column, types: Mapping[str, str] = STREET_TYPES) -> Column:
    table = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(c)), c)


def address_line(number: Column, repeat: Column, kind: Column, name: Column, more: Column, place: Column) -> Column:
    """Number and repetition together, then the other parts, by single spaces; missing parts are left out."""
    text = lambda x: F.nullif(F.trim(F.coalesce(x.cast("string"), F.lit(""))), F.lit(""))
    first = F.nullif(F.concat(F.coalesce(text(number), F.lit("")), F.coalesce(text(repeat), F.lit(""))), F.lit(""))
    return F.concat_ws(" ", first, text(street_type(kind)), text(name), text(more), text(place))


def drop_garbage(c: Column) -> Column:
    """An address without what only says that there is none."""
    for pattern in (r"(?i)^(adresse )?(inconnue?|nsp|ne sait pas)\b *", r"^[-./ ?]+", r"(?i)^(idem|voir) .*$"):
        c = F.regexp_replace(c, pattern, "")
    return c


def split_name(c: Column) -> tuple[Column, Column]:
    """What stands before, and in, parentheses or after a comma; the second is null where there is neither."""
    inside = F.nullif(F.regexp_extract(c, r"\(([^)]*)\)", 1), F.lit(""))
    after = F.nullif(F.trim(F.regexp_extract(c, r",(.*)$", 1)), F.lit(""))
    return F.trim(F.regexp_replace(c, r"[(,].*$", "")), F.coalesce(inside, after)


def strip_type_suffix(c: Column) -> Column:
    return F.regexp_replace(c, r"\..*$", "")


def nearest_words(df: DataFrame, column: str, vocabulary: DataFrame, word: str, most: int) -> DataFrame:
    """All words of a vocabulary with a column's words' first letter and within an edit distance of them: df, candidate, distance."""
    return df.join(near_words(df, column, vocabulary, word, most).withColumnRenamed("word", column), column)


def spell_correct(df: DataFrame, key: str, column: str, vocabulary: DataFrame, word: str, most: int = 1) -> DataFrame:
    """key, corrected: words that aren't in the vocabulary replaced where there is just one near word; else the text as it was."""
    each = df.select(key, column, F.posexplode(words(F.col(column))).alias("_at", "_word"))
    known = vocabulary.select(F.col(word).alias("_word")).distinct().withColumn("_known", F.lit(True))
    unknown = each.select("_word").distinct().join(known, "_word", "left_anti")
    near = nearest_words(unknown, "_word", vocabulary, word, most).groupBy("_word").agg(F.count("*").alias("_n"), F.min("candidate").alias("_near"))
    fixed = each.join(known, "_word", "left").join(near, "_word", "left")
    better = F.when(F.col("_known"), F.col("_word")).when(F.col("_n") == 1, F.col("_near"))
    parts = fixed.groupBy(key, column).agg(F.array_sort(F.collect_list(F.struct("_at", better.alias("w")))).alias("p"))
    whole = F.array_join(F.transform("p", lambda x: x["w"]), " ")
    done = parts.select(key, F.when(F.exists("p", lambda x: x["w"].isNull()), F.col(column)).otherwise(whole).alias("corrected"))
    return df.select(key, column).join(done, key, "left").select(key, F.coalesce("corrected", column).alias("corrected"))
