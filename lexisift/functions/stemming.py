"""French stems by the published Snowball rules, over the distinct words of Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The vowels, and the endings of the Snowball rules for French by what is done with them.
VOWELS = "aeiouyâàëéêèïîôûù"
STANDARD = {
    "delete": "ance iqUe isme able iste eux ances iqUes ismes ables istes", "ation": "atrice ateur ation atrices ateurs ations", "log": "logie logies",
    "u": "usion ution usions utions", "ent": "ence ences", "ement": "ement ements", "ité": "ité ités", "if": "if ive ifs ives", "eau": "eaux", "al": "aux",
    "eux": "euse euses", "issement": "issement issements", "amment": "amment", "emment": "emment", "ment": "ment ments",
}
I_VERBS = (
    "îmes ît îtes i ie Ie ies ir ira irai iraIent irais irait iras irent irez iriez irions irons iront is issaIent issais issait issant issante issantes issants isse "
    "issent isses issez issiez issions issons it"
)
E_VERBS = "é ée ées és èrent er era erai eraIent erais erait eras erez eriez erions erons eront ez iez"
A_VERBS = "âmes ât âtes a ai aIent ais ait ant ante antes ants as asse assent asses assiez assions"

KINDS = {ending: kind for kind, endings in STANDARD.items() for ending in endings.split()}


def last(endings: str) -> re.Pattern:
    """The longest of some endings at a word's end: a search finds the leftmost."""
    return re.compile("(?:" + "|".join(endings.split()) + r")\Z")


_STANDARD, _I, _OTHER, _LAST = last(" ".join(KINDS)), last(I_VERBS), last(f"ions {E_VERBS} {A_VERBS}"), last("ion ier ière Ier Ière e ë")
_REGION = re.compile(f"[{VOWELS}][^{VOWELS}]", re.S)
_FIRST = re.compile(f"(?s).[^{VOWELS}]*[{VOWELS}]")
_A = frozenset(A_VERBS.split())


def marked(word: str) -> str:
    """u, i and y that are no vowels in their place, as capitals."""
    out = ""
    for at, c in enumerate(word):
        before, after = out[-1:], word[at + 1 : at + 2]
        is_vowel = lambda x: bool(x) and x in VOWELS
        if c == "u" and (is_vowel(before) and is_vowel(after) or before == "q") or c == "i" and is_vowel(before) and is_vowel(after) or c == "y" and (is_vowel(before) or is_vowel(after)):
            c = c.upper()
        out += c
    return out


def regions(w: str) -> tuple[int, int, int]:
    """Where RV, R1 and R2 begin."""
    if len(w) > 2 and w[0] in VOWELS and w[1] in VOWELS or w[:3] in ("par", "col", "tap"):
        rv = 3
    else:
        rv = m.end() if (m := _FIRST.match(w)) else len(w)
    r1 = m.end() if (m := _REGION.search(w)) else len(w)
    r2 = m.end() if (m := _REGION.search(w, r1)) else len(w)
    return rv, r1, r2


def standard_suffix(w: str, rv: int, r1: int, r2: int) -> tuple[str, bool]:
    """The word without a standard suffix, and whether that is all (else verb endings are looked at too)."""
    m = _STANDARD.search(w)
    if not m:
        return w, False
    kind, at = KINDS[m[0]], m.start()
    stem, far, mid, near = w[:at], at >= r2, at >= r1, at >= rv

    def off(s: str, end: str, instead: str | None = None) -> str:
        """s without an end that is in R2, or with something instead if it is not."""
        if not s.endswith(end):
            return s
        return s[: -len(end)] if len(s) - len(end) >= r2 else s if instead is None else s[: -len(end)] + instead

    if kind == "delete" and far:
        return stem, True
    if kind == "ation" and far:
        return off(stem, "ic", "iqU"), True
    if kind in ("log", "u", "ent") and far:
        return stem + kind, True
    if kind == "ement" and near:
        if stem.endswith("iv"):
            cut = off(stem, "iv")
            return (off(cut, "at") if cut != stem else cut), True
        if stem.endswith("eus"):
            return (stem[:-3] if at - 3 >= r2 else stem[:-1] + "x" if at - 3 >= r1 else stem), True
        if stem.endswith(("abl", "iqU")):
            return off(stem, stem[-3:]), True
        if stem.endswith(("ièr", "Ièr")) and at - 3 >= rv:
            return stem[:-3] + "i", True
        return stem, True
    if kind == "ité" and far:
        for end, instead in (("abil", "abl"), ("ic", "iqU"), ("iv", None)):
            if stem.endswith(end):
                return off(stem, end, instead), True
        return stem, True
    if kind == "if" and far:
        cut = off(stem, "at")
        return (off(cut, "ic", "iqU") if cut != stem else cut), True
    if kind == "eau":
        return stem + "eau", True
    if kind == "al" and mid:
        return stem + "al", True
    if kind == "eux" and (far or mid):
        return (stem if far else stem + "eux"), True
    if kind == "issement" and mid and stem and stem[-1] not in VOWELS:
        return stem, True
    if kind in ("amment", "emment") and near:
        return stem + kind[0] + "nt", False
    if kind == "ment" and at - 1 >= rv and stem and stem[-1] in VOWELS:
        return stem, False
    return w, False


def verb_suffix(w: str, rv: int, r2: int) -> str:
    m = _I.search(w, rv)
    if m and m.start() - 1 >= rv and w[m.start() - 1] not in VOWELS:
        return w[: m.start()]
    m = _OTHER.search(w, rv)
    if not m or m[0] == "ions" and m.start() < r2:
        return w
    stem = w[: m.start()]
    return stem[:-1] if m[0] in _A and stem.endswith("e") and len(stem) - 1 >= rv else stem


def residual_suffix(w: str, rv: int, r2: int) -> str:
    if len(w) > 1 and w.endswith("s") and w[-2] not in "aiouès":
        w = w[:-1]
    m = _LAST.search(w, rv) if rv <= len(w) else None
    if not m:
        return w
    at = m.start()
    if m[0] == "ion":
        return w[:at] if at >= r2 and at - 1 >= rv and w[at - 1] in "st" else w
    if m[0] == "e":
        return w[:at]
    if m[0] == "ë":
        return w[:at] if at - 2 >= rv and w[:at].endswith("gu") else w
    return w[:at] + "i"


def french_stem(word: str) -> str:
    """The stem of one word in lower case."""
    w = marked(word)
    rv, r1, r2 = regions(w)
    stem, done = standard_suffix(w, rv, r1, r2)
    if not done:
        stem = verb_suffix(stem, rv, r2)
    if stem != w:
        stem = stem[:-1] + {"Y": "i", "ç": "c"}.get(stem[-1:], stem[-1:])
    else:
        stem = residual_suffix(stem, rv, r2)
    if stem.endswith(("enn", "onn", "ett", "ell", "eill")):
        stem = stem[:-1]
    stem = re.sub(rf"[éè]([^{VOWELS}]+)\Z", r"e\1", stem)
    return stem.replace("I", "i").replace("U", "u").replace("Y", "y")


def each_word(items: Column, rule: Callable[[str], str]) -> Column:
    """An array of words with a rule applied to each: once for each distinct word of an Arrow batch. Nulls stay."""

    @F.arrow_udf("array<string>")
    def run(batch: pa.Array) -> pa.Array:
        coded = batch.flatten().dictionary_encode()
        made = pa.array([None if w is None else rule(w) for w in coded.dictionary.to_pylist()], pa.string())
        sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.ListArray.from_arrays(offsets, made.take(coded.indices), mask=batch.is_null())

    return run(items)


#: Words whose rule is remembered by a task at once.
REMEMBERED = 1_000_000


def each_text(texts: Column, split: Callable[[str], list[str]], rule: Callable[[str], str | None], once: bool = False, joined: bool = False) -> Column:
    """A text's words with a rule applied to each, in one Arrow pass over whole texts; words for which it gives None go.

    The rule runs once for each distinct word that a batch or those before it have. once: each result once in a text;
    joined: a text of the words between spaces, null where none stay, instead of an array. A null text stays null.
    """
    known: dict[str, str | None] = {}

    @F.arrow_udf("string" if joined else "array<string>")
    def run(batch: pa.Array) -> pa.Array:
        out = []
        for text in batch.to_pylist():
            if text is None:
                out.append(None)
                continue
            words = split(text)
            for w in words:
                if w not in known:
                    known[w] = rule(w)
            made = [m for w in words if (m := known[w]) is not None]
            made = list(dict.fromkeys(made)) if once else made
            out.append((" ".join(made) or None) if joined else made)
            if len(known) > REMEMBERED:
                known.clear()
        return pa.array(out, pa.string() if joined else pa.list_(pa.string()))

    return run.asNondeterministic()(texts)  # so that a filter on the result does not run it a second time
