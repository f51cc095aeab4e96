"""English suffix stripping (Porter 1980, with the extensions ROUGE scorers use)."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words with a set stem.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Suffix -> replacement, tried in this order, first match decides.
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"),
    ("biliti", "ble"), ("fulli", "ful"), ("logi", "log"),
]
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]


_KINDS = {ord(c): "v" if c in "aeiou" else c if c == "y" else "c" for c in map(chr, range(128))}


def _shape(stem: str) -> str:
    """One letter per character: c(onsonant) or v(owel). A y after a consonant is a vowel."""
    out = stem.translate(_KINDS)
    while "y" in out:
        at = out.index("y")
        out = out[:at] + ("v" if at and out[at - 1] == "c" else "c") + out[at + 1 :]
    return out


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double_consonant(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _shape(w)[-1] == "c"


def _cvc(w: str) -> bool:
    shape = _shape(w)
    return (shape[-3:] == "cvc" and w[-1] not in "wxy") or (len(w) == 2 and shape == "vc")


def _plural(w: str) -> str:
    if w.endswith("ies") and len(w) == 4:
        return w[:-1]
    for suffix, cut in (("sses", 2), ("ies", 2), ("ss", 0), ("s", 1)):
        if w.endswith(suffix):
            return w[: len(w) - cut]
    return w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        base = w[: -len(suffix)]
        if w.endswith(suffix) and _has_vowel(base):
            break
    else:
        return w
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if _double_consonant(base):
        return base if base[-1] in "lsz" else base[:-1]
    if _measure(base) == 1 and _cvc(base):
        return base + "e"
    return base


def _final_y(w: str) -> str:
    if w.endswith("y") and len(w) > 2 and _shape(w[:-1])[-1] == "c":
        return w[:-1] + "i"
    return w


def _derived(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _derived(w[:-2])
    for suffix, new in STEP2:
        if w.endswith(suffix):
            base = w[: -len(suffix)]
            tested = w[:-3] if suffix == "logi" else base
            return base + new if _measure(tested) > 0 else w
    return w


def _adjective(w: str) -> str:
    for suffix, new in STEP3:
        if w.endswith(suffix):
            base = w[: -len(suffix)]
            return base + new if _measure(base) > 0 else w
    return w


def _long_suffix(w: str) -> str:
    for suffix in STEP4:
        if w.endswith(suffix):
            base = w[: -len(suffix)]
            ok = _measure(base) > 1 and (suffix != "ion" or base[-1:] in ("s", "t"))
            return base if ok else w
    return w


def _tidy(w: str) -> str:
    if w.endswith("e"):
        base = w[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _cvc(base)):
            w = base
    if w.endswith("ll") and _measure(w[:-1]) > 1:
        w = w[:-1]
    return w


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _derived, _adjective, _long_suffix, _tidy):
        word = step(word)
    return word


def score_stem(word: str) -> str:
    """ROUGE leaves words of three letters or fewer alone."""
    return stem(word) if len(word) > 3 else word


def stem_tokens(tokens: Column) -> Column:
    """Stem an ``array<string>`` column; each distinct token of a batch is stemmed once."""

    @F.arrow_udf("array<string>")
    def run(batch: pa.Array) -> pa.Array:
        coded = batch.flatten().dictionary_encode()
        stems = pa.array([score_stem(w) for w in coded.dictionary.to_pylist()], pa.string())
        lengths = batch.value_lengths().fill_null(0).to_numpy()
        offsets = pa.array([0, *lengths.cumsum().tolist()], pa.int32())
        return pa.ListArray.from_arrays(offsets, stems.take(coded.indices))

    return run(tokens)


def stem_vocab(df: DataFrame, tokens: Column) -> DataFrame:
    """Distinct tokens of a corpus with their stems and counts."""

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([score_stem(w) for w in batch.to_pylist()], pa.string())

    counts = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(
        F.count("*").alias("n")
    )
    return counts.select("token", run("token").alias("stem"), "n")
