"""English suffix stripping (Porter's algorithm with the common extensions) as an Arrow UDF over token arrays."""

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOWELS = set("aeiou")

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}

# Suffix tables of the published algorithm (suffix, replacement).
DERIVED = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
           ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
           ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
           ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"), ("logi", "log")]
REDUCED = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
DROPPED = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
           "iti", "ous", "ive", "ize"]


def _shape(word: str) -> str:
    """'c' and 'v' per letter; y is a vowel after a consonant."""
    shape = ""
    for letter in word:
        vowel = letter in VOWELS or (letter == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _double_end(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    """consonant-vowel-consonant (last not w, x, y), or a two-letter vowel-consonant word."""
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or (len(word) == 2 and shape == "vc")


def _plural(w: str) -> str:
    if w.endswith("ies"):
        return w[:-3] + ("ie" if len(w) == 4 else "i")
    if w.endswith("sses"):
        return w[:-2]
    return w[:-1] if w.endswith("s") and not w.endswith("ss") else w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-3] + ("ie" if len(w) == 4 else "i")
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    cut = next((w[:-len(s)] for s in ("ed", "ing") if w.endswith(s)), None)
    if cut is None or "v" not in _shape(cut):
        return w
    if cut.endswith(("at", "bl", "iz")):
        return cut + "e"
    if _double_end(cut):
        return cut if cut[-1] in "lsz" else cut[:-1]
    return cut + "e" if _measure(cut) == 1 and _short_end(cut) else cut


def _final_y(w: str) -> str:
    return w[:-1] + "i" if w.endswith("y") and len(w) > 2 and _shape(w[:-1])[-1] == "c" else w


def _swap(w: str, table) -> str:
    """Apply the first matching suffix if the part before it has a vowel-consonant pair."""
    for suffix, new in table:
        if w.endswith(suffix):
            stem = w[:-len(suffix)]
            kept = w[:-3] if suffix == "logi" else stem
            return stem + new if _measure(kept) > 0 else w
    return w


def _derived(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _derived(w[:-2])
    return _swap(w, DERIVED)


def _drop(w: str) -> str:
    for suffix in DROPPED:
        if w.endswith(suffix):
            stem = w[:-len(suffix)]
            allowed = _measure(stem) > 1 and (suffix != "ion" or stem[-1:] in ("s", "t"))
            return stem if allowed else w
    return w


def _final_e(w: str) -> str:
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _short_end(stem)):
            w = stem
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w


def stem(word: str) -> str:
    """Stem of a lower-case word; words of up to two letters stay."""
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _derived, lambda w: _swap(w, REDUCED), _drop, _final_e):
        word = step(word)
    return word


CACHED_STEMS = 1 << 16


def stemmed_lists(lists: pa.Array, known: dict) -> pa.Array:
    """Lists of tokens to lists of stems; a null list becomes an empty one. Each distinct token is looked at once."""
    encoded = lists.flatten().dictionary_encode()
    stems = []
    for token in encoded.dictionary.to_pylist():
        if len(token) > 3:
            if token not in known:
                if len(known) >= CACHED_STEMS:
                    known.clear()
                known[token] = stem(token)
            token = known[token]
        stems.append(token)
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(stems, pa.string()).take(encoded.indices))


@F.arrow_udf(ArrayType(StringType()))
def stem_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Stem tokens longer than three letters. Row-local, with a bounded cache per task: no shuffle on hot words, and no Python
    object per token."""
    known: dict = {}
    for batch in batches:
        yield stemmed_lists(batch, known)
