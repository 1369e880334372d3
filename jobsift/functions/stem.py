"""Porter stemming of token arrays, one stem per distinct word of a task.

The stemmer follows M. F. Porter, "An algorithm for suffix stripping" (1980),
with the departures that common Python toolkits apply by default: a few
irregular words, no change to words of one or two letters, and milder handling
of "ies", "ied", final "y", "alli", "fulli" and "logi".
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsift.functions.arrays import slices

# Words with a stem of their own
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning",
    "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
# Suffix tables of steps 2, 3 and 4 of the paper
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance",
    "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e",
    "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful",
}
STEP3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic",
    "ful": "", "ness": "",
}
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def _shape(word: str) -> str:
    """The word as consonants (c) and vowels (v); y is a vowel after a consonant."""
    shape = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _short(stem: str) -> bool:
    """Ends consonant-vowel-consonant, or is a vowel and a consonant."""
    shape = _shape(stem)
    return shape == "vc" or (shape.endswith("cvc") and stem[-1] not in "wxy")


def _longest_suffix(word: str, suffixes) -> str | None:
    matching = [s for s in suffixes if word.endswith(s)]
    return max(matching, key=len) if matching else None


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word if word.endswith("ss") or not word.endswith("s") else word[:-1]


def _past_or_gerund(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    ending = _longest_suffix(word, ("ed", "ing"))
    if ending is None or "v" not in _shape(word[: -len(ending)]):
        return word
    stem = word[: -len(ending)]
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c":
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short(stem) else stem


def _final_y(word: str) -> str:
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        return word[:-1] + "i"
    return word


def _double_suffix(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _double_suffix(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _swap(word, STEP2)


def _swap(word: str, table: Mapping[str, str]) -> str:
    suffix = _longest_suffix(word, table)
    if suffix is None or _measure(word[: -len(suffix)]) == 0:
        return word
    return word[: -len(suffix)] + table[suffix]


def _drop_suffix(word: str) -> str:
    suffix = _longest_suffix(word, STEP4)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    if _measure(stem) < 2 or (suffix == "ion" and stem[-1] not in "st"):
        return word
    return stem


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        measure = _measure(stem)
        if measure > 1 or (measure == 1 and not _short(stem)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def porter(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _final_y(_past_or_gerund(_plural(word)))
    word = _swap(_double_suffix(word), STEP3)
    return _tidy(_drop_suffix(word))


# Words that are kept with their results in a task, and that are mapped at a time
KNOWN_WORDS = 1 << 18
SLICE_WORDS = 1 << 18


def map_words(tokens: Column, resolve_for_task: Callable[[], Callable[[str], str]]) -> Column:
    """Apply a word function to every element of a token array.

    Slices of a batch are dictionary-encoded, so Python sees a distinct word once
    per slice and the rest is a vectorised take.  What is known of words is kept up to a
    size.  No shuffle, no explode.
    """

    def mapped(lists: pa.Array, resolve: Callable[[str], str], known: dict[str, str]) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(lists), 0)
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(lengths).cast(pa.int32())])
        encoded = lists.flatten().dictionary_encode()
        words = encoded.dictionary.to_pylist()
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = resolve(word)
        found = pa.array([known[w] for w in words], pa.string())
        return pa.ListArray.from_arrays(offsets, found.take(encoded.indices))

    @F.arrow_udf("array<string>")
    def over_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        resolve = resolve_for_task()
        known: dict[str, str] = {}
        for lists in batches:
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            parts = [mapped(lists.slice(a, b - a), resolve, known) for a, b in slices(sizes, SLICE_WORDS)]
            yield pa.concat_arrays(parts or [pa.array([], pa.list_(pa.string()))])

    return over_batches(tokens)


def stemmed(tokens: Column) -> Column:
    """Porter stem of every token."""
    return map_words(tokens, lambda: porter)
