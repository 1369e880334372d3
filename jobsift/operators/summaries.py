"""The summary columns of the rule-based annotator from parallel arrays of a batch.

Words of a batch are coded once by a dictionary, so what depends on a word alone
(lower case, class, stop word) is decided once per distinct word.  Tokens are arrays of
codes, documents are segments of them, and counts per document are sorted keys of
(document, value).  Names of a gazetteer are found by a trie that all tokens
descend together.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from jobsift import lexicons

CLASSES = ["NOUN", "PROPN", "VERB", "ADV", "NUM", "SYM", "PUNCT"]
_NOUN, _PROPN, _VERB, _ADV, _NUM, _SYM, _PUNCT = range(7)


@dataclass
class Trie:
    """Entries as runs of words: edges ``(node, word)`` in one sorted array of keys."""

    words: pa.Array
    keys: np.ndarray
    children: np.ndarray
    entry: np.ndarray
    surfaces: pa.Array
    labels: pa.Array

    @classmethod
    def of(cls, rows: Sequence[tuple[str, str]]) -> Trie:
        """From (surface, label), one row per surface; words are parted by single blanks."""
        codes: dict[str, int] = {}
        edges: dict[tuple[int, int], int] = {}
        entry = [-1]
        for i, (surface, _) in enumerate(rows):
            node = 0
            for word in surface.split(" "):
                step = (node, codes.setdefault(word, len(codes)))
                if step not in edges:
                    edges[step] = len(entry)
                    entry.append(-1)
                node = edges[step]
            entry[node] = i
        n = max(len(codes), 1)
        keys = np.array([node * n + word for node, word in edges], np.int64)
        order = np.argsort(keys)
        return cls(
            pa.array(list(codes), pa.string()),
            keys[order],
            np.array(list(edges.values()), np.int64)[order],
            np.array(entry, np.int64),
            pa.array([s for s, _ in rows], pa.string()),
            pa.array([label for _, label in rows], pa.string()),
        )

    def find(self, dictionary: pa.Array, code: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and entries of all runs of words inside one segment, by start and then length."""
        if not len(self.keys) or not len(code):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = pc.fill_null(pc.index_in(dictionary, value_set=self.words), -1).to_numpy().astype(np.int64)
        word, n = known[code], len(self.words)
        at = np.flatnonzero(word >= 0)
        node, depth = np.zeros(len(at), np.int64), 0
        starts, entries, lengths = [], [], []
        while len(at) or not starts:
            wanted = node * n + word[at + depth]
            place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            found = self.keys[place] == wanted
            at, node = at[found], self.children[place[found]]
            ended = self.entry[node] >= 0
            starts.append(at[ended])
            entries.append(self.entry[node[ended]])
            depth += 1
            lengths.append(np.full(len(starts[-1]), depth))
            more = at + depth < len(code)
            at, node = at[more], node[more]
            same = (segment[at + depth] == segment[at]) & (word[at + depth] >= 0)
            at, node = at[same], node[same]
        start, entry = np.concatenate(starts), np.concatenate(entries)
        order = np.lexsort((np.concatenate(lengths), start))
        return start[order], entry[order]


def word_counts(sentences: pa.ListArray) -> np.ndarray:
    """Words of each document given as a list of sentences of words."""
    parents = pc.list_parent_indices(sentences).to_numpy().astype(np.int64)
    sizes = pc.list_value_length(sentences.flatten()).to_numpy(zero_copy_only=False)
    return np.bincount(parents, sizes, minlength=len(sentences)).astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RunTable:
    """A table of bits, of fixed size, of the runs of words that begin or are an entry.

    It may take other runs for entries and never misses one, so what it lets pass is
    joined to the entries afterwards.
    """

    BITS = 26
    BEGINS, IS = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)

    def __init__(self, words: np.ndarray | None = None) -> None:
        self.bits = words
        self.known: dict[str, int] = {}

    def _hashes(self, words: pa.Array) -> np.ndarray:
        if len(self.known) >= Lexicon.LIMIT:
            self.known.clear()
        for word in words.to_pylist():
            if word not in self.known:
                self.known[word] = int.from_bytes(hashlib.blake2b((word or "").encode(), digest_size=8).digest(), "little")
        return np.array([self.known[word] for word in words.to_pylist()], np.uint64)

    @staticmethod
    def _next(run: np.ndarray, word: np.ndarray) -> np.ndarray:
        return _mixed(run * np.uint64(0x9E3779B97F4A7C15) + word)

    def _place(self, run: np.ndarray, kind: np.uint64) -> np.ndarray:
        return _mixed(run ^ kind) >> np.uint64(64 - self.BITS)

    def places(self, surfaces: pa.Array) -> np.ndarray:
        """Bits of the entries, whose words are parted by single blanks."""
        lists = pc.split_pattern(surfaces, " ")
        coded = lists.flatten().dictionary_encode()
        hashes = self._hashes(coded.dictionary)[coded.indices.to_numpy()]
        sizes = pc.list_value_length(lists).to_numpy()
        at = np.cumsum(sizes) - sizes
        run, depth, found = np.zeros(len(at), np.uint64), 0, []
        while len(at):
            run, depth = self._next(run, hashes[at + depth]), depth + 1
            found += [self._place(run, self.BEGINS), self._place(run[sizes == depth], self.IS)]
            more = sizes > depth
            at, run, sizes = at[more], run[more], sizes[more]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)

    def _holds(self, place: np.ndarray) -> np.ndarray:
        return (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1

    def runs(self, words: pa.Array, segment: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Starts and texts of the runs of words inside one segment that may be entries."""
        coded = words.dictionary_encode()
        code, dictionary = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        hashes = self._hashes(dictionary)
        at, depth = np.arange(len(code)), 0
        run = np.zeros(len(code), np.uint64)
        starts, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(at):
            run, depth = self._next(run, hashes[code[at + depth]]), depth + 1
            begins = self._holds(self._place(run, self.BEGINS))
            at, run = at[begins], run[begins]
            starts.append(at[self._holds(self._place(run, self.IS))])
            lengths.append(np.full(len(starts[-1]), depth))
            more = at + depth < len(code)
            at, run = at[more], run[more]
            same = segment[at + depth] == segment[at]
            at, run = at[same], run[same]
        start, length = np.concatenate(starts), np.concatenate(lengths)
        offsets = np.append(0, np.cumsum(length))
        places = np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), dictionary.take(pa.array(code[places])))
        return start, pc.binary_join(lists, " ")


def _is_word(char: str) -> bool:
    category = unicodedata.category(char)
    return category[0] in "LM" or category in ("Nd", "Nl", "Pc") or char in "‌‍"


def _class_of(word: str, lowered: str, closed: dict[str, int], symbols: set[str]) -> int:
    """Class of a word that does not open a sentence."""
    if len(word) == 1:
        if word in symbols:
            return _SYM
        if not _is_word(word):
            return _PUNCT
    if word.isascii() and word.isdigit():
        return _NUM
    if lowered in closed:
        return closed[lowered]
    if word != lowered and unicodedata.category(word[0]) == "Lu":
        return _PROPN
    return _class_of_ending(lowered)


def _class_of_ending(lowered: str) -> int:
    if lowered.endswith("ly"):
        return _ADV
    return _VERB if lowered.endswith(("ing", "ed")) else _NOUN


class Lexicon:
    """What the rules know of single words, kept for the words of a task up to a size."""

    LIMIT = 1 << 18

    def __init__(self, closed: dict[str, list[str]], symbols: Sequence[str], stops: Sequence[str]) -> None:
        self.classes = CLASSES + list(closed)
        self.closed = {w: len(CLASSES) + i for i, members in enumerate(closed.values()) for w in members}
        self.symbols, self.stops = set(symbols), set(stops)
        self.known: dict[str, tuple[str, int, int, bool, bool, bool]] = {}

    def about(self, word: str) -> tuple[str, int, int, bool, bool, bool]:
        """Lower case, class, class as the first word of a sentence, whether it counts as content, is of letters, is a stop word."""
        found = self.known.get(word)
        if found is None:
            lowered = word.lower()
            inside = _class_of(word, lowered, self.closed, self.symbols)
            first = _class_of_ending(lowered) if inside == _PROPN else inside
            letters, stop = word.isalpha(), lowered in self.stops
            content = letters and not stop and len(lowered) > 2
            if len(self.known) >= self.LIMIT:
                self.known.clear()
            found = self.known[word] = (lowered, inside, first, content, letters, stop)
        return found


def _lists(document: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    """Values in order of their documents as one list per document."""
    offsets = np.zeros(n + 1, np.int32)
    np.cumsum(np.bincount(document, minlength=n), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _joined(document: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    return pc.binary_join(_lists(document, values, n), ", ")


def _places(document: np.ndarray) -> np.ndarray:
    """Place of each row within its document, for rows in order of documents."""
    starts = np.flatnonzero(np.r_[True, document[1:] != document[:-1]]) if len(document) else np.zeros(0, np.int64)
    return np.arange(len(document)) - np.repeat(starts, np.diff(np.r_[starts, len(document)]))


def _most_common(document: np.ndarray, value: np.ndarray, names: pa.Array, k: int, n: int) -> pa.Array:
    """Per document the k most frequent values, the earlier one first on ties, joined."""
    size = max(len(names), 1)
    key, first, count = np.unique(document * size + value, return_index=True, return_counts=True)
    order = np.lexsort((first, -count, key // size))
    order = order[_places(key[order] // size) < k]
    return _joined(key[order] // size, names.take(pa.array(key[order] % size)), n)


def _first_distinct(document: np.ndarray, texts: pa.Array, k: int, n: int) -> pa.Array:
    """Per document the first k distinct texts in order of appearance, joined."""
    coded = texts.dictionary_encode()
    size = max(len(coded.dictionary), 1)
    key, first = np.unique(document * size + coded.indices.to_numpy().astype(np.int64), return_index=True)
    order = np.argsort(first)
    order = order[_places(key[order] // size) < k]
    return _joined(key[order] // size, coded.dictionary.take(pa.array(key[order] % size)), n)


class Coded:
    """The words of documents given as lists of sentences of words, each with its place and class."""

    def __init__(self, sentences: pa.ListArray, lexicon: Lexicon) -> None:
        sentence_of = sentences.flatten()
        self.words = sentence_of.flatten()
        self.sentence = pc.list_parent_indices(sentence_of).to_numpy().astype(np.int64)
        self.document = pc.list_parent_indices(sentences).to_numpy().astype(np.int64)[self.sentence]
        coded = self.words.dictionary_encode()
        self.code, self.dictionary = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        self.known = [lexicon.about(w) for w in self.dictionary.to_pylist()]
        n = len(self.sentence)
        self.opens = np.r_[True, self.sentence[1:] != self.sentence[:-1]] if n else np.zeros(0, bool)
        self.upos = np.where(self.opens, self.about(2)[self.code], self.about(1)[self.code])

    def about(self, field: int) -> np.ndarray:
        return np.array([k[field] for k in self.known], np.int64)

    def noun_runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of nouns, which of them begin a run within a sentence, and the offsets of the runs."""
        at = np.flatnonzero((self.upos == _NOUN) | (self.upos == _PROPN))
        starts = np.r_[True, (np.diff(at) > 1) | self.opens[at[1:]]] if len(at) else np.zeros(0, bool)
        return at, starts, np.append(np.flatnonzero(starts), len(at)).astype(np.int32)


def token_lists(sentences: pa.ListArray, lexicon: Lexicon, fields: Sequence[pa.Field]) -> pa.ListArray:
    """The tokens of each document, with the given fields in the order of the annotations."""
    coded = Coded(sentences, lexicon)
    code, n = coded.code, len(sentences)
    sizes = pc.list_value_length(sentences).to_numpy()
    values = [
        pa.array(coded.sentence - (np.cumsum(sizes) - sizes)[coded.document], pa.int32()),
        pa.array(_places(coded.document), pa.int32()),
        coded.words,
        pa.array([k[0] for k in coded.known], pa.string()).take(pa.array(code)),
        pa.array(lexicon.classes, pa.string()).take(pa.array(coded.upos)),
        pa.array(np.zeros(len(code), bool)),
        pa.array(coded.about(4)[code] == 1),
        pa.array(coded.about(5)[code] == 1),
    ]
    return _lists(coded.document, pa.StructArray.from_arrays(values, fields=list(fields)), n)


def chunk_lists(sentences: pa.ListArray, lexicon: Lexicon, fields: Sequence[pa.Field]) -> pa.ListArray:
    """The noun chunks of each document as spans."""
    coded = Coded(sentences, lexicon)
    at, starts, offsets = coded.noun_runs()
    runs = pa.ListArray.from_arrays(pa.array(offsets), coded.dictionary.take(pa.array(coded.code[at])))
    first = at[starts]
    values = [
        pa.array(_places(coded.document)[first], pa.int32()),
        pa.repeat("NP", len(first)),
        pc.binary_join(runs, " "),
        pa.repeat("", len(first)),
    ]
    return _lists(coded.document[first], pa.StructArray.from_arrays(values, fields=list(fields)), len(sentences))


def summarise(sentences: pa.ListArray, lexicon: Lexicon, trie: Trie | None) -> dict[str, pa.Array]:
    """The summary columns of documents given as lists of sentences of words."""
    n = len(sentences)
    coded = Coded(sentences, lexicon)
    document, sentence, code, dictionary = coded.document, coded.sentence, coded.code, coded.dictionary
    opens, upos = coded.opens, coded.upos
    lowered = pa.array([k[0] for k in coded.known], pa.string()).dictionary_encode()
    lemma, lemmas = lowered.indices.to_numpy().astype(np.int64), lowered.dictionary
    content = coded.about(3)

    counted = np.flatnonzero(content[code])
    n_tokens = np.bincount(document, minlength=n)
    n_sentences = np.bincount(document[opens], minlength=n)

    at, starts, offsets = coded.noun_runs()
    runs = pa.ListArray.from_arrays(pa.array(offsets), lemmas.take(pa.array(lemma[code[at]])))
    chunks = pc.binary_join(runs, " ")
    size = pc.utf8_length(chunks).to_numpy()
    fit = (size >= 2) & (size <= 50)
    chunk = chunks.filter(pa.array(fit)).dictionary_encode()
    chunk_document = document[at[starts]][fit]

    least = np.maximum(n_sentences, 1)
    columns = {
        "spacy_sentences": pa.array(n_sentences, pa.int32()),
        "spacy_tokens": pa.array(n_tokens, pa.int32()),
        "spacy_top_lemmas": _most_common(document[counted], lemma[code[counted]], lemmas, lexicons.TOP_LEMMAS, n),
        "adv_tokens": pa.array(n_tokens, pa.int32()),
        "adv_sentences": pa.array(least, pa.int32()),
        "adv_tokens_per_sentence": pa.array(n_tokens / least, pa.float64()),
        "adv_top_pos": _most_common(document, upos, pa.array(lexicon.classes, pa.string()), lexicons.TOP_POS, n),
        "adv_top_noun_chunks": _most_common(
            chunk_document, chunk.indices.to_numpy().astype(np.int64), chunk.dictionary, lexicons.TOP_NOUN_CHUNKS, n
        ),
    }
    start, entry = trie.find(dictionary, code, sentence) if trie else (np.zeros(0, np.int64),) * 2
    labels = np.zeros(0, object) if trie is None else np.array(trie.labels.to_pylist(), object)[entry]
    texts = pa.array([], pa.string()) if trie is None else trie.surfaces.take(pa.array(entry))
    org, place = labels == "ORG", (labels == "GPE") | (labels == "LOC")
    named = pc.binary_join_element_wise(texts, pc.binary_join_element_wise("(", pa.array(labels, pa.string()), ")", ""), "")
    for name, kind, values, cap in (
        ("spacy_orgs", org, texts, lexicons.BASIC_ENTITY_CAP),
        ("spacy_places", place, texts, lexicons.BASIC_ENTITY_CAP),
        ("adv_orgs", org, texts, lexicons.ADVANCED_ENTITY_CAP),
        ("adv_places", place, texts, lexicons.ADVANCED_ENTITY_CAP),
        ("adv_other_ents", ~(org | place), named, lexicons.ADVANCED_ENTITY_CAP),
    ):
        kind = np.asarray(kind, bool)
        columns[name] = _first_distinct(document[start[kind]], values.filter(pa.array(kind)), cap, n)
    return columns


def segments(texts: pa.ListArray, sentences: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Document and sentence of every word, sentences numbered over all documents."""
    document = pc.list_parent_indices(texts).to_numpy().astype(np.int64)
    within = sentences.flatten().to_numpy().astype(np.int64)
    changes = (document[1:] != document[:-1]) | (within[1:] != within[:-1])
    return document, np.cumsum(np.r_[False, changes]) if len(document) else document


def spans(texts: pa.ListArray, sentences: pa.ListArray, trie: Trie) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, place of the first word in it, and entry of every run of words that is an entry."""
    coded = texts.flatten().dictionary_encode()
    document, segment = segments(texts, sentences)
    start, entry = trie.find(coded.dictionary, coded.indices.to_numpy().astype(np.int64), segment)
    first = np.searchsorted(document, document[start])
    return document[start], start - first, entry
