"""Which of many keywords a text contains: one automaton over whole Arrow buffers.

The keywords form a trie over their UTF-8 bytes.  All positions of a buffer descend it
together, a byte at a time, and those without a next node fall away; after the first
bytes few are left.  The work depends on the text and hardly on how many keywords
there are, and no text becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20


class Automaton:
    """A byte trie: ``following[node, byte]`` is the next node or -1, ``word[node]`` a keyword or -1."""

    def __init__(self, words: Sequence[str]) -> None:
        following, word = [np.full(256, -1, np.int32)], [-1]
        for i, text in enumerate(words):
            node = 0
            for byte in text.encode():
                if following[node][byte] < 0:
                    following[node][byte] = len(following)
                    following.append(np.full(256, -1, np.int32))
                    word.append(-1)
                node = following[node][byte]
            word[node] = i
        self.following, self.word, self.size = np.stack(following), np.array(word, np.int32), len(words)
        # two bytes at once tell most positions that no keyword starts there
        first = self.following[0]
        second = np.where(first[:, None] >= 0, self.following[first], -1)
        self.begins = ((second >= 0) | ((first >= 0) & (self.word[first] >= 0))[:, None]).ravel()
        self.everywhere = bool(words) and self.word[0] >= 0

    def presence(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Marks (text x keyword) for texts between successive bounds of a buffer."""
        n = len(bounds) - 1
        found = np.zeros((n, self.size), bool)
        if self.everywhere:
            found[:, self.word[0]] = True
        if not len(data):
            return found
        pairs = data.astype(np.uint16) << 8
        pairs[:-1] |= data[1:]
        at = np.flatnonzero(self.begins[pairs])
        node = self.following[0][data[at]]
        # the byte behind the last one is any byte, so its first step may lead nowhere
        at, node = at[node >= 0], node[node >= 0]
        depth = 1
        while len(at):
            word = self.word[node]
            hit = word >= 0
            if hit.any():
                text = np.searchsorted(bounds, at[hit], "right") - 1
                inside = at[hit] + depth <= bounds[text + 1]
                found[text[inside], word[hit][inside]] = True
            more = at + depth < len(data)
            at, node = at[more], node[more]
            node = self.following[node, data[at + depth]]
            at, node = at[node >= 0], node[node >= 0]
            depth += 1
        return found


def _texts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and bounds of the texts of a column, in slices; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at, n = 0, len(column)
    while at < n:
        to = min(max(int(np.searchsorted(ends, ends[at] + SLICE_BYTES, "right")) - 1, at + 1), n)
        yield flat[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
        at = to


def words_contained(text: Column, words: Sequence[str]) -> Column:
    """The keywords that a text contains as substrings, in list order."""
    listed = list(words)

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # equal words of the list are one keyword, put back at each of its places
        distinct = list(dict.fromkeys(listed))
        automaton, names = Automaton(distinct), pa.array(listed, pa.string())
        places = np.array([distinct.index(w) for w in listed], np.int64)
        for column in batches:
            parts = [automaton.presence(*part)[:, places] for part in _texts(column)]
            found = np.concatenate(parts) if parts else np.zeros((0, len(listed)), bool)
            offsets = np.zeros(len(found) + 1, np.int32)
            np.cumsum(found.sum(1), out=offsets[1:])
            yield pa.ListArray.from_arrays(pa.array(offsets), names.take(pa.array(np.nonzero(found)[1])))

    return run(text)


def weights_contained(text: Column, groups: Sequence[Mapping[int, Sequence[str]]]) -> Column:
    """For each group the sum of the weights of the words that the text contains."""
    weighted = [(i, word, weight) for i, group in enumerate(groups) for weight, words in group.items() for word in words]

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        distinct = list(dict.fromkeys(word for _, word, _ in weighted))
        automaton, place = Automaton(distinct), {word: i for i, word in enumerate(distinct)}
        weights = np.zeros((len(distinct), len(groups)), np.int32)
        for group, word, weight in weighted:
            weights[place[word], group] += weight
        for column in batches:
            parts = [automaton.presence(*part).astype(np.int32) @ weights for part in _texts(column)]
            points = np.concatenate(parts) if parts else np.zeros((0, len(groups)), np.int32)
            offsets = np.arange(len(points) + 1, dtype=np.int32) * len(groups)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(points.ravel()))

    return run(text)
