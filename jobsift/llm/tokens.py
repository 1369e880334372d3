"""Token ids in fixed-width binary files.

A file holds the ids of its documents one after another, each in the least bits
that number the vocabulary, in blocks of a fixed count of ids.  A footer has the
block offsets and the first id of every document, so any range of ids is found
and unpacked with numpy without reading what precedes it.

File: magic, then blocks, then the footer (block offsets, first ids, keys, null
marks of keys), then a trailer of fixed size.  All numbers are little-endian.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsift.llm import _files
from jobsift.llm._store import shuffles_dropped
from jobsift.llm._words import WHITE, RangeHash, Texts, slices
from jobsift.session import scratch_path

MAGIC = b"jsids001"
BLOCK_IDS = 1 << 16
#: Larger slices than elsewhere, since every slice extends the memory of pieces.
SLICE_BYTES = 1 << 20
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: Different pieces of text a worker remembers before it starts anew; more take memory and save no time.
MEMO_PIECES = 500_000
_TRAILER = np.dtype(
    [("bits", "<u4"), ("block_ids", "<u4"), ("n_ids", "<u8"), ("n_blocks", "<u8"), ("n_docs", "<u8"), ("footer", "<u8"), ("magic", "S8")]
)


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits == 16:
        return ids.astype("<u2").tobytes()
    places = np.arange(bits, dtype=np.uint32)
    spread = (ids.astype(np.uint32)[:, None] >> places) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, start: int, count: int, bits: int) -> np.ndarray:
    """``count`` ids from the ``start``-th of a block on."""
    if bits == 16:
        return np.frombuffer(data, "<u2", count, start * 2).astype(np.uint32)
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)])
    bit = (np.arange(count, dtype=np.int64) + start) * bits
    byte, found = bit >> 3, np.zeros(count, np.uint64)
    for k in range(5):
        found |= raw[byte + k].astype(np.uint64) << np.uint64(8 * k)
    found >>= (bit & 7).astype(np.uint64)
    return (found & np.uint64((1 << bits) - 1)).astype(np.uint32)


class Writer:
    """Streams ids into one file; holds a block and the index of its documents."""

    def __init__(self, sink, bits: int) -> None:
        self.sink, self.bits = sink, bits
        self.offsets, self.firsts, self.keys, self.held = [len(MAGIC)], [], [], []
        self.waiting, self.n_ids = 0, 0
        sink.write(MAGIC)

    def add(self, keys: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        """Whole documents: their keys, numbers of ids and ids."""
        self.keys += keys
        self.firsts.append(self.n_ids + np.cumsum(lengths) - lengths)
        self.held.append(ids)
        self.waiting += len(ids)
        self.n_ids += len(ids)
        if self.waiting >= BLOCK_IDS:
            self._flush(False)

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        full = len(ids) if whole else len(ids) // BLOCK_IDS * BLOCK_IDS
        for at in range(0, full, BLOCK_IDS):
            data = pack(ids[at : min(at + BLOCK_IDS, full)], self.bits)
            self.sink.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.held, self.waiting = [ids[full:]], len(ids) - full

    def close(self) -> None:
        self._flush(True)
        firsts = np.concatenate([*self.firsts, [self.n_ids]]).astype("<u8")
        for part in (
            np.array(self.offsets, "<u8"),
            firsts,
            np.array([k or 0 for k in self.keys], "<i8"),
            np.array([k is None for k in self.keys], np.uint8),
        ):
            self.sink.write(part.tobytes())
        trailer = (self.bits, BLOCK_IDS, self.n_ids, len(self.offsets) - 1, len(self.keys), self.offsets[-1], MAGIC)
        self.sink.write(np.array([trailer], _TRAILER).tobytes())
        self.sink.close()


class Reader:
    """Random access to the ids of a file."""

    def __init__(self, source, size: int) -> None:
        self.source = source
        t = np.frombuffer(self._read(size - _TRAILER.itemsize, _TRAILER.itemsize), _TRAILER)[0]
        if t["magic"] != MAGIC:
            raise ValueError("not a file of token ids")
        self.bits, self.block_ids, self.n_ids = int(t["bits"]), int(t["block_ids"]), int(t["n_ids"])
        n_blocks, n_docs = int(t["n_blocks"]), int(t["n_docs"])
        footer = self._read(int(t["footer"]), size - _TRAILER.itemsize - int(t["footer"]))
        self.offsets = np.frombuffer(footer, "<u8", n_blocks + 1).astype(np.int64)
        at = 8 * (n_blocks + 1)
        self.firsts = np.frombuffer(footer, "<u8", n_docs + 1, at).astype(np.int64)
        at += 8 * (n_docs + 1)
        keys = np.frombuffer(footer, "<i8", n_docs, at)
        nulls = np.frombuffer(footer, np.uint8, n_docs, at + 8 * n_docs).astype(bool)
        self.keys = pa.array(keys, mask=nulls)

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file; reads only the blocks they lie in."""
        if start >= end:
            return np.zeros(0, np.uint32)
        one, last = start // self.block_ids, (end - 1) // self.block_ids
        data = self._read(self.offsets[one], int(self.offsets[last + 1] - self.offsets[one]))
        found = []
        for block in range(one, last + 1):
            base, lo = self.offsets[block] - self.offsets[one], max(start - block * self.block_ids, 0)
            hi = min(end - block * self.block_ids, self.block_ids)
            piece = data[base : base + self.offsets[block + 1] - self.offsets[block]]
            found.append(unpack(piece, lo, hi - lo, self.bits))
        return np.concatenate(found)


class Encoder:
    """Encodes whole texts, each different piece of them once.

    The tokenizer splits before the white space that follows a word, whatever
    comes around, so a text may be cut there and pieces encoded apart.  Pieces are
    told apart by 64-bit hashes.  A special token in a text has its own id, as with
    the library's defaults, and the piece that holds it is encoded alone.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.vocabulary = self.model.get_vocab_size()
        names = [self.model.id_to_token(i) or "" for i in range(self.vocabulary)]
        #: A byte-level token has one character for each of its bytes.
        self.token_bytes = np.array([len(x) for x in names], np.int64)
        added = {i: t.content.encode() for i, t in self.model.get_added_tokens_decoder().items()}
        for i, content in added.items():
            self.token_bytes[i] = len(content)
        self.special = list(added.values())
        self._forget()

    def _forget(self) -> None:
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.ids = [np.zeros(1, np.int64)], [np.zeros(0, np.uint32)]

    @staticmethod
    def pieces(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Start bytes of the pieces, and whether each may follow another in one string."""
        data, bounds = texts.bytes, texts.bounds
        n = len(data)
        white = WHITE[data]
        # White space beyond ASCII ends in these bytes; no cut is made behind them.
        wide = np.zeros(n, bool)
        wide[1:] = (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        wide[2:] |= (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3) & (data[2:] >= 0x80)
        cut = np.zeros(n, bool)
        cut[1:] = white[1:] & ~white[:-1] & ~wide[:-1]
        heads = bounds[:-1][np.diff(bounds) > 0]
        joined = cut.copy()
        joined[heads] = white[heads]
        cut[heads] = True
        start = np.flatnonzero(cut)
        last = np.append(start[1:], n) - 1
        return start, joined[start] & ~white[last] & ~wide[last] if len(start) else np.zeros(0, bool)

    def _encode_new(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, joinable: np.ndarray) -> None:
        raw = data.tobytes()
        if any(x in raw for x in self.special):
            held = [any(x in raw[a:b] for x in self.special) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            joinable = joinable & ~np.array(held, bool)
        runs, alone = np.flatnonzero(joinable), np.flatnonzero(~joinable)
        groups = [runs[at : at + 256] for at in range(0, len(runs), 256)] + [alone[i : i + 1] for i in range(len(alone))]
        lists = [[raw[start[i] : end[i]] for i in group] for group in groups]
        encoded = self.model.encode_batch_fast([b"".join(x).decode() for x in lists], add_special_tokens=False)
        lengths = np.zeros(len(start), np.int64)
        ordered: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(groups)
        for g, (group, found) in enumerate(zip(groups, encoded, strict=True)):
            ids = np.array(found.ids, np.uint32)
            ends = np.cumsum(self.token_bytes[ids])
            stops = np.searchsorted(ends, np.cumsum([len(x) for x in lists[g]])) + 1
            if len(ids) == 0 or not np.array_equal(ends[stops - 1], np.cumsum([len(x) for x in lists[g]])):
                raise ValueError("a token crosses a cut")
            lengths[group] = np.diff(stops, prepend=0)
            ordered[g] = ids
        order = np.concatenate(groups) if groups else np.zeros(0, np.int64)
        tops = self.first[-1][-1] + np.cumsum(lengths[order])
        base = sum(map(len, self.first)) - 1
        self.first.append(tops)
        self.ids += ordered
        slots = np.empty(len(start), np.int64)
        slots[order] = base + np.arange(len(order))
        self._new_slots = slots

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and all ids in order."""
        if len(self.known) > MEMO_PIECES:
            self._forget()
        start, joinable = self.pieces(texts)
        if not len(start):
            return np.zeros(len(texts), np.int64), np.zeros(0, np.uint32)
        end = np.append(start[1:], len(texts.bytes))
        hashes, where, back = np.unique(RangeHash(texts.bytes).of(start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, hashes)
        there = np.zeros(len(hashes), bool)
        inside = at < len(self.known)
        there[inside] = self.known[at[inside]] == hashes[inside]
        new = where[~there]
        if len(new):
            self._encode_new(texts.bytes, start[new], end[new], joinable[new])
            self.known = np.insert(self.known, at[~there], hashes[~there])
            self.slot = np.insert(self.slot, at[~there], self._new_slots)
            self.first, self.ids = [np.concatenate(self.first)], [np.concatenate(self.ids)]
        slots = self.slot[np.searchsorted(self.known, hashes)][back]
        first, pool = self.first[0], self.ids[0]
        lengths = first[slots + 1] - first[slots]
        before = np.cumsum(lengths) - lengths
        ids = pool[np.repeat(first[slots] - before, lengths) + np.arange(lengths.sum())]
        text = np.searchsorted(texts.bounds, start, "right") - 1
        return np.bincount(text, lengths, len(texts)).astype(np.int64), ids


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def write_ids(
    docs: DataFrame, folder: str, text: str = "text", key: str = "doc_id", tokenizer: str = TOKENIZER, end_id: int = END_ID
) -> DataFrame:
    """Write the ids of all texts in ascending key order; returns the manifest.

    Rows are dealt to files by ranges of the key.  Null keys come first, equal
    keys in the order of their texts; null and empty texts are the end id alone.
    ``tokenizer`` is the name of a vocabulary file that every executor has, or a path.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = writer = None
        for batch in batches:
            model = encoder(tokenizer if "/" in tokenizer else _tokenizer_path(tokenizer))
            for texts in slices(batch.column(1), SLICE_BYTES):
                lengths, ids = model.encode(texts)
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                if writer is None:
                    name = _files.attempt_name(folder, part, ".ids")
                    writer = Writer(_files.create(name), bits_for(model.vocabulary))
                writer.add(batch.column(0)[texts.rows].to_pylist(), lengths + 1, ids)
        if writer is not None:
            writer.close()
            size = writer.offsets[-1] + 8 * len(writer.offsets) + 17 * len(writer.keys) + 8 + _TRAILER.itemsize
            yield pa.RecordBatch.from_pylist([{"part": part, "path": name, "bytes": size, "n_ids": writer.n_ids}], _MANIFEST)

    rows = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))
    dealt = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    with shuffles_dropped(docs.sparkSession):
        dealt.mapInArrow(run, "part long, path string, bytes long, n_ids long").write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


_MANIFEST = pa.schema([("part", pa.int64()), ("path", pa.string()), ("bytes", pa.int64()), ("n_ids", pa.int64())])
READ_IDS = 1 << 20


def read_documents(
    manifest: DataFrame, of_ids: Callable[[np.ndarray], object], schema: str, kind: pa.DataType
) -> DataFrame:
    """One row per document of the files: key, ``start``, ``n_tokens`` and ``value`` of its ids.

    ``start`` counts the ids of all documents before it; its window holds one row per file.
    Files are read by as many tasks as there are files, some blocks at a time.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _files.read(row["path"]) as source:
                    reader = Reader(source, row["bytes"])
                    firsts, at = reader.firsts, 0
                    while at < len(firsts) - 1:
                        to = int(np.searchsorted(firsts, firsts[at] + READ_IDS, "right")) - 1
                        to = min(max(to, at + 1), len(firsts) - 1)
                        ids = reader.ids(int(firsts[at]), int(firsts[to]))
                        cuts = firsts[at : to + 1] - firsts[at]
                        values = [of_ids(ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                reader.keys[at:to],
                                pa.array(firsts[at:to] + row["base"]),
                                pa.array(np.diff(cuts)),
                                pa.array(values, kind),
                            ],
                            ["key", "start", "n_tokens", "value"],
                        )
                        at = to

    files = placed.select("path", "bytes", "base").repartition(max(1, manifest.count()))
    return files.mapInArrow(run, f"key long, start long, n_tokens long, value {schema}")


def _crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def token_digests(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Write the ids of ``docs``, read the files back: key, start, n_tokens, ids_crc32."""
    manifest = write_ids(docs, scratch_path(spark, "token-ids"), **options)
    read = read_documents(manifest, _crc32, "long", pa.int64())
    return read.withColumnsRenamed({"key": options.get("key", "doc_id"), "value": "ids_crc32"})
