"""Grouped prefix join on word shingles.

Two sets of Jaccard similarity t or more share a shingle among the first
n - ceil(t n) + 1 of each, in any common order.  Here rarer shingles come first,
by a table of counts of fixed size over all documents.  Documents with equal sets
are one node; sets with the same size and prefix are one group; groups that share
a prefix shingle are candidates, filtered by size and place, and then expanded to
their sets, which are verified exactly.

Only components are wanted, so each posting list and each group is first joined
with its leader.  Whatever these links do not connect is compared pair by pair, in
lists of different groups and inside each group; of the tokens that two sets share
in open lists, the first one makes the pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift.llm._graph import components
from jobsift.llm._words import RangeHash, Texts, slices, words_of
from jobsift.llm._store import free_name, stored

SHINGLE = 5
WORDED = r"[^\x20\x09-\x0D]"
PERCENT = 80
#: Counters of shingle frequencies: 4 MB, the same for every corpus.
COUNTERS = 1 << 20
#: 64-bit words of a set's parities, and shared tokens that a set carries along to leave out pairs made before.
PARITY_WORDS = 16
EARLY_TOKENS = 8
#: Groups of a list from which its rows carry all parity words and earlier tokens; shorter ones have few pairs.
LONG_LIST = 16
SHORT_PARITIES = 4
#: 64-bit words of the bit table of wanted texts: 2 MB, the same for every corpus.
FILTER_WORDS = 1 << 18
_CHUNK = 1 << 12
_MERGES = 64


def shingle_sets(texts: Texts, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a shorter text is one shingle."""
    words = words_of(texts, lower=True)
    ranges = RangeHash(words.hash)
    grams = ranges.grams(width)
    first = words.first
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < width))
    whole = dict(zip(short.tolist(), ranges.of(first[short], first[short + 1]), strict=True))
    sets = []
    for i, n in enumerate(counts.tolist()):
        if n >= width:
            sets.append(np.unique(grams[first[i] : first[i] + n - width + 1]))
        else:
            sets.append(np.array([whole[i]] if n else [], np.uint64))
    return sets


def parities(items: np.ndarray) -> list[int]:
    """64-bit words: bit b tells whether an odd number of shingles has hash b.

    Two sets differ in at least as many shingles as these words differ in bits.
    """
    size = 64 * PARITY_WORDS
    odd = np.bincount((items >> np.uint64(40)).astype(np.int64) % size, minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(">i8").tolist()


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def shingle_counts(docs: DataFrame, text: str, width: int) -> np.ndarray:
    """Documents per counter, over the whole corpus.

    Every task sends one table of fixed size, cut into chunks that are summed in
    two steps; the result has ``COUNTERS`` numbers.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for texts in slices(batch.column(0)):
                sets = shingle_sets(texts, width)
                at = np.concatenate(sets) & np.uint64(COUNTERS - 1)
                table += np.bincount(at.astype(np.int64), minlength=COUNTERS)
        part = TaskContext.get().partitionId() % _MERGES
        chunks = [table[i : i + _CHUNK].astype("<u8") for i in range(0, COUNTERS, _CHUNK)]
        kept = [(i, c.tobytes()) for i, c in enumerate(chunks) if c.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in kept], pa.int32()), pa.array([part] * len(kept), pa.int32()), pa.array([c for _, c in kept], pa.binary())],
            ["chunk", "part", "counts"],
        )

    def summed(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), "<u8") for x in rows.column("counts"))
        return pa.table({"chunk": rows.column("chunk").slice(0, 1), "part": rows.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "chunk int, part int, counts binary"
    parts = docs.select(docs[text].cast("string").alias("text")).mapInArrow(count, schema)
    parts = parts.groupBy("chunk", "part").applyInArrow(summed, schema)
    table = np.zeros(COUNTERS, np.uint64)
    for row in parts.groupBy("chunk").applyInArrow(summed, schema).collect():
        table[row["chunk"] * _CHUNK : (row["chunk"] + 1) * _CHUNK] = np.frombuffer(row["counts"], "<u8")
    return np.minimum(table, 0xFFFFFFFF).astype(np.uint32)


_SCAN = "key {}, mark long, n int, digest binary, g long, prefix array<long>, bits array<long>"


def _signatures(docs: DataFrame, text: str, key: str, width: int, percent: int) -> DataFrame:
    """Row key, text mark, set size, digest of the set, group, and the prefix in rare-first order.

    The group is a hash of set size and prefix.
    """
    counts = docs.sparkSession.sparkContext.broadcast(shingle_counts(docs, text, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(2)):
                sizes, digests, groups, prefixes, bits = [], [], [], [], []
                for s in shingle_sets(texts, width):
                    rare = counts.value[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
                    prefix = s[np.argsort(rare, kind="stable")[: prefix_size(len(s), percent)]]
                    sizes.append(len(s))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    group = hashlib.blake2b(prefix.tobytes(), digest_size=8, salt=len(s).to_bytes(8, "little"))
                    groups.append(int.from_bytes(group.digest(), "little", signed=True))
                    prefixes.append(prefix)
                    bits.append(parities(s))
                offsets = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
                flat = np.concatenate(prefixes).astype(np.int64) if prefixes else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[texts.rows],
                        batch.column(1)[texts.rows],
                        pa.array(sizes, pa.int32()),
                        pa.array(digests, pa.binary()),
                        pa.array(groups, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                        pa.array(bits, pa.list_(pa.int64())),
                    ],
                    ["key", "mark", "n", "digest", "g", "prefix", "bits"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return _marked(docs, text, key).mapInArrow(run, _SCAN.format(kind))


def _marked(docs: DataFrame, text: str, key: str) -> DataFrame:
    value = docs[text].cast("string")
    return docs.select(docs[key].alias("key"), F.xxhash64(value).alias("mark"), value.alias("text"))


def _sets(docs: DataFrame, text: str, key: str, rows: DataFrame, digests: DataFrame, width: int) -> DataFrame:
    """(digest, items) of the wanted digests, from one reading of the texts that have them.

    ``rows`` has one text mark for each digest.
    """
    marks = stored(rows.join(digests, "digest", "left_semi").select("mark").distinct(), "wanted-marks")
    # A bit table of fixed size keeps most unwanted texts from the exact join, which may move them.
    word, bit = f"shiftrightunsigned(mark, 6) & {FILTER_WORDS - 1}", "shiftleft(1L, CAST(mark & 63 AS INT))"
    wanted = marks.selectExpr(f"{word} AS word", f"{bit} AS bit").groupBy("word").agg(F.bit_or("bit").alias("set"))
    likely = _marked(docs, text, key).join(F.broadcast(wanted), F.expr(f"({word}) = word AND (set & {bit}) <> 0"), "left_semi")
    texts = likely.join(marks, "mark", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                found: dict[bytes, np.ndarray] = {}
                for s in shingle_sets(part, width):
                    if len(s):
                        found.setdefault(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.binary()), pa.array([s.astype(np.int64) for s in found.values()], pa.list_(pa.int64()))],
                    ["digest", "items"],
                )

    return texts.mapInArrow(run, "digest binary, items array<long>").dropDuplicates(["digest"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of digests whose sets are similar enough."""
    left = sets.select(F.col("digest").alias("u"), F.col("items").alias("a"))
    right = sets.select(F.col("digest").alias("v"), F.col("items").alias("b"))
    both = pairs.join(left, "u").join(right, "v")
    shared = F.size(F.array_intersect("a", "b"))
    union = F.size("a") + F.size("b") - shared
    return both.where(shared * 100 >= union * percent).select("u", "v")


def _fits(x: Callable[[str], Column], y: Callable[[str], Column], percent: int, placed: bool = True, differing: bool = True) -> Column:
    """Exact filters: sizes, places of the shared shingle, and bits that differ.

    From the first shared shingle on, what is left of both sets must reach the
    overlap needed; and the sets may differ in no more than the rest.
    """
    n, m = x("n").cast("long"), y("n").cast("long")
    needed = F.ceil((n + m) * percent / F.lit(100.0 + percent) - F.lit(1e-9))
    fits = (F.least(n, m) * 100) >= (F.greatest(n, m) * percent)
    if placed:
        fits &= F.least(n - x("i"), m - y("i")) >= needed
    if not differing:
        return fits
    bits = F.lit(0)
    for k in range(PARITY_WORDS):
        # beyond the words that are there, nothing is known to differ
        word = F.bit_count(F.get(x("bits"), F.lit(k)).bitwiseXOR(F.get(y("bits"), F.lit(k))))
        bits += F.coalesce(word, F.lit(0))
    return fits & (bits <= n + m - 2 * needed)


def similar_groups(
    docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(key, n_shingles, digest, component_id) of every row.

    ``component_id`` is the least key reachable by links.  Equal sets are linked.
    A row without words has no shingles and is a component of its own, with its
    own key.  Null keys take part but never name a component, unless all keys of
    it are null.  Repeated rows are copies like others; other columns are not read.
    """
    return _judged(docs, text, key, width, percent).select(
        F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), "digest", "component_id"
    )


def _judged(docs: DataFrame, text: str, key: str, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(key, mark, n, digest, label, component_id) of every row; the label is the least digest of the component."""
    signed = stored(_signatures(docs, text, key, width, percent), "signatures")
    rows = signed.select("key", "mark", "n", "digest")
    links = stored(_links(docs, text, key, signed, width, percent), "links")
    labels = components(links)
    filled = rows.where("n > 0")
    least = filled.groupBy("digest").agg(F.min("key").alias("least"))
    named = least.join(labels.withColumnRenamed("node", "digest"), "digest", "left").withColumn(
        "label", F.coalesce("label", "digest")
    )
    ids = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "label").select("digest", "label", "component_id")
    columns = ["key", "mark", "n", "digest", "label", "component_id"]
    empty = rows.where("n = 0").withColumn("label", F.lit(None).cast("binary")).withColumn("component_id", F.col("key"))
    return filled.join(named, "digest").select(*columns).unionByName(empty.select(*columns))


def _links(docs: DataFrame, text: str, key: str, signed: DataFrame, width: int, percent: int) -> DataFrame:
    """Verified links of digests that connect all similar sets."""
    filled = signed.where("n > 0")
    members = stored(filled.select("g", "n", "digest", "bits").dropDuplicates(["g", "digest"]), "group-members")
    leaders = members.groupBy("g", "n").agg(F.min(F.struct("digest", "bits")).alias("l")).select("g", "n", "l.*")
    several = members.groupBy("g").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").select("g")
    groups = stored(filled.groupBy("g").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix")), "groups")
    listed = groups.select("g", "n", F.posexplode("prefix").alias("i", "token"))
    # The fewer rarer shingles precede the token, the more sets of its list can be similar to the leader.
    tops = listed.groupBy("token").agg(F.min(F.struct("i", "g")).alias("top"), F.count(F.lit(1)).alias("groups"))
    tops = stored(tops.where("groups > 1").select("token", "top.g", "groups").withColumnRenamed("g", "top"), "list-tops")
    shared = listed.join(tops, "token").select("token", "g", "n", "i", "top", (F.col("groups") >= LONG_LIST).alias("long"))
    shared = stored(shared, "shared-tokens")
    side = lambda name: lambda c: F.col(f"{name}.{c}")
    # Pairs that sizes or places rule out here are left to the comparison of open lists.
    x, y = shared.where("g <> top").alias("x"), shared.where("g = top").select("token", "n", "i").alias("y")
    meets = _fits(side("x"), side("y"), percent, differing=False)
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & meets).select("x.g", "x.top").distinct()
    m, led, paired = members.alias("m"), leaders.alias("l"), pairs.alias("p")
    near = _fits(side("m"), side("l"), percent, placed=False)
    chosen = [F.col("m.digest").alias("u"), F.col("l.digest").alias("v")]
    first = m.join(paired, F.col("m.g") == F.col("p.g")).join(led, F.col("p.top") == F.col("l.g")).where(near)
    inside = m.join(led, F.col("m.g") == F.col("l.g")).where(near & (F.col("m.digest") != F.col("l.digest")))
    tried = stored(first.select(*chosen).union(inside.select(*chosen)).distinct(), "leader-pairs")
    # one text for each set, however many rows have it
    rows = stored(filled.groupBy("digest").agg(F.min("mark").alias("mark")), "set-marks")
    links = stored(_verified(tried, _sets(docs, text, key, rows, _ends(tried), width), percent), "leader-links")

    # What the leaders did not connect: groups and tokens whose sets lie in different components.
    labels = components(links)
    known = members.join(labels.withColumnRenamed("node", "digest"), "digest", "left").withColumn(
        "label", F.coalesce("label", "digest")
    )
    listed = stored(shared.drop("top").join(known.select("g", "label").distinct(), "g"), "labelled-lists")
    largest = listed.groupBy("token", "label").agg(F.count(F.lit(1)).alias("sets")).groupBy("token")
    largest = largest.agg(F.max_by("label", F.struct("sets", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
    open_tokens = stored(largest.where("labels > 1").select("token", "main"), "open-tokens")
    placed = _with_earlier(_with_partner(listed.join(open_tokens, "token"), percent))
    bits = F.when(F.col("long"), F.col("bits")).otherwise(_folded("bits"))
    labelled = stored(placed.join(known, "g").withColumn("bits", bits).drop("long"), "labelled")
    open_lists = labelled.join(open_tokens, "token")
    # The sets of a list's largest component need no comparison with each other: one side holds only the rest.
    a, b = open_lists.where("label <> main").alias("a"), open_lists.alias("b")
    other = a.join(
        b,
        (F.col("a.token") == F.col("b.token"))
        & (F.col("a.g") != F.col("b.g"))
        & ((F.col("b.label") == F.col("b.main")) | (F.col("a.label") < F.col("b.label")))
        & _fits(side("a"), side("b"), percent)
        & ~F.arrays_overlap("a.before", "b.before"),
    )
    # Sets of one group share the whole prefix, so they are compared by group and not by token or place.
    grouped = stored(known.join(several, "g", "left_semi"), "grouped")
    split = grouped.groupBy("g").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    open_groups = grouped.join(split.select("g"), "g", "left_semi")
    c, d = open_groups.alias("c"), open_groups.alias("d")
    within = c.join(
        d,
        (F.col("c.g") == F.col("d.g"))
        & (F.col("c.label") < F.col("d.label"))
        & _fits(side("c"), side("d"), percent, placed=False),
    )
    rest = other.select(F.col("a.digest").alias("u"), F.col("b.digest").alias("v"))
    rest = rest.union(within.select(F.col("c.digest").alias("u"), F.col("d.digest").alias("v"))).distinct()
    untried = tried.union(tried.select("v", "u"))
    rest = stored(rest.join(untried, ["u", "v"], "left_anti"), "open-pairs")
    more = _verified(rest, _sets(docs, text, key, rows, _ends(rest), width), percent)
    return links.union(more)


def _with_partner(lists: DataFrame, percent: int) -> DataFrame:
    """(g, i, token, long) of the groups that sizes and places let meet one of another component in an open list.

    Only semi-joins of narrow rows, so nothing grows with the pairs of a list; rows may come out twice.
    Similar sets pass at the first token they share, so nothing is lost.  Sets that meet in a closed list
    are in one component already.
    """
    x, y = lists.alias("x"), lists.alias("y")
    side = lambda name: lambda c: F.col(f"{name}.{c}")
    meets = (F.col("x.token") == F.col("y.token")) & (F.col("x.label") != F.col("y.label"))
    meets &= _fits(side("x"), side("y"), percent, differing=False)
    apart = F.col("label") != F.col("main")
    met = x.join(y.where(apart), meets, "left_semi").union(x.where(apart).join(y.where(~apart), meets, "left_semi"))
    return met.select("g", "i", "token", "long")


def _with_earlier(placed: DataFrame) -> DataFrame:
    """Add ``before`` to (g, i, token, long) rows: the group's first tokens in long lists that precede this one.

    Sets order their tokens alike, so two sets with a common token in ``before`` have met there, and
    with no worse places.  A token that is not carried along costs a repeated pair and loses none.
    """
    every = placed.groupBy("g").agg(F.sort_array(F.collect_set(F.struct("i", "token", "long"))).alias("all"))
    early = F.slice(F.filter("all", lambda t: t["long"]), 1, EARLY_TOKENS)
    rows = every.select("g", early.alias("early"), F.explode("all").alias("t"))
    before = F.transform(F.filter("early", lambda t: F.col("t.long") & (t["i"] < F.col("t.i"))), lambda t: t["token"])
    return rows.select("g", "t.i", "t.token", "t.long", before.alias("before"))


def _folded(bits: str) -> Column:
    """Parities of fewer, wider classes of shingles: words that fall together are added."""
    words = []
    for k in range(SHORT_PARITIES):
        word = F.get(F.col(bits), F.lit(k))
        for other in range(k + SHORT_PARITIES, PARITY_WORDS, SHORT_PARITIES):
            word = word.bitwiseXOR(F.get(F.col(bits), F.lit(other)))
        words.append(word)
    return F.array(*words)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("digest")).union(pairs.select(F.col("v").alias("digest"))).distinct()


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One row of every component with all its columns: that with the least key and, among equals, the least text hash.

    A null key comes after all others.  Rows whose keys are null or repeated but
    whose texts are not similar are components of their own, and each stays.
    Rows without words all stay; of equal rows with words one does.
    """
    judged = _judged(docs, text, key, **options).where("n > 0")
    first = judged.groupBy("label").agg(F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "mark")).alias("first"))
    named, told = free_name(docs, "first_key"), free_name(docs, "first_mark")
    first = first.select(F.col("first.key").alias(named), F.col("first.mark").alias(told))
    value = docs[text].cast("string")
    worded = F.coalesce(value.rlike(WORDED), F.lit(False))
    same = docs[key].eqNullSafe(first[named]) & (F.xxhash64(value) == first[told])
    found = docs.where(worded).join(first, same).dropDuplicates([named, told])
    return found.select(*[F.col(f"`{c}`") for c in docs.columns]).union(docs.where(~worded))
