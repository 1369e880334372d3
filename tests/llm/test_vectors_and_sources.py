"""Source audit, best products and clusters against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsift.llm import clusters, divergence, maxscore

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, lang string, source string, term string, place int, value long, p string"
VECTORS = "vec_id long, embedding array<float>, row string, id int, block int, place string, vector int, cluster int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    from jobsift.session import ship_package

    ship_package(spark)


def documents():
    rng = random.Random(3)
    words = ["w%s" % "abcdefghij"[i % 10] * (1 + i // 10) for i in range(60)] + ["É", "NAÏVE", "naïve", "日本", "x1y", "don't"]
    rows = []
    for i in range(120):
        lang = ["en", "en", "fr", None, ""][i % 5]
        source = "hot" if i % 3 else ["a", "b", None, "é", ""][i // 3 % 5]
        text = " ".join(rng.choices(words, range(1, len(words) + 1), k=rng.randrange(40)))
        rows.append((i, text if i % 11 else None, lang, source))
    rows += [(500, "rare words only", "de", "a"), (501, "", "de", "b"), (502, None, "xx", None)]
    rows += [(7, "the the the", "en", "a")] * 3 + [(None, "long Word " * 60_000, "en", "b")]
    return [(*r, "t", 1, 2, "p") for r in rows]


def audit_by_force(rows, top):
    counts, seen, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for row in rows:
        text, lang, source = (v or "" for v in row[1:4])
        groups.add((lang, source))
        fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        terms = [t.translate(fold) for t in TERM.findall(text)]
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in seen[lang].items() if n >= 3) for lang, _ in groups}

    def shares(lang, count):
        total = sum(count[t] for t in kept[lang])
        return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept[lang])) for t in kept[lang]}

    own = {g: shares(g[0], counts[g]) for g in groups}
    whole = {lang: shares(lang, sum((counts[g] for g in groups if g[0] == lang), collections.Counter())) for lang in kept}
    price = lambda p, q: (p - q) ** 2 // q
    out = []
    for lang, source in groups:
        p = own[lang, source]
        pairs = [(s, sum(price(p[t], own[lang, s][t]) for t in p)) for g, s in groups if g == lang and s != source]
        terms = [(t, price(p[t], whole[lang][t])) for t in p if counts[lang, source][t] and p[t] > whole[lang][t]]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, t, v, i + 1) for i, (t, v) in enumerate(items) if part == "pair" or i < top]
    return sorted(out)


@pytest.mark.parametrize("cells", [divergence.BLOCK_CELLS, 7])
def test_audit(spark, cells):
    rows = documents()
    found = divergence.audit(spark.createDataFrame(rows, DOCS).repartition(4), block_cells=cells, top=9)
    assert sorted(map(tuple, found.collect())) == audit_by_force(rows, 9)


def test_audit_with_bands_and_joined_groups(spark, monkeypatch):
    """More sources than a band, and a group table too large to broadcast."""
    monkeypatch.setattr(divergence, "BROADCAST_BYTES", 0)
    rows = documents()
    prices = divergence._block_prices
    assert sorted(map(tuple, divergence.audit(spark.createDataFrame(rows, DOCS)).collect())) == audit_by_force(rows, 200)

    import pyarrow as pa

    rng = np.random.default_rng(1)
    counts = np.where(rng.random((11, 40)) < 0.2, rng.integers(1, 9, (11, 40)), 0)
    counts[:, counts.sum(0) == 0] = 1
    absent = rng.integers(1, 50, 11)
    places, columns = np.nonzero(counts)
    table = pa.table(
        {
            "place": np.concatenate([places, np.arange(11)]),
            "term": [f"t{c}" for c in columns] + [None] * 11,
            "p": np.concatenate([counts[places, columns] * 100, absent]),
        }
    )
    monkeypatch.setattr(divergence, "BAND_ROWS", 4)
    got = {}
    for low in range(3):
        for high in range(low, 3):
            own = np.isin(table["place"].to_numpy() // 4, [low, high])
            for r in prices("x", low, high, table.filter(pa.array(own))).to_pylist():
                i, j = r["place"], r["other"]
                got[i, j] = r["value"] + (40 - r["seen"]) * int((absent[i] - absent[j]) ** 2 // absent[j])
    p = np.where(counts > 0, counts * 100, absent[:, None])
    assert got == {(i, j): int(((p[i] - p[j]) ** 2 // p[j]).sum()) for i in range(11) for j in range(11) if i != j}


def test_shares_are_exact_at_size(spark):
    n, total, terms = 12_345_678_901_234, 98_765_432_109_876, 7_654_321
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 1) // (total + terms)


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).collect() == []


def vectors():
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(0, 0.125, 64).astype(np.float32)]) for i in range(400)]
    same = rows[5][1]
    rows += [(1000 + i, same) for i in range(150)] + [(5, same), (50, same), (None, same)]
    rows += [(600, None), (650, [None] + [0.1] * 63), (700, [math.nan] * 64), (750, [math.inf] * 64)]
    rows += [(800, [0.0] * 64), (850, [1.0, 2.0]), (900, []), (950, [0.5] * 100), (951, [3.0e4] * 64)]
    return [(*r, "r", 1, 2, "p", 3, 4) for r in rows]


def usable(row):
    return row[1] is not None and all(x is not None and math.isfinite(x) for x in row[1])


@pytest.mark.parametrize("shard,block", [(maxscore.SHARD_VALUES, maxscore.BLOCK_VALUES), (3000, 700)])
def test_best_products(spark, shard, block):
    rows = vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = maxscore.best_products(df, df["vec_id"] % 50 == 0, shard_values=shard, block_values=block)
    kept = [(r[0], [math.floor(256 * x) for x in r[1]]) for r in rows if usable(r)]
    expected = []
    for i, (query, q) in enumerate(kept):
        if query is not None and query % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(q, d)), key is None, key) for j, (key, d) in enumerate(kept) if i != j]
            scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
            expected += [(query, k + 1, s[2], -s[0]) for k, s in enumerate(scores[:5])]
    order = lambda r: (r[0], r[1], r[3], r[2] or 0)
    assert sorted(map(tuple, found.collect()), key=order) == sorted(expected, key=order)


def test_lists_are_split_and_skipped():
    """The essential lists do not cover all terms, and sparse lists are probed."""
    rng = np.random.default_rng(2)
    values = np.where(rng.random((500, 40)) < 0.1, rng.integers(-50, 200, (500, 40)), 0)
    values[:, 0] = rng.integers(1, 3000, 500)
    postings = maxscore.Postings(np.full(500, 40), values.ravel())
    added = []
    plain = postings.add
    postings.add = lambda scores, place, weight: (added.append(place), plain(scores, place, weight))
    assert any(vectors is not None for vectors, _ in postings.lists)
    for q in values[:30]:
        found, scores = maxscore._best(postings, q, -1, 5)
        exact = values @ q
        order = np.argsort(-exact, kind="stable")[:5]
        assert list(found) == list(order) and list(scores) == list(exact[order])
    assert len(added) < 30 * np.count_nonzero(values[:30], axis=1).mean() * 0.8


def test_products_beyond_64_bits():
    values = np.array([[1 << 40, 1 << 40], [1 << 39, 1], [3, -(1 << 41)]])
    postings = maxscore.Postings(np.full(3, 2), values.ravel())
    found, scores = maxscore._best(postings, values[0], 0, 2)
    assert list(found) == [1, 2] and scores[0] == (1 << 79) + (1 << 40) and scores[1] == 3 * (1 << 40) - (1 << 81)


def test_best_products_of_few(spark):
    nothing = spark.createDataFrame([], VECTORS)
    assert maxscore.best_products(nothing, F.lit(True)).collect() == []
    two = spark.createDataFrame([r for r in vectors() if r[0] in (0, 1)], VECTORS)
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in maxscore.best_products(two, two["vec_id"] == 0).collect()] == [(0, 1, 1)]


def clusters_by_force(rows, k=16, rounds=3):
    kept = [(r[0], [math.floor(64 * x) for x in r[1]]) for r in rows if usable(r) and len(r[1]) == 64]
    name = lambda r: hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centroids = [list(r[1]) for r in sorted(kept, key=lambda r: (name(r), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, v in kept:
            members[near(v)[1]].append(v)
        for c, own in members.items():
            centroids[c] = [sum(column) // len(own) for column in zip(*own)]
    found = [(key, *near(v)) for key, v in kept]
    inertia = collections.Counter()
    for _, distance, c in found:
        inertia[c] += distance
    return [(key, c, d, inertia[c], sum(inertia.values()), tuple(centroids[c])) for key, d, c in found]


def as_rows(found):
    return [(r["id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"])) for r in found]


def test_clusters(spark):
    rows = vectors()
    found = clusters.cluster(spark.createDataFrame(rows, VECTORS).repartition(3))
    assert sorted(as_rows(found.collect()), key=repr) == sorted(clusters_by_force(rows), key=repr)


def test_clusters_of_few(spark):
    assert clusters.cluster(spark.createDataFrame([], VECTORS)).collect() == []
    rows = [r for r in vectors() if r[0] in (5, 951, 850)]
    found = clusters.cluster(spark.createDataFrame(rows, VECTORS))
    assert sorted(as_rows(found.collect()), key=repr) == sorted(clusters_by_force(rows), key=repr)


def test_hilbert_curve_is_continuous():
    """All cells of a small grid: places are distinct, and successors are neighbours."""
    for d, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.indices((1 << bits,) * d).reshape(d, -1).T
        keys = clusters.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        path = cells[np.argsort(np.array(keys, object))].astype(int)
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_boxes_exclude_centroids_but_never_the_nearest():
    rng = np.random.default_rng(4)
    centroids = clusters.Centroids(rng.integers(-60, 60, (12, 3)).tolist())
    fewer = 0
    for _ in range(300):
        vectors = rng.integers(-60, 60, 3) + rng.integers(-6, 7, (20, 3))
        low, high = vectors.min(0), vectors.max(0)
        near = centroids.candidates(low, high)
        distance = ((vectors[:, None] - centroids.matrix) ** 2).sum(2)
        ties = distance == distance.min(1, keepdims=True)
        assert set(np.flatnonzero(ties.any(0))) <= set(near)
        assert (centroids.assign(vectors, low, high)[0] == distance.argmin(1)).all()
        fewer += len(near) < 6
    assert fewer > 200
