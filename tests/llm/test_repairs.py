"""Texts that collide or are very long, and columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from jobsift.llm import chat, decontaminate, fmindex, jaccard, mixing, quality, tokens
from jobsift.llm._words import RangeHash


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    from jobsift.session import ship_package

    ship_package(spark)


def parity_word(flipped):
    """0/1 by the parity of the bits of the place: a polynomial modulo 2^64 cannot tell it from its complement."""
    return "".join("01"[(bin(i).count("1") + flipped) % 2] for i in range(4096))


def test_long_words_do_not_collide(spark, tmp_path):
    import numpy as np

    one, two = parity_word(0), parity_word(1)
    data = np.frombuffer((one + two).encode(), np.uint8)
    a, b = RangeHash(data).of(np.array([0, 4096]), np.array([4096, 8192]))
    assert a != b
    rest = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{one} {rest}"), (2, f"{two} a{rest}"), (3, one), (4, two), (5, f"{one}\n{two}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = {r.doc_id: r.component_id for r in jaccard.similar_groups(docs).collect()}
    assert groups[3] == 3 and groups[4] == 4
    kept = {r.doc_id: r.n_removed for r in fmindex.remove_repeats(docs.where("doc_id in (3, 4)")).collect()}
    assert kept == {3: 0, 4: 0}
    windows = [" ".join([word] + [f"v{i}" for i in range(34)]) for word in (one, two)]
    same = spark.createDataFrame([(1, windows[0]), (2, windows[1])], "doc_id long, text string")
    assert {r.n_removed for r in fmindex.remove_repeats(same).collect()} == {0}
    lines = {r.doc_id: r.n_dup_lines for r in quality.quality(docs).collect()}
    assert lines[5] == 0


def test_tokens_of_long_words(spark):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = {1: parity_word(0), 2: parity_word(1)}
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in tokens.token_digests(spark, docs).collect():
        ids = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_chat_keeps_long_texts_and_broken_records(spark):
    long = F.concat(F.repeat(F.lit("ab<|im_end|>\n"), 1_700_000), F.lit("end"))
    rows = spark.range(1).select(F.lit(1).cast("long").alias("conv_id"), F.lit("assistant").alias("role"), long.alias("text"))
    rows = rows.withColumn("record", F.to_json(F.struct("role", F.substring("text", 1, 64).alias("text"))))
    turns = chat.one_row_per_turn(chat.canonical_turns(rows, beside={"role": "role", "text": "text"}), "conv_id")
    back = chat.parsed_chats(chat.format_chats(turns.withColumn("turn", F.lit(0))))
    got = back.select(F.length(F.get("turns", F.lit(0))["text"]).alias("n"), F.length(F.get("loss_texts", F.lit(0))).alias("loss"))
    assert tuple(got.first()) == (13 * 1_700_000 + 3,) * 2
    with pytest.raises(Exception, match="beside"):
        whole = rows.select("conv_id", F.to_json(F.struct("role", "text")).alias("record"))
        chat.canonical_turns(whole).select("layout").collect()
    broken = spark.createDataFrame([(2, "{no json"), (3, '{"other": 1}'), (4, None)], "conv_id long, record string")
    kept = chat.one_row_per_turn(chat.canonical_turns(broken), "conv_id").collect()
    assert sorted(tuple(r) for r in kept) == [(i, 0, "", "") for i in (2, 3, 4)]


def test_clashing_names(spark):
    names = ["first_key", "first_mark", "found_key", "found_mark", "mix_draw", "mix_finish", "mix_finishes", "__key", "__mark"]
    text = "one two three four five six seven eight nine ten"
    rows = [(i, text if i < 3 else f"{text} {i}" * 3, "s", *range(9)) for i in range(6)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    first = jaccard.one_of_each(docs)
    assert first.columns == docs.columns and sorted(r.doc_id for r in first.collect())[0] == 0
    benchmark = spark.createDataFrame([(1, "Anna has 3 red apples and 5 green pears in her old basket today.")], "item_id long, text string")
    assert decontaminate.clean_documents(docs, benchmark).count() == 6
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == 6


def shared_passage(n, seed=3):
    """A passage of 60 words in every document, with surroundings of its own."""
    import random

    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    around = lambda: " ".join(f"u{rng.randrange(10**9)}" for _ in range(40))
    return [(i, f"{around()} {passage} {around()}") for i in range(n)]


def words_by_force(rows, width):
    import collections

    seen = collections.Counter()
    for _, text in rows:
        words = text.split()
        seen.update(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    removed = {}
    for key, text in rows:
        words = text.split()
        gone = {j for i in range(len(words) - width + 1) if seen[tuple(words[i : i + width])] > 1 for j in range(i, i + width)}
        removed[key] = len(gone)
    return removed


@pytest.mark.parametrize("limit", [2048, 20])
def test_hot_anchors_are_dealt_by_window(spark, monkeypatch, limit):
    """Every document's region around the passage is another; no shard gets them all, and results stay."""
    import pyarrow as pa

    from jobsift.llm import _anchors, suffixes

    monkeypatch.setattr(_anchors, "HOT_REGIONS", limit)
    monkeypatch.setattr(_anchors, "REGION_BYTES", 1 << 14)
    monkeypatch.setattr(_anchors, "GROUP_BYTES", 1 << 16)
    rows = shared_passage(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sizes = []
    plain = _anchors.contexts

    def watched(*args):
        found = plain(*args)
        count = lambda table: pa.table({"shard": table["shard"].slice(0, 1), "n": [len(_anchors.Contexts(table).keys)]})
        sizes.append([r.n for r in found.groupBy("shard").applyInArrow(count, "shard int, n long").collect()])
        return found

    monkeypatch.setattr(_anchors, "contexts", watched)
    got = {r.doc_id: r.n_removed for r in fmindex.remove_repeats(docs).collect()}
    assert got == words_by_force(rows, 35)
    got = {r.doc_id: r.n_removed for r in suffixes.remove_substrings(docs, batches=2).collect()}
    first = rows[0][0]
    assert got[first] == 0 and all(n >= len(" ".join(f"p{i}" for i in range(60))) for k, n in got.items() if k != first)
    if limit < 2048:
        for found in sizes:
            assert max(found) <= 2 * sum(found) / len(found)


def test_hot_anchors_keep_windows_of_one_document(spark, monkeypatch):
    """Windows of an anchor that is cut into windows differ by their own bytes."""
    from jobsift.llm import _anchors, suffixes

    monkeypatch.setattr(_anchors, "HOT_REGIONS", 8)
    passage = "a line of forty bytes in every document "
    raws = {i: f"{i * 7919:030d}{passage}{i * 104729:030d}" for i in range(40)}
    raws[40] = raws[3]
    first = {}
    for i, raw in raws.items():
        for at in range(len(raw) - 49):
            first.setdefault(raw[at : at + 50], i)
    expected = {
        i: len({b for at in range(len(raw) - 49) if first[raw[at : at + 50]] < i for b in range(at, at + 50)})
        for i, raw in raws.items()
    }
    docs = spark.createDataFrame(list(raws.items()), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.n_removed for r in suffixes.remove_substrings(docs, batches=1).collect()}
    assert got == expected
