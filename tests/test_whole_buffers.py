"""Array scans over whole batches against plain Python, and joins for large sides."""

import csv
import io
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobsift import lexicons, limits
from jobsift.functions.keywords import Automaton, weights_contained, words_contained
from jobsift.operators import annotate, clean, summaries, web
from jobsift.plans import views
from jobsift.sources import split_csv, tables

# ------------------------------------------------------------------- keywords


def test_automaton_finds_what_is_contained():
    rng = random.Random(2)
    words = ["a", "ab", "abc", "bca", "é", "日本", "c++", "ui/ux", "cab", "zzz", "abcabcabcabc"]
    texts = ["", "a", "ab", "xyz", "日", "日本語", "é", "c+", "c++"]
    texts += ["".join(rng.choices("abc+é日本ui/x ", k=rng.randrange(30))) for _ in range(400)]
    data = "".join(texts).encode()
    bounds = np.cumsum([0] + [len(t.encode()) for t in texts])
    found = Automaton(words).presence(np.frombuffer(data, np.uint8), bounds)
    assert found.tolist() == [[w in t for w in words] for t in texts]


def test_keywords_of_nulls_repeats_and_slices(spark, monkeypatch):
    values = [None, "", "spark and sql", "SQL", "spar", "spark " * 500]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string").coalesce(1)
    listed = ["sql", "spark", "", "sql"]
    got = [r.w for r in df.select("i", words_contained(F.col("t"), listed).alias("w")).orderBy("i").collect()]
    assert got == [[w for w in listed if w in (v or "")] for v in values]
    groups = [{2: ["sql", "spark"], 1: ["and"]}, {3: ["spark"]}]
    points = [r.p for r in df.select("i", weights_contained(F.col("t"), groups).alias("p")).orderBy("i").collect()]
    assert points == [[0, 0], [0, 0], [5, 3], [0, 0], [0, 0], [2, 3]]


def test_area_keywords_on_documents(spark, sf_dir):
    from jobsift.operators import label

    docs = views.postings(spark, sf_dir)
    rows = docs.select(F.lower("descricao_texto").alias("t"), label.area_points(F.col("descricao_texto")).alias("p")).collect()
    for r in rows:
        assert r.p == [
            sum(weight for weight, words in area.items() for w in words if w in r.t) for area in lexicons.AREA_KEYWORDS.values()
        ]


# ------------------------------------------------------------------ summaries


def test_summaries_equal_the_annotations(spark, sf_dir):
    strange = ["Ⅷ ½ x² ok. 12 3a! $ $5 + - _ a_b", "Éric went. ÉRIC ran! “quoted” Running quickly, NAMED Bob", " . ! ?", "ΟΔΟΣ Σ. Οδός"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, t) for t in [*strange, None, ""]], "doc_id long, text string"))
    words = docs.select(F.explode(F.split("text", " ")).alias("surface")).distinct().filter("length(surface) > 5").limit(200)
    names = words.select("surface", F.get(F.array(*map(F.lit, ["ORG", "LOC", "MISC"])), F.pmod(F.length("surface"), F.lit(3))).alias("label"))
    names = names.unionByName(spark.createDataFrame([("went . ÉRIC", "ORG"), ("Éric went", "ORG"), ("Éric", "GPE")], names.schema)).cache()
    fast = annotate.summarize_text(docs, "text", names)
    slow = annotate.summarize(annotate.annotate(docs, "text", gazetteer=names)).select(*fast.columns)
    assert sorted(map(repr, fast.collect())) == sorted(map(repr, slow.collect()))
    assert fast.filter("spacy_orgs <> ''").count() > 2


def test_trie_equals_all_runs():
    rng = random.Random(8)
    words = [rng.choice("abcd") for _ in range(400)]
    segment = np.sort(np.array([rng.randrange(60) for _ in words]))
    entries = {" ".join(rng.choices("abcd", k=rng.randrange(1, 6))): "X" for _ in range(60)} | {"z": "Y", "a z": "Y"}
    trie = summaries.Trie.of(list(entries.items()))
    coded = pa.array(words).dictionary_encode()
    start, entry = trie.find(coded.dictionary, coded.indices.to_numpy().astype(np.int64), segment)
    expected = [
        (i, " ".join(words[i : i + n]))
        for i in range(len(words))
        for n in range(1, 6)
        if i + n <= len(words) and segment[i + n - 1] == segment[i] and " ".join(words[i : i + n]) in entries
    ]
    assert [(int(s), trie.surfaces[int(e)].as_py()) for s, e in zip(start, entry)] == expected


def test_known_words_are_bounded(monkeypatch):
    monkeypatch.setattr(summaries.Lexicon, "LIMIT", 3)
    lexicon = summaries.Lexicon(annotate.WORD_CLASSES, annotate.SYMBOLS, ["the"])
    first = [lexicon.about(w) for w in "The quick dogs running quickly 12 $".split()]
    assert len(lexicon.known) <= 3
    assert first == [lexicon.about(w) for w in "The quick dogs running quickly 12 $".split()]


def test_runs_begin_behind_first_words_only(spark):
    rows = [(1, "Big Acme Corp and Acme."), (1, "Acme Corp Ltd Corp"), (None, "Corp Acme"), (None, "")]
    docs = annotate.annotate(spark.createDataFrame(rows, "doc_id long, t string"), "t")
    longest = F.create_map(F.lit("Acme"), F.lit(2))
    runs = [r.s for d in docs.select(annotate._word_runs(F.col("tokens"), longest).alias("r")).collect() for r in d.r or [] for s in [r.surface] for r in [type("R", (), {"s": s})]]
    assert sorted(runs) == ["Acme", "Acme", "Acme", "Acme", "Acme .", "Acme Corp", "Acme Corp"]
    entries = spark.createDataFrame([("Acme", "ORG"), ("Acme Corp", "ORG"), ("Corp Acme", "X")], "surface string, label string")
    found = annotate.span_rows(annotate.entities_by_join(docs, entries)).filter("kind = 'ENT'").collect()
    assert len(found) == 4 + 2 + 1


# ------------------------------------------------------------------ split CSV


def write(path, rows, end="\n", bom=False):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([["id", "a b", "text"], *rows])
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + out.getvalue().encode())


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_split_csv_equals_the_reader_of_whole_files(spark, tmp_path, size):
    rng = random.Random(size)
    pieces = ["x", '"', "\n", ",", "é", " ", "word", '""', "\n\n", "日本"]
    rows = [[str(i), "".join(rng.choices(pieces, k=rng.randrange(6))), "".join(rng.choices(pieces, k=rng.randrange(25)))] for i in range(25)]
    rows.append(["long", "", "line one\n" * 60])
    folder = tmp_path / "csv"
    folder.mkdir()
    write(folder / "one.csv", rows[:12])
    write(folder / "two.csv", rows[12:])
    (folder / "empty.csv").write_bytes(b"")
    got = split_csv.read(spark, str(folder), tables.CSV_OPTIONS, size)
    assert got.columns == ["id", "a b", "text"]
    whole = spark.read.options(**tables.CSV_OPTIONS).csv([str(folder / "one.csv"), str(folder / "two.csv")])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect()))
    assert sorted(r.id for r in got.collect()) == sorted(r[0] for r in rows)
    if size < 100:
        splits = split_csv.records(spark, str(folder), size).inputFiles()
        assert len(splits) > 2  # more tasks than files wrote the pieces


def test_split_csv_line_ends_and_headers(spark, tmp_path):
    folder = tmp_path / "dos"
    folder.mkdir()
    write(folder / "a.csv", [["1", "x", "two\r\nlines"], ["2", "", "q"]], "\r\n", bom=True)
    got = {r.id: r.text for r in split_csv.read(spark, str(folder), tables.CSV_OPTIONS, 8).collect()}
    assert set(got) == {"1", "2"} and got["2"] == "q" and got["1"].split() == ["two", "lines"]
    (folder / "b.csv").write_text("other,header\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        split_csv.read(spark, str(folder), tables.CSV_OPTIONS)


def test_split_postings_keep_schema(spark, tmp_path):
    (tmp_path / "p.csv").write_text('titulo,descricao_texto,extra\n"a","b\nc",d\n,"x",\n')
    got = tables.read_postings_csv(spark, str(tmp_path / "p.csv"), split=True, split_bytes=5)
    whole = tables.read_postings_csv(spark, str(tmp_path / "p.csv"))
    assert got.columns == whole.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect()))


# ------------------------------------------------------------------------ joins


def test_heavy_words_are_spread_over_tasks(spark, monkeypatch):
    """A word with a third of all rows: no task holds over twice the median."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        word = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("w"), F.col("id") % 5000))
        facts = spark.range(n).select("id", word.alias("form"))
        table = spark.range(9000).select(F.concat(F.lit("w"), "id").alias("form"), F.col("id").alias("lemma"))
        table = table.unionByName(spark.createDataFrame([("hot", -1)], "form string, lemma long"))
        joined = limits.spread_join(facts, table, "form", F.col("id"), "left")
        assert joined.columns == ["form", "id", "lemma"]
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == n and len(sizes) == 8 and max(sizes) <= 2 * sorted(sizes)[4]
        plain = facts.join(table, "form", "left")
        assert joined.select(*plain.columns).exceptAll(plain).isEmpty()
        assert limits.spread_join(facts, table, "form", F.col("id")).count() == facts.filter("form IS NOT NULL").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lookup_in_nothing(spark):
    facts = spark.createDataFrame([], "form string, id long")
    table = spark.createDataFrame([("a", 1)], "form string, lemma long")
    assert limits.spread_join(facts, table, "form", F.col("id"), "left").collect() == []


def test_lemma_and_stem_by_the_join(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ["mice", "running"]), (None, ["mice"])], "doc_id long, tokens array<string>")
    lemmas = spark.createDataFrame([("mice", "mouses")], "form string, lemma string")
    shipped = clean.map_tokens(docs, "tokens", "out", lemmas, stem=True).collect()
    monkeypatch.setattr(clean, "small_rows", lambda frame: None)
    joined = clean.map_tokens(docs, "tokens", "out", lemmas, stem=True).collect()
    assert sorted(map(repr, shipped)) == sorted(map(repr, joined))


def test_only_wanted_pages_pass_the_filter(spark):
    pages = spark.range(20_000).select(F.col("id").alias("page_id"), F.concat(F.lit("u"), "id").alias("url"))
    urls = spark.createDataFrame([(f"u{i * 7}",) for i in range(1000)] + [("u7",), ("nowhere",)], "url string")
    got = web.wanted_pages(pages, urls)
    assert sorted(r.page_id for r in got.collect()) == [i * 7 for i in range(1000)]
    hopeful = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_filter" in hopeful
    assert web.wanted_pages(pages, urls.limit(0)).count() == 0
