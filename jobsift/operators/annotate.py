"""Linguistic annotations of a text and their per-document summaries.

Annotations stay inside the document row as arrays, so a corpus is annotated
once and every summary is a projection: no explode, no join, no shuffle.  The
long tables are one ``inline`` away (``token_rows``, ``span_rows``).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift import lexicons
from jobsift.functions.arrays import let, most_common, one_row_per_item, slices
from jobsift.functions.text import joined, strip, text_of
from jobsift.limits import row_groups, small_rows
from jobsift.operators.summaries import (
    Lexicon,
    RunTable,
    Trie,
    chunk_lists,
    segments,
    spans,
    summarise,
    token_lists,
    word_counts,
)
from jobsift.session import stored
from jobsift.sources.tables import require_columns

log = logging.getLogger(__name__)

TEXT_COL = "descricao_texto"
TOKENS_TYPE = (
    "array<struct<sent:int,pos:int,text:string,lemma:string,upos:string,"
    "is_space:boolean,is_alpha:boolean,is_stop:boolean>>"
)
SPANS_TYPE = "array<struct<pos:int,kind:string,text:string,label:string>>"

# Words that a task looks at in one go, and those of a group of rows that share a piece of a gazetteer
SLICE_WORDS = 1 << 18
GROUP_WORDS = 1 << 20
CHARS_PER_WORD = 5

# Closed word classes of the rule-based annotator
WORD_CLASSES = {
    "DET": "a an the this that these those each every some any no".split(),
    "ADP": "of in to for with on at from by about into over under between through".split(),
    "CCONJ": "and or but nor".split(),
    "PRON": "i you he she it we they me him her us them who what which".split(),
    "AUX": "am is are was were be been being has have had do does did can will should".split(),
}
SYMBOLS = list("$%+<=>^`|~")

# A batch annotator takes texts and yields, per text, (tokens, spans): lists of
# dicts with the fields of TOKENS_TYPE and SPANS_TYPE.  A factory builds it,
# once per task.
Annotator = Callable[[Sequence[str]], Iterable[tuple[list[dict], list[dict]]]]
AnnotatorFactory = Callable[[], Annotator]


def _word_class(word: Column, lowered: Column, first: Column) -> Column:
    # cheap comparisons guard the regular expressions, as this runs once per word
    single = F.length(word) == 1
    closed = [w for members in WORD_CLASSES.values() for w in members]
    classes = F.lit(None).cast("string")
    for name, members in WORD_CLASSES.items():
        classes = F.when(lowered.isin(members), name).otherwise(classes)
    return (
        F.when(single & word.isin(SYMBOLS), "SYM")
        .when(single & ~word.rlike(r"(?U)\w"), "PUNCT")
        .when((word < ":") & word.rlike("^[0-9]+$"), "NUM")
        .when(lowered.isin(closed), classes)
        .when((word != lowered) & ~first & word.rlike(r"^\p{Lu}"), "PROPN")
        .when(lowered.endswith("ly"), "ADV")
        .when(lowered.endswith("ing") | lowered.endswith("ed"), "VERB")
        .otherwise("NOUN")
    )


def sentence_words(text: Column) -> Column:
    """array<array<string>>: words and punctuation marks of each sentence of a text."""
    marked = F.regexp_replace(text, r"([.!?])\s+", "$1\u0001")
    sentences = F.filter(F.split(marked, "\u0001"), lambda s: s.rlike(r"\S"))
    return F.transform(sentences, lambda s: F.regexp_extract_all(s, F.lit(r"(?U)\w+|[^\w\s]"), F.lit(0)))


def rule_tokens(text: Column, stop_words: Sequence[str] | None = None) -> Column:
    """Words and punctuation marks of a text; sentences end at ``.``, ``!``, ``?``."""
    stops = lexicons.ENGLISH_STOP_WORDS if stop_words is None else list(stop_words)
    marked = F.regexp_replace(text, r"([.!?])\s+", "$1\u0001")
    sentences = F.filter(F.split(marked, "\u0001"), lambda s: s.rlike(r"\S"))
    words = F.flatten(
        F.transform(
            sentences,
            lambda s, n: F.transform(
                F.regexp_extract_all(s, F.lit(r"(?U)\w+|[^\w\s]"), F.lit(0)),
                lambda w, i: F.struct(
                    n.alias("sent"),
                    (i == 0).alias("first"),
                    w.alias("text"),
                    F.lower(w).alias("lemma"),
                ),
            ),
        )
    )
    return F.transform(
        words,
        lambda w, i: F.struct(
            w["sent"].alias("sent"),
            i.alias("pos"),
            w["text"].alias("text"),
            w["lemma"].alias("lemma"),
            _word_class(w["text"], w["lemma"], w["first"]).alias("upos"),
            F.lit(False).alias("is_space"),
            w["text"].rlike(r"^\p{L}+$").alias("is_alpha"),
            w["lemma"].isin(stops).alias("is_stop"),
        ),
    )


def noun_chunks(tokens: Column) -> Column:
    """Longest runs of nouns and proper nouns within a sentence, as NP spans."""

    def over_tokens(t: Column) -> Column:
        last = F.size(t) - 1

        def is_noun(i: Column) -> Column:
            return F.coalesce(F.get(t, i)["upos"].isin("NOUN", "PROPN"), F.lit(False))

        def edge(i: Column, other: Column) -> Column:
            outside = (other < 0) | (other > last)
            return is_noun(i) & (
                outside | ~is_noun(other) | (F.get(t, i)["sent"] != F.get(t, other)["sent"])
            )

        every = F.sequence(F.lit(0), last)
        starts = F.filter(every, lambda i: edge(i, i - 1))
        ends = F.filter(every, lambda i: edge(i, i + 1))
        chunks = F.zip_with(
            starts,
            ends,
            lambda s, e: F.struct(
                s.alias("pos"),
                F.lit("NP").alias("kind"),
                F.array_join(
                    F.transform(F.slice(t, s + 1, e - s + 1), lambda x: x["text"]), " "
                ).alias("text"),
                F.lit("").alias("label"),
            ),
        )
        return F.when(F.size(t) > 0, chunks)

    return F.coalesce(let(tokens, over_tokens), F.array().cast(SPANS_TYPE))


def one_label_per_surface(gazetteer: DataFrame) -> DataFrame:
    return (
        gazetteer.filter(F.col("surface").isNotNull() & F.col("label").isNotNull())
        .groupBy("surface")
        .agg(F.min("label").alias("label"))
    )


def add_gazetteer_spans(
    df: DataFrame, gazetteer: DataFrame, key: str = "doc_id", rules_of: str | None = None
) -> DataFrame:
    """Append ENT spans for every gazetteer surface found in the tokens.

    A gazetteer of bounded size travels with the tasks and nothing shuffles.  Of a
    larger one each group of rows gets the piece that occurs in it.  ``rules_of`` names the
    column whose text the built-in rules made the annotations of: then the rows move with
    that text, and are annotated behind it.
    """
    entries = stored(one_label_per_surface(gazetteer), "gazetteer")
    rows = small_rows(entries)
    if rows is None:
        return _entities_joined(df, entries) if rules_of is None else _entities_of_text(df, rules_of, entries)
    shipped = df.sparkSession.sparkContext.broadcast(Trie.of([(r["surface"], r["label"]) for r in rows]))
    found = _shipped_entities(F.col("tokens"), shipped)
    # the lookup counts array elements, the annotator may number tokens its own way
    placed = F.transform(
        found, lambda s: s.withField("pos", F.get(F.col("tokens"), s["pos"])["pos"])
    )
    return df.withColumn("spans", F.concat("spans", placed))


def _shipped_entities(tokens: Column, shipped) -> Column:
    @F.arrow_udf(SPANS_TYPE)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        trie = shipped.value
        for texts, sents in batches:
            yield _entities(texts, sents, trie)

    # marked so that a filter derived from a later explode does not run it again
    return run.asNondeterministic()(
        F.transform(tokens, lambda t: t["text"]), F.transform(tokens, lambda t: t["sent"])
    )


def _word_runs(tokens: Column, longest: Column) -> Column:
    """array<struct<pos, surface>>: runs of words of one sentence behind the first words of entries.

    ``longest`` maps a first word to the number of words of its longest entry; no run is
    longer, and other words begin none.
    """

    def over_tokens(t: Column) -> Column:
        starts = F.filter(
            F.transform(
                t, lambda w, i: F.struct(i.alias("i"), F.try_element_at(longest, w["text"]).alias("n"))
            ),
            lambda s: s["n"].isNotNull(),
        )
        runs = F.flatten(
            F.transform(
                starts,
                lambda s: F.transform(
                    F.filter(
                        F.sequence(F.lit(1), s["n"]),
                        lambda n: F.get(t, s["i"] + n - 1)["sent"] == F.get(t, s["i"])["sent"],
                    ),
                    lambda n: F.struct(
                        F.get(t, s["i"])["pos"].alias("pos"),
                        F.array_join(
                            F.transform(F.slice(t, s["i"] + 1, n), lambda x: x["text"]), " "
                        ).alias("surface"),
                    ),
                ),
            )
        )
        return F.when(F.size(starts) > 0, runs)

    return let(tokens, over_tokens)


def _run_table(entries: DataFrame) -> np.ndarray:
    """The bits of ``RunTable`` as one array, whose size does not depend on the entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = RunTable()
        for batch in batches:
            places = table.places(batch.column(0))
            words = np.zeros(1 << (RunTable.BITS - 6), np.uint64)
            np.bitwise_or.at(words, places >> np.uint64(6), np.uint64(1) << (places & np.uint64(63)))
            used = np.flatnonzero(words)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used].view(np.int64))], ["word", "bits"])

    parts = entries.select("surface").mapInArrow(run, "word long, bits long")
    found = parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (RunTable.BITS - 6), np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return words


def _pieces(grouped: DataFrame, entries: DataFrame, listed: Callable) -> DataFrame:
    """(_group, surface, label): the entries that occur in the rows of each group.

    ``grouped`` is ``_group`` and the columns that ``listed`` makes a list of words, their
    documents and their sentences of.  A task sends each run of words that may be an entry
    once per batch and group, whatever its occurrences.
    """
    shipped = grouped.sparkSession.sparkContext.broadcast(_run_table(entries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = RunTable(shipped.value)
        for batch in batches:
            for words, document, segment, part in listed(batch):
                start, surfaces = table.runs(words, segment)
                group = part.column(0).to_numpy()[document[start]]
                found = pa.table({"_group": pa.array(group, pa.int64()), "surface": surfaces})
                yield from found.group_by(["_group", "surface"]).aggregate([]).combine_chunks().to_batches()

    runs = grouped.mapInArrow(run, "_group long, surface string")
    return runs.join(entries, "surface").select("_group", "surface", "label")


def _listed_tokens(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Words, documents and sentences of (_group, texts, sents, ...) in slices."""
    for low, high in slices(pc.list_value_length(batch.column(1)).fill_null(0).to_numpy(), SLICE_WORDS):
        part = batch.slice(low, high - low)
        yield part.column(1).flatten(), *segments(part.column(1), part.column(2)), part


def _listed_sentences(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The same of (_group, sentences, ...)."""
    for low, high in slices(word_counts(batch.column(1)), SLICE_WORDS):
        part = batch.slice(low, high - low)
        lists = part.column(1).flatten()
        sentence = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
        document = pc.list_parent_indices(part.column(1)).to_numpy().astype(np.int64)
        yield lists.flatten(), document[sentence], sentence, part


def _trie_of(pieces: pa.Table) -> Trie:
    rows = dict(zip(pieces["surface"].to_pylist(), pieces["label"].to_pylist(), strict=True))
    return Trie.of(sorted(rows.items()))


def _entities(texts: pa.ListArray, sents: pa.ListArray, trie: Trie, numbers: pa.ListArray | None = None) -> pa.ListArray:
    """The entities of each document as spans; ``pos`` counts array elements, or is taken from ``numbers``."""
    document, place, entry = spans(texts, sents, trie)
    if numbers is not None:
        sizes = pc.list_value_length(numbers).to_numpy()
        place = numbers.flatten().to_numpy()[(np.cumsum(sizes) - sizes)[document] + place]
    return _entity_lists(document, place, entry, trie, len(texts))


def _entity_lists(document: np.ndarray, place: np.ndarray, entry: np.ndarray, trie: Trie, n: int) -> pa.ListArray:
    offsets = np.zeros(n + 1, np.int32)
    np.cumsum(np.bincount(document, minlength=n), out=offsets[1:])
    kinds = pa.array(["ENT"] * len(entry), pa.string())
    taken = pa.array(entry)
    items = [pa.array(place, pa.int32()), kinds, trie.surfaces.take(taken), trie.labels.take(taken)]
    flat = pa.StructArray.from_arrays(items, fields=list(_arrow_spans().value_type))
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


def entities_by_join(df: DataFrame, entries: DataFrame) -> DataFrame:
    """Spans by a distributed join, for gazetteers of any size.

    Rows are dealt into groups.  A group sends each run of words that may be an entry
    once, these meet the entries, and the group gets back the piece of the gazetteer that
    occurs in it; its words and that piece meet by the group.  Only words move, and the rows
    once, when they get their spans.  Rows are told apart by an id written with them, so null
    and repeated keys are kept as they are.
    """
    return _entities_joined(df, stored(entries, "gazetteer"))


def _entities_joined(df: DataFrame, entries: DataFrame) -> DataFrame:
    """``entities_by_join`` with entries that are written already."""
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "annotated")
    field = lambda name: F.transform("tokens", lambda t: t[name])
    grouped = row_groups(rows, F.size("tokens"), GROUP_WORDS).filter(F.size("tokens") > 0)
    words = grouped.select("_group", field("text").alias("texts"), field("sent").alias("sents"), field("pos").alias("numbers"), "_row")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        trie, found = _trie_of(right), []
        for batch in left.combine_chunks().to_batches():
            for *_, part in _listed_tokens(batch):
                entities = _entities(*(part.column(i) for i in (1, 2)), trie, part.column(3))
                found.append(pa.table([part.column(4), entities], ["_row", "_entities"]))
        found = pa.concat_tables(found)
        return found.filter(pc.greater(pc.list_value_length(found["_entities"]), 0))

    pieces = _pieces(words.select("_group", "texts", "sents"), entries, _listed_tokens)
    found = words.groupBy("_group").cogroup(pieces.groupBy("_group")).applyInArrow(run, f"_row long, _entities {SPANS_TYPE}")
    return (
        rows.join(found, "_row", "left")
        .withColumn("spans", F.concat("spans", F.coalesce("_entities", F.array().cast(SPANS_TYPE))))
        .drop("_entities", "_row")
    )


def _entities_of_text(df: DataFrame, text_col: str, entries: DataFrame) -> DataFrame:
    """The same for annotations of the built-in rules, which are made again where the rows have moved to."""

    def work(chunks: list[pa.ListArray], trie: Trie) -> list[pa.ListArray]:
        found = []
        for sentences in chunks:
            batch = pa.record_batch([pa.nulls(len(sentences), pa.int64()), sentences], ["_group", "sentences"])
            for words, document, sentence, part in _listed_sentences(batch):
                coded = words.dictionary_encode()
                start, entry = trie.find(coded.dictionary, coded.indices.to_numpy().astype(np.int64), sentence)
                place = start - np.searchsorted(document, document[start])
                found.append(_entity_lists(document[start], place, entry, trie, len(part)))
        return found

    moved = _by_pieces(df.drop("tokens", "spans"), text_col, entries, "_entities", SPANS_TYPE, _arrow_spans(), work)
    found = _rule_annotations(moved, text_col).withColumn("spans", F.concat("spans", "_entities"))
    return found.select(*[F.col(f"`{c}`") for c in df.columns])


def choose_annotator(*factories: AnnotatorFactory) -> AnnotatorFactory | None:
    """The first factory that can be built here; None means the built-in rules."""
    for factory in factories:
        try:
            factory()
        except Exception as error:  # a missing package or model, whatever its type
            log.warning("annotator not available: %s", error)
        else:
            return factory
    return None


def _arrow_spans() -> pa.DataType:
    return pa.list_(
        pa.struct(
            [("pos", pa.int32()), ("kind", pa.string()), ("text", pa.string()),
             ("label", pa.string())]
        )
    )


def _arrow_tokens() -> pa.DataType:
    return pa.list_(
        pa.struct(
            [("sent", pa.int32()), ("pos", pa.int32()), ("text", pa.string()),
             ("lemma", pa.string()), ("upos", pa.string()), ("is_space", pa.bool_()),
             ("is_alpha", pa.bool_()), ("is_stop", pa.bool_())]
        )
    )


def _by_rules(sentences: Column, lists: Callable, kind: str, arrow: pa.DataType, stops: Sequence[str]) -> Column:
    """The lists that the rules make of sentences of words, in slices."""

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon = Lexicon(WORD_CLASSES, SYMBOLS, stops)
        for batch in batches:
            for low, high in slices(word_counts(batch), SLICE_WORDS):
                yield lists(batch.slice(low, high - low), lexicon, list(arrow.value_type))

    return run(sentences)


def _rule_annotations(df: DataFrame, text_col: str, stop_words: Sequence[str] | None = None) -> DataFrame:
    """``tokens`` as ``rule_tokens`` and ``spans`` as ``noun_chunks`` make them, from whole batches of words.

    Each is a step of its own, so one that is not asked for is not made.
    """
    stops = lexicons.ENGLISH_STOP_WORDS if stop_words is None else list(stop_words)
    cut = df.withColumn("_sentences", sentence_words(text_of(text_col)))
    tokens = _by_rules(F.col("_sentences"), token_lists, TOKENS_TYPE, _arrow_tokens(), stops)
    chunks = _by_rules(F.col("_sentences"), chunk_lists, SPANS_TYPE, _arrow_spans(), stops)
    return cut.withColumn("tokens", tokens).withColumn("spans", chunks).drop("_sentences")


def _plugged(text: Column, factory: AnnotatorFactory) -> Column:
    token_type = _arrow_tokens()
    span_type = _arrow_spans()

    @F.arrow_udf(f"struct<tokens:{TOKENS_TYPE},spans:{SPANS_TYPE}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        annotate_texts = factory()
        for texts in batches:
            values = texts.to_pylist()
            tokens, spans = [], []
            for start in range(0, len(values), lexicons.ANNOTATE_BATCH_ROWS):
                part = values[start : start + lexicons.ANNOTATE_BATCH_ROWS]
                for doc_tokens, doc_spans in annotate_texts(part):
                    tokens.append(doc_tokens)
                    spans.append(doc_spans)
            yield pa.StructArray.from_arrays(
                [pa.array(tokens, token_type), pa.array(spans, span_type)], ["tokens", "spans"]
            )

    return run(text)


def annotate(
    df: DataFrame,
    text_col: str = TEXT_COL,
    factory: AnnotatorFactory | None = None,
    gazetteer: DataFrame | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """Append ``tokens`` and ``spans``.

    With a factory its annotator runs on Arrow batches; without one the built-in
    rules do, on the words that the JVM finds.
    """
    require_columns(df, text_col)
    if factory is None:
        annotated = _rule_annotations(df, text_col)
    else:
        annotated = (
            df.withColumn("_annotation", _plugged(text_of(text_col), factory))
            .withColumns({"tokens": F.col("_annotation.tokens"), "spans": F.col("_annotation.spans")})
            .drop("_annotation")
        )
    if gazetteer is None:
        return annotated
    return add_gazetteer_spans(annotated, gazetteer, key, text_col if factory is None else None)


def token_rows(annotated: DataFrame, key: str = "doc_id") -> DataFrame:
    """Long form, one row per token."""
    return one_row_per_item(annotated, F.col("tokens"), "t", key).select(key, "t.*")


def span_rows(annotated: DataFrame, key: str = "doc_id") -> DataFrame:
    """Long form, one row per span."""
    return one_row_per_item(annotated, F.col("spans"), "s", key).select(key, "s.*")


# ------------------------------------------------------------- summaries


def _visible(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~t["is_space"])


def token_count(tokens: Column) -> Column:
    return F.size(_visible(tokens))


def sentence_count(tokens: Column) -> Column:
    return F.size(F.array_distinct(F.transform(tokens, lambda t: t["sent"])))


def top_lemmas(tokens: Column, k: int = lexicons.TOP_LEMMAS) -> Column:
    content = F.filter(
        tokens,
        lambda t: ~t["is_space"] & t["is_alpha"] & ~t["is_stop"] & (F.length(t["lemma"]) > 2),
    )
    return most_common(F.transform(content, lambda t: F.lower(t["lemma"])), k)


def top_pos(tokens: Column, k: int = lexicons.TOP_POS) -> Column:
    return most_common(F.transform(_visible(tokens), lambda t: t["upos"]), k)


def top_noun_chunks(spans: Column, k: int = lexicons.TOP_NOUN_CHUNKS) -> Column:
    chunks = F.transform(
        F.filter(spans, lambda s: s["kind"] == "NP"), lambda s: F.lower(strip(s["text"]))
    )
    return most_common(F.filter(chunks, lambda c: F.length(c).between(2, 50)), k)


def entities(spans: Column, labels: Sequence[str], cap: int) -> Column:
    """Distinct entity texts of the given labels in order of appearance."""
    wanted = F.filter(spans, lambda s: (s["kind"] == "ENT") & s["label"].isin(list(labels)))
    return F.slice(F.array_distinct(F.transform(wanted, lambda s: strip(s["text"]))), 1, cap)


def other_entities(spans: Column, cap: int = lexicons.ADVANCED_ENTITY_CAP) -> Column:
    """``text(LABEL)`` of the entities that are neither organisations nor places."""
    wanted = F.filter(
        spans, lambda s: (s["kind"] == "ENT") & ~s["label"].isin(ORGANISATION + PLACE)
    )
    named = F.transform(
        wanted, lambda s: F.concat(strip(s["text"]), F.lit("("), s["label"], F.lit(")"))
    )
    return F.slice(F.array_distinct(named), 1, cap)


# Entity labels
ORGANISATION = ["ORG"]
PLACE = ["GPE", "LOC"]


def basic_summary(tokens: str = "tokens", spans: str = "spans") -> dict[str, Column]:
    cap = lexicons.BASIC_ENTITY_CAP
    return {
        "spacy_sentences": sentence_count(F.col(tokens)),
        "spacy_tokens": token_count(F.col(tokens)),
        "spacy_top_lemmas": joined(top_lemmas(F.col(tokens))),
        "spacy_orgs": joined(entities(F.col(spans), ORGANISATION, cap)),
        "spacy_places": joined(entities(F.col(spans), PLACE, cap)),
    }


def advanced_summary(tokens: str = "tokens", spans: str = "spans") -> dict[str, Column]:
    cap = lexicons.ADVANCED_ENTITY_CAP
    n_tokens = token_count(F.col(tokens))
    n_sentences = F.greatest(sentence_count(F.col(tokens)), F.lit(1))
    return {
        "adv_tokens": n_tokens,
        "adv_sentences": n_sentences,
        "adv_tokens_per_sentence": F.round(n_tokens / n_sentences, 2),
        "adv_top_pos": joined(top_pos(F.col(tokens))),
        "adv_top_noun_chunks": joined(top_noun_chunks(F.col(spans))),
        "adv_orgs": joined(entities(F.col(spans), ORGANISATION, cap)),
        "adv_places": joined(entities(F.col(spans), PLACE, cap)),
        "adv_other_ents": joined(other_entities(F.col(spans), cap)),
    }


def summarize(annotated: DataFrame, basic: bool = True, advanced: bool = True) -> DataFrame:
    """Replace the annotations by the summary columns of one or both stages."""
    columns: dict[str, Column] = {}
    if basic:
        columns |= basic_summary()
    if advanced:
        columns |= advanced_summary()
    return annotated.withColumns(columns).drop("tokens", "spans")


SUMMARY_TYPE = (
    "spacy_sentences int, spacy_tokens int, spacy_top_lemmas string, spacy_orgs string, spacy_places string, "
    "adv_tokens int, adv_sentences int, adv_tokens_per_sentence double, adv_top_pos string, "
    "adv_top_noun_chunks string, adv_orgs string, adv_places string, adv_other_ents string"
)


_SUMMARY_STRUCT = ", ".join(field.replace(" ", ":") for field in SUMMARY_TYPE.split(", "))
_SUMMARY_NAMES = [field.split(" ")[0] for field in SUMMARY_TYPE.split(", ")]
_SUMMARY_ARROW = pa.struct(
    [(n, {"int": pa.int32(), "double": pa.float64(), "string": pa.string()}[t]) for n, t in (f.split(" ") for f in SUMMARY_TYPE.split(", "))]
)


def _summary_parts(sentences: pa.ListArray, lexicon: Lexicon, trie: Trie | None) -> list[pa.StructArray]:
    """The summaries of a batch, made in slices."""
    found = []
    for low, high in slices(word_counts(sentences), SLICE_WORDS):
        columns = summarise(sentences.slice(low, high - low), lexicon, trie)
        found.append(pa.StructArray.from_arrays([columns[n] for n in _SUMMARY_NAMES], _SUMMARY_NAMES))
    return found


def _by_pieces(
    df: DataFrame, text_col: str, entries: DataFrame, name: str, kind: str, arrow: pa.DataType, work: Callable
) -> DataFrame:
    """The rows with column ``name``, which ``work`` makes of their sentences and the names that occur in their group.

    The rows move once, as they are, and are cut into words behind that.
    """
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "texts")
    text = text_of(text_col)
    grouped = row_groups(rows, F.length(text) / F.lit(CHARS_PER_WORD), GROUP_WORDS)
    sentences = sentence_words(text).alias("_sentences")
    given = df.columns
    schema = T.StructType([*df.schema, *T.StructType.fromDDL(f"`{name}` {kind}")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = work(left["_sentences"].chunks, _trie_of(right))
        return left.select(given).append_column(name, pa.chunked_array(parts, arrow))

    pieces = _pieces(grouped.select("_group", sentences), entries, _listed_sentences)
    cut = grouped.drop("_row").repartition("_group").select("*", sentences)
    return cut.groupBy("_group").cogroup(pieces.groupBy("_group")).applyInArrow(run, schema)


def _summaries_by_join(
    df: DataFrame, text_col: str, entries: DataFrame, stop_words: Sequence[str] | None
) -> DataFrame:
    """The summary columns with a gazetteer of any size, as in ``entities_by_join``."""
    stops = lexicons.ENGLISH_STOP_WORDS if stop_words is None else list(stop_words)

    def work(chunks: list[pa.ListArray], trie: Trie) -> list[pa.StructArray]:
        lexicon = Lexicon(WORD_CLASSES, SYMBOLS, stops)
        return [part for chunk in chunks for part in _summary_parts(chunk, lexicon, trie)]

    return _with_summary(_by_pieces(df, text_col, entries, "_summary", f"struct<{_SUMMARY_STRUCT}>", _SUMMARY_ARROW, work))


def _with_summary(df: DataFrame) -> DataFrame:
    """The fields of ``_summary`` as columns."""
    columns = {n: F.col(f"_summary.{n}") for n in _SUMMARY_NAMES}
    columns["adv_tokens_per_sentence"] = F.round("_summary.adv_tokens_per_sentence", 2)
    return df.withColumns(columns).drop("_summary")


def summarize_text(
    df: DataFrame,
    text_col: str = TEXT_COL,
    gazetteer: DataFrame | None = None,
    stop_words: Sequence[str] | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """Append the summary columns of the built-in rules without keeping the annotations.

    Only the words of the sentences leave the JVM, and only the summaries come back.  Of a
    gazetteer too large to travel with the tasks each group of rows gets the piece that occurs
    in it, with equal results.
    """
    require_columns(df, text_col)
    trie = None
    if gazetteer is not None:
        entries = stored(one_label_per_surface(gazetteer), "gazetteer")
        rows = small_rows(entries)
        if rows is None:
            return _summaries_by_join(df, text_col, entries, stop_words)
        trie = Trie.of([(r["surface"], r["label"]) for r in rows])
    shipped = df.sparkSession.sparkContext.broadcast(trie)
    stops = lexicons.ENGLISH_STOP_WORDS if stop_words is None else list(stop_words)

    @F.arrow_udf(SUMMARY_TYPE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon, found = Lexicon(WORD_CLASSES, SYMBOLS, stops), shipped.value
        for sentences in batches:
            yield pa.concat_arrays(_summary_parts(sentences, lexicon, found) or [pa.array([], _SUMMARY_ARROW)])

    return _with_summary(df.withColumn("_summary", run(sentence_words(text_of(text_col)))))
