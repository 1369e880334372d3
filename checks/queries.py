"""One query per operator, each over whole tables.

Integers are widened so that both engines agree on types; doubles are rounded to
six places, the precision at which two engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift import lexicons
from jobsift.functions.arrays import let, one_row_per_item
from jobsift.functions.html import link_targets, text_from_html
from jobsift.functions.text import (
    content_tokens,
    joined,
    normalized,
    strip,
    text_of,
    word_tokens,
)
from jobsift.operators import (
    annotate,
    clean,
    extract,
    label,
    metrics,
    model,
    report,
    tfidf,
    web,
)
from jobsift.plans import chain, views
from jobsift.session import scratch_path, ship_package, stored
from jobsift.sources import sinks, tables

Query = Callable[[SparkSession, str], DataFrame]

TEXT = "descricao_texto"
DOMAIN = "https://jobs.example.com"
PREFIX = "/"
RUN_DATE = "2024-01-31"
SOURCE = "Stored pages"
LISTING_PAGES = 1_000_000
MAX_JOBS = 500
SPLITS_PER_FILE = 4
FEATURES = lexicons.CORPUS_MAX_FEATURES

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return comparable(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return run


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("long")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def documents(spark, sf_dir):
    return views.load(spark, sf_dir, "documents")


def pages(spark, sf_dir):
    return views.load(spark, sf_dir, "pages")


# ------------------------------------------------------- scans and sinks


@query
def s1_s3_csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    postings = views.postings(spark, sf_dir)
    sinks.write_csv(postings, path)
    return tables.read_postings_csv(spark, path, postings.schema)


@query
def s1_reference_layout(spark, sf_dir):
    """A file without key, in another order and with a column more, bound by name."""
    path = scratch_path(spark, "layout")
    nothing = [F.lit(None).cast("string").alias(c) for c in tables.POSTING_COLUMNS if c not in ("titulo", TEXT, "link")]
    link = F.concat(F.lit("https://jobs.example/"), "doc_id")
    extra = F.col("doc_id").cast("string").alias("extra")
    sinks.write_csv(views.postings(spark, sf_dir).select(TEXT, *nothing, link.alias("link"), extra, "titulo"), path)
    read = tables.read_postings_csv(spark, path)
    same_key = F.count(F.lit(1)).over(Window.partitionBy("doc_id"))
    return read.select("link", "titulo", TEXT, "empresa", "extra", same_key.alias("rows_of_key"))


@query
def s1_split_csv(spark, sf_dir):
    """Files with line breaks inside fields, each read by several tasks."""
    path = scratch_path(spark, "split")
    postings = views.postings(spark, sf_dir)
    # one task writes a file, so a file takes in a fixed number of input splits
    files = -(-postings.rdd.getNumPartitions() // SPLITS_PER_FILE)
    sinks.write_csv(postings.coalesce(max(files, 1)), path)
    return tables.read_postings_csv(spark, path, postings.schema, split=True, split_bytes=256 << 10)


@query
def s4_raw_postings_sink(spark, sf_dir):
    path = scratch_path(spark, "raw")
    postings = web.assemble_postings(views.job_pages(spark, sf_dir), RUN_DATE, SOURCE)
    sinks.write_raw_postings(postings, path)
    return tables.read_postings_csv(spark, path)


@query
def s5_tfidf_sink(spark, sf_dir):
    matrix, vocab = tfidf.build_tfidf(documents(spark, sf_dir), "text", FEATURES)
    path = scratch_path(spark, "tfidf")
    sinks.write_tfidf(matrix, vocab, path)
    return spark.read.parquet(f"{path}/tfidf_features")


@query
def s6_vocabulary_sink(spark, sf_dir):
    path = scratch_path(spark, "vocabulary")
    vocab = tfidf.vocabulary(documents(spark, sf_dir), "text", FEATURES)
    sinks.write_vocabulary_json(vocab, path)
    return spark.read.schema("term_id long, term string, idf double").json(path)


@query
def s7_confusion_sink(spark, sf_dir):
    path = scratch_path(spark, "confusion")
    matrix = metrics.confusion_matrix(predictions(spark, sf_dir))
    sinks.write_confusion(matrix, metrics.label_order(spark), path)
    return spark.read.parquet(f"{path}/confusion_matrix")


@query
def s8_label_order(spark, sf_dir):
    """Order of the labels that occur, written as text and read back."""
    path = scratch_path(spark, "labels")
    occurring = labeled(spark, sf_dir).select(F.col("label_area").alias("label")).distinct()
    order = metrics.label_order(spark).join(occurring, "label", "left_semi")
    matrix = metrics.confusion_matrix(predictions(spark, sf_dir))
    sinks.write_confusion(matrix, order, path)
    return tables.read_label_order(spark, f"{path}/labels_order")


@query
def s9_page_scan(spark, sf_dir):
    scanned = tables.read_pages(spark, f"{sf_dir}/pages.parquet")
    return scanned.select("page_id", "url", F.length("html").alias("html_chars"))


@query
def s10_first_rows(spark, sf_dir):
    return tables.first_rows(views.postings(spark, sf_dir).select("doc_id", "titulo"), 100)


# ---------------------------------------------------------------- web pages


@query
def w1_absolute_urls(spark, sf_dir):
    targets = pages(spark, sf_dir).select("page_id", link_targets(F.col("html")).alias("hrefs"))
    links = one_row_per_item(targets, F.col("hrefs"), "href", "page_id", pos="pos")
    return links.withColumn("url", web.absolute_url(F.col("href"), DOMAIN))


def linked_listing(spark, sf_dir):
    return web.listing_links(views.listing(spark, sf_dir), DOMAIN, PREFIX)


@query
def w2_listing_links(spark, sf_dir):
    linked = linked_listing(spark, sf_dir)
    return one_row_per_item(linked, F.col("links"), "url", "page_id", pos="pos")


@query
def w3_pages_read(spark, sf_dir):
    sizes = linked_listing(spark, sf_dir).select("cat_order", "page", F.size("links").alias("n_links"))
    return web.pages_read(sizes, MAX_JOBS, LISTING_PAGES, min_links=5)


@query
def w4_first_seen_urls(spark, sf_dir):
    linked = linked_listing(spark, sf_dir)
    links = one_row_per_item(linked, F.col("links"), "url", "cat_order", "page", pos="pos")
    return web.first_seen_urls(links, MAX_JOBS)


@query
def w2_w4_frontier(spark, sf_dir):
    return web.frontier(views.listing(spark, sf_dir), MAX_JOBS, LISTING_PAGES, DOMAIN, PREFIX)


@query
def w5_job_posting(spark, sf_dir):
    found = views.job_pages(spark, sf_dir).select("page_id", web.job_posting(F.col("html")).alias("job"))
    return found.filter("job is not null").select("page_id", "job.*").drop("@type")


@query
def w6_job_fields(spark, sf_dir):
    fields = web.job_fields(views.job_pages(spark, sf_dir)).filter("has_job")
    return fields.select("page_id", "titulo", "empresa", "tipo_emprego", "data_publicacao", TEXT)


@query
def w7_locations(spark, sf_dir):
    return web.job_fields(views.job_pages(spark, sf_dir)).select("page_id", "localizacao")


@query
def w8_visible_text(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", text_from_html(F.col("html")).alias("text"))


@query
def w9_fallback(spark, sf_dir):
    fields = web.job_fields(views.job_pages(spark, sf_dir)).filter("not has_job")
    return fields.select("page_id", "titulo", "empresa", TEXT)


@query
def w10_postings(spark, sf_dir):
    return web.assemble_postings(views.job_pages(spark, sf_dir), RUN_DATE, SOURCE)


@query
def w_collect_postings(spark, sf_dir):
    """From listing pages to postings, with failed listing and detail pages."""
    listing, details = views.collected_listing(spark, sf_dir), views.collected_pages(spark, sf_dir)
    return web.collect_postings(listing, details, RUN_DATE, MAX_JOBS, LISTING_PAGES, DOMAIN, "/remote-jobs/", SOURCE)


@query
def w11_source_list(spark, sf_dir):
    """Stored listing pages of each default source."""
    listed = views.listing(spark, sf_dir).groupBy("cat_order").agg(F.count(F.lit(1)).alias("n"))
    return (
        web.categories(spark)
        .join(listed, "cat_order", "left")
        .select("cat_order", "base_url", F.coalesce("n", F.lit(0)).alias("n_pages"))
    )


# ------------------------------------------------------------ regex features


def _feature(name):
    def run(spark, sf_dir):
        return views.postings(spark, sf_dir).select(
            "doc_id", joined(extract.feature_arrays(text_of(TEXT))[name]).alias(name)
        )

    return run


for _key, _name in {
    "r1_seniority": "senioridade_re",
    "r2_regime": "regime_re",
    "r3_salary": "salario_re",
    "r4_workload": "carga_horaria_re",
    "r5_r9_urls": "urls_re",
    "r6_r9_emails": "emails_re",
    "r11_skills": "skills_re",
}.items():
    _run = _feature(_name)
    _run.__name__ = _key
    query(_run)


@query
def r7_all_matches(spark, sf_dir):
    """Matches as found, trimmed, before repeats are removed."""
    found = F.regexp_extract_all(
        text_of(TEXT), F.lit(f"(?iU){lexicons.REGIME_PATTERN}"), F.lit(0)
    )
    matches = one_row_per_item(views.postings(spark, sf_dir), found, "value", "doc_id", pos="pos")
    return matches.withColumn("value", strip(F.col("value")))


@query
def r8_distinct_ignore_case(spark, sf_dir):
    """First spelling of every regime term, in order, one row each."""
    regime = extract.regime(text_of(TEXT))
    return one_row_per_item(views.postings(spark, sf_dir), regime, "value", "doc_id", pos="pos")


@query
def r10_joined_seniority_and_regime(spark, sf_dir):
    text = text_of(TEXT)
    return views.postings(spark, sf_dir).select(
        "doc_id", joined(F.concat(extract.seniority(text), extract.regime(text))).alias("terms")
    )


FEATURE_COLUMNS = [
    "senioridade_re", "regime_re", "salario_re", "carga_horaria_re", "urls_re",
    "emails_re", "skills_re",
]


@query
def r12_all_features(spark, sf_dir):
    return extract.extract_features(views.postings(spark, sf_dir)).select("doc_id", *FEATURE_COLUMNS)


# ------------------------------------------------------------------ clean text


@query
def t1_t3_normalized(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", normalized(text_of("text")).alias("text"))


def _token_query(column):
    def run(spark, sf_dir):
        return documents(spark, sf_dir).select("doc_id", F.array_join(column(), " ").alias("tokens"))

    return run


def _words():
    return word_tokens(normalized(text_of("text")))


for _key, _column in {
    "t4_word_tokens": _words,
    "t5_long_tokens": lambda: content_tokens(_words(), []),
    "t6_content_tokens": lambda: content_tokens(_words()),
}.items():
    _run = _token_query(_column)
    _run.__name__ = _key
    query(_run)


def tokenized(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", clean.tokens_of("text").alias("tokens"))


def plural_dictionary(tokens):
    """A noun dictionary taken from the corpus: words whose singular also occurs."""
    words = stored(one_row_per_item(tokens, F.col("tokens"), "word").distinct(), "words")
    plural = words.filter(F.col("word").endswith("s") & (F.length("word") > 3)).select(
        F.col("word").alias("form"), F.expr("substring(word, 1, length(word) - 1)").alias("lemma")
    )
    return plural.join(words.withColumnRenamed("word", "lemma"), "lemma", "left_semi").select(
        "form", "lemma"
    )


@query
def t7_lemmas(spark, sf_dir):
    tokens = tokenized(spark, sf_dir)
    lemmas = clean.map_tokens(tokens, "tokens", "lemmas", plural_dictionary(tokens))
    return lemmas.select("doc_id", F.array_join("lemmas", " ").alias("lemmas"))


@query
def t8_stems(spark, sf_dir):
    stems = clean.map_tokens(tokenized(spark, sf_dir), "tokens", "stems", stem=True)
    return stems.select("doc_id", F.array_join("stems", " ").alias("stems"))


@query
def t9_rejoined_lemmas(spark, sf_dir):
    """Dictionary forms by the distributed join, joined again in word order."""
    tokens = tokenized(spark, sf_dir)
    dictionary = clean.one_lemma_per_form(plural_dictionary(tokens))
    lemmas = clean.lemmatize_by_join(tokens, "tokens", "lemmas", dictionary)
    return lemmas.select("doc_id", F.array_join("lemmas", " ").alias("text_clean"))


@query
def t9_clean_text(spark, sf_dir):
    return clean.clean_text(documents(spark, sf_dir), "text").select("doc_id", "text_clean")


# ---------------------------------------------------------------------- TF-IDF


@query
def f1_terms(spark, sf_dir):
    terms = tfidf.terms_of(text_of("text"))
    return documents(spark, sf_dir).select("doc_id", terms.alias("terms")).select(
        "doc_id",
        F.size("terms").alias("n_terms"),
        F.md5(F.array_join("terms", "|")).alias("terms_md5"),
    )


@query
def f2_term_counts(spark, sf_dir):
    return tfidf.term_counts(documents(spark, sf_dir), "text")


@query
def f2_term_frequencies(spark, sf_dir):
    return tfidf.term_frequencies(documents(spark, sf_dir), "text")


@query
def f3_f4_f6_vocabulary(spark, sf_dir):
    return tfidf.vocabulary(documents(spark, sf_dir), "text", FEATURES)


@query
def f5_tfidf(spark, sf_dir):
    return tfidf.build_tfidf(documents(spark, sf_dir), "text", FEATURES)[0]


@query
def f7_transform(spark, sf_dir):
    """Vocabulary of the English documents applied to all others."""
    docs = documents(spark, sf_dir)
    vocab = tfidf.vocabulary(docs.filter("lang = 'en'"), "text", FEATURES)
    return tfidf.tfidf(docs.filter("lang <> 'en'"), vocab, FEATURES, "text")


@query
def f8_matrix(spark, sf_dir):
    n = lexicons.CORPUS_MAX_FEATURES
    return tfidf.build_tfidf(documents(spark, sf_dir), "text", n)[0]


# ----------------------------------------------------------------- annotations


def gazetteer(docs, text):
    """Names taken from the corpus: long capitalised words, pairs of capitalised words."""

    def names(words):
        marked = F.transform(words, lambda w: F.when(w.rlike(r"^\p{Lu}\p{L}*$"), w))

        def found(m):
            following = F.slice(m, 2, F.greatest(F.size(m), F.lit(1)))
            pairs = F.zip_with(m, following, lambda a, b: F.concat(a, F.lit(" "), b))
            singles = F.filter(m, lambda w: F.length(w) >= 6)
            return F.concat(singles, F.filter(pairs, lambda x: x.isNotNull()))

        return let(marked, found)

    listed = F.flatten(F.transform(annotate.sentence_words(text_of(text)), names))
    surfaces = one_row_per_item(docs, listed, "surface").distinct()
    kind = F.element_at(
        F.array(*[F.lit(x) for x in ["ORG", "GPE", "LOC", "PRODUCT"]]),
        (F.length("surface") % 4 + 1).cast("int"),
    )
    return surfaces.select("surface", kind.alias("label"))


def annotated(spark, sf_dir, entities=False):
    docs = annotate.annotate(documents(spark, sf_dir).select("doc_id", "text"), "text")
    if entities:
        docs = annotate.add_gazetteer_spans(docs, gazetteer(documents(spark, sf_dir), "text"), rules_of="text")
    return docs.select("doc_id", "tokens", "spans")


@query
def n1_annotations(spark, sf_dir):
    return annotate.token_rows(annotated(spark, sf_dir))


def _summary(key, columns, entities=False):
    def run(spark, sf_dir):
        return annotated(spark, sf_dir, entities).select("doc_id", *columns())

    run.__name__ = key
    query(run)


def _from(summary, *names):
    return lambda: [summary()[n].alias(n) for n in names]


_summary("n3_token_count", _from(annotate.basic_summary, "spacy_tokens"))
_summary("n4_sentence_count", lambda: [
    annotate.basic_summary()["spacy_sentences"].alias("spacy_sentences"),
    annotate.advanced_summary()["adv_sentences"].alias("adv_sentences"),
])
_summary("n5_tokens_per_sentence", _from(annotate.advanced_summary, "adv_tokens_per_sentence"))
_summary("n6_top_lemmas", _from(annotate.basic_summary, "spacy_top_lemmas"))
_summary("n7_organisations", lambda: [
    annotate.basic_summary()["spacy_orgs"].alias("spacy_orgs"),
    annotate.advanced_summary()["adv_orgs"].alias("adv_orgs"),
], entities=True)
_summary("n8_places", lambda: [
    annotate.basic_summary()["spacy_places"].alias("spacy_places"),
    annotate.advanced_summary()["adv_places"].alias("adv_places"),
], entities=True)
_summary("n9_other_entities", _from(annotate.advanced_summary, "adv_other_ents"), entities=True)
_summary("n10_top_pos", _from(annotate.advanced_summary, "adv_top_pos"))
_summary("n11_top_noun_chunks", _from(annotate.advanced_summary, "adv_top_noun_chunks"))


@query
def n12_gazetteer_spans(spark, sf_dir):
    return annotate.span_rows(annotated(spark, sf_dir, True)).filter("kind = 'ENT'").drop("kind")


@query
def n12_spans_joined(spark, sf_dir):
    """The same spans by the distributed join."""
    entries = annotate.one_label_per_surface(gazetteer(documents(spark, sf_dir), "text"))
    found = annotate.entities_by_join(annotated(spark, sf_dir), entries)
    return annotate.span_rows(found).filter("kind = 'ENT'").drop("kind")


SUMMARY_COLUMNS = [
    "spacy_sentences", "spacy_tokens", "spacy_top_lemmas", "spacy_orgs", "spacy_places",
    "adv_tokens", "adv_sentences", "adv_tokens_per_sentence", "adv_top_pos",
    "adv_top_noun_chunks", "adv_orgs", "adv_places", "adv_other_ents",
]


@query
def n13_summaries(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return annotate.summarize_text(docs, "text", gazetteer(docs, "text")).select("doc_id", *SUMMARY_COLUMNS)


# ------------------------------------------------------- labels, model, metrics


def scores(boost):
    return label.area_scores(text_of(TEXT), text_of("titulo"), boost=boost)


def _score_rows(spark, sf_dir, boost):
    rows = one_row_per_item(views.postings(spark, sf_dir), scores(boost), "s", "doc_id")
    return rows.select("doc_id", "s.label", "s.score")


@query
def l1_keyword_scores(spark, sf_dir):
    return _score_rows(spark, sf_dir, 0)


@query
def l2_boosted_scores(spark, sf_dir):
    return _score_rows(spark, sf_dir, lexicons.TITLE_BOOST)


@query
def l3_best_area(spark, sf_dir):
    best = views.postings(spark, sf_dir).select("doc_id", F.array_max(scores(lexicons.TITLE_BOOST)).alias("b"))
    return best.select("doc_id", F.col("b.label").alias("label"), F.col("b.score").alias("score"))


def labeled(spark, sf_dir):
    return label.label_areas(views.postings(spark, sf_dir))


@query
def l4_l6_l7_labels(spark, sf_dir):
    return labeled(spark, sf_dir).select("doc_id", "label_area")


@query
def l5_labels_of_clean_text(spark, sf_dir):
    """Labels from cleaned text, here the content words before stemming."""
    words = views.postings(spark, sf_dir).withColumn(
        "text_clean", F.array_join(clean.tokens_of(TEXT), " ")
    )
    return label.label_areas(words).select("doc_id", "label_area")


@query
def l5_labels_of_stemmed_text(spark, sf_dir):
    """Labels from ``text_clean`` as the chain makes it."""
    cleaned = clean.clean_text(views.postings(spark, sf_dir), TEXT)
    return label.label_areas(cleaned).select("doc_id", "label_area")


def split(spark, sf_dir):
    rows = labeled(spark, sf_dir).select("doc_id", TEXT, "label_area")
    return model.stratified_split(stored(rows, "labeled"))


@query
def m1_split(spark, sf_dir):
    return split(spark, sf_dir).select("doc_id", "label_area", "is_test")


@query
def m2_test_tfidf(spark, sf_dir):
    """Vocabulary of the train rows, matrix of the test rows."""
    rows = stored(split(spark, sf_dir), "split")
    vocab = tfidf.vocabulary(rows.filter("not is_test"), TEXT, lexicons.MODEL_MAX_FEATURES)
    return tfidf.tfidf(rows.filter("is_test"), vocab, lexicons.MODEL_MAX_FEATURES, TEXT)


@query
def m3_m4_predictions(spark, sf_dir):
    _, predicted = model.evaluate(stored(labeled(spark, sf_dir), "labeled"), TEXT)
    return predicted


@query
def m3_m4_certificate(spark, sf_dir):
    """Per label: rows, predictions other than the largest margin, and whether the fit is proven."""
    rows = stored(split(spark, sf_dir), "split")
    train, test = rows.filter("not is_test"), rows.filter("is_test")
    fitted = model.train_classifier(train, TEXT)
    best = fitted.predict(test).join(model.margins(test, fitted), "doc_id")
    unequal = best.groupBy(F.col("label_area").alias("label")).agg(F.count_if(F.col("pred") != F.col("best")).alias("n_unequal"))
    proven = model.certificate(train, fitted).select("label", (F.col("gradient") <= model.GRADIENT_BOUND).alias("proven"))
    sizes = rows.groupBy(F.col("label_area").alias("label")).agg(
        F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test")
    )
    return (
        sizes.join(proven, "label", "left")
        .join(unequal, "label", "left")
        .select("label", "n_train", "n_test", F.coalesce("n_unequal", F.lit(0)).alias("n_unequal"), "proven")
    )


def predictions(spark, sf_dir):
    """Full labels against labels from keywords alone."""
    text, title, points = text_of(TEXT), text_of("titulo"), F.col("points")
    return views.postings(spark, sf_dir).withColumn("points", label.area_points(text)).select(
        "doc_id",
        label.best_area(label.area_scores(text, title, points=points)).alias("y"),
        label.best_area(label.area_scores(text, title, boost=0, points=points)).alias("pred"),
    )


@query
def m5_accuracy(spark, sf_dir):
    return metrics.accuracy(predictions(spark, sf_dir))


@query
def m6_class_report(spark, sf_dir):
    return metrics.class_report(predictions(spark, sf_dir))


@query
def m6_class_report_of_labels(spark, sf_dir):
    """The two flags of the label table as truth and prediction."""
    flags = views.load(spark, sf_dir, "labels")
    return metrics.class_report(
        flags.select(F.col("quality").cast("string").alias("y"), F.col("toxic").cast("string").alias("pred"))
    )


@query
def m7_confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(predictions(spark, sf_dir))


# --------------------------------------------------------------------- reports


@query
def a1_top_skills(spark, sf_dir):
    return report.top_skills(views.postings(spark, sf_dir))


@query
def a2_seniority(spark, sf_dir):
    features = views.postings(spark, sf_dir).withColumn(
        "senioridade_re", joined(extract.seniority(text_of(TEXT)))
    )
    return report.seniority_distribution(features)


@query
def a3_confusion_grid(spark, sf_dir):
    return metrics.confusion_grid(metrics.confusion_matrix(predictions(spark, sf_dir)))


@query
def a4_top_skill_pairs(spark, sf_dir):
    return report.top_skill_pairs(views.postings(spark, sf_dir))


@query
def a6_top_posting_skills(spark, sf_dir):
    """Top-k with insertion-order ties over the longer skill list."""
    counted = report.skill_counts(views.postings(spark, sf_dir), skills=lexicons.POSTING_SKILLS)
    return report.top_by_first_seen(counted, 10, ["skill"])


@query
def p1_end_to_end(spark, sf_dir):
    """Rows per result table of the whole chain."""
    return chain.summary(chain.run(spark, views.postings(spark, sf_dir)))


def chain_result(name):
    """A result of the chain with a lemma table and a gazetteer, and only the stages behind it."""

    def run(spark, sf_dir):
        postings = views.postings(spark, sf_dir)
        tokens = postings.select(clean.tokens_of(TEXT).alias("tokens"))
        cfg = chain.Config(lemmas=plural_dictionary(tokens), gazetteer=gazetteer(postings, TEXT))
        return chain.run(spark, postings, cfg, [name])[name]

    return run


@query
def p1_labeled(spark, sf_dir):
    rows = chain_result("labeled")(spark, sf_dir)
    return rows.select("doc_id", "text_clean", "label_area", *FEATURE_COLUMNS, *SUMMARY_COLUMNS)


for _name in ("vocabulary", "top_skills", "skill_pairs", "seniority"):
    _run = chain_result(_name)
    _run.__name__ = f"p1_{_name}"
    query(_run)
