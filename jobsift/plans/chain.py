"""The whole chain from postings to labels, model evaluation and reports."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsift import lexicons
from jobsift.operators import annotate, clean, extract, label, metrics, model, report, tfidf
from jobsift.plans.manifest import Run, Stage, frame_key
from jobsift.session import scratch_path, ship_package
from jobsift.sources import sinks, tables


@dataclass
class Config:
    text_col: str = "descricao_texto"
    max_features: int = lexicons.CORPUS_MAX_FEATURES
    model_max_features: int = lexicons.MODEL_MAX_FEATURES
    model_max_iter: int = lexicons.MODEL_MAX_ITER
    test_size: float = lexicons.TEST_SIZE
    max_rows: int | None = None
    text_source: str = "clean"
    reports: bool = True
    annotator: annotate.AnnotatorFactory | None = None
    lemmas: DataFrame | None = None
    gazetteer: DataFrame | None = None
    out_dir: str | None = field(default=None)
    # tells inputs apart that lie in the same files, or in none
    version: str = ""


def enrich(postings: DataFrame, cfg: Config) -> DataFrame:
    """Every row-wise stage: regex features, annotation summaries, clean text.

    One pass over the text; annotated once for both summaries.
    """
    features = extract.extract_features(postings, cfg.text_col)
    if cfg.annotator is None:
        summarized = annotate.summarize_text(features, cfg.text_col, cfg.gazetteer)
    else:
        annotated = annotate.annotate(features, cfg.text_col, cfg.annotator, cfg.gazetteer)
        summarized = annotate.summarize(annotated)
    return clean.clean_text(summarized, cfg.text_col, cfg.lemmas)


def stages(spark: SparkSession, postings: DataFrame, cfg: Config, out_dir: str) -> dict[str, Stage]:
    """The written tables of a run, each with the stages it reads and the settings that decide it."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{out_dir}/{name}")

    def table(build: Callable[[], DataFrame]) -> Callable[[str], None]:
        return lambda path: sinks.write_parquet(build(), path)

    def rows() -> DataFrame:
        return tables.first_rows(read("enriched"), cfg.max_rows)

    def split() -> DataFrame:
        kept = label.label_text_column(read("labeled"), cfg.text_col, cfg.text_source)
        return model.stratified_split(read("labeled").select("doc_id", kept, "label_area"), test_size=cfg.test_size)

    def fit(path: str) -> None:
        train = read("split").filter(~F.col("is_test"))
        text_col = label.label_text_column(read("labeled"), cfg.text_col, cfg.text_source)
        model.train_classifier(
            train, text_col, max_features=cfg.model_max_features, max_iter=cfg.model_max_iter
        ).save(path)

    def fitted() -> model.TextClassifier:
        return model.TextClassifier.load(spark, f"{out_dir}/model")

    def predictions() -> DataFrame:
        test = read("split").filter("is_test").withColumnRenamed("label_area", "y")
        return fitted().predict(test).select("doc_id", "y", "pred")

    def certificate() -> DataFrame:
        trained = fitted()
        gradients = model.certificate(read("split").filter(~F.col("is_test")), trained)
        return gradients.withColumn("iterations", F.lit(trained.iterations))

    def confusion(path: str) -> None:
        matrix = metrics.confusion_matrix(read("predictions"))
        sinks.write_confusion(matrix, metrics.label_order(spark), out_dir)

    def weights(path: str) -> None:
        vocab = read("tfidf_vocab")
        matrix = tfidf.tfidf(read("enriched"), vocab, cfg.max_features, "text_clean")
        sinks.write_parquet(matrix.select("doc_id", "term_id", "tfidf"), path)

    def terms() -> DataFrame:
        return tfidf.vocabulary(read("enriched"), "text_clean", cfg.max_features).select("term_id", "term", "idf")

    given = (frame_key(postings), frame_key(cfg.lemmas), frame_key(cfg.gazetteer), cfg.version)
    return {
        "enriched": Stage(table(lambda: enrich(postings, cfg)), (), (*given, cfg.text_col, repr(cfg.annotator))),
        "tfidf_vocab": Stage(table(terms), ("enriched",), (cfg.max_features,)),
        "tfidf_features": Stage(weights, ("enriched", "tfidf_vocab")),
        "labeled": Stage(
            table(lambda: label.label_areas(rows(), cfg.text_col, text_source=cfg.text_source)),
            ("enriched",), (cfg.max_rows, cfg.text_source),
        ),
        "split": Stage(table(split), ("labeled",), (cfg.test_size,)),
        "model": Stage(fit, ("split",), (cfg.model_max_features, cfg.model_max_iter)),
        "certificate": Stage(table(certificate), ("split", "model")),
        "predictions": Stage(table(predictions), ("split", "model")),
        "confusion_matrix": Stage(confusion, ("predictions",)),
        "top_skills": Stage(table(lambda: report.top_skills(read("labeled"), cfg.text_col)), ("labeled",)),
        "seniority": Stage(table(lambda: report.seniority_distribution(read("labeled"))), ("labeled",)),
        "skill_pairs": Stage(table(lambda: report.top_skill_pairs(read("labeled"), cfg.text_col)), ("labeled",)),
    }


# Results by name: the stage they come from.
RESULTS = {
    "labeled": "labeled",
    "tfidf": "tfidf_features",
    "vocabulary": "tfidf_vocab",
    "predictions": "predictions",
    "certificate": "certificate",
    "accuracy": "predictions",
    "class_report": "predictions",
    "confusion": "confusion_matrix",
}
REPORTS = {
    "top_skills": "top_skills",
    "seniority": "seniority",
    "confusion_grid": "confusion_matrix",
    "skill_pairs": "skill_pairs",
}


def run(
    spark: SparkSession,
    postings: DataFrame,
    cfg: Config | None = None,
    only: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """The result tables by name, all of them or those of ``only``.

    Every stage is written once under ``out_dir`` and committed there; a run that is
    started again with the same folder, inputs and settings goes on behind the last stage
    that was finished.  Only the stages behind the wanted results are run.
    """
    cfg = cfg or Config()
    ship_package(spark)
    tables.require_columns(postings, cfg.text_col)
    out_dir = (cfg.out_dir or scratch_path(spark, "run")).rstrip("/")
    work = Run(spark, out_dir, stages(spark, postings, cfg, out_dir))
    wanted = RESULTS | (REPORTS if cfg.reports else {})
    results = {}
    for name, stage in wanted.items():
        if only is not None and name not in only:
            continue
        work.ensure(stage)
        results[name] = spark.read.parquet(work.path(stage))
    for name, derive in {
        "accuracy": metrics.accuracy,
        "class_report": metrics.class_report,
        "confusion_grid": lambda matrix: report.confusion_report(
            matrix, tables.read_label_order(spark, f"{out_dir}/labels_order")
        ),
    }.items():
        if name in results:
            results[name] = derive(results[name])
    return results


def summary(results: dict[str, DataFrame]) -> DataFrame:
    """(result, n): rows per result table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("result"), "n")
        for name, df in results.items()
    ]
    total = counted[0]
    for other in counted[1:]:
        total = total.unionByName(other)
    return total
