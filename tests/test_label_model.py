import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsift import lexicons
from jobsift.operators import label, metrics, model


@pytest.mark.parametrize(
    "text, title, expected",
    [
        ("figma", None, "Design"),
        ("sql", None, "Outro"),
        ("docker react", None, "DevOps"),
        ("", "Product Designer", "Design"),
        ("", "Mobile Software Engineer", "Backend"),
        (None, None, "Outro"),
        ("x" * 280 + " DevOps lead", None, "DevOps"),
        ("Machine Learning with Spark", "", "Dados"),
        ("", "FRONT-END dev", "Frontend"),
        ("product manager", "QA Engineer", "Produto"),
    ],
)
def test_golden(texts, text, title, expected):
    got = label.label_areas(texts((text, title)))
    assert got.first().label_area == expected


def test_title_window_is_300_characters(texts):
    df = texts(("y" * 295 + " sre role", None), ("y" * 299 + " data scientist", None))
    scores = label.area_scores(F.col("descricao_texto"), F.lit(""))
    rows = df.orderBy("doc_id").select(F.transform(scores, lambda s: s["score"]).alias("s")).collect()
    by_label = [dict(zip(lexicons.AREA_KEYWORDS, r.s)) for r in rows]
    assert by_label[0]["DevOps"] == 3 + 5  # "sre" ends inside the window
    assert by_label[1]["Dados"] == 3  # keyword only, the title pattern starts beyond it


def test_lexicon_sizes():
    assert sum(len(w) for area in lexicons.AREA_KEYWORDS.values() for w in area.values()) == 230
    assert (len(lexicons.POSTING_SKILLS), len(lexicons.REPORT_SKILLS)) == (64, 31)
    assert len(lexicons.AREA_LABELS) == 10 and len(lexicons.TITLE_PATTERNS) == 9


def test_text_source(texts):
    df = texts(("docker kubernetes", None)).withColumn("text_clean", F.lit("react redux"))
    assert label.label_areas(df).first().label_area == "Frontend"
    assert label.label_areas(df, text_source="raw").first().label_area == "DevOps"
    assert label.label_areas(df.drop("descricao_texto", "titulo")).first().label_area == "Frontend"
    with pytest.raises(ValueError):
        label.label_areas(df.drop("descricao_texto", "text_clean"))


def labelled(spark, sizes):
    rows = [(i, name) for i, name in enumerate(n for n, k in sizes.items() for _ in range(k))]
    return spark.createDataFrame(rows, "doc_id long, label_area string")


@pytest.mark.parametrize(
    "sizes, quotas",
    [
        ({"a": 50, "b": 30, "c": 20}, {"a": 10, "b": 6, "c": 4}),
        ({"a": 7, "b": 6, "c": 1}, {"a": 2, "b": 1, "c": 0}),
        ({"a": 9}, {"a": 2}),
        ({"a": 1, "b": 1}, {"a": 0, "b": 0}),
    ],
)
def test_split_quotas(spark, sizes, quotas):
    split = model.stratified_split(labelled(spark, sizes))
    got = {
        r.label_area: r.n
        for r in split.groupBy("label_area").agg(F.sum(F.col("is_test").cast("int")).alias("n")).collect()
    }
    assert got == quotas
    n = sum(sizes.values())
    if all(k > 1 for k in sizes.values()):
        assert sum(got.values()) == math.ceil(0.2 * n)


def test_split_is_the_hash_order_whatever_the_partitioning(spark):
    df = labelled(spark, {"a": 400, "b": 37})
    one = {r.doc_id for r in model.stratified_split(df.coalesce(1)).filter("is_test").collect()}
    many = {r.doc_id for r in model.stratified_split(df.repartition(7)).filter("is_test").collect()}
    ranked = df.withColumn("h", model.split_hash("doc_id", 42)).toPandas()
    expected = set()
    for name, k in {"a": 81, "b": 7}.items():
        expected |= set(ranked[ranked.label_area == name].sort_values(["h", "doc_id"]).doc_id[:k])
    assert one == many == expected


def test_split_with_crowded_buckets(spark, monkeypatch):
    df = labelled(spark, {"a": 400, "b": 37})
    fine = {r.doc_id for r in model.stratified_split(df).filter("is_test").collect()}
    monkeypatch.setattr(model, "BUCKET_HEX_DIGITS", 1)
    coarse = {r.doc_id for r in model.stratified_split(df).filter("is_test").collect()}
    assert fine == coarse


def pairs(spark, y, pred):
    return spark.createDataFrame(list(zip(range(len(y)), y, pred)), "doc_id long, y string, pred string")


def test_metrics_golden(spark):
    df = pairs(spark, "AAB", "ABB")
    assert metrics.accuracy(df).first().accuracy == pytest.approx(2 / 3)
    report = {r.label: r for r in metrics.class_report(df).collect()}
    assert (report["A"].precision, report["A"].recall, report["A"].support) == (1.0, 0.5, 2)
    assert (report["B"].precision, report["B"].recall, report["B"].support) == (0.5, 1.0, 1)
    assert report["macro avg"].f1 == pytest.approx(2 / 3)
    assert report["weighted avg"].precision == pytest.approx((2 * 1 + 0.5) / 3)
    assert report["weighted avg"].support == 3


def test_undefined_ratios_are_zero(spark):
    report = {r.label: r for r in metrics.class_report(pairs(spark, "AA", "AC")).collect()}
    assert (report["C"].precision, report["C"].recall, report["C"].f1, report["C"].support) == (0, 0, 0, 0)


def test_confusion_covers_all_labels_and_sums_to_the_rows(spark):
    df = pairs(spark, ["QA", "QA", "Dados"], ["QA", "Outro", "Dados"])
    matrix = metrics.confusion_matrix(df)
    assert matrix.count() == 100
    assert matrix.agg(F.sum("n")).first()[0] == 3
    grid = metrics.confusion_grid(matrix).collect()
    assert [r.true_label for r in grid] == lexicons.AREA_LABELS
    assert (grid[6]["QA"], grid[6]["Outro"], grid[0]["Dados"]) == (1, 1, 1)


def test_model_learns_separable_labels(spark):
    words = {"Dados": "etl spark warehouse", "QA": "selenium bug testing", "Design": "figma sketch usability"}
    rows = [(i, f"{words[name]} w{i % 9}", name) for i, name in enumerate(sorted(words) * 20)]
    df = spark.createDataFrame(rows, "doc_id long, t string, label_area string")
    fitted, predicted = model.evaluate(df, "t", max_features=50, max_iter=50)
    assert predicted.count() == 12 and fitted.labels == sorted(words)
    assert metrics.accuracy(predicted).first().accuracy == 1.0
    assert fitted.predict(df).columns == ["doc_id", "t", "label_area", "pred"]


def test_one_label_is_predicted_always(spark):
    rows = [(i, "a b text", "Outro") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, t string, label_area string")
    _, predicted = model.evaluate(df, "t", max_features=5)
    assert {(r.y, r.pred) for r in predicted.collect()} == {("Outro", "Outro")}
    assert predicted.count() == 2


def test_vectors_equal_the_long_table(spark, sf_dir):
    from jobsift.operators import tfidf

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").alias("t"))
    vocab = tfidf.vocabulary(docs, "t", 100)
    long = {(r.doc_id, r.term_id): r.tfidf for r in tfidf.tfidf(docs, vocab, 100, "t").collect()}
    features = model.fit_features(docs, "t", 100)
    vectors = {}
    for row in model.featurize(docs, "t", features).select("doc_id", "features").collect():
        for i, v in zip(row.features.indices, row.features.values):
            vectors[(row.doc_id, int(i))] = float(v)
    assert vectors.keys() == long.keys()
    assert all(vectors[k] == pytest.approx(long[k]) for k in long)


def noisy(spark, labels, n=60):
    words = {"A": "etl spark lake", "B": "bug test lake", "C": "figma sketch test"}
    rows = [(i, f"{words[labels[i % len(labels)]]} w{i % 7} w{i % 5}", labels[(i + i // 9) % len(labels)]) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, t string, label_area string")


@pytest.mark.parametrize("labels", ["AB", "ABC"])
def test_certificate_is_the_gradient(spark, labels):
    """Against differences of the objective, and large for coefficients that are not the best."""
    df = noisy(spark, labels).repartition(3)
    fitted = model.train_classifier(df, "t", max_features=20, max_iter=200)
    proven = {r.label: r.gradient for r in model.certificate(df, fitted).collect()}
    assert set(proven) == set(labels) and max(proven.values()) <= model.GRADIENT_BOUND
    short = model.train_classifier(df, "t", max_features=20, max_iter=1)
    gradients = {r.label: r.gradient for r in model.certificate(df, short).collect()}
    assert max(gradients.values()) > 10 * model.GRADIENT_BOUND

    vectors = model.featurize(df, "t", short.features).select("features", "label_area").collect()
    x = np.array([r.features.toArray() for r in vectors])
    y = np.array([short.labels.index(r.label_area) for r in vectors])
    w, b = short.regression.coefficientMatrix.toArray().copy(), short.regression.interceptVector.toArray().copy()

    def objective(w, b):
        margins = x @ w.T + b
        if len(labels) == 2:
            margins = np.hstack([np.zeros_like(margins), margins])
        loss = np.log(np.exp(margins).sum(1)) - margins[np.arange(len(y)), y]
        return loss.mean() + short.penalty / 2 * (w**2).sum()

    for k in range(len(w)):
        slopes = []
        for j in range(w.shape[1]):
            step = np.zeros_like(w)
            step[k, j] = 1e-5
            slopes.append(abs(objective(w + step, b) - objective(w - step, b)) / 2e-5)
        step = np.zeros_like(b)
        step[k] = 1e-5
        slopes.append(abs(objective(w, b + step) - objective(w, b - step)) / 2e-5)
        assert max(slopes) == pytest.approx(gradients[short.labels[k]], rel=1e-4)


def test_fit_is_repeated_until_proven(spark, monkeypatch):
    df = noisy(spark, "ABC")
    monkeypatch.setattr(model, "TOLERANCES", (0.5, 1e-8))
    assert model.largest_gradient(df, model.train_classifier(df, "t", max_features=20, max_iter=200)) <= model.GRADIENT_BOUND


def test_saved_model_predicts_the_same(spark, tmp_path):
    df = noisy(spark, "ABC")
    fitted = model.train_classifier(df, "t", max_features=20, max_iter=50)
    fitted.save(str(tmp_path / "m"))
    again = model.TextClassifier.load(spark, str(tmp_path / "m"))
    assert (again.labels, again.penalty, again.iterations) == (fitted.labels, fitted.penalty, fitted.iterations)
    assert again.predict(df).orderBy("doc_id").collect() == fitted.predict(df).orderBy("doc_id").collect()
    best = model.margins(df, again).join(again.predict(df), "doc_id")
    assert best.filter("best <> pred").isEmpty()
    one = model.train_classifier(df.filter("label_area = 'A'"), "t", max_features=5)
    one.save(str(tmp_path / "one"))
    assert {r.pred for r in model.TextClassifier.load(spark, str(tmp_path / "one")).predict(df).collect()} == {"A"}
    assert [r.gradient for r in model.certificate(df.filter("label_area = 'A'"), one).collect()] == [0.0]
