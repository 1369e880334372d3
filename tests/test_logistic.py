"""The fit: sums over counted documents against plain arrays, few passes, and going on where it stopped."""

import numpy as np
import pytest

from jobsift.operators import logistic, model

LABELS = ["A", "B", "C"]


def rows(spark, n=90):
    words = {"A": "etl spark lake", "B": "bug test lake", "C": "figma sketch test"}
    data = []
    for i in range(n):
        name = LABELS[(i + i // 9) % 3]
        text = f"{words[LABELS[i % 3]]} w{i % 7} w{i % 5}"
        # no known term, no text, and counts beyond a byte
        text = ("zz", None, "etl " * 300 + text)[i % 30] if i % 30 < 3 else text
        data.append((i % 8 or None, text, name))
    return spark.createDataFrame(data, "doc_id long, t string, label_area string").repartition(5)


def dense(df, features):
    found = model.featurize(df, "t", features).select("features", "label_area").collect()
    return np.array([r.features.toArray() for r in found]), np.array([LABELS.index(r.label_area) for r in found])


@pytest.mark.parametrize("tasks", [2, 5])
def test_sums_are_those_of_the_vectors(spark, monkeypatch, tasks):
    monkeypatch.setattr(logistic, "PARTIALS", 2)
    monkeypatch.setattr(logistic, "SLICE_TERMS", 40)
    df = rows(spark)
    features = model.fit_features(df.filter("t <> 'zz'"), "t", 12)
    counted = logistic.Counted.of(df, "t", "label_area", model.weights_of(features), LABELS)
    counted.tasks = tasks
    x, y = dense(df, features)
    assert counted.n == len(y) == 90
    assert counted.shares() == pytest.approx(np.bincount(y) / len(y))
    mean, variance = counted.mean_and_variance()
    assert mean == pytest.approx(x.mean(0)) and variance == pytest.approx(x.var(0))
    rng = np.random.default_rng(3)
    w, b = rng.normal(size=(3, x.shape[1])), rng.normal(size=3)
    margins = x @ w.T + b
    share = np.exp(margins) / np.exp(margins).sum(1, keepdims=True)
    f, slopes, free = counted.loss(w, b, 0.1)
    assert f == pytest.approx(-np.log(share[np.arange(90), y]).mean() + 0.05 * (w**2).sum())
    share[np.arange(90), y] -= 1
    assert slopes == pytest.approx(share.T @ x / 90 + 0.1 * w) and free == pytest.approx(share.sum(0) / 90)


def test_few_passes_lead_to_a_small_gradient(spark, monkeypatch, sf_dir):
    from jobsift.operators.label import label_areas
    from jobsift.plans import views

    passes, summed = [], logistic.Counted.summed
    monkeypatch.setattr(logistic.Counted, "summed", lambda *a: passes.append(1) or summed(*a))
    train = label_areas(views.postings(spark, sf_dir)).select("doc_id", "descricao_texto", "label_area").cache()
    fitted = model.train_classifier(train, "descricao_texto", max_features=2000)
    assert model.largest_gradient(train, fitted) <= 2e-5
    # the solver of the library took 259 iterations and left 2.4e-5
    assert fitted.iterations <= len(passes) <= 100


def test_a_fit_goes_on_where_it_stopped(spark):
    df = rows(spark)
    features = model.fit_features(df, "t", 12)
    counted = logistic.Counted.of(df, "t", "label_area", model.weights_of(features), LABELS)
    descent = logistic.Descent(counted, 1 / 90)
    descent.run(3, 1e-12)
    assert (descent.iterations, len(descent.losses)) == (3, 4)
    descent.run(500, 1e-12)
    assert 3 < descent.iterations < 500 and sorted(descent.losses, reverse=True) == pytest.approx(descent.losses, abs=1e-12)
    coefficients, intercepts = descent.model()
    _, slopes, free = counted.loss(coefficients, intercepts, 1 / 90)
    assert max(abs(slopes).max(), abs(free).max()) < 1e-6
    assert abs(coefficients.sum(0)).max() < 1e-8 and abs(intercepts.sum()) < 1e-8


def test_a_row_without_a_label_is_refused(spark):
    df = spark.createDataFrame([(1, "a text", "A"), (2, "b text", "B"), (3, "c text", None)], "doc_id long, t string, label_area string")
    with pytest.raises(Exception, match="without a label"):
        model.train_classifier(df, "t", max_features=5)
