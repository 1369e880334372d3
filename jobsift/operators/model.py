"""Stratified split and the baseline classifier."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    StringIndexer,
)
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from jobsift import lexicons
from jobsift.functions.text import text_of
from jobsift.limits import MAX_BROADCAST_ROWS
from jobsift.operators.logistic import Counted, Descent
from jobsift.operators.tfidf import Weights, terms_of, vocabulary, word_lists
from jobsift.session import stored

BUCKET_HEX_DIGITS = 4
# Fixed value: the largest component of the mean loss's gradient at which common solvers stop
GRADIENT_BOUND = 1e-4
# Change of the loss at which a fit ends, tried in this order until the gradient is small enough
TOLERANCES = (1e-6, 1e-8)


def split_hash(key: str, seed: int) -> Column:
    """A fixed pseudo-random order of the rows."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def test_quotas(sizes: DataFrame, label_col: str, test_size: float) -> DataFrame:
    """(label, quota): test rows per label by largest remainder.

    The total is ``ceil(test_size * n)``.  A label with one row stays in train.
    """
    everyone = W.partitionBy()
    total = F.sum("n").over(everyone)
    n_test = F.ceil(F.round(total * F.lit(test_size), 9))
    shared = sizes.select(label_col, "n", n_test.alias("n_test"), total.alias("total")).filter(
        "n > 1"
    )
    exact = F.col("n") * F.col("n_test")
    floors = shared.select(
        label_col,
        "n",
        "n_test",
        F.floor(exact / F.col("total")).alias("base"),
        (exact % F.col("total")).alias("remainder"),
    )
    by_remainder = W.partitionBy().orderBy(F.desc("remainder"), label_col)
    left = F.col("n_test") - F.sum("base").over(everyone)
    k = F.count(F.lit(1)).over(everyone)
    place = F.row_number().over(by_remainder)
    extra = F.floor(left / k) + F.when(place <= left % k, 1).otherwise(0)
    return floors.select(
        label_col, F.least(F.col("base") + extra, F.col("n")).cast("long").alias("quota")
    )


def stratified_split(
    df: DataFrame,
    label_col: str = "label_area",
    key: str = "doc_id",
    test_size: float = lexicons.TEST_SIZE,
    seed: int = lexicons.SPLIT_SEED,
) -> DataFrame:
    """Add ``is_test``: the first rows of each label in hash order, up to its quota.

    Same rows as ranking each label by hash, without sorting a label in one
    task: a histogram of hash buckets finds the bucket where the quota is
    reached, only that bucket is ranked, and all rows are then compared with the
    one hash per label at which the test set ends.  That table is written, so
    its size is known to the last join, whatever the number of labels.  Reads
    ``df`` several times: pass a stored table when the labels are expensive.
    """
    hashed = df.withColumn("_hash", split_hash(key, seed))
    bucket = F.conv(F.substring("_hash", 1, BUCKET_HEX_DIGITS), 16, 10).cast("int")
    keys = hashed.select(label_col, "_hash", key, bucket.alias("_bucket"))
    histogram = keys.groupBy(label_col, "_bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = histogram.groupBy(label_col).agg(F.sum("n").alias("n"))
    quotas = test_quotas(sizes, label_col, test_size)
    earlier = W.partitionBy(label_col).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    cut = (
        histogram.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(quotas, label_col)
        .filter((F.col("before") < F.col("quota")) & (F.col("quota") <= F.col("before") + F.col("n")))
        .select(label_col, "_bucket", (F.col("quota") - F.col("before")).alias("take"))
    )
    in_order = W.partitionBy(label_col).orderBy("_hash", key)
    last_test_row = (
        keys.join(cut, [label_col, "_bucket"])
        .withColumn("_rank", F.row_number().over(in_order))
        .filter(F.col("_rank") == F.col("take"))
        .select(label_col, F.struct("_hash", key).alias("_last"))
    )
    return (
        hashed.join(stored(last_test_row, "split-cut"), label_col, "left")
        .withColumn(
            "is_test", F.coalesce(F.struct("_hash", key) <= F.col("_last"), F.lit(False))
        )
        .drop("_hash", "_last")
    )


@dataclass
class TextClassifier:
    """TF-IDF of the train texts and a logistic regression on top."""

    features: PipelineModel
    labels: list[str]
    regression: LogisticRegressionModel | None
    text_col: str
    penalty: float = 0.0
    iterations: int = 0

    def predict(self, df: DataFrame) -> DataFrame:
        """Append ``pred``; a model that saw one label only predicts it always."""
        if self.regression is None:
            return df.withColumn("pred", F.lit(self.labels[0]))
        scored = self.regression.transform(featurize(df, self.text_col, self.features))
        names = F.array(*[F.lit(label) for label in self.labels])
        return scored.withColumn("pred", F.get(names, F.col("prediction").cast("int"))).select(
            *df.columns, "pred"
        )

    def save(self, path: str) -> None:
        """Write the parts and, last, what ties them together."""
        self.features.write().overwrite().save(f"{path}/features")
        if self.regression is not None:
            self.regression.write().overwrite().save(f"{path}/regression")
        spark = SparkSession.active()
        about = (self.labels, self.regression is not None, self.text_col, self.penalty, self.iterations)
        spark.createDataFrame([about], _ABOUT).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextClassifier:
        about = spark.read.parquet(f"{path}/about").first()
        regression = LogisticRegressionModel.load(f"{path}/regression") if about["fitted"] else None
        features = PipelineModel.load(f"{path}/features")
        return cls(features, list(about["labels"]), regression, about["text_col"], about["penalty"], about["iterations"])

    def linear(self) -> Linear:
        """The fitted numbers as arrays, at most features times labels of them."""
        coefficients = self.regression.coefficientMatrix.toArray()
        intercepts = self.regression.interceptVector.toArray()
        if len(intercepts) == 1:
            # two labels have one row of coefficients; the other label's margin is 0
            coefficients = np.vstack([np.zeros_like(coefficients), coefficients])
            intercepts = np.array([0.0, intercepts[0]])
        return Linear(weights_of(self.features), coefficients, intercepts)


_ABOUT = "labels array<string>, fitted boolean, text_col string, penalty double, iterations int"


@dataclass
class Linear:
    """Vocabulary, coefficients (label x term) and intercepts."""

    words: Weights
    coefficients: np.ndarray
    intercepts: np.ndarray

    def margins(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Margins (document x label), and the weighed terms they are made of."""
        document, term, _, weight = self.words.weigh(lists)
        n = len(lists)
        columns = [np.bincount(document, row[term] * weight, minlength=n) for row in self.coefficients]
        return np.stack(columns, axis=1) + self.intercepts, document, term, weight


def margins(df: DataFrame, classifier: TextClassifier, key: str = "doc_id") -> DataFrame:
    """(key, margins, best): the margin of each label, from the weighed terms of the text.

    A scan of the texts that uses the fitted numbers only, apart from the library's
    own transform; ``best`` is the label with the largest margin, the first of equal ones.
    """
    shipped = df.sparkSession.sparkContext.broadcast((classifier.linear(), classifier.labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linear, labels = shipped.value
        names = pa.array(labels, pa.string())
        for batch in batches:
            found, *_ = linear.margins(batch.column(1))
            flat = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype="int32") * len(labels), found.ravel())
            best = names.take(pa.array(found.argmax(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), flat, best], [key, "margins", "best"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(key, word_lists(classifier.text_col).alias("words"))
    return rows.mapInArrow(run, f"`{key}` {kind}, margins array<double>, best string")


def certificate(train: DataFrame, classifier: TextClassifier, label_col: str = "label_area") -> DataFrame:
    """(label, n, gradient): the largest component of the penalised gradient for each label.

    The objective is the mean of the losses plus half the penalty times the squared
    coefficients.  It is convex, so a small gradient proves that the coefficients are near
    the best ones, however they were found.  The gradient is summed from the weighed
    terms of the train rows: every task sends one number per label and term, so nothing
    shuffles with the rows.  A model of one label has nothing to fit: its gradient is 0.
    """
    counts = train.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    if classifier.regression is None:
        return counts.withColumn("gradient", F.lit(0.0))
    shipped = train.sparkSession.sparkContext.broadcast((classifier.linear(), classifier.labels))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linear, labels = shipped.value
        k, size = linear.coefficients.shape
        # the intercept is one more term, of weight 1 in every document
        total, rows = np.zeros((k, size + 1)), 0
        for batch in batches:
            found, document, term, weight = linear.margins(batch.column(0))
            found -= found.max(1, keepdims=True)
            share = np.exp(found)
            share /= share.sum(1, keepdims=True)
            truth = pc.index_in(batch.column(1), value_set=pa.array(labels, pa.string())).to_numpy()
            share[np.arange(len(share)), truth] -= 1
            rows += len(share)
            for label in range(k):
                total[label, :size] += np.bincount(term, share[document, label] * weight, minlength=size)
                total[label, size] += share[:, label].sum()
        label, term = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(label, pa.int32()), pa.array(term, pa.int32()), pa.array(total.ravel())], ["y", "term_id", "part"]
        )

    texts = train.select(word_lists(classifier.text_col).alias("words"), F.col(label_col).alias("label"))
    parts = texts.mapInArrow(partial, "y int, term_id int, part double")
    linear = classifier.linear()
    names = F.array(*[F.lit(label) for label in classifier.labels])
    penalised = np.hstack([classifier.penalty * linear.coefficients, np.zeros((len(linear.intercepts), 1))])
    if classifier.regression.coefficientMatrix.numRows == 1:
        # one row of coefficients stands for both labels, with opposite signs
        penalised[0] = -penalised[1]
    y, term = np.indices(penalised.shape).reshape(2, -1)
    own = train.sparkSession.createDataFrame(
        pa.table({"y": pa.array(y, pa.int32()), "term_id": pa.array(term, pa.int32()), "own": penalised.ravel()})
    )
    component = F.abs(F.col("part") / F.lit(train.count()) + F.col("own"))
    return (
        parts.groupBy("y", "term_id")
        .agg(F.sum("part").alias("part"))
        .join(own, ["y", "term_id"])
        .groupBy(F.get(names, F.col("y")).alias("label"))
        .agg(F.max(component).alias("gradient"))
        .join(counts, "label")
        .select("label", "n", "gradient")
    )


def fit_features(
    train: DataFrame, text_col: str, max_features: int, key: str = "doc_id"
) -> PipelineModel:
    """Vocabulary and IDF of the train texts as a vector pipeline.

    The vocabulary has at most ``max_features`` rows, which is also the size of
    the model's weight vectors, so it fits the driver by construction.
    """
    if max_features > MAX_BROADCAST_ROWS:
        raise ValueError(f"max_features must be at most {MAX_BROADCAST_ROWS}")
    rows = vocabulary(train, text_col, max_features).orderBy("term_id").collect()
    counter = CountVectorizerModel.from_vocabulary(
        [r["term"] for r in rows], inputCol="_terms", outputCol="_tf"
    )
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="_tf", outputCol="_tfidf"
    )
    return PipelineModel([counter, weigh, Normalizer(p=2.0, inputCol="_tfidf", outputCol="features")])


def weights_of(features: PipelineModel) -> Weights:
    """The vocabulary and IDF of a vector pipeline."""
    counter, weigh, _ = features.stages
    terms, idf = counter.vocabulary, weigh.getScalingVec().toArray()
    return Weights(pa.array(terms, pa.string()), np.arange(len(terms), dtype="int32"), idf)


def featurize(df: DataFrame, text_col: str, features: PipelineModel) -> DataFrame:
    """Append the unit-length sparse TF-IDF vector: a projection, no shuffle."""
    terms = df.withColumn("_terms", terms_of(text_of(text_col)))
    return features.transform(terms).drop("_terms", "_tf", "_tfidf")


def train_classifier(
    train: DataFrame,
    text_col: str,
    label_col: str = "label_area",
    key: str = "doc_id",
    max_features: int = lexicons.MODEL_MAX_FEATURES,
    max_iter: int = lexicons.MODEL_MAX_ITER,
    inverse_penalty: float = 1.0,
    gradient_bound: float = GRADIENT_BOUND,
) -> TextClassifier:
    """Fit on the train rows; L2 penalty of a loss summed over rows with weight C.

    The texts are cut into words twice, for the vocabulary and for the counts that all
    iterations read.  A fit that ended with too large a gradient goes on with a smaller tolerance.
    """
    features = fit_features(train, text_col, max_features, key)
    indexer = StringIndexer(
        inputCol=label_col, outputCol="_y", stringOrderType="alphabetAsc"
    ).fit(train)
    labels = list(indexer.labels)
    if len(labels) < 2:
        return TextClassifier(features, labels, None, text_col)
    counted = Counted.of(train, text_col, label_col, weights_of(features), labels)
    penalty = 1.0 / (inverse_penalty * counted.n)
    descent = Descent(counted, penalty)
    for tolerance in TOLERANCES:
        descent.run(max_iter, tolerance)
        regression = regression_model(train.sparkSession, *descent.model())
        fitted = TextClassifier(features, labels, regression, text_col, penalty, descent.iterations)
        if descent.iterations >= max_iter or largest_gradient(train, fitted, label_col, counted) <= gradient_bound:
            break
    return fitted


def regression_model(spark: SparkSession, coefficients: np.ndarray, intercepts: np.ndarray) -> LogisticRegressionModel:
    """The library's model with these numbers; one row of coefficients stands for two labels."""
    rows, size = coefficients.shape
    matrix = DenseMatrix(rows, size, coefficients.ravel(), isTransposed=True)
    context = spark.sparkContext
    return LogisticRegressionModel(
        spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
            LogisticRegressionModel.__name__ + "_" + uuid4().hex[:12],
            _py2java(context, matrix),
            _py2java(context, Vectors.dense(intercepts)),
            max(rows, 2),
            rows > 1,
        )
    )


def largest_gradient(
    train: DataFrame, classifier: TextClassifier, label_col: str = "label_area", counted: Counted | None = None
) -> float:
    """The largest component of the certificate, from the texts or from rows that are counted already.

    Their counts and lengths are those that ``certificate`` makes of the texts.
    """
    if counted is None:
        return certificate(train, classifier, label_col).agg(F.max("gradient")).first()[0]
    regression = classifier.regression
    coefficients, intercepts = regression.coefficientMatrix.toArray(), regression.interceptVector.toArray()
    _, slopes, free = counted.loss(coefficients, intercepts, classifier.penalty)
    return max(np.abs(slopes).max(), np.abs(free).max())


def evaluate(
    labeled: DataFrame,
    text_col: str,
    label_col: str = "label_area",
    key: str = "doc_id",
    test_size: float = lexicons.TEST_SIZE,
    seed: int = lexicons.SPLIT_SEED,
    max_features: int = lexicons.MODEL_MAX_FEATURES,
    max_iter: int = lexicons.MODEL_MAX_ITER,
) -> tuple[TextClassifier, DataFrame]:
    """Split, train, predict: the model and (doc_id, y, pred) of the test rows."""
    rows = labeled.select(key, text_col, label_col)
    split = stored(stratified_split(rows, label_col, key, test_size, seed), "split")
    model = train_classifier(
        split.filter(~F.col("is_test")), text_col, label_col, key, max_features, max_iter
    )
    test = split.filter("is_test").select(key, text_col, F.col(label_col).alias("y"))
    return model, model.predict(test).select(key, "y", "pred")
