"""What reaches a Python worker at once."""

from collections.abc import Iterator

import pyarrow as pa

from jobsift.session import ARROW_BATCH, ARROW_BATCH_BYTES, ship_package


def largest(df) -> int:
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    return df.mapInArrow(sizes, "bytes long").agg({"bytes": "max"}).first()[0]


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    ship_package(spark)
    texts = spark.range(4_000).repartition(1).selectExpr("id", "repeat('long text ', 500) AS text")
    assert largest(texts) < ARROW_BATCH_BYTES + 100_000


def test_a_bound_of_the_application_stays(spark, monkeypatch):
    held = spark.conf.get(ARROW_BATCH)
    context = spark.sparkContext
    given = context.getConf().set(ARROW_BATCH, "1000000")
    monkeypatch.setattr(type(context), "getConf", lambda self: given)
    spark.conf.set(ARROW_BATCH, "1000000")
    try:
        ship_package(spark)
        assert spark.conf.get(ARROW_BATCH) == "1000000"
    finally:
        spark.conf.set(ARROW_BATCH, held)


def test_the_memo_of_an_encoder_is_bounded_and_changes_no_ids():
    import numpy as np

    from jobsift.llm import tokens
    from jobsift.llm._words import slices

    path = tokens._tokenizer_path(tokens.TOKENIZER)
    model, most, ids = tokens.Encoder(path), 0, []
    numbers = [" ".join(f"n{i}" for i in range(at, at + 10_000)) for at in range(0, 600_000, 10_000)]
    repeated = pa.array([*numbers, numbers[0]])
    for part in slices(repeated, tokens.SLICE_BYTES):
        ids.append(model.encode(part)[1])
        most = max(most, len(model.known) - len(part.bytes) // 4)
    assert most <= 500_000
    first = tokens.Encoder(path).encode(next(slices(repeated, 1)))[1]
    found = np.concatenate(ids)
    assert np.array_equal(found[: len(first)], first) and np.array_equal(found[-len(first) :], first)
