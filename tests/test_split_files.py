"""The files that the query on split CSV reads."""

import glob
import tempfile

from checks import queries
from jobsift.sources import split_csv


def test_no_task_writes_all_rows_and_every_file_is_read_in_splits(spark, monkeypatch):
    folder = tempfile.mkdtemp(prefix="run-")
    text = 'first, "quoted" line\nsecond line ' + "word " * 40
    rows = spark.range(24_000).selectExpr("id AS doc_id", f"concat(id, ' {text}') AS text", "'en' AS lang", "'web' AS source")
    rows.repartition(16).write.parquet(f"{folder}/documents.parquet")
    seen = []
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{folder}/csv")
    monkeypatch.setattr(queries.tables, "read_postings_csv", lambda *a, f=queries.tables.read_postings_csv, **k: seen.append(k) or f(*a, **k))
    before = spark.conf.get(split_csv.SPLIT_BYTES), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(split_csv.SPLIT_BYTES, "100000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100000")
    try:
        found = queries.QUERIES["s1_split_csv"](spark, folder)
        files = glob.glob(f"{folder}/csv/*.csv")
        assert len(files) >= 4
        assert seen[0]["split"] and seen[0]["split_bytes"] < min(len(open(x, "rb").read()) for x in files)
        assert found.count() == 24_000 and found.select("doc_id").distinct().count() == 24_000
        assert found.filter("descricao_texto LIKE concat(doc_id, ' first, \"quoted\" line\nsecond line word%')").count() == 24_000
    finally:
        spark.conf.set(split_csv.SPLIT_BYTES, before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
