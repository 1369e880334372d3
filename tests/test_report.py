from pyspark.sql import functions as F

from jobsift.operators import extract, report
from jobsift.plans import views


def test_pairs_golden(texts):
    got = report.top_skill_pairs(texts("python and sql", "sql python spark"))
    assert [(r.pair, r.n) for r in got.collect()] == [
        ("python+sql", 2), ("python+spark", 1), ("spark+sql", 1),
    ]


def test_seniority_golden(texts):
    df = extract.extract_features(texts("Senior, Jr", "nothing", None))
    got = report.seniority_distribution(df).collect()
    assert {(r.seniority, r.n) for r in got} == {("senior", 1), ("Sem", 2)}


def test_seniority_without_the_column_is_empty(texts):
    got = report.seniority_distribution(texts("a"))
    assert got.columns == ["seniority", "n"] and got.count() == 0


def test_ties_follow_first_appearance(texts):
    got = report.top_skills(texts("rust and go", "java", "python"), k=3).collect()
    assert [(r.skill, r.n) for r in got] == [("go", 1), ("rust", 1), ("java", 1)]


def test_no_skill_gives_an_empty_report(texts):
    assert report.top_skills(texts("zzz", None)).count() == 0
    assert report.top_skill_pairs(texts("python", "")).count() == 0


def test_pair_total_is_the_sum_over_documents(spark, sf_dir):
    postings = views.postings(spark, sf_dir)
    total = report.skill_pair_counts(postings).agg(F.sum("n")).first()[0]
    k = F.size(report.words_contained(F.lower("descricao_texto"), report.lexicons.REPORT_SKILLS))
    expected = postings.select((k * (k - 1) / 2).cast("long").alias("p")).agg(F.sum("p")).first()[0]
    assert total == expected > 0


def test_one_hot_combination(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "python sql").otherwise(F.concat(F.lit("x"), "id")).alias("descricao_texto"),
    )
    assert [(r.pair, r.n) for r in report.top_skill_pairs(df).collect()] == [("python+sql", 1000)]
