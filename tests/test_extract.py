import pytest
from pyspark.sql import functions as F

from jobsift.functions.arrays import distinct_ignore_case, most_common
from jobsift.operators import extract


def features(texts, *rows):
    return [r.asDict() for r in extract.extract_features(texts(*rows)).orderBy("doc_id").collect()]


@pytest.mark.parametrize(
    "text, column, expected",
    [
        ("Senior senior Jr. dev", "senioridade_re", "Senior, Jr"),
        ("sênior, estágio", "senioridade_re", "sênior, estágio"),
        ("$120k $5,000 R$ 12.000,00 R$5000 90k $120000", "salario_re",
         "$120, R$ 12.000,00, R$5000, 90k"),
        ("remote On-site onsite on site in-office", "regime_re",
         "remote, On-site, onsite, on site, in-office"),
        ("40 hours per week 40h/semana", "carga_horaria_re", "40 hours per week, 40h/semana"),
        ("20 HOURS / WEEK", "carga_horaria_re", "20 HOURS / WEEK"),
        ("see https://a.b/c, www.x.y) a.b-c@d.e.com", "urls_re", "https://a.b/c,, www.x.y)"),
        ("see https://a.b/c, www.x.y) a.b-c@d.e.com", "emails_re", "a.b-c@d.e.com"),
        ("WWW.A.B HTTP://C.D", "urls_re", "WWW.A.B, HTTP://C.D"),
        (" ".join(f"http://x.y/{i}" for i in range(7)), "urls_re",
         ", ".join(f"http://x.y/{i}" for i in range(5))),
        ("JavaScript on Google", "skills_re", "javascript, java, go"),
        ("$120000", "salario_re", "$120"),
        ("$5,000", "salario_re", ""),
        ("mid level or mid", "senioridade_re", "mid level, mid"),
        ("seniority leading", "senioridade_re", ""),
    ],
)
def test_golden(texts, text, column, expected):
    assert features(texts, text)[0][column] == expected


def test_null_and_empty_text(texts):
    names = [
        "senioridade_re", "regime_re", "salario_re", "carga_horaria_re", "urls_re",
        "emails_re", "skills_re",
    ]
    for row in features(texts, None, "", "   "):
        assert [row[n] for n in names] == [""] * 7


def test_missing_column_lists_what_exists(texts):
    with pytest.raises(ValueError, match="descricao_texto"):
        extract.extract_features(texts("a"), "no_such_column")


def test_distinct_ignore_case_is_idempotent_and_ordered(spark):
    df = spark.createDataFrame([(["b", "A", "B", "a", "c"],), ([],), (["x"],)], "v array<string>")
    once = df.select(distinct_ignore_case(F.col("v")).alias("v"))
    twice = once.select(distinct_ignore_case(F.col("v")).alias("v"))
    assert [r.v for r in once.collect()] == [["b", "A", "c"], [], ["x"]]
    assert once.collect() == twice.collect()


def test_most_common_breaks_ties_by_first_appearance(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c", "a", "d"],), ([],)], "v array<string>")
    assert [r.v for r in df.select(most_common(F.col("v"), 3).alias("v")).collect()] == [["b", "a", "c"], []]


def test_same_result_for_any_partitioning(spark, sf_dir):
    from jobsift.plans import views

    postings = views.postings(spark, sf_dir)
    one = extract.extract_features(postings.coalesce(1)).orderBy("doc_id").collect()
    many = extract.extract_features(postings.repartition(13)).orderBy("doc_id").collect()
    assert one == many
