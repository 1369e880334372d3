"""Posting, page and listing tables derived from the supplied test tables.

The supplied text hardly contains any of the looked-for terms, so phrases chosen
by the row id are appended.  Each statement is valid in Spark SQL and in ANSI
SQL engines alike and covers every row of its base table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobsift.sources.tables import spread

POSTINGS_SQL = """
SELECT doc_id,
 CASE doc_id % 7 WHEN 0 THEN 'Senior Data Engineer' WHEN 1 THEN 'Front-end Developer'
  WHEN 2 THEN 'Software Engineer' WHEN 3 THEN 'DevOps Lead' WHEN 4 THEN 'Product Manager'
  WHEN 5 THEN '' ELSE NULL END AS titulo,
 concat(text, ' ',
  CASE doc_id % 5 WHEN 0 THEN 'Senior senior Jr. role' WHEN 1 THEN 'Internship or mid level'
   WHEN 2 THEN 'principal staff lead' WHEN 3 THEN 'pleno' ELSE '' END, ' ',
  CASE doc_id % 3 WHEN 0 THEN 'fully remote Remote' WHEN 1 THEN 'hybrid or on-site' ELSE '' END, ' ',
  CASE doc_id % 4 WHEN 0 THEN 'pays $120,000.50 yearly' WHEN 1 THEN 'paga R$ 12.000,00 mensal'
   WHEN 2 THEN '100k-120k' ELSE '$5,000' END, ' ',
  CASE doc_id % 6 WHEN 0 THEN '40 hours per week' WHEN 1 THEN '20 h / semana' ELSE '' END, ' ',
  CASE doc_id % 11 WHEN 0 THEN 'python sql spark airflow machine learning'
   WHEN 1 THEN 'react javascript css figma' WHEN 2 THEN 'docker kubernetes terraform ci/cd'
   WHEN 3 THEN 'java spring boot postgres rest api' WHEN 4 THEN 'kotlin swift flutter'
   WHEN 5 THEN 'roadmap okr backlog' WHEN 6 THEN 'selenium cypress pytest'
   WHEN 7 THEN 'owasp siem iam' ELSE '' END, ' ',
  CASE doc_id % 13 WHEN 0 THEN 'see https://jobs.example.com/a, www.example.org/b) mail hr@example.com'
   ELSE '' END) AS descricao_texto
FROM documents
"""

JOB_PAGES_SQL = """
SELECT page_id, url, concat(html, CASE page_id % 5
 WHEN 0 THEN '<script type="application/ld+json">{"@type":"JobPosting","title":"Data Engineer","description":"<p>Build <b>ETL</b></p>","datePosted":"2024-01-02","employmentType":"FULL_TIME","hiringOrganization":{"name":"Acme"},"jobLocation":{"address":{"addressLocality":"Lisbon","addressCountry":"PT"}}}</script>'
 WHEN 1 THEN '<script type="application/ld+json">[{"@type":"Organization"},{"@type":"JobPosting","title":"QA Engineer","description":"Test","hiringOrganization":"plain","jobLocation":[{"address":{"addressLocality":"Rio","addressRegion":"RJ"}},{"address":{"addressCountry":"BR"}}]}]</script>'
 WHEN 2 THEN '<script type="application/ld+json">{"@type":"Organization","name":"Acme"}</script>'
 WHEN 3 THEN '<script type="application/ld+json">{"@type": broken</script>'
 ELSE '' END) AS html FROM pages
"""

LISTING_SQL = """
SELECT page_id, cast(page_id % 4 as int) AS cat_order,
 cast(floor(page_id / 4) + 1 as int) AS page, html FROM pages
"""

_LINK = """'<a href="/remote-jobs/', page_id + {0}, '">job</a>'"""
COLLECTED_LISTING_SQL = f"""
SELECT page_id, cast(page_id % 50 as int) AS cat_order, cast(floor(page_id / 50) + 1 as int) AS page,
 CASE WHEN page_id % 17 = 3 THEN NULL
  WHEN page_id % 29 = 7 THEN concat({", ".join(_LINK.format(k) for k in range(3))})
  ELSE concat({", ".join(_LINK.format(k) for k in range(0, 14, 2))}, '<a href="/about">us</a>') END AS html
FROM pages
"""

COLLECTED_PAGES_SQL = f"""
SELECT page_id, concat('https://jobs.example.com/remote-jobs/', page_id) AS url,
 CASE WHEN page_id % 13 = 5 THEN NULL ELSE html END AS html FROM ({JOB_PAGES_SQL})
"""


KEYS = {"documents": "doc_id", "pages": "page_id", "labels": "doc_id"}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"), KEYS[table])


def _derived(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    name = f"jobsift_base_{table}"
    load(spark, sf_dir, table).createOrReplaceTempView(name)
    return spark.sql(sql.replace(f"FROM {table}", f"FROM {name}"))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "documents", POSTINGS_SQL)


def job_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "pages", JOB_PAGES_SQL)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "pages", LISTING_SQL)


def collected_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages that link to stored pages; some failed, some are the last of their category."""
    return _derived(spark, sf_dir, "pages", COLLECTED_LISTING_SQL)


def collected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages under the URLs that the listing pages link to; some failed."""
    return _derived(spark, sf_dir, "pages", COLLECTED_PAGES_SQL)
