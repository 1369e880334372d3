import pytest
from pyspark.sql import functions as F

from jobsift.functions.html import visible_text
from jobsift.operators import web
from jobsift.plans import views
from jobsift.sources import sinks


def test_absolute_url(spark):
    df = spark.createDataFrame([("/x",), ("x",), ("http://h",), ("",), (None,)], "h string")
    got = [r[0] for r in df.select(web.absolute_url(F.col("h"), "D")).collect()]
    assert got == ["D/x", "D/x", "http://h", "", ""]


def links(spark, html, prefix="/remote-jobs/"):
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(web.posting_links(F.col("html"), "D", prefix)).first()[0]


def test_links_of_a_listing(spark):
    html = """<!-- <a href="/remote-jobs/commented">x</a> -->
    <script>var s = '<a href="/remote-jobs/script">';</script>
    <A class="b" HREF=' /remote-jobs/one '>1</A> <a href=/remote-jobs/two>2</a>
    <a data-href="/remote-jobs/no" href="/about">3</a> <a
      title="t" href="/remote-jobs/three?a=1&amp;b=2">4</a> <a href="/remote-jobs/one">again</a>
    <a name="x">no href</a> <abbr href="/remote-jobs/abbr">no</abbr>"""
    assert links(spark, html) == [
        "D/remote-jobs/one", "D/remote-jobs/two", "D/remote-jobs/three?a=1&b=2",
    ]


def test_links_of_a_failed_page_stay_null(spark):
    df = spark.createDataFrame([(0, 1, None)], "cat_order int, page int, html string")
    assert web.listing_links(df).first().links is None


def read(spark, rows, **kw):
    df = spark.createDataFrame(rows, "cat_order int, page int, n_links int")
    return sorted((r.cat_order, r.page) for r in web.pages_read(df, **kw).collect())


def test_few_links_end_a_category(spark):
    assert read(spark, [(0, 1, 6), (0, 2, 4), (0, 3, 9)]) == [(0, 1), (0, 2)]


def test_failed_page_is_skipped(spark):
    assert read(spark, [(0, 1, None), (0, 2, 7), (1, 1, 5)]) == [(0, 1), (0, 2), (1, 1)]


def test_cap_ends_everything(spark):
    rows = [(0, 1, 6), (0, 2, 6), (0, 3, 6), (1, 1, 6)]
    assert read(spark, rows, max_jobs=12) == [(0, 1), (0, 2)]
    assert read(spark, rows, max_jobs=13) == [(0, 1), (0, 2), (0, 3)]


def test_unread_pages_do_not_count(spark):
    rows = [(0, 1, 4), (0, 2, 100), (1, 1, 6), (1, 2, 6)]
    assert read(spark, rows, max_jobs=11) == [(0, 1), (1, 1), (1, 2)]


def test_pages_beyond_the_range_are_not_read(spark):
    assert read(spark, [(0, p, 9) for p in range(0, 9)], pages_per_category=2) == [(0, 1), (0, 2)]


def test_chunks_of_categories(spark, monkeypatch):
    rows = [(c, p, 5 + (c * p) % 3) for c in range(40) for p in (1, 2, 3)]
    whole = read(spark, rows, max_jobs=300)
    monkeypatch.setattr(web, "CATEGORIES_PER_CHUNK", 3)
    assert read(spark, rows, max_jobs=300) == whole
    total, expected = 0, []
    for c, p, n in rows:
        if total < 300:
            expected.append((c, p))
            total += n
    assert whole == sorted(expected)


def test_first_seen_urls(spark):
    rows = [(0, 1, 0, "b"), (0, 1, 1, "a"), (0, 2, 0, "b"), (1, 1, 0, "c")]
    df = spark.createDataFrame(rows, "cat_order int, page int, pos int, url string")
    assert [r.url for r in web.first_seen_urls(df, 2).collect()] == ["b", "a"]


def script(body, kind="application/ld+json"):
    return f'<script type="{kind}">{body}</script>'


JOB = '{"@type":"JobPosting","title":"T","description":"a &amp; <b>b</b>"}'


@pytest.mark.parametrize(
    "html, title",
    [
        (script(JOB), "T"),
        (script(f'[{{"@type":"Other"}}, {JOB}]'), "T"),
        (script("{bad") + script(JOB), "T"),
        (script('{"@type":"Other"}') + script(JOB.replace('"T"', '"U"')), "U"),
        (script('{"@type":"JobPosting","title":"two\nlines"}'), "two lines"),
        ("<!-- " + script(JOB) + " -->", None),
        (script(JOB, "text/javascript"), None),
        (script('{"@type":["JobPosting"],"title":"T"}'), None),
        (script("  "), None),
        (script(JOB + " x"), None),
        (script(JOB + JOB), None),
        (script(JOB[:-1]), None),
        (script('["text", 5, ' + JOB + "]"), "T"),
        (script('[{"@type":"JobPosting","title":"A"}, {bad]'), None),
        (script('{"@type":"JobPosting","title":{"k":1}}'), '{"k":1}'),
        ("<SCRIPT id=x type='application/ld+json' async>" + JOB + "</SCRIPT>", "T"),
        ("<p>none</p>", None),
    ],
)
def test_job_posting(spark, html, title):
    df = spark.createDataFrame([(html,)], "html string").select(web.job_posting(F.col("html")).alias("j"))
    job = df.first().j
    assert (job and job.title) == title


@pytest.mark.parametrize(
    "location, text",
    [
        ('{"address":{"addressLocality":"Lisbon","addressCountry":"PT"}}', "Lisbon, PT"),
        ('[{"address":{"addressRegion":"RJ"}},{"address":{}},{"address":{"addressCountry":"BR"}}]', "RJ, BR"),
        ('[{"address":"text"},{"address":{"addressCountry":"BR"}}]', "BR"),
        ('["text",{"address":{"addressCountry":"BR"}}]', "BR"),
        ("Remote", ""),
        ("[]", ""),
        (None, ""),
    ],
)
def test_location_text(spark, location, text):
    df = spark.createDataFrame([(location,)], "l string")
    assert df.select(web.location_text(F.col("l"))).first()[0] == text


@pytest.mark.parametrize(
    "markup, text",
    [
        ("<p>Build <b>ETL</b></p>", "Build ETL"),
        ("a<!-- c -->b", "a b"),
        ("<style>x</style><script>y<p></script>z<template>t<b>u</b></template>", "z"),
        ("<title>T</title>x &lt; y &copy; &#39;q&#39;", "T x < y © 'q'"),
        ("1 < 2 and <br>next<br/>last", "1 < 2 and next last"),
        ("  \n plain ", "plain"),
        ("<ruby>k<rt>r</rt></ruby>", "k"),
        ("<div><template>h</div>shown", "shown"),
        ("", ""),
        (None, None),
    ],
)
def test_visible_text(markup, text):
    assert visible_text(markup, " ") == text


def test_fields_and_fallback(spark):
    long_text = "w" * 3000
    rows = [
        (1, "u1", script('{"@type":"JobPosting","title":"Dev","description":"<p>x</p>","employmentType":["A","B"],'
                         '"hiringOrganization":{"name":"Acme"}}')),
        (2, "u2", f"<h1> Big <b>Title</b> </h1><h1>No</h1><p>{long_text}</p>"),
        (3, "u3", None),
        (4, "u4", "<p>no heading</p>"),
        (5, "u5", script('{"@type":"JobPosting","hiringOrganization":"plain"}') + "<h1>H</h1>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.doc_id: r for r in web.assemble_postings(pages, "2024-05-06").collect()}
    assert set(got) == {1, 2, 4, 5}
    assert (got[1].titulo, got[1].empresa, got[1].tipo_emprego, got[1].descricao_texto) == (
        "Dev", "Acme", '["A","B"]', "x",
    )
    assert got[2].titulo == "BigTitle"
    assert len(got[2].descricao_texto) == 2000 and got[2].descricao_texto.startswith("Big Title No w")
    assert (got[4].titulo, got[4].descricao_texto) == ("", "no heading")
    assert (got[5].titulo, got[5].empresa, got[5].descricao_texto) == ("", "", "")
    assert {(r.origem, r.data_coleta) for r in got.values()} == {("WeWorkRemotely", "2024-05-06")}


def test_derived_pages(spark, sf_dir):
    got = web.job_fields(views.job_pages(spark, sf_dir)).collect()
    by_case = {}
    for r in got:
        by_case.setdefault(r.page_id % 5, set()).add((r.has_job, r.empresa, r.localizacao))
    assert by_case[0] == {(True, "Acme", "Lisbon, PT")}
    assert by_case[1] == {(True, "", "Rio, RJ, BR")}
    assert all(by_case[c] == {(False, "", "")} for c in (2, 3, 4))


def test_collect_postings(spark, tmp_path):
    listing = spark.createDataFrame(
        [(0, 1, "".join(f'<a href="/remote-jobs/{i}">j</a>' for i in range(6))),
         (0, 2, '<a href="/remote-jobs/2">j</a><a href="/remote-jobs/9">j</a>'),
         (0, 3, '<a href="/remote-jobs/late">j</a>'), (1, 1, None)],
        "cat_order int, page int, html string",
    )
    pages = spark.createDataFrame(
        [(i, f"D/remote-jobs/{i}", f"<h1>Job {i}</h1>" if i != 3 else None) for i in range(12)],
        "page_id long, url string, html string",
    )
    got = web.collect_postings(listing, pages, "2024-01-01", domain="D")
    assert sorted(r.doc_id for r in got.collect()) == [0, 1, 2, 4, 5, 9]
    assert sinks.write_raw_postings(got, str(tmp_path / "raw"))
    assert not sinks.write_raw_postings(got.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_categories(spark):
    assert web.categories(spark).count() == 12
    assert [tuple(r) for r in web.categories(spark, "http://one").collect()] == [(0, "http://one")]
