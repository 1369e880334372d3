"""From stored listing and detail pages to a postings table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from jobsift import lexicons
from jobsift.functions.html import (
    first_heading,
    ld_json_blocks,
    link_targets,
    text_from_html,
)
from jobsift.functions.arrays import let, one_row_per_item
from jobsift.session import stored

JOB_SCHEMA = (
    "struct<`@type`:string,title:string,description:string,datePosted:string,"
    "employmentType:string,hiringOrganization:string,jobLocation:string>"
)
ADDRESS_SCHEMA = "struct<addressLocality:string,addressRegion:string,addressCountry:string>"
STRICT_JSON = {"allowSingleQuotes": "false"}
CATEGORIES_PER_CHUNK = 1024
# Words of 64 bits in the filter of wanted URLs: two megabytes with their places.
FILTER_WORDS = 1 << 17


def absolute_url(href: Column, domain: str = lexicons.SITE_DOMAIN) -> Column:
    link = F.coalesce(href, F.lit(""))
    return (
        F.when(link == "", "")
        .when(link.startswith("http"), link)
        .when(link.startswith("/"), F.concat(F.lit(domain), link))
        .otherwise(F.concat(F.lit(f"{domain}/"), link))
    )


def categories(spark: SparkSession, base_url: str | None = None) -> DataFrame:
    """(cat_order, base_url): one given source, or the default categories."""
    urls = [base_url] if base_url else lexicons.CATEGORY_URLS
    return spark.createDataFrame(list(enumerate(urls)), "cat_order int, base_url string")


def posting_links(
    html: Column, domain: str = lexicons.SITE_DOMAIN, prefix: str = lexicons.LINK_PREFIX
) -> Column:
    """Distinct absolute posting links of a listing page, in document order."""
    wanted = F.filter(link_targets(html), lambda h: h.startswith(prefix))
    return F.array_distinct(F.transform(wanted, lambda h: absolute_url(h, domain)))


def listing_links(
    listing: DataFrame,
    domain: str = lexicons.SITE_DOMAIN,
    prefix: str = lexicons.LINK_PREFIX,
) -> DataFrame:
    """Add ``links`` to listing pages; a failed page keeps null."""
    return listing.withColumn("links", posting_links(F.col("html"), domain, prefix))


def pages_read(
    linked: DataFrame,
    max_jobs: int = lexicons.MAX_JOBS,
    pages_per_category: int = lexicons.PAGES_PER_CATEGORY,
    min_links: int = lexicons.MIN_LINKS_TO_CONTINUE,
) -> DataFrame:
    """Listing pages that a crawl with the stop rules would read.

    Input (cat_order, page, n_links) with null n_links for a failed page.  A
    category ends after its first page with few links, and everything ends once
    the links seen so far (repeats included) reach ``max_jobs``.  No window
    spans all rows: pages are summed within their category, categories within
    chunks, and only chunk totals are summed globally.
    """
    in_range = linked.filter(F.col("page").between(1, pages_per_category)).select(
        "cat_order", "page", "n_links"
    )
    before = W.partitionBy("cat_order").orderBy("page").rowsBetween(W.unboundedPreceding, -1)
    few = F.col("n_links").isNotNull() & (F.col("n_links") < min_links)
    open_pages = (
        in_range.withColumn("few_before", F.coalesce(F.sum(few.cast("int")).over(before), F.lit(0)))
        .filter("few_before = 0")
        .withColumn("n", F.coalesce("n_links", F.lit(0)).cast("long"))
        .withColumn("in_category", F.coalesce(F.sum("n").over(before), F.lit(0)))
    )
    totals = open_pages.groupBy("cat_order").agg(F.sum("n").alias("n"))
    chunk = F.floor(F.col("cat_order") / CATEGORIES_PER_CHUNK).alias("chunk")
    chunked = totals.select("cat_order", "n", chunk)
    earlier = W.partitionBy("chunk").orderBy("cat_order").rowsBetween(W.unboundedPreceding, -1)
    chunk_totals = chunked.groupBy("chunk").agg(F.sum("n").alias("n"))
    all_chunks = W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    chunk_offsets = chunk_totals.select(
        "chunk", F.coalesce(F.sum("n").over(all_chunks), F.lit(0)).alias("chunks_before")
    )
    offsets = (
        chunked.withColumn("in_chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(chunk_offsets, "chunk")
        .select("cat_order", (F.col("in_chunk") + F.col("chunks_before")).alias("cats_before"))
    )
    return (
        open_pages.join(offsets, "cat_order")
        .withColumn("links_before", F.col("cats_before") + F.col("in_category"))
        .filter(F.col("links_before") < max_jobs)
        .select("cat_order", "page", "n_links", "links_before")
    )


def first_seen_urls(links: DataFrame, max_jobs: int = lexicons.MAX_JOBS) -> DataFrame:
    """Distinct URLs in crawl order (cat_order, page, pos), at most ``max_jobs``."""
    order = F.struct("cat_order", "page", "pos")
    return (
        links.groupBy("url")
        .agg(F.min(order).alias("seen"))
        .orderBy("seen")
        .limit(max_jobs)
        .select("url", "seen.cat_order", "seen.page", "seen.pos")
    )


def frontier(
    listing: DataFrame,
    max_jobs: int = lexicons.MAX_JOBS,
    pages_per_category: int = lexicons.PAGES_PER_CATEGORY,
    domain: str = lexicons.SITE_DOMAIN,
    prefix: str = lexicons.LINK_PREFIX,
) -> DataFrame:
    """Posting URLs to visit: links, stop rules, first-seen distinct, cap."""
    in_range = listing.filter(F.col("page").between(1, pages_per_category))
    parsed = listing_links(in_range, domain, prefix).select("cat_order", "page", "links")
    # the stop rules look at the sizes several times, so pages are parsed once
    linked = stored(parsed, "listing-links")
    sizes = linked.select(
        "cat_order", "page", F.when(F.col("links").isNotNull(), F.size("links")).alias("n_links")
    )
    read = pages_read(sizes, max_jobs, pages_per_category).select("cat_order", "page")
    kept = linked.join(read, ["cat_order", "page"])
    found = one_row_per_item(kept, F.col("links"), "url", "cat_order", "page", pos="pos")
    return first_seen_urls(found, max_jobs)


def _json_value(text: Column) -> Column:
    """JSON text of one complete value; null when anything is wrong or left over.

    The parser stops after the first value, so the text is read as a member of
    an object, which must end right after it.
    """
    member = F.concat(F.lit('{"v":'), text, F.lit("}"))
    return F.from_json(member, "struct<v:string>", STRICT_JSON)["v"]


def _listed(value: Column) -> Column:
    """A JSON list as its elements, anything else as a list of one."""
    return F.when(value.startswith("["), F.from_json(value, "array<string>")).otherwise(
        F.array(value)
    )


def job_posting(html: Column) -> Column:
    """First schema.org JobPosting of a page, or null.

    A block is one object or a list.  A block that is not valid JSON is tried
    again with white space collapsed and then skipped.
    """

    def candidates(block: Column) -> Column:
        collapsed = F.regexp_replace(block, r"(?U)\s+", " ")
        value = F.coalesce(_json_value(block), _json_value(collapsed))
        return F.transform(_listed(value), lambda o: F.from_json(o, JOB_SCHEMA, STRICT_JSON))

    parsed = F.flatten(F.transform(ld_json_blocks(html), candidates))
    return F.get(F.filter(parsed, lambda o: o["@type"] == "JobPosting"), F.lit(0))


def location_text(location: Column) -> Column:
    """Places of a jobLocation (JSON text): locality, region and country each."""

    def place(item: Column) -> Column:
        address_text = F.from_json(item, "struct<address:string>", STRICT_JSON)["address"]
        address = F.from_json(address_text, ADDRESS_SCHEMA, STRICT_JSON)
        parts = F.array(
            address["addressLocality"], address["addressRegion"], address["addressCountry"]
        )
        return F.array_join(F.filter(parts, lambda x: F.coalesce(x, F.lit("")) != ""), ", ")

    places = F.transform(_listed(location), place)
    named = let(places, lambda found: F.filter(found, lambda x: x != ""))
    return F.coalesce(F.array_join(named, ", "), F.lit(""))


def job_fields(pages: DataFrame) -> DataFrame:
    """Posting fields of each fetched page; failed pages (null html) are dropped.

    Pages with a JobPosting use its fields; the others fall back to the first
    heading and the start of the visible text.
    """
    empty = F.lit("")
    fetched = pages.filter(F.col("html").isNotNull())
    found = fetched.withColumn("job", job_posting(F.col("html")))
    has_job = F.col("job").isNotNull()

    def field(name: str) -> Column:
        return F.coalesce(F.col("job")[name], empty)

    markup = F.when(has_job, field("description")).otherwise(F.col("html"))
    heading = F.when(~has_job, first_heading(F.col("html")))
    texts = found.withColumns(
        {
            "body": text_from_html(markup),
            "heading": text_from_html(heading, separator=""),
        }
    )
    short_body = F.substring("body", 1, lexicons.FALLBACK_TEXT_CHARS)
    organization = F.get_json_object(F.col("job.hiringOrganization"), "$.name")
    return texts.select(
        "page_id",
        "url",
        has_job.alias("has_job"),
        F.when(has_job, field("title")).otherwise(F.coalesce("heading", empty)).alias("titulo"),
        F.coalesce(organization, empty).alias("empresa"),
        field("employmentType").alias("tipo_emprego"),
        location_text(F.col("job.jobLocation")).alias("localizacao"),
        field("datePosted").alias("data_publicacao"),
        F.when(has_job, F.col("body")).otherwise(short_body).alias("descricao_texto"),
    )


def assemble_postings(
    pages: DataFrame, run_date: str, source: str = lexicons.SOURCE_NAME
) -> DataFrame:
    """Posting records of detail pages, with source and collection date."""
    return job_fields(pages).select(
        F.col("page_id").alias("doc_id"),
        "titulo",
        "empresa",
        "tipo_emprego",
        "localizacao",
        "data_publicacao",
        "descricao_texto",
        F.col("url").alias("link"),
        F.lit(source).alias("origem"),
        F.lit(run_date).alias("data_coleta"),
    )


def _bits(url: str) -> list[Column]:
    """Place and bits of a URL in the filter: three bits of one of its words."""
    hashed = F.xxhash64(url)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(hashed, n), F.lit(64)).cast("int")) for n in (20, 32, 44)]
    return [
        F.pmod(hashed, F.lit(FILTER_WORDS)).alias("_word"),
        bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).alias("_bits"),
    ]


def wanted_pages(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """The pages of the wanted URLs, whatever their number.

    A Bloom filter of fixed size, summed from the URLs by the cluster, is joined to the pages
    first: it is small by construction, and most pages that nobody wants go
    before they are moved or parsed.  The exact join takes the few that it lets through.
    """
    words = urls.select(*_bits("url")).groupBy("_word").agg(F.bit_or("_bits").alias("_filter"))
    hopeful = (
        pages.select(*pages.columns, *_bits("url"))
        .join(F.broadcast(words), "_word")
        .filter(F.col("_filter").bitwiseAND(F.col("_bits")) == F.col("_bits"))
        .select(*pages.columns)
    )
    return hopeful.join(urls.select("url").distinct(), "url")


def collect_postings(
    listing: DataFrame,
    pages: DataFrame,
    run_date: str,
    max_jobs: int = lexicons.MAX_JOBS,
    pages_per_category: int = lexicons.PAGES_PER_CATEGORY,
    domain: str = lexicons.SITE_DOMAIN,
    prefix: str = lexicons.LINK_PREFIX,
    source: str = lexicons.SOURCE_NAME,
) -> DataFrame:
    """Whole collection: listing pages to URLs to stored pages to postings.

    Listing and detail pages that failed (null html) are skipped.  The wanted URLs are
    written once, as the filter and the join both read them.
    """
    urls = stored(frontier(listing, max_jobs, pages_per_category, domain, prefix).select("url"), "wanted-urls")
    return assemble_postings(wanted_pages(pages, urls), run_date, source)
