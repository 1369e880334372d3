"""The same results stated as SQL on the supplied tables.

Written from the meaning of each operator with set-based SQL (joins, windows,
unnested rows), not from the Spark expressions.
"""

from __future__ import annotations

import re

from jobsift import lexicons
from jobsift.functions.stem import IRREGULAR, STEP2, STEP3, STEP4
from jobsift.operators.annotate import SYMBOLS, WORD_CLASSES
from jobsift.plans.views import COLLECTED_LISTING_SQL, COLLECTED_PAGES_SQL, JOB_PAGES_SQL, LISTING_SQL, POSTINGS_SQL

TEXT = "descricao_texto"
DOMAIN = "https://jobs.example.com"
ORACLES: dict[str, str] = {}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(words) -> str:
    return "[" + ", ".join(quoted(w) for w in words) + "]"


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


POSTINGS = f"postings AS ({POSTINGS_SQL})"
JOB_PAGES = f"job_pages AS ({JOB_PAGES_SQL})"
LISTING = f"listing AS ({LISTING_SQL})"

# ------------------------------------------------------- scans and sinks

ORACLES["s1_s3_csv_round_trip"] = with_(
    POSTINGS,
    select=f"SELECT doc_id, nullif(titulo, '') AS titulo, nullif({TEXT}, '') AS {TEXT} FROM postings",
)
ORACLES["s1_split_csv"] = ORACLES["s1_s3_csv_round_trip"]
ORACLES["s1_reference_layout"] = with_(
    POSTINGS,
    select=f"""SELECT 'https://jobs.example/' || doc_id AS link, nullif(titulo, '') AS titulo, nullif({TEXT}, '') AS {TEXT},
 CAST(NULL AS VARCHAR) AS empresa, CAST(doc_id AS VARCHAR) AS extra, CAST(1 AS BIGINT) AS rows_of_key FROM postings""",
)
ORACLES["s9_page_scan"] = "SELECT page_id, url, length(html) AS html_chars FROM pages"
ORACLES["s10_first_rows"] = with_(
    POSTINGS, select="SELECT doc_id, titulo FROM postings ORDER BY doc_id LIMIT 100"
)

# ---------------------------------------------------------------- web pages

HREFS = """hrefs AS (
 SELECT page_id, i - 1 AS pos, l[i] AS href
 FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages),
  unnest(range(1, len(l) + 1)) AS u(i))"""
ABSOLUTE = f"""CASE WHEN href = '' THEN '' WHEN starts_with(href, 'http') THEN href
  WHEN starts_with(href, '/') THEN '{DOMAIN}' || href ELSE '{DOMAIN}/' || href END"""
ORACLES["w1_absolute_urls"] = with_(
    HREFS, select=f"SELECT page_id, pos, href, {ABSOLUTE} AS url FROM hrefs"
)
LINKS = f"""links AS (
 SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY first) - 1 AS pos, url
 FROM (SELECT page_id, {ABSOLUTE} AS url, min(pos) AS first FROM hrefs
  WHERE starts_with(href, '/') GROUP BY ALL))"""
ORACLES["w2_listing_links"] = with_(HREFS, LINKS, select="SELECT page_id, pos, url FROM links")
PAGES_READ = """sizes AS (
 SELECT cat_order, page, page_id, (SELECT count(*) FROM links k WHERE k.page_id = l.page_id) AS n_links
 FROM listing l),
few AS (
 SELECT *, coalesce(sum(CASE WHEN n_links < 5 THEN 1 ELSE 0 END) OVER (PARTITION BY cat_order
  ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS few_before FROM sizes),
summed AS (
 SELECT cat_order, page, page_id, n_links, coalesce(sum(n_links) OVER (ORDER BY cat_order, page
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS links_before
 FROM few WHERE few_before = 0),
pages_read AS (SELECT * FROM summed WHERE links_before < 500)"""
ORACLES["w3_pages_read"] = with_(
    HREFS, LINKS, LISTING, PAGES_READ,
    select="""SELECT cat_order::BIGINT AS cat_order, page::BIGINT AS page, n_links,
 links_before::BIGINT AS links_before FROM pages_read""",
)
FIRST_SEEN = """SELECT url, cat_order::BIGINT AS cat_order, page::BIGINT AS page, pos FROM (
  SELECT url, cat_order, page, pos, row_number() OVER (PARTITION BY url ORDER BY cat_order, page, pos) AS rn
  FROM links JOIN {source} USING (page_id))
 WHERE rn = 1 ORDER BY cat_order, page, pos LIMIT 500"""
ORACLES["w4_first_seen_urls"] = with_(HREFS, LINKS, LISTING, select=FIRST_SEEN.format(source="listing"))
ORACLES["w2_w4_frontier"] = with_(
    HREFS, LINKS, LISTING, PAGES_READ, select=FIRST_SEEN.format(source="pages_read")
)

JOBS = """blocks AS (
 SELECT page_id, i, l[i] AS block
 FROM (SELECT page_id, regexp_extract_all(html, '<script type="application/ld\\+json">(.*?)</script>', 1, 's') AS l
  FROM job_pages), unnest(range(1, len(l) + 1)) AS u(i)),
items AS (
 SELECT page_id, i, 0 AS j, block::JSON AS o FROM blocks
 WHERE json_valid(block) AND json_type(block) = 'OBJECT'
 UNION ALL
 SELECT page_id, i, j, json_extract(block, '$[' || j || ']') AS o
 FROM (SELECT * FROM blocks WHERE json_valid(block) AND json_type(block) = 'ARRAY'),
  unnest(range(0, json_array_length(block)::BIGINT)) AS u(j)),
jobs AS (
 SELECT page_id, o FROM items WHERE json_extract_string(o, '$."@type"') = 'JobPosting'
 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY i, j) = 1),
fields AS (
 SELECT page_id, json_extract_string(o, '$.title') AS title,
  json_extract_string(o, '$.description') AS description,
  json_extract_string(o, '$.datePosted') AS "datePosted",
  json_extract_string(o, '$.employmentType') AS "employmentType",
  json_extract_string(o, '$.hiringOrganization') AS "hiringOrganization",
  json_extract_string(o, '$.jobLocation') AS "jobLocation",
  coalesce(json_extract_string(o, '$.hiringOrganization.name'), '') AS empresa,
  json_extract(o, '$.jobLocation') AS location FROM jobs),
places AS (
 SELECT page_id, 0 AS j, location AS p FROM fields WHERE json_type(location) = 'OBJECT'
 UNION ALL
 SELECT page_id, j, json_extract(location, '$[' || j || ']') FROM (SELECT * FROM fields
  WHERE json_type(location) = 'ARRAY'), unnest(range(0, json_array_length(location)::BIGINT)) AS u(j)),
place_texts AS (
 SELECT page_id, j, concat_ws(', ', nullif(json_extract_string(p, '$.address.addressLocality'), ''),
  nullif(json_extract_string(p, '$.address.addressRegion'), ''),
  nullif(json_extract_string(p, '$.address.addressCountry'), '')) AS place FROM places),
locations AS (
 SELECT page_id, string_agg(place, ', ' ORDER BY j) AS localizacao FROM place_texts
 WHERE place <> '' GROUP BY page_id)"""


def visible_text(expression: str, separator: str) -> str:
    """Visible text in plain SQL, for markup with the entities these pages use."""
    marked = (
        f"regexp_replace(regexp_replace({expression},"
        " '<!--.*?-->|<script.*?</script>|<style.*?</style>', chr(1), 'gs'), '<[^>]*>', chr(1), 'g')"
    )
    decode = "x"
    for entity, character in [
        ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"),
    ]:
        decode = f"replace({decode}, '{entity}', '{character}')"
    trimmed = rf"regexp_replace({decode}, '^\s+|\s+$', '', 'g')"
    strings = f"list_filter(list_transform(string_split({marked}, chr(1)), lambda x: {trimmed}), lambda x: x <> '')"
    return f"coalesce(array_to_string({strings}, '{separator}'), '')"


HEADING = r"regexp_extract(html, '<h1[^>]*>.*?</h1>', 0, 's')"
POSTING_ROWS = f"""posting_rows AS (
 SELECT page_id, url, f.page_id IS NOT NULL AS has_job,
  CASE WHEN f.page_id IS NOT NULL THEN coalesce(f.title, '') ELSE {visible_text(HEADING, '')} END AS titulo,
  coalesce(f.empresa, '') AS empresa, coalesce(f."employmentType", '') AS tipo_emprego,
  coalesce(localizacao, '') AS localizacao, coalesce(f."datePosted", '') AS data_publicacao,
  CASE WHEN f.page_id IS NOT NULL THEN {visible_text("coalesce(f.description, '')", ' ')}
   ELSE substring({visible_text('html', ' ')}, 1, 2000) END AS {TEXT}
 FROM job_pages LEFT JOIN fields f USING (page_id) LEFT JOIN locations USING (page_id)
 WHERE html IS NOT NULL)"""
PAGE_CTES = (JOB_PAGES, JOBS, POSTING_ROWS)
ORACLES["w5_job_posting"] = with_(
    JOB_PAGES, JOBS,
    select="""SELECT page_id, title, description, "datePosted", "employmentType", "hiringOrganization",
 "jobLocation" FROM fields""",
)
ORACLES["w6_job_fields"] = with_(
    *PAGE_CTES,
    select=f"""SELECT page_id, titulo, empresa, tipo_emprego, data_publicacao, {TEXT}
 FROM posting_rows WHERE has_job""",
)
ORACLES["w7_locations"] = with_(*PAGE_CTES, select="SELECT page_id, localizacao FROM posting_rows")
ORACLES["w8_visible_text"] = f"SELECT page_id, {visible_text('html', ' ')} AS text FROM pages"
ORACLES["w9_fallback"] = with_(
    *PAGE_CTES, select=f"SELECT page_id, titulo, empresa, {TEXT} FROM posting_rows WHERE NOT has_job"
)
ORACLES["w10_postings"] = with_(
    *PAGE_CTES,
    select=f"""SELECT page_id AS doc_id, titulo, empresa, tipo_emprego, localizacao, data_publicacao,
 {TEXT}, url AS link, 'Stored pages' AS origem, '2024-01-31' AS data_coleta FROM posting_rows""",
)
ORACLES["s4_raw_postings_sink"] = with_(
    *PAGE_CTES,
    select=f"""SELECT page_id AS doc_id, nullif(titulo, '') AS titulo, nullif(empresa, '') AS empresa,
 nullif(tipo_emprego, '') AS tipo_emprego, nullif(localizacao, '') AS localizacao,
 nullif(data_publicacao, '') AS data_publicacao, nullif({TEXT}, '') AS {TEXT}, url AS link,
 'Stored pages' AS origem, '2024-01-31' AS data_coleta FROM posting_rows""",
)
ORACLES["w_collect_postings"] = with_(
    f"listing AS ({COLLECTED_LISTING_SQL})",
    HREFS.replace("FROM pages)", "FROM listing)"),
    LINKS.replace("starts_with(href, '/')", "starts_with(href, '/remote-jobs/')", 2).replace(
        "WHEN starts_with(href, '/remote-jobs/') THEN", "WHEN starts_with(href, '/') THEN"
    ),
    PAGES_READ.replace("n_links < 5", "n_links < 5 AND html IS NOT NULL").replace(
        "SELECT cat_order, page, page_id, (SELECT", "SELECT cat_order, page, page_id, html, (SELECT"
    ),
    f"first_seen AS ({FIRST_SEEN.format(source='pages_read')})",
    f"job_pages AS (SELECT * FROM ({COLLECTED_PAGES_SQL}) WHERE url IN (SELECT url FROM first_seen))",
    JOBS,
    POSTING_ROWS,
    select=f"""SELECT page_id AS doc_id, titulo, empresa, tipo_emprego, localizacao, data_publicacao,
 {TEXT}, url AS link, 'Stored pages' AS origem, '2024-01-31' AS data_coleta FROM posting_rows""",
)
SOURCES = ", ".join(f"({i}, {quoted(u)})" for i, u in enumerate(lexicons.CATEGORY_URLS))
ORACLES["w11_source_list"] = with_(
    LISTING,
    select=f"""SELECT c.cat_order::BIGINT AS cat_order, base_url, count(page_id) AS n_pages
 FROM (VALUES {SOURCES}) AS c(cat_order, base_url) LEFT JOIN listing l ON l.cat_order = c.cat_order
 GROUP BY ALL""",
)

# ------------------------------------------------------------ regex features


def matches(pattern: str) -> str:
    """Trimmed matches with their position, one row each."""
    return rf"""
 SELECT doc_id, i AS pos, regexp_replace(l[i], '^\s+|\s+$', '', 'g') AS value
 FROM (SELECT doc_id, regexp_extract_all({TEXT}, {quoted('(?i)' + pattern)}) AS l FROM postings),
  unnest(range(1, len(l) + 1)) AS u(i)"""


def distinct_matches(pattern: str) -> str:
    return f"""
 SELECT doc_id, pos, value FROM ({matches(pattern)}) WHERE value <> ''
 QUALIFY row_number() OVER (PARTITION BY doc_id, lower(value) ORDER BY pos) = 1"""


def joined_feature(pattern: str, name: str, first: int | None = None) -> str:
    cap = f"QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pos) <= {first}" if first else ""
    return f"""{name}_rows AS ({distinct_matches(pattern)}),
{name}_t AS (SELECT doc_id, string_agg(value, ', ' ORDER BY pos) AS {name}
 FROM (SELECT * FROM {name}_rows {cap}) GROUP BY doc_id)"""


def skill_rows(words: list[str]) -> str:
    rows = ", ".join(f"({i}, {quoted(s)})" for i, s in enumerate(words))
    return f"""SELECT doc_id, idx, skill FROM postings, (VALUES {rows}) AS s(idx, skill)
 WHERE contains(lower({TEXT}), skill)"""


SKILLS_T = f"""skills_re_t AS (SELECT doc_id, string_agg(skill, ', ' ORDER BY idx) AS skills_re
 FROM ({skill_rows(lexicons.POSTING_SKILLS)}) GROUP BY doc_id)"""
FEATURES = {
    "senioridade_re": joined_feature(lexicons.SENIORITY_PATTERN, "senioridade_re"),
    "regime_re": joined_feature(lexicons.REGIME_PATTERN, "regime_re"),
    "salario_re": joined_feature(lexicons.SALARY_PATTERN, "salario_re"),
    "carga_horaria_re": joined_feature(lexicons.WORKLOAD_PATTERN, "carga_horaria_re"),
    "urls_re": joined_feature(lexicons.URL_PATTERN, "urls_re", 5),
    "emails_re": joined_feature(lexicons.EMAIL_PATTERN, "emails_re", 5),
    "skills_re": SKILLS_T,
}


def feature_select(*names: str) -> str:
    columns = ", ".join(f"coalesce({n}, '') AS {n}" for n in names)
    joins = " ".join(f"LEFT JOIN {n}_t USING (doc_id)" for n in names)
    return with_(
        POSTINGS, *[FEATURES[n] for n in names], select=f"SELECT doc_id, {columns} FROM postings {joins}"
    )


for _key, _name in {
    "r1_seniority": "senioridade_re",
    "r2_regime": "regime_re",
    "r3_salary": "salario_re",
    "r4_workload": "carga_horaria_re",
    "r5_r9_urls": "urls_re",
    "r6_r9_emails": "emails_re",
    "r11_skills": "skills_re",
}.items():
    ORACLES[_key] = feature_select(_name)
ORACLES["r12_all_features"] = feature_select(*FEATURES)
ORACLES["r7_all_matches"] = with_(
    POSTINGS, select=f"SELECT doc_id, pos - 1 AS pos, value FROM ({matches(lexicons.REGIME_PATTERN)})"
)
ORACLES["r8_distinct_ignore_case"] = with_(
    POSTINGS,
    select=f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos, value
 FROM ({distinct_matches(lexicons.REGIME_PATTERN)})""",
)
ORACLES["r10_joined_seniority_and_regime"] = with_(
    POSTINGS,
    FEATURES["senioridade_re"],
    FEATURES["regime_re"],
    select="""SELECT doc_id, concat_ws(', ', senioridade_re, regime_re) AS terms FROM postings
 LEFT JOIN senioridade_re_t USING (doc_id) LEFT JOIN regime_re_t USING (doc_id)""",
)

# ------------------------------------------------------------------ clean text


def normalized(column: str) -> str:
    return (
        rf"trim(regexp_replace(regexp_replace(regexp_replace(lower({column}), 'http\S+|www\.\S+', ' ', 'g'),"
        r" '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))"
    )


def tokens_cte(source: str, column: str) -> str:
    """words(doc_id, pos, token): words after splitting contractions."""
    parts = ", ".join(f"({quoted(f)}, {quoted(p)})" for f, p in lexicons.CONTRACTIONS.items())
    return f"""raw_words AS (
 SELECT doc_id, i AS pos, l[i] AS token FROM (SELECT doc_id, string_split({normalized(column)}, ' ') AS l
  FROM {source}), unnest(range(1, len(l) + 1)) AS u(i)),
words AS (
 SELECT doc_id, pos * 2 + j AS pos, p[j] AS token
 FROM (SELECT doc_id, pos, string_split(coalesce(parts, token), ' ') AS p
  FROM raw_words LEFT JOIN (VALUES {parts}) AS c(form, parts) ON token = form), unnest(range(1, len(p) + 1)) AS u(j)
 WHERE p[j] <> ''),
long_words AS (SELECT * FROM words WHERE length(token) > 2),
content AS (SELECT * FROM long_words WHERE NOT list_contains({listed(lexicons.ENGLISH_STOP_WORDS)}, token))"""


def rejoined(rows: str, source: str = "documents", column: str = "token", name: str = "tokens") -> str:
    return f"""SELECT d.doc_id, coalesce(string_agg({column}, ' ' ORDER BY pos), '') AS {name}
 FROM {source} d LEFT JOIN {rows} r ON r.doc_id = d.doc_id GROUP BY d.doc_id"""


TOKENS = tokens_cte("documents", "text")
ORACLES["t1_t3_normalized"] = f"SELECT doc_id, {normalized('text')} AS text FROM documents"
ORACLES["t4_word_tokens"] = with_(TOKENS, select=rejoined("words"))
ORACLES["t5_long_tokens"] = with_(TOKENS, select=rejoined("long_words"))
ORACLES["t6_content_tokens"] = with_(TOKENS, select=rejoined("content"))
LEMMAS = """vocabulary AS (SELECT DISTINCT token FROM content),
lemma AS (
 SELECT v.token AS form, s.token AS lemma FROM vocabulary v JOIN vocabulary s ON v.token = s.token || 's'
 WHERE length(v.token) > 3),
lemmatized AS (
 SELECT doc_id, pos, coalesce(lemma, token) AS word FROM content LEFT JOIN lemma ON token = form)"""
ORACLES["t7_lemmas"] = with_(
    TOKENS, LEMMAS, select=rejoined("lemmatized", column="word", name="lemmas")
)
ORACLES["t9_rejoined_lemmas"] = with_(
    TOKENS, LEMMAS, select=rejoined("lemmatized", column="word", name="text_clean")
)

# stems: the same published rules as successive updates of a vocabulary table,
# where s is the word written as V (vowel) and C (consonant)


def cut(k: int, column: str = "w") -> str:
    return f"left({column}, (length({column}) - {k})::INT)"


def measure(k: int) -> str:
    """Vowel-consonant groups of the word without its last k letters."""
    return f"(length({cut(k, 's')}) - length(replace({cut(k, 's')}, 'VC', ''))) // 2"


def short(k: int) -> str:
    return (
        f"({cut(k, 's')} = 'VC' OR (ends_with({cut(k, 's')}, 'CVC')"
        f" AND right({cut(k)}, 1) NOT IN ('w', 'x', 'y')))"
    )


def stem_step(name: str, previous: str, expression: str) -> str:
    shape = "regexp_replace(regexp_replace(w, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g')"
    shape = f"regexp_replace({shape}, '^y', 'C')"
    for _ in range(4):
        shape = f"replace(replace({shape}, 'Cy', 'CV'), 'Vy', 'VC')"
    return f"""{name} AS (SELECT token, w, {shape} AS s, before FROM (
 SELECT token, {expression} AS w, w AS before FROM {previous}))"""


def suffix_cases(table: dict[str, str], more_than: int) -> str:
    cases = ""
    for suffix in sorted(table, key=len, reverse=True):
        k = len(suffix)
        extra = f" AND right({cut(k)}, 1) IN ('s', 't')" if suffix == "ion" else ""
        cases += (
            f" WHEN ends_with(w, '{suffix}') THEN CASE WHEN {measure(k)} > {more_than}{extra}"
            f" THEN {cut(k)} || '{table[suffix]}' ELSE w END"
        )
    return cases


def ended(suffix: str) -> str:
    return f"ends_with(w, '{suffix}')"


STEM_STEPS = [
    stem_step("p0", "(SELECT DISTINCT token, token AS w FROM content)", "w"),
    stem_step("p1", "p0", f"""CASE WHEN {ended('ies')} THEN CASE WHEN length(w) = 4 THEN {cut(1)} ELSE {cut(2)} END
  WHEN {ended('sses')} THEN {cut(2)} WHEN {ended('ss')} THEN w WHEN {ended('s')} THEN {cut(1)} ELSE w END"""),
    stem_step("p2", "p1", f"""CASE WHEN {ended('ied')} THEN CASE WHEN length(w) = 4 THEN {cut(1)} ELSE {cut(2)} END
  WHEN {ended('eed')} THEN CASE WHEN {measure(3)} > 0 THEN {cut(1)} ELSE w END
  WHEN {ended('ed')} AND contains({cut(2, 's')}, 'V') THEN {cut(2)}
  WHEN {ended('ing')} AND contains({cut(3, 's')}, 'V') THEN {cut(3)} ELSE w END"""),
    stem_step("p3", "p2", f"""CASE WHEN NOT ((ends_with(before, 'ed') AND length(before) - length(w) = 2
   AND NOT ends_with(before, 'eed') AND NOT ends_with(before, 'ied'))
   OR (ends_with(before, 'ing') AND length(before) - length(w) = 3)) THEN w
  WHEN {ended('at')} OR {ended('bl')} OR {ended('iz')} THEN w || 'e'
  WHEN length(w) > 1 AND right(w, 1) = left(right(w, 2), 1) AND right(s, 1) = 'C'
   THEN CASE WHEN right(w, 1) IN ('l', 's', 'z') THEN w ELSE {cut(1)} END
  WHEN {measure(0)} = 1 AND {short(0)} THEN w || 'e' ELSE w END"""),
    stem_step("p4", "p3", f"""CASE WHEN {ended('y')} AND length(w) > 2 AND right({cut(1, 's')}, 1) = 'C'
  THEN {cut(1)} || 'i' ELSE w END"""),
    stem_step("p5", "p4", f"CASE WHEN {ended('alli')} AND {measure(4)} > 0 THEN {cut(2)} ELSE w END"),
    stem_step("p6", "p5", f"""CASE WHEN {ended('logi')} THEN CASE WHEN {measure(3)} > 0 THEN {cut(1)} ELSE w END
 {suffix_cases(STEP2, 0)} ELSE w END"""),
    stem_step("p7", "p6", f"CASE {suffix_cases(STEP3, 0)} ELSE w END"),
    stem_step("p8", "p7", f"CASE {suffix_cases(dict.fromkeys(STEP4, ''), 1)} ELSE w END"),
    stem_step("p9", "p8", f"""CASE WHEN {ended('e')} AND ({measure(1)} > 1 OR ({measure(1)} = 1 AND NOT {short(1)}))
  THEN {cut(1)} ELSE w END"""),
    stem_step("p10", "p9", f"CASE WHEN {ended('ll')} AND {measure(1)} > 1 THEN {cut(1)} ELSE w END"),
    "irregular(word, fixed) AS (VALUES "
    + ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in IRREGULAR.items())
    + ")",
    """stems AS (
 SELECT c.doc_id, c.pos, coalesce(fixed, w) AS stem FROM content c JOIN p10 USING (token)
 LEFT JOIN irregular ON word = c.token)""",
]
ORACLES["t8_stems"] = with_(
    TOKENS, *STEM_STEPS, select=rejoined("stems", column="stem", name="stems")
)
ORACLES["t9_clean_text"] = with_(
    TOKENS, *STEM_STEPS, select=rejoined("stems", column="stem", name="text_clean")
)

# ---------------------------------------------------------------------- TF-IDF


def terms_cte(source: str, column: str, prefix: str = "") -> str:
    """term lists per document, then counts."""
    p = prefix
    return rf"""{p}word_lists AS (
 SELECT doc_id, regexp_extract_all(lower({column}), '[\p{{L}}\p{{N}}_]{{2,}}') AS w FROM {source}),
{p}term_lists AS (
 SELECT doc_id, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS terms
 FROM {p}word_lists),
{p}counted AS (
 SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM {p}term_lists) GROUP BY ALL),
{p}frequencies AS (
 SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM {p}counted GROUP BY term)"""


def vocabulary_cte(k: int, source: str, prefix: str = "") -> str:
    return f"""vocab AS (
 SELECT row_number() OVER (ORDER BY term) - 1 AS term_id, term, cf, df,
  ln((1.0 + (SELECT count(*) FROM {source})) / (1.0 + df)) + 1 AS idf
 FROM (SELECT * FROM {prefix}frequencies ORDER BY cf DESC, term LIMIT {k}))"""


def matrix_cte(prefix: str = "") -> str:
    return f"""weighted AS (
 SELECT doc_id, term_id, term, tf, tf * idf AS w FROM {prefix}counted JOIN vocab USING (term)),
matrix AS (
 SELECT doc_id, term_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM weighted)"""


DOC_TERMS = terms_cte("documents", "text")
MATRIX_SELECT = "SELECT doc_id, term_id, term, tf, round(tfidf, 6) AS tfidf FROM matrix"
ORACLES["f1_terms"] = with_(
    DOC_TERMS,
    select="""SELECT doc_id, len(terms) AS n_terms, md5(coalesce(array_to_string(terms, '|'), '')) AS terms_md5
 FROM term_lists""",
)
ORACLES["f2_term_counts"] = with_(DOC_TERMS, select="SELECT doc_id, term, tf FROM counted")
ORACLES["f2_term_frequencies"] = with_(DOC_TERMS, select="SELECT term, df, cf FROM frequencies")
VOCAB = vocabulary_cte(5000, "documents")
ORACLES["f3_f4_f6_vocabulary"] = with_(
    DOC_TERMS, VOCAB, select="SELECT term_id, term, cf, df, round(idf, 6) AS idf FROM vocab"
)
ORACLES["s6_vocabulary_sink"] = with_(
    DOC_TERMS, VOCAB, select="SELECT term_id, term, round(idf, 6) AS idf FROM vocab"
)
ORACLES["f5_tfidf"] = with_(DOC_TERMS, VOCAB, matrix_cte(), select=MATRIX_SELECT)
ORACLES["s5_tfidf_sink"] = with_(
    DOC_TERMS, VOCAB, matrix_cte(),
    select="SELECT doc_id, term_id, round(tfidf, 6) AS tfidf FROM matrix",
)
ORACLES["f8_matrix"] = with_(
    DOC_TERMS, vocabulary_cte(5000, "documents"), matrix_cte(), select=MATRIX_SELECT
)
ORACLES["f7_transform"] = with_(
    "english AS (SELECT * FROM documents WHERE lang = 'en')",
    "others AS (SELECT * FROM documents WHERE lang <> 'en')",
    terms_cte("english", "text", "fit_"),
    terms_cte("others", "text"),
    vocabulary_cte(5000, "english", "fit_"),
    matrix_cte(),
    select=MATRIX_SELECT,
)

# ----------------------------------------------------------------- annotations

CLASS_CASES = "\n".join(f"  WHEN list_contains({listed(words)}, lemma) THEN '{tag}'" for tag, words in WORD_CLASSES.items())
ANNOTATIONS = rf"""sentence_lists AS (
 SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
  lambda s: regexp_matches(s, '\S')) AS s FROM documents),
sentences AS (
 SELECT doc_id, i - 1 AS sent, regexp_extract_all(s[i], '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}\p{{Mn}}_\s]') AS w
 FROM sentence_lists, unnest(range(1, len(s) + 1)) AS u(i)),
words AS (SELECT doc_id, sent, i, w[i] AS text, lower(w[i]) AS lemma FROM sentences, unnest(range(1, len(w) + 1)) AS u(i)),
tokens AS (
 SELECT doc_id, sent, row_number() OVER (PARTITION BY doc_id ORDER BY sent, i) - 1 AS pos, text, lemma,
  CASE WHEN list_contains({listed(SYMBOLS)}, text) THEN 'SYM'
  WHEN NOT regexp_matches(text, '[\p{{L}}\p{{N}}_]') THEN 'PUNCT'
  WHEN regexp_full_match(text, '[0-9]+') THEN 'NUM'
{CLASS_CASES}
  WHEN regexp_matches(text, '^\p{{Lu}}') AND i > 1 THEN 'PROPN'
  WHEN ends_with(lemma, 'ly') THEN 'ADV'
  WHEN ends_with(lemma, 'ing') OR ends_with(lemma, 'ed') THEN 'VERB' ELSE 'NOUN' END AS upos,
  false AS is_space, regexp_full_match(text, '\p{{L}}+') AS is_alpha,
  list_contains({listed(lexicons.ENGLISH_STOP_WORDS)}, lemma) AS is_stop FROM words)"""
SIZES = """sizes AS (
 SELECT d.doc_id, count(t.pos) AS n_tokens, count(DISTINCT t.sent) AS n_sent
 FROM documents d LEFT JOIN tokens t ON t.doc_id = d.doc_id GROUP BY d.doc_id)"""


def top_values(name: str, rows: str, value: str, k: int) -> str:
    return f"""{name} AS (
 SELECT doc_id, string_agg(value, ', ' ORDER BY rn) AS {name} FROM (
  SELECT doc_id, {value} AS value,
   row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(pos)) AS rn
  FROM ({rows}) GROUP BY doc_id, {value}) WHERE rn <= {k} GROUP BY doc_id)"""


def first_distinct(name: str, rows: str, value: str, k: int) -> str:
    return f"""{name} AS (
 SELECT doc_id, string_agg(value, ', ' ORDER BY rn) AS {name} FROM (
  SELECT doc_id, {value} AS value,
   row_number() OVER (PARTITION BY doc_id ORDER BY min(struct_pack(pos := pos, n := length(text)))) AS rn
  FROM ({rows}) GROUP BY doc_id, {value}) WHERE rn <= {k} GROUP BY doc_id)"""


CHUNKS = """nouns AS (
 SELECT doc_id, sent, pos, text, pos - row_number() OVER (PARTITION BY doc_id, sent ORDER BY pos) AS island
 FROM tokens WHERE upos IN ('NOUN', 'PROPN')),
chunks AS (
 SELECT doc_id, min(pos) AS pos, lower(string_agg(text, ' ' ORDER BY pos)) AS chunk
 FROM nouns GROUP BY doc_id, sent, island)"""
SPANS = """names AS (SELECT * FROM tokens WHERE is_alpha AND regexp_matches(text, '^\\p{Lu}')),
surfaces AS (
 SELECT text AS surface FROM names WHERE length(text) >= 6
 UNION
 SELECT a.text || ' ' || b.text FROM names a JOIN names b
  ON a.doc_id = b.doc_id AND a.sent = b.sent AND b.pos = a.pos + 1),
gazetteer AS (
 SELECT surface, ['ORG', 'GPE', 'LOC', 'PRODUCT'][length(surface) % 4 + 1] AS label FROM surfaces),
grams AS (
 SELECT doc_id, pos, text FROM tokens
 UNION ALL
 SELECT a.doc_id, a.pos, a.text || ' ' || b.text FROM tokens a JOIN tokens b
  ON a.doc_id = b.doc_id AND a.sent = b.sent AND b.pos = a.pos + 1),
spans AS (SELECT doc_id, pos, text, label FROM grams JOIN gazetteer ON text = surface)"""
ORG = "SELECT * FROM spans WHERE label = 'ORG'"
PLACE = "SELECT * FROM spans WHERE label IN ('GPE', 'LOC')"
OTHER = "SELECT * FROM spans WHERE label NOT IN ('ORG', 'GPE', 'LOC')"
SUMMARIES = {
    "spacy_top_lemmas": top_values(
        "spacy_top_lemmas",
        "SELECT * FROM tokens WHERE is_alpha AND NOT is_stop AND length(lemma) > 2", "lemma", 8,
    ),
    "adv_top_pos": top_values("adv_top_pos", "SELECT * FROM tokens", "upos", 6),
    "adv_top_noun_chunks": top_values(
        "adv_top_noun_chunks", "SELECT * FROM chunks WHERE length(chunk) BETWEEN 2 AND 50", "chunk", 8
    ),
    "spacy_orgs": first_distinct("spacy_orgs", ORG, "text", 6),
    "adv_orgs": first_distinct("adv_orgs", ORG, "text", 8),
    "spacy_places": first_distinct("spacy_places", PLACE, "text", 6),
    "adv_places": first_distinct("adv_places", PLACE, "text", 8),
    "adv_other_ents": first_distinct("adv_other_ents", OTHER, "text || '(' || label || ')'", 8),
}
COUNTS = {
    "spacy_tokens": "n_tokens",
    "spacy_sentences": "n_sent",
    "adv_tokens": "n_tokens",
    "adv_sentences": "greatest(n_sent, 1)",
    "adv_tokens_per_sentence": "round(n_tokens / greatest(n_sent, 1)::DOUBLE, 2)",
}


def summary_select(*names: str) -> str:
    texts = [n for n in names if n in SUMMARIES]
    ctes = [ANNOTATIONS, SIZES]
    if "adv_top_noun_chunks" in texts:
        ctes.append(CHUNKS)
    if any(n.endswith(("orgs", "places", "ents")) for n in texts):
        ctes.append(SPANS)
    ctes += [SUMMARIES[n] for n in texts]
    columns = ", ".join(
        f"{COUNTS[n]} AS {n}" if n in COUNTS else f"coalesce({n}.{n}, '') AS {n}" for n in names
    )
    joins = " ".join(f"LEFT JOIN {n} USING (doc_id)" for n in texts)
    return with_(*ctes, select=f"SELECT doc_id, {columns} FROM sizes {joins}")


ORACLES["n1_annotations"] = with_(
    ANNOTATIONS,
    select="SELECT doc_id, sent, pos, text, lemma, upos, is_space, is_alpha, is_stop FROM tokens",
)
for _key, _names in {
    "n3_token_count": ["spacy_tokens"],
    "n4_sentence_count": ["spacy_sentences", "adv_sentences"],
    "n5_tokens_per_sentence": ["adv_tokens_per_sentence"],
    "n6_top_lemmas": ["spacy_top_lemmas"],
    "n7_organisations": ["spacy_orgs", "adv_orgs"],
    "n8_places": ["spacy_places", "adv_places"],
    "n9_other_entities": ["adv_other_ents"],
    "n10_top_pos": ["adv_top_pos"],
    "n11_top_noun_chunks": ["adv_top_noun_chunks"],
    "n13_summaries": [
        "spacy_sentences", "spacy_tokens", "spacy_top_lemmas", "spacy_orgs", "spacy_places",
        "adv_tokens", "adv_sentences", "adv_tokens_per_sentence", "adv_top_pos",
        "adv_top_noun_chunks", "adv_orgs", "adv_places", "adv_other_ents",
    ],
}.items():
    ORACLES[_key] = summary_select(*_names)
ORACLES["n12_gazetteer_spans"] = with_(
    ANNOTATIONS, SPANS, select="SELECT doc_id, pos, text, label FROM spans"
)
ORACLES["n12_spans_joined"] = ORACLES["n12_gazetteer_spans"]

# ------------------------------------------------------- labels, model, metrics


def scores_cte(source: str, text: str, title: str = "titulo") -> str:
    """evidence(doc_id, rank, label, score, boost): one row per document and area."""
    keywords = ", ".join(
        f"({rank}, {quoted(label)}, {quoted(word)}, {weight})"
        for rank, (label, weighted) in enumerate(lexicons.AREA_KEYWORDS.items())
        for weight, words in weighted.items()
        for word in words
    )
    boosts = " ".join(
        f"WHEN {quoted(label)} THEN regexp_matches(title, {quoted('(?i)' + p)})"
        f" OR regexp_matches(opening, {quoted('(?i)' + p)})"
        for label, p in lexicons.TITLE_PATTERNS.items()
    )
    return f"""lowered AS (
 SELECT doc_id, lower(coalesce({text}, '')) AS t, lower(coalesce({title}, '')) AS title,
  substring(lower(coalesce({text}, '')), 1, 300) AS opening FROM {source}),
keywords(rank, label, word, weight) AS (VALUES {keywords}),
areas AS (SELECT DISTINCT rank, label FROM keywords),
hits AS (
 SELECT doc_id, rank, sum(weight)::BIGINT AS score FROM lowered JOIN keywords ON contains(t, word) GROUP BY ALL),
evidence AS (
 SELECT l.doc_id, a.rank, a.label, coalesce(h.score, 0) AS score,
  CASE WHEN (CASE a.label {boosts} END) THEN 5 ELSE 0 END AS boost
 FROM lowered l CROSS JOIN areas a LEFT JOIN hits h ON h.doc_id = l.doc_id AND h.rank = a.rank)"""


def best_cte(name: str, score: str) -> str:
    return f"""{name} AS (
 SELECT doc_id, label, {score} AS score, CASE WHEN {score} < 2 THEN 'Outro' ELSE label END AS area
 FROM evidence QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY {score} DESC, rank) = 1)"""


SCORES = scores_cte("postings", TEXT)
BEST = best_cte("best", "score + boost")
BEST_PLAIN = best_cte("best_plain", "score")
ORACLES["l1_keyword_scores"] = with_(POSTINGS, SCORES, select="SELECT doc_id, label, score FROM evidence")
ORACLES["l2_boosted_scores"] = with_(
    POSTINGS, SCORES, select="SELECT doc_id, label, (score + boost)::BIGINT AS score FROM evidence"
)
ORACLES["l3_best_area"] = with_(
    POSTINGS, SCORES, BEST, select="SELECT doc_id, label, score::BIGINT AS score FROM best"
)
ORACLES["l4_l6_l7_labels"] = with_(
    POSTINGS, SCORES, BEST, select="SELECT doc_id, area AS label_area FROM best"
)
CLEAN_POSTINGS = (
    tokens_cte("postings", TEXT)
    + """,
clean_postings AS (
 SELECT p.doc_id, any_value(p.titulo) AS titulo, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS text_clean
 FROM postings p LEFT JOIN content c ON c.doc_id = p.doc_id GROUP BY p.doc_id)"""
)
ORACLES["l5_labels_of_clean_text"] = with_(
    POSTINGS, CLEAN_POSTINGS, scores_cte("clean_postings", "text_clean"), BEST,
    select="SELECT doc_id, area AS label_area FROM best",
)
STEMMED_POSTINGS = """stemmed_postings AS (
 SELECT p.doc_id, any_value(p.titulo) AS titulo, coalesce(string_agg(stem, ' ' ORDER BY pos), '') AS text_clean
 FROM postings p LEFT JOIN stems s ON s.doc_id = p.doc_id GROUP BY p.doc_id)"""
ORACLES["l5_labels_of_stemmed_text"] = with_(
    POSTINGS, tokens_cte("postings", TEXT), *STEM_STEPS, STEMMED_POSTINGS,
    scores_cte("stemmed_postings", "text_clean"), BEST,
    select="SELECT doc_id, area AS label_area FROM best",
)
LABELED = f"""labeled AS (SELECT doc_id, {TEXT}, area AS label_area FROM best JOIN postings USING (doc_id))"""
SPLIT = """label_sizes AS (SELECT label_area, count(*) AS n FROM labeled GROUP BY label_area),
totals AS (SELECT sum(n) AS total, ceil(round(sum(n) * 0.2, 9)) AS n_test FROM label_sizes),
shares AS (
 SELECT label_area, n, n_test, floor(n * n_test / total) AS base,
  n * n_test - floor(n * n_test / total) * total AS remainder
 FROM label_sizes, totals WHERE n > 1),
quotas AS (
 SELECT label_area, base + floor((n_test - sum(base) OVER ()) / count(*) OVER ())
  + CASE WHEN row_number() OVER (ORDER BY remainder DESC, label_area)
   <= (n_test - sum(base) OVER ()) % count(*) OVER () THEN 1 ELSE 0 END AS quota FROM shares),
split AS (
 SELECT doc_id, l.label_area, l.descricao_texto, row_number() OVER (PARTITION BY l.label_area
  ORDER BY md5('42:' || doc_id), doc_id) <= coalesce(quota, 0) AS is_test
 FROM labeled l LEFT JOIN quotas q ON q.label_area = l.label_area)"""
LABEL_CTES = (POSTINGS, SCORES, BEST, LABELED)
ORACLES["m1_split"] = with_(*LABEL_CTES, SPLIT, select="SELECT doc_id, label_area, is_test FROM split")
ORACLES["m2_test_tfidf"] = with_(
    *LABEL_CTES, SPLIT,
    "train AS (SELECT * FROM split WHERE NOT is_test)",
    "test AS (SELECT * FROM split WHERE is_test)",
    terms_cte("train", TEXT, "fit_"),
    terms_cte("test", TEXT),
    vocabulary_cte(6000, "train", "fit_"),
    matrix_cte(),
    select=MATRIX_SELECT,
)
ORACLES["m3_m4_certificate"] = with_(
    *LABEL_CTES, SPLIT,
    select="""SELECT label_area AS label, count(*) FILTER (NOT is_test) AS n_train, count(*) FILTER (is_test) AS n_test,
 0::BIGINT AS n_unequal, true AS proven FROM split GROUP BY label_area""",
)
PREDICTIONS = """predictions AS (
 SELECT doc_id, b.area AS y, p.area AS pred FROM best b JOIN best_plain p USING (doc_id))"""
PREDICTION_CTES = (POSTINGS, SCORES, BEST, BEST_PLAIN, PREDICTIONS)
ORACLES["m5_accuracy"] = with_(
    *PREDICTION_CTES,
    select="SELECT round(avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM predictions",
)


def report_select(source: str) -> str:
    return f"""SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
 support FROM (
 WITH classes AS (SELECT y AS label FROM {source} UNION SELECT pred FROM {source}),
 sums AS (
  SELECT label, (SELECT count(*) FROM {source} WHERE y = label AND pred = label) AS tp,
   (SELECT count(*) FROM {source} WHERE y = label) AS support,
   (SELECT count(*) FROM {source} WHERE pred = label) AS predicted FROM classes),
 ratios AS (
  SELECT label, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted::DOUBLE END AS precision,
   CASE WHEN support = 0 THEN 0.0 ELSE tp / support::DOUBLE END AS recall, support FROM sums),
 scored AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM ratios)
 SELECT label, precision, recall, f1, support FROM scored
 UNION ALL
 SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM scored
 UNION ALL
 SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support)::BIGINT FROM scored)"""


ORACLES["m6_class_report"] = with_(*PREDICTION_CTES, select=report_select("predictions"))
ORACLES["m6_class_report_of_labels"] = with_(
    "flags AS (SELECT quality::VARCHAR AS y, toxic::VARCHAR AS pred FROM labels)",
    select=report_select("flags"),
)
ORDER = "label_order(label_idx, label) AS (VALUES " + ", ".join(
    f"({i}, {quoted(name)})" for i, name in enumerate(lexicons.AREA_LABELS)
) + ")"
CONFUSION = """SELECT a.label_idx::BIGINT AS true_idx, a.label AS true_label, b.label_idx::BIGINT AS pred_idx,
 b.label AS pred_label, (SELECT count(*) FROM predictions WHERE y = a.label AND pred = b.label) AS n
 FROM label_order a CROSS JOIN label_order b"""
ORACLES["m7_confusion_matrix"] = with_(*PREDICTION_CTES, ORDER, select=CONFUSION)
ORACLES["s7_confusion_sink"] = ORACLES["m7_confusion_matrix"]
ORACLES["s8_label_order"] = with_(
    POSTINGS, SCORES, BEST, ORDER,
    select="""SELECT row_number() OVER (ORDER BY label_idx) - 1 AS label_idx, label FROM label_order
 WHERE label IN (SELECT area FROM best)""",
)
GRID = ", ".join(
    f"sum(CASE WHEN pred = {quoted(name)} THEN 1 ELSE 0 END)::BIGINT AS \"{name}\"" for name in lexicons.AREA_LABELS
)
ORACLES["a3_confusion_grid"] = with_(
    *PREDICTION_CTES, ORDER,
    select=f"""SELECT label_idx::BIGINT AS true_idx, label AS true_label, {GRID}
 FROM label_order LEFT JOIN predictions ON y = label GROUP BY ALL""",
)

# --------------------------------------------------------------------- reports


def top_skills(words: list[str], k: int) -> str:
    return f"""SELECT skill, count(*) AS n FROM ({skill_rows(words)}) GROUP BY skill
 ORDER BY n DESC, min(struct_pack(d := doc_id, i := idx)) LIMIT {k}"""


ORACLES["a1_top_skills"] = with_(POSTINGS, select=top_skills(lexicons.REPORT_SKILLS, 20))
ORACLES["a6_top_posting_skills"] = with_(POSTINGS, select=top_skills(lexicons.POSTING_SKILLS, 10))
ORACLES["a2_seniority"] = with_(
    POSTINGS, FEATURES["senioridade_re"],
    select="""SELECT seniority, count(*) AS n FROM (
  SELECT p.doc_id, coalesce(lower(trim(string_split(senioridade_re, ',')[1])), 'Sem') AS seniority
  FROM postings p LEFT JOIN senioridade_re_t s ON s.doc_id = p.doc_id)
 GROUP BY seniority ORDER BY n DESC, min(doc_id) LIMIT 12""",
)
ORACLES["a4_top_skill_pairs"] = with_(
    POSTINGS, f"mentions AS ({skill_rows(lexicons.REPORT_SKILLS)})",
    select="""SELECT a.skill || '+' || b.skill AS pair, count(*) AS n
 FROM mentions a JOIN mentions b ON a.doc_id = b.doc_id AND a.skill < b.skill
 GROUP BY a.skill, b.skill ORDER BY n DESC, min(a.doc_id), a.skill, b.skill LIMIT 10""",
)

# ----------------------------------------------------------------------- chain


def of_postings(cte: str) -> str:
    """An annotation statement over postings, beside the statements of the cleaned text."""
    return re.sub(r"\bwords\b", "annotated_words", re.sub(r"\bdocuments\b", "posting_texts", cte))


CHAIN_TEXT = (
    POSTINGS,
    tokens_cte("postings", TEXT),
    LEMMAS,
    "lemma_words AS (SELECT doc_id, pos, word AS token FROM lemmatized)",
    *[step.replace("content", "lemma_words") for step in STEM_STEPS],
    """cleaned AS (
 SELECT p.doc_id, any_value(p.titulo) AS titulo, coalesce(string_agg(stem, ' ' ORDER BY pos), '') AS text_clean
 FROM postings p LEFT JOIN stems s ON s.doc_id = p.doc_id GROUP BY p.doc_id)""",
)
CHAIN_SUMMARIES = [*COUNTS, *SUMMARIES]
ORACLES["p1_labeled"] = with_(
    *CHAIN_TEXT,
    f"posting_texts AS (SELECT doc_id, {TEXT} AS text FROM postings)",
    *[of_postings(cte) for cte in (ANNOTATIONS, SIZES, CHUNKS, SPANS, *SUMMARIES.values())],
    *FEATURES.values(),
    scores_cte("cleaned", "text_clean"),
    BEST,
    select="SELECT doc_id, text_clean, area AS label_area, "
    + ", ".join(f"coalesce({n}, '') AS {n}" for n in FEATURES) + ", "
    + ", ".join(f"{COUNTS[n]} AS {n}" if n in COUNTS else f"coalesce({n}.{n}, '') AS {n}" for n in CHAIN_SUMMARIES)
    + " FROM cleaned JOIN best USING (doc_id) JOIN sizes USING (doc_id) "
    + " ".join(f"LEFT JOIN {n}_t USING (doc_id)" for n in FEATURES) + " "
    + " ".join(f"LEFT JOIN {n} USING (doc_id)" for n in SUMMARIES),
)
ORACLES["p1_vocabulary"] = with_(
    *CHAIN_TEXT, terms_cte("cleaned", "text_clean"), vocabulary_cte(5000, "cleaned"),
    select="SELECT term_id, term, round(idf, 6) AS idf FROM vocab",
)
for _key, _of in {"top_skills": "a1_top_skills", "seniority": "a2_seniority", "skill_pairs": "a4_top_skill_pairs"}.items():
    ORACLES[f"p1_{_key}"] = ORACLES[_of]
