"""Registered queries: each runs an operator over the driver tables and has an independent DuckDB SQL twin.

``QUERIES[name] = (spark_fn(spark, sf_dir) -> DataFrame, sql: str | None)``. The fixtures hold no Portuguese, so
the language and URL rules use fixture values (``en``; tokens ``es``/``fr``); all other thresholds are the
reference's.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsift.functions import normalize as N
from textsift.functions import rules as R
from textsift.functions import text as T
from textsift.operators import stats as A
from textsift.operators import waterfall as WF
from textsift.plans import oracle as O
from textsift.sources.readers import table

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


# Fixture configuration: documents carry their language label; the target language is English.
PARAMS = WF.FilterParams(languages=("en",))


def labelled_documents(spark: SparkSession, sf_dir: str, params: WF.FilterParams = PARAMS) -> DataFrame:
    docs = table(spark, sf_dir, "documents", cpu_heavy=True)
    base = docs.select("doc_id", "text", "source", F.col("lang").alias("language"),
                       F.lit(1.0).alias("language_score"))
    return WF.label(base, params)


def _wf_sql(select: str, p: WF.FilterParams = PARAMS) -> str:
    return O.waterfall_sql(p, "documents", "doc_id", "text", "lang", "CAST(1.0 AS DOUBLE)", select)


# --- W1 / A3: the waterfall and its reason counts ------------------------------------------------------------------

@register("filter_reasons", _wf_sql("""
SELECT filter_step, coalesce(filter_reason, 'total') AS filter_reason, CAST(count(*) AS BIGINT) AS n
FROM lab WHERE filter_step IS NOT NULL
GROUP BY GROUPING SETS ((filter_step, filter_reason), (filter_step))"""))
def q_filter_reasons(spark, sf_dir):
    return A.reason_counts(labelled_documents(spark, sf_dir))


@register("filter_labels", _wf_sql("SELECT id AS doc_id, filter_step, filter_reason FROM lab"))
def q_filter_labels(spark, sf_dir):
    return labelled_documents(spark, sf_dir).select("doc_id", "filter_step", "filter_reason")


@register("reason_share", _wf_sql("""
, c AS (SELECT filter_step, filter_reason, count(*) AS n FROM lab WHERE filter_step IS NOT NULL GROUP BY ALL)
SELECT filter_step, filter_reason, CAST(n AS BIGINT) AS n,
       CASE WHEN sum(n) OVER (PARTITION BY filter_step) > 0
            THEN round(100.0 * n / sum(n) OVER (PARTITION BY filter_step), 6) ELSE 0.0 END AS pct
FROM c"""))
def q_reason_share(spark, sf_dir):
    return A.reason_share(A.reason_counts(labelled_documents(spark, sf_dir)))


# --- T1/T2/T3 and W2 formatters ------------------------------------------------------------------------------------

@register("post_scrape", f"""
WITH {O.post_scrape_ctes("documents", "doc_id", "text", PARAMS)}
SELECT id AS doc_id, text, NOT regexp_matches(text, {O.lit(O.ANY)}) AS is_empty FROM ps""")
def q_post_scrape(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", cpu_heavy=True)
    t = N.post_scrape(F.col("text"))
    return docs.select("doc_id", t.alias("text")).withColumn("is_empty", N.is_empty_text(F.col("text")))


def _formatted_sql() -> str:
    ip = N.IPV4_RE
    once = f"regexp_replace(text, {O.lit(N.EMAIL_RE)}, {O.lit(N.EMAIL_MASK)}, 'g')"
    ip1 = f"regexp_replace({once}, {O.lit(ip)}, {O.lit(chr(92) + '1' + N.IP_MASK + chr(92) + '7')}, 'g')"
    ip2 = f"regexp_replace({ip1}, {O.lit(ip)}, {O.lit(chr(92) + '1' + N.IP_MASK + chr(92) + '7')}, 'g')"
    sym = f"regexp_replace({ip2}, {O.lit(N.symbol_lines_re(['|']))}, chr(10), 'g')"
    return _wf_sql(f"""
, f AS (SELECT id, {sym} AS text FROM lab WHERE filter_step IS NULL)
SELECT id AS doc_id, text, CAST(len(regexp_extract_all(text, {O.lit(N.TOKEN_RE)})) AS BIGINT) AS token_count FROM f""")


@register("formatted_survivors", _formatted_sql())
def q_formatted_survivors(spark, sf_dir):
    kept, _ = WF.split(labelled_documents(spark, sf_dir))
    return WF.format_survivors(kept).select("doc_id", "text", "token_count")


# --- rule metrics (integer numerators/denominators) ----------------------------------------------------------------

REP_COLS = ["n_lines", "dup_lines", "n_paras", "dup_paras", "n_chars", "dup_line_chars", "dup_para_chars",
            "word_chars"] + [f"top_{n}gram_chars" for n in (2, 3, 4)] + [f"dup_{n}gram_chars" for n in range(5, 11)]
LINE_COLS = ["n_lines", "punct_lines", "short_lines", "line_chars", "dup_line_chars", "newlines", "n_words"]
DOC_COLS = ["n_words", "word_chars", "alpha_words", "hashes", "ellipses", "n_lines", "bullet_lines", "ellipsis_lines",
            "stop_words"]


def _metrics_sql(cols: list[str]) -> str:
    return f"""
WITH src AS (SELECT doc_id AS id, text FROM documents),
{O.metric_ctes("src")}
SELECT id AS doc_id, {", ".join(cols)} FROM mx"""


def _metrics(spark, sf_dir, builder):
    docs = table(spark, sf_dir, "documents", cpu_heavy=True)
    b, c = R.bind(docs.select("doc_id", "text"))
    m = builder(c)
    return b.select("doc_id", *[m[k].cast("bigint").alias(k) for k in m])


@register("repetition_metrics", _metrics_sql(REP_COLS))
def q_repetition_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir, R.repetition_metrics)


@register("line_quality_metrics", _metrics_sql(LINE_COLS))
def q_line_quality_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir, R.line_quality_metrics)


@register("doc_quality_metrics", _metrics_sql(DOC_COLS))
def q_doc_quality_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir, R.doc_quality_metrics)


# --- A10: per-collection reason counts, zero-filled across collections ---------------------------------------------

@register("compare_collections", _wf_sql("""
, c AS (SELECT d.source AS run, filter_step, filter_reason, count(*) AS n
        FROM lab JOIN documents d ON lab.id = d.doc_id WHERE filter_step IS NOT NULL GROUP BY ALL),
keys AS (SELECT DISTINCT filter_step, filter_reason FROM c),
runs AS (SELECT DISTINCT run, filter_step FROM c)
SELECT r.run, k.filter_step, k.filter_reason, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM runs r JOIN keys k ON r.filter_step = k.filter_step
LEFT JOIN c ON c.run = r.run AND c.filter_step = k.filter_step AND c.filter_reason = k.filter_reason"""))
def q_compare_collections(spark, sf_dir):
    lab = labelled_documents(spark, sf_dir).where(F.col("filter_step").isNotNull())
    counts = lab.groupBy(F.col("source").alias("run"), "filter_step", "filter_reason").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
    return A.compare_runs(counts)


# --- M1-M11: MinHash near-duplicates ------------------------------------------------------------------------------

from textsift.operators import dedup as D  # noqa: E402
from textsift.operators import minhash as M  # noqa: E402


def _docs_src(spark, sf_dir):
    return table(spark, sf_dir, "documents", cpu_heavy=True).select("doc_id", "text", "source")


def _mh_sql(select: str, cfg=M.PER_COLLECTION, scope: tuple[str, ...] = (),
            src: str = "(SELECT doc_id AS id, text, source FROM documents)") -> str:
    return f"WITH RECURSIVE src AS {src},\n{O.minhash_ctes('src', cfg, scope)}\n{select}"


@register("minhash_signatures", _mh_sql("SELECT id AS doc_id, CAST(k AS BIGINT) AS k, mh AS minhash FROM sig"))
def q_minhash_signatures(spark, sf_dir):
    s = M.signatures(_docs_src(spark, sf_dir), M.PER_COLLECTION)
    return s.select(F.col("id").alias("doc_id"), F.posexplode("sig")).select(
        "doc_id", (F.col("pos") + 1).cast("bigint").alias("k"), F.col("col").alias("minhash"))


@register("minhash_buckets", _mh_sql("SELECT id AS doc_id, CAST(band AS BIGINT) AS band, dup_of FROM edges"))
def q_minhash_buckets(spark, sf_dir):
    cfg = M.PER_COLLECTION
    e = M.bucket_edges(M.band_keys(M.signatures(_docs_src(spark, sf_dir), cfg), cfg))
    return e.select(F.col("id").alias("doc_id"), F.col("band").cast("bigint").alias("band"), "dup_of")


@register("minhash_clusters", _mh_sql("""SELECT id AS doc_id, cluster_id AS minhash_cluster_id,
  size AS minhash_cluster_size FROM clusters"""))
def q_minhash_clusters(spark, sf_dir):
    return D.minhash_clusters(_docs_src(spark, sf_dir), M.PER_COLLECTION)


@register("minhash_dedup", _mh_sql(f"""SELECT id AS doc_id, size AS minhash_cluster_size,
  {O.upsampling_sql('size')} AS upsampling_weight FROM clusters WHERE cluster_id = id"""))
def q_minhash_dedup(spark, sf_dir):
    kept, _ = D.dedup(_docs_src(spark, sf_dir), M.PER_COLLECTION)
    return kept.select("doc_id", "minhash_cluster_size", "upsampling_weight")


@register("minhash_dedup_per_collection", _mh_sql(f"""SELECT source, id AS doc_id, size AS minhash_cluster_size,
  {O.upsampling_sql('size')} AS upsampling_weight FROM clusters WHERE cluster_id = id""", scope=("source",)))
def q_minhash_dedup_per_collection(spark, sf_dir):
    """Every collection deduplicated on its own, all in one plan (collection is part of the band key)."""
    kept, _ = D.dedup(_docs_src(spark, sf_dir), M.PER_COLLECTION, scope=("source",))
    return kept.select("source", "doc_id", "minhash_cluster_size", "upsampling_weight")


@register("minhash_copies_64", """
SELECT min(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS copies, CAST(1 AS BIGINT) AS clusters
FROM documents WHERE regexp_matches(lower(text), '[\\p{L}\\p{N}]') GROUP BY lower(text)""")
def q_minhash_copies_64(spark, sf_dir):
    """M1: the 64-bit family: documents with the same words, without regard to case, are always in one cluster (its other hash
    values have no SQL form)."""
    docs = _docs_src(spark, sf_dir)
    ids = D.minhash_clusters(docs, M.PER_COLLECTION_64).select("doc_id", "minhash_cluster_id")
    groups = docs.where(F.lower("text").rlike(T.NORM_WORD_RE)).select("doc_id", F.sha2(F.lower("text"), 256).alias("same"))
    return groups.join(ids, "doc_id").groupBy("same").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.countDistinct("minhash_cluster_id").alias("clusters")).drop("same")


# Tiers for the fixture: labelled quality 1 -> high, 0 -> low, unlabelled -> medium; benchmark passages form a
# second collection in the high tier. Ids are made unique across the two tables (documents even, benchmark odd).
TIER_SRC_SQL = """(
  SELECT d.doc_id * 2 AS id, d.text, d.source AS collection,
         CASE l.quality WHEN 1 THEN 'high' WHEN 0 THEN 'low' ELSE 'medium' END AS tier
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  UNION ALL
  SELECT item_id * 2 + 1 AS id, text, 'benchmark' AS collection, 'high' AS tier FROM benchmark)"""


def tiered_corpus(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", cpu_heavy=True)
    labels = table(spark, sf_dir, "labels")
    tier = (F.when(F.col("quality") == 1, F.lit("high")).when(F.col("quality") == 0, F.lit("low"))
            .otherwise(F.lit("medium")))
    d = docs.join(labels.select("doc_id", "quality"), "doc_id", "left").select(
        (F.col("doc_id") * 2).alias("id"), "text", F.col("source").alias("collection"), tier.alias("tier"))
    b = table(spark, sf_dir, "benchmark").select((F.col("item_id") * 2 + 1).alias("id"), "text",
                                                  F.lit("benchmark").alias("collection"), F.lit("high").alias("tier"))
    return d.unionByName(b)


@register("minhash_dedup_per_tier", _mh_sql(f"""SELECT tier, id, collection, size AS minhash_cluster_size,
  {O.upsampling_sql('size')} AS upsampling_weight
FROM clusters JOIN (SELECT id AS cid, collection FROM src) s ON clusters.id = s.cid
WHERE cluster_id = id""", cfg=M.PER_TIER, scope=("tier",), src=TIER_SRC_SQL))
def q_minhash_dedup_per_tier(spark, sf_dir):
    """All collections of a tier deduplicated together (40 x 15 bands, 4-grams), tiers independent."""
    kept, _ = D.dedup(tiered_corpus(spark, sf_dir), M.PER_TIER, id_col="id", scope=("tier",))
    return kept.select("tier", "id", "collection", "minhash_cluster_size", "upsampling_weight")


# --- S1/F1-F14: crawl index rows derived from pages ------------------------------------------------------------------

from textsift.functions import urls as U  # noqa: E402
from textsift.operators import extract as X  # noqa: E402
from textsift.operators import index as IX  # noqa: E402
from textsift.sources import readers as S  # noqa: E402

INDEX_ROWS_SQL = """
idx0 AS (
  SELECT page_id, url,
         lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)) AS host,
         regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) AS path
  FROM pages),
idx1 AS (
  SELECT page_id, array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || path AS surt,
         CAST(20080101000000 + page_id AS VARCHAR) AS timestamp, url,
         CASE WHEN page_id % 7 = 0 THEN '404' ELSE '200' END AS status,
         CASE WHEN page_id % 11 = 0 THEN 'application/pdf' ELSE 'text/html' END AS mime
  FROM idx0),
idx AS (SELECT * FROM idx1 UNION ALL SELECT * FROM idx1 WHERE page_id % 5 = 0)"""


def _pages(spark, sf_dir, heavy=False):
    return table(spark, sf_dir, "pages", cpu_heavy=heavy)


@register("index_rows", f"WITH {INDEX_ROWS_SQL}\nSELECT surt, timestamp, url, status, mime FROM idx")
def q_index_rows(spark, sf_dir):
    """Index text lines (rendered from pages) parsed back: split on the first two spaces + JSON."""
    return S.parse_index_lines(S.index_lines_from_pages(_pages(spark, sf_dir))).select(
        "surt", "timestamp", "url", "status", "mime")


@register("index_selection", f"""WITH {INDEX_ROWS_SQL}
SELECT DISTINCT surt, timestamp, url, status, mime FROM idx
WHERE status = '200' AND mime = 'text/html'
  AND (url LIKE '%.es/%' OR url LIKE '%/es/%' OR url LIKE '%/es-%' OR url LIKE '%/es\\_%' ESCAPE '\\'
       OR url LIKE '%/es' OR surt LIKE 'es,%')""")
def q_index_selection(spark, sf_dir):
    """F1 + F2 + F5 with country token ``es``."""
    rows = S.index_rows_from_pages(_pages(spark, sf_dir)).drop("page_id")
    return IX.select_index(rows, tok="es")


@register("foreign_variant_filter", """
SELECT page_id, url FROM pages
WHERE url IS NOT NULL AND NOT (contains(url, '/pt-es') OR contains(url, '/pt_es/') OR contains(url, '.com/es')
                               OR contains(url, '.es') OR contains(url, '/es/'))""")
def q_foreign_variant_filter(spark, sf_dir):
    """F4 with variant token ``es`` (substring semantics)."""
    p = _pages(spark, sf_dir)
    return p.where(U.not_foreign_variant(F.col("url"), variant="es")).select("page_id", "url")


@register("fetch_list", f"""WITH {INDEX_ROWS_SQL},
d AS (SELECT DISTINCT surt, timestamp, url FROM idx WHERE status = '200' AND mime = 'text/html')
SELECT surt, timestamp, url, 'https://replay.example/wayback/' || timestamp || 'id_/' || url AS replay_url,
       CAST((row_number() OVER (ORDER BY surt, timestamp, url) - 1) // {IX.FETCH_BATCH} AS BIGINT) AS batch
FROM d""")
def q_fetch_list(spark, sf_dir):
    """F9 + F10 + F11: fetch list of the selected index with replay URLs and consecutive 990-row batches."""
    rows = S.index_rows_from_pages(_pages(spark, sf_dir))
    ok = IX.dedup_index(rows.where(U.http_ok(F.col("status"), F.col("mime"))).select("surt", "timestamp", "url"),
                        keys=("surt", "timestamp", "url"))
    return IX.fetch_list(ok)


@register("fetch_outcomes", """
WITH g AS (
  SELECT coalesce(event_type, 'total') AS status, count(*) AS n, sum(value) * 8 AS bits
  FROM events GROUP BY ROLLUP (event_type)),
span AS (SELECT epoch_us(max(ts)) - epoch_us(min(ts)) AS us FROM events)
SELECT status, CAST(n AS BIGINT) AS n, round(bits, 6) AS bits,
       round(CASE WHEN us > 0 THEN bits / (us / 1e6) END, 6) AS bits_per_s
FROM g, span""")
def q_fetch_outcomes(spark, sf_dir):
    """F12 over the events table used as a fetch log (status = event_type, bytes = value)."""
    return IX.fetch_stats(IX.fetch_log_from_events(table(spark, sf_dir, "events")))


@register("fetch_ok", "SELECT event_id AS fetch_id, event_type AS status, value AS bytes FROM events "
                      "WHERE event_type = 'view' AND value > 0")
def q_fetch_ok(spark, sf_dir):
    """fetches that yield a page."""
    return IX.fetch_ok(IX.fetch_log_from_events(table(spark, sf_dir, "events"))).select("fetch_id", "status", "bytes")


DOMAIN_SQL = "regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)"


@register("domain_counts", f"""
SELECT {DOMAIN_SQL} AS domain, CAST(count(*) AS BIGINT) AS n FROM pages
WHERE {DOMAIN_SQL} <> '' GROUP BY 1""")
def q_domain_counts(spark, sf_dir):
    """F13 + A6: pages per network location."""
    return A.domain_counts(_pages(spark, sf_dir))


@register("top_domains", f"""
SELECT domain, n FROM (
  SELECT {DOMAIN_SQL} AS domain, CAST(count(*) AS BIGINT) AS n FROM pages WHERE {DOMAIN_SQL} <> '' GROUP BY 1)
ORDER BY n DESC, domain ASC LIMIT 50""")
def q_top_domains(spark, sf_dir):
    """The 50 largest domains (a top-k report: the limit is the feature)."""
    return A.top_k(A.domain_counts(_pages(spark, sf_dir)), "domain", k=50)


def _extract_sql() -> str:
    """Written apart from the operator's constants: the page is cut at literal marks, not matched with its regexes."""
    ws = "[ \\t\\r\\f\\x0B]+"
    decode = lambda e: ("list_reduce(list_transform([('&quot;', chr(34)), ('&copy;', chr(169)), ('&middot;', chr(183)), ('&lt;', '<'), ('&gt;', '>'), "  # noqa: E731
                        f"('&amp;', '&')], lambda r: struct_pack(f := r[1], t := r[2], x := {e})), lambda a, b: struct_pack(f := b.f, t := b.t, x := replace(a.x, a.f, a.t)))")
    done = lambda e: f"replace(({decode(e)}).x, '&amp;', '&')"
    tidy = lambda e: (f"trim(array_to_string(list_filter(list_transform(string_split(regexp_replace({e}, '{ws}', ' ', 'g'), chr(10)), "  # noqa: E731
                      "lambda l: trim(l)), lambda l: l <> ''), chr(10)))")
    return f"""
WITH b AS (SELECT page_id, url, html, html[position('</head>' IN html) + 7:] AS body FROM pages),
c AS (SELECT *, CASE WHEN contains(body, '<article>') AND contains(body, '</article>')
         THEN body[position('<article>' IN body) + 9:position('</article>' IN body) - 1] ELSE body END AS main FROM b),
d AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(main, '<nav>.*?</nav>', ' ', 'gs'), '<footer>.*?</footer>', ' ', 'gs'), '<!--.*?-->', ' ', 'gs') AS kept FROM c),
e AS (SELECT *, array_to_string(list_transform(string_split(replace(kept, '<', chr(1) || '<'), chr(1)), lambda t:
         CASE WHEN t[1] <> '<' OR NOT contains(t, '>') THEN t
              WHEN regexp_matches(t, '^</?(p|div|h[1-6]|li|ul|ol|br|tr|table|section|article|pre|blockquote)[ >/]') THEN chr(10) || t[position('>' IN t) + 1:]
              ELSE t[position('>' IN t) + 1:] END), '') AS plain FROM d),
f AS (SELECT page_id, url, {tidy(done("plain"))} AS text,
         CASE WHEN contains(html, '<title>') THEN {tidy(done("string_split(string_split(html, '<title>')[2], '</title>')[1]"))} END AS title FROM e)
SELECT page_id, url, CASE WHEN title <> '' THEN title END AS title, text FROM f WHERE text <> ''"""


@register("extract_pages", _extract_sql())
def q_extract_pages(spark, sf_dir):
    """X1 + F6: title and main text of every page; pages with no text left are dropped."""
    p = _pages(spark, sf_dir, heavy=True)
    out = p.select("page_id", "url", X.page_parts(F.col("html")).alias("_x")).select("page_id", "url", "_x.title", "_x.text")
    return (out.where(F.col("text").isNotNull() & (F.col("text") != ""))
            .withColumn("title", F.when(F.col("title") != "", F.col("title"))))


#: Marks put into every page: a nested ad, an ad inside a box of the article, a list of links, a list item with one link.
PAGE_EDITS = (('<div class="ad">', '<div class="ad"><div>sponsored</div>by<div>us<div>all</div></div>'),
              ('</article>', '<ul><li><a href="/x">Related page</a></li><li>Look at <a href="/y">that</a> for more</ul><div class="box">Open<div class="ads top">Buy<div>now</div>!</div>Closed &amp;<b>bold</div></article>'))


def _blocks_sql() -> str:
    """A token table: tags and texts of each page in order, with running depths; ads by the depth of ``div`` around them."""
    html = "html"
    for old, new in PAGE_EDITS:
        html = f"replace({html}, {O.lit(old)}, {O.lit(new)})"
    text = "replace(replace(replace(replace(replace(replace(tok, '&quot;', chr(34)), '&copy;', chr(169)), '&middot;', chr(183)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
    fold = lambda e: f"trim(regexp_replace({e}, '[ \t\n\r\f\x0B]+', ' ', 'g'))"
    depth = lambda name: f"CAST(sum(CASE WHEN name = '{name}' THEN CASE WHEN shut THEN -1 ELSE 1 END ELSE 0 END) OVER w AS BIGINT) AS d_{name}"
    return f"""
WITH t0 AS (SELECT page_id, regexp_extract_all({html}, '(?s)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<[^>]*>|[^<]+') AS l FROM pages),
t1 AS (SELECT page_id, unnest(l) AS tok, generate_subscripts(l, 1) AS i FROM t0),
t2 AS (SELECT *, regexp_extract(tok, '^</?([a-zA-Z][a-zA-Z0-9]*)', 1) AS name, starts_with(tok, '</') AS shut FROM t1),
t3 AS (SELECT *, {", ".join(map(depth, ("div", "nav", "footer", "head", "article", "a")))},
  sum(CASE WHEN regexp_matches(name, '^(p|div|h[1-6]|li|ul|ol|br|article|nav|footer|head|body|html)$') THEN 1 ELSE 0 END) OVER w AS block FROM t2
  WINDOW w AS (PARTITION BY page_id ORDER BY i ROWS UNBOUNDED PRECEDING)),
ads AS (SELECT page_id, i AS first, d_div FROM t3 WHERE name = 'div' AND NOT shut AND regexp_matches(tok, 'class="([^"]* )?ads?( [^"]*)?"')),
gone AS (SELECT ads.page_id, ads.first, min(t3.i) AS last FROM ads JOIN t3 ON t3.page_id = ads.page_id AND t3.i > ads.first AND t3.d_div < ads.d_div GROUP BY ALL),
t4 AS (SELECT t3.*, {text} AS x FROM t3 WHERE tok[1] <> '<' AND d_nav = 0 AND d_footer = 0 AND d_head = 0
  AND NOT EXISTS (SELECT 1 FROM gone WHERE gone.page_id = t3.page_id AND t3.i BETWEEN gone.first AND gone.last)),
b AS (SELECT page_id, block, max(d_article) AS art, {fold("string_agg(x, '' ORDER BY i)")} AS text, {fold("coalesce(string_agg(x, '' ORDER BY i) FILTER (WHERE d_a > 0), '')")} AS links FROM t4 GROUP BY ALL),
c AS (SELECT *, max(art) OVER (PARTITION BY page_id) AS has FROM b WHERE text <> '')
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY block) - 1 AS INTEGER) AS pos, text, CAST(length(text) AS INTEGER) AS n_chars,
  CAST(length(links) AS INTEGER) AS link_chars, 2 * length(links) <= length(text) AS kept FROM c WHERE art > 0 OR has = 0"""


@register("page_blocks", _blocks_sql())
def q_page_blocks(spark, sf_dir):
    """Text blocks of every page with their link characters; nested ads, unclosed items and lists of links are put in first."""
    html = F.col("html")
    for old, new in PAGE_EDITS:
        html = F.replace(html, F.lit(old), F.lit(new))
    p = _pages(spark, sf_dir, heavy=True).select("page_id", X.page_blocks(html).alias("b"))
    return p.select("page_id", F.posexplode("b").alias("pos", "x")).select("page_id", "pos", "x.text", "x.n_chars", "x.link_chars", "x.kept")


# --- L1/L2 + A1/A2/A11/A13: language identification and its statistics ---------------------------------------------

from textsift.operators import language as LG  # noqa: E402

LANG_BUCKETS = 1 << 16
TARGET_LANGS = ("en",)


def language_scores(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", cpu_heavy=True)
    model = LG.train(docs, text_col="text", label_col="lang", buckets=LANG_BUCKETS)
    return LG.detect(model, docs, id_col="doc_id", text_col="text")


def _lang_sql(select: str) -> str:
    b = LANG_BUCKETS
    norm = O.lit(O.NORM)
    return f"""
WITH tw AS (SELECT lang, unnest(regexp_extract_all(lower(text), {norm})) AS word FROM documents),
cnt AS (SELECT lang, {O.md5_31('word')} % {b} AS bucket, count(*) AS c FROM tw GROUP BY ALL),
tot AS (SELECT lang, sum(c) AS n FROM cnt GROUP BY lang),
dper AS (SELECT lang, count(*) AS d FROM documents WHERE lang IS NOT NULL GROUP BY lang),
lp AS (SELECT dper.lang, ln(dper.d / (SELECT sum(d) FROM dper)) AS log_prior, ln(coalesce(tot.n, 0) + {b}) AS log_denom
       FROM dper LEFT JOIN tot ON dper.lang = tot.lang),
dw AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {norm})) AS word FROM documents),
db AS (SELECT doc_id, {O.md5_31('word')} % {b} AS bucket FROM dw),
nw AS (SELECT doc_id, len(regexp_extract_all(lower(text), {norm})) AS nw FROM documents),
m AS (SELECT db.doc_id, cnt.lang, sum(ln(cnt.c + 1)) AS s FROM db JOIN cnt ON db.bucket = cnt.bucket GROUP BY ALL),
sc AS (SELECT nw.doc_id, nw.nw, lp.lang,
              (lp.log_prior + coalesce(m.s, 0) - nw.nw * lp.log_denom) / greatest(nw.nw, 1) AS z
       FROM nw CROSS JOIN lp LEFT JOIN m ON m.doc_id = nw.doc_id AND m.lang = lp.lang),
sm AS (SELECT doc_id, nw, lang, exp(z - max(z) OVER (PARTITION BY doc_id)) AS e FROM sc),
fin AS (SELECT doc_id, nw, lang, e / sum(e) OVER (PARTITION BY doc_id) AS p,
               row_number() OVER (PARTITION BY doc_id ORDER BY e DESC, lang ASC) AS rk FROM sm),
scored AS (SELECT doc_id, CASE WHEN nw > 0 THEN lang END AS language,
                  CASE WHEN nw > 0 THEN round(p, 6) ELSE 0.0 END AS language_score FROM fin WHERE rk = 1),
removed AS (SELECT * FROM scored WHERE NOT coalesce(language IN ({", ".join(O.lit(x) for x in TARGET_LANGS)})
                                                    AND language_score >= {O.dbl(0.799)}, FALSE))
{select}"""


@register("language_id", _lang_sql("SELECT doc_id, language, language_score FROM scored"))
def q_language_id(spark, sf_dir):
    """L1: naive-Bayes language label and score for every document (trained on the labelled documents)."""
    return language_scores(spark, sf_dir)


@register("language_removed", _lang_sql("SELECT doc_id, language, language_score FROM removed"))
def q_language_removed(spark, sf_dir):
    """L2: documents removed by the language filter (target en, threshold 0.799), with label and score."""
    _, removed = LG.language_filter(language_scores(spark, sf_dir), TARGET_LANGS, 0.799)
    return removed


@register("removed_per_language", _lang_sql(
    "SELECT language, CAST(count(*) AS BIGINT) AS n FROM removed GROUP BY language"))
def q_removed_per_language(spark, sf_dir):
    """A2."""
    _, removed = LG.language_filter(language_scores(spark, sf_dir), TARGET_LANGS, 0.799)
    return A.removed_per_language(removed)


@register("target_language_score_hist", _lang_sql(
    "SELECT language_score, CAST(count(*) AS BIGINT) AS n FROM removed WHERE language = 'en' GROUP BY 1"))
def q_target_language_score_hist(spark, sf_dir):
    """A1: removed documents labelled with the target language, per exact score."""
    _, removed = LG.language_filter(language_scores(spark, sf_dir), TARGET_LANGS, 0.799)
    return A.language_score_hist(removed, "en")


@register("rounded_score_hist", _lang_sql("""
SELECT CAST(round(CAST(language_score AS DECIMAL(20, 10)), 3) AS DOUBLE) AS score, CAST(count(*) AS BIGINT) AS n
FROM removed WHERE language = 'en' GROUP BY 1"""))
def q_rounded_score_hist(spark, sf_dir):
    """The target-language removed-score histogram (A1) merged after rounding to 3 decimals."""
    _, removed = LG.language_filter(language_scores(spark, sf_dir), TARGET_LANGS, 0.799)
    return A.rounded_score_counts(A.language_score_hist(removed, "en"))


@register("top_removed_languages", _lang_sql("""
, c AS (SELECT language AS key, count(*) AS n FROM removed GROUP BY 1),
r AS (SELECT key, n, row_number() OVER (ORDER BY n DESC, key ASC) AS rk FROM c)
SELECT key, CAST(n AS BIGINT) AS n FROM r WHERE rk <= 2
UNION ALL
SELECT 'Others' AS key, CAST(coalesce(sum(n) FILTER (WHERE rk > 2), 0) AS BIGINT) AS n FROM r"""))
def q_top_removed_languages(spark, sf_dir):
    """The top removed languages (2 of the tables' four; the report's default is 40) and an ``Others`` row."""
    _, removed = LG.language_filter(language_scores(spark, sf_dir), TARGET_LANGS, 0.799)
    return A.top_n_with_others(A.removed_per_language(removed), "language", top=2)


# --- C1-C6: scoring and tiers -----------------------------------------------------------------------------------------

from textsift.operators import scoring as SC  # noqa: E402


_MODELS: dict[tuple[str, str], object] = {}


def quality_model(spark, sf_dir):
    """The quality model of a data set, fitted once a session: fitting isn't part of a scoring plan (the benchmark's warm run has it)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        docs = table(spark, sf_dir, "documents", cpu_heavy=True)
        _MODELS[key] = SC.train_quality_model(docs.join(table(spark, sf_dir, "labels"), "doc_id"), buckets=QUALITY_BUCKETS)
    return _MODELS[key]


QUALITY_BUCKETS = 1 << 18


def _quality_sql(src: str) -> str:
    """CTEs up to ``scored`` (id, quality_label, edu_score, depth_score, binary_edu_score): the model refitted, then the texts of ``src`` (id, text)."""
    tok, b, mu = O.lit(N.TOKEN_RE), QUALITY_BUCKETS, SC.PRIOR_WORDS
    return f"""
qt AS (SELECT CASE WHEN l.quality = 0 THEN 0 WHEN l.toxic = 1 THEN 1 ELSE 2 END AS k, regexp_extract_all(lower(d.text), {tok}) AS w FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
qc AS (SELECT k, {O.md5_31('word')} % {b} AS bucket, count(*) AS c FROM (SELECT k, unnest(w) AS word FROM qt) GROUP BY ALL),
qk AS (SELECT d.k, floor(ln(d.n / sum(d.n) OVER ()) * {SC.SCALE} + 0.5) AS prior, coalesce(t.n, 0) AS n FROM (SELECT k, count(*) AS n FROM qt GROUP BY k) d LEFT JOIN (SELECT k, sum(c) AS n FROM qc GROUP BY k) t ON d.k = t.k),
qw AS (SELECT id, {O.md5_31('word')} % {b} AS bucket, count(*) AS m FROM (SELECT id, unnest(regexp_extract_all(lower(text), {tok})) AS word FROM {src}) GROUP BY ALL),
qa AS (SELECT bucket, sum(c) AS a FROM qc GROUP BY bucket),
qp0 AS (SELECT qw.*, (coalesce(qa.a, 0) + 1) / ((SELECT sum(c) FROM qc) + {b}) AS p FROM qw LEFT JOIN qa ON qa.bucket = qw.bucket),
qs AS (SELECT q.id, qk.k, sum(m) AS n, sum(m * floor(ln((coalesce(qc.c, 0) + {mu} * p) / (qk.n + {mu}) / p) * {SC.SCALE} + 0.5)) AS z
  FROM qp0 q CROSS JOIN qk LEFT JOIN qc ON qc.k = qk.k AND qc.bucket = q.bucket GROUP BY ALL),
qz AS (SELECT s.id, qk.k, (qk.prior + coalesce(qs.z, 0)) / {SC.SCALE} / sqrt(greatest(coalesce(qs.n, 0), 1)) AS z FROM {src} s CROSS JOIN qk LEFT JOIN qs ON qs.id = s.id AND qs.k = qk.k),
qp AS (SELECT id, max(z) FILTER (WHERE k = 0) AS z0, max(z) FILTER (WHERE k = 1) AS z1, max(z) FILTER (WHERE k = 2) AS z2 FROM qz GROUP BY id),
qe AS (SELECT *, exp(z0 - greatest(z0, z1, z2)) AS e0, exp(z1 - greatest(z0, z1, z2)) AS e1, exp(z2 - greatest(z0, z1, z2)) AS e2 FROM qp),
qr AS (SELECT *, round((e1 + 2 * e2) / (e0 + e1 + e2) * 2.5, 6) AS edu_score, round(e2 / (e0 + e1 + e2) * 5, 6) AS depth_score FROM qe),
scored AS (SELECT id, CASE WHEN z0 >= z1 AND z0 >= z2 THEN 'low' WHEN z1 >= z2 THEN 'medium' ELSE 'high' END AS quality_label, edu_score, depth_score, CAST(edu_score >= 2.5 AS INTEGER) AS binary_edu_score FROM qr)"""


@register("quality_scores", f"""WITH src AS (SELECT doc_id AS id, text FROM documents),{_quality_sql('src')}
SELECT d.doc_id, d.source, s.quality_label, s.edu_score, s.depth_score, s.binary_edu_score FROM scored s JOIN documents d ON d.doc_id = s.id""")
def q_quality_scores(spark, sf_dir):
    """C1 + C2 + C3: the built-in quality model fitted on ``labels``, applied to every document."""
    docs = table(spark, sf_dir, "documents", cpu_heavy=True)
    model = quality_model(spark, sf_dir)
    return SC.score_documents(model, docs.select("doc_id", "source", "text")).select(
        "doc_id", "source", "quality_label", "edu_score", "depth_score", "binary_edu_score")


@register("quality_argmax", """
WITH c AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
s AS (SELECT vec_id, i % 3 AS k, sum(CAST(floor(x * 1000) AS BIGINT)) AS z FROM c GROUP BY ALL),
l AS (SELECT vec_id, max(z) FILTER (WHERE k = 1) AS a, max(z) FILTER (WHERE k = 2) AS b, max(z) FILTER (WHERE k = 0) AS c FROM s GROUP BY vec_id)
SELECT vec_id, CASE WHEN a >= b AND a >= c THEN 'low' WHEN b >= c THEN 'medium' ELSE 'high' END AS quality_label FROM l""")
def q_quality_argmax(spark, sf_dir):
    """label = argmax of three logits (first wins ties): sums over every third component of the whole vector."""
    e = table(spark, sf_dir, "embeddings")
    whole = F.transform("embedding", lambda x: F.floor(x * F.lit(1000).cast("float")))
    part = lambda k: F.aggregate(F.filter(whole, lambda x, i: i % 3 == k), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return e.select("vec_id", SC.argmax_label(F.array(part(0), part(1), part(2))).alias("quality_label"))


TIER_SQL = "CASE l.quality WHEN 1 THEN 'high' WHEN 0 THEN 'low' ELSE 'medium' END"


def labelled_tiers(spark, sf_dir) -> DataFrame:
    """Documents with a tier from ``labels`` (1 -> high, 0 -> low, unlabelled -> medium) and a token count."""
    docs = table(spark, sf_dir, "documents", cpu_heavy=True)
    labels = table(spark, sf_dir, "labels")
    tier = (F.when(F.col("quality") == 1, F.lit("high")).when(F.col("quality") == 0, F.lit("low"))
            .otherwise(F.lit("medium")))
    return docs.join(labels.select("doc_id", "quality"), "doc_id", "left").select(
        "doc_id", F.col("source").alias("collection"), tier.alias("quality_label"),
        N.token_count(F.col("text")).alias("token_count"))


TIERED_SQL = f"""
WITH t AS (
  SELECT d.doc_id, d.source AS collection, {TIER_SQL} AS quality_label,
         CAST(len(regexp_extract_all(d.text, {O.lit(N.TOKEN_RE)})) AS BIGINT) AS token_count
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


@register("tier_counts", TIERED_SQL + """
SELECT collection, quality_label, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY ALL""")
def q_tier_counts(spark, sf_dir):
    """Documents per (collection, tier)."""
    return SC.tier_counts(labelled_tiers(spark, sf_dir))


@register("skip_labelled", """
SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_skip_labelled(spark, sf_dir):
    """Incremental run: documents already in the done manifest (``labels``) are skipped (left anti join)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return S.skip_done(docs, table(spark, sf_dir, "labels"), ["doc_id"])


# --- A4/A5/A7/A8/A14/A15/A16: corpus statistics over the tiers ---------------------------------------------------------

@register("corpus_totals", TIERED_SQL + """,
g AS (SELECT quality_label AS tier, count(*) AS total_entries, sum(token_count) AS total_token_count FROM t GROUP BY 1)
SELECT tier, CAST(total_entries AS BIGINT) AS total_entries, CAST(total_token_count AS BIGINT) AS total_token_count
FROM g
UNION ALL
SELECT 'total', CAST(sum(total_entries) AS BIGINT), CAST(sum(total_token_count) AS BIGINT)
FROM g WHERE tier IN ('medium', 'high')""")
def q_corpus_totals(spark, sf_dir):
    """A4 + A8: entries and tokens per tier, plus the total over medium and high only."""
    per = A.corpus_totals(labelled_tiers(spark, sf_dir))
    return A.with_grand_total(per, [], ["total_entries", "total_token_count"]).select(
        "tier", "total_entries", "total_token_count")


def _dist_sql(select: str) -> str:
    cols = ", ".join(f"sum(CASE WHEN token_count >= {lo} THEN 1 ELSE 0 END) AS b_{name}"
                     for name, lo in A.TOKEN_BUCKETS)
    unions = " UNION ALL ".join(f"SELECT tier, '{name}' AS bucket, CAST(b_{name} AS BIGINT) AS n FROM w"
                                for name, _ in A.TOKEN_BUCKETS)
    return TIERED_SQL + f""",
w AS (SELECT quality_label AS tier, {cols} FROM t GROUP BY 1),
dist AS ({unions}),
dist_all AS (SELECT * FROM dist UNION ALL
             SELECT 'total', bucket, CAST(sum(n) AS BIGINT) FROM dist WHERE tier IN ('medium', 'high') GROUP BY bucket)
{select}"""


@register("token_distribution", _dist_sql("SELECT tier, bucket, n FROM dist_all"))
def q_token_distribution(spark, sf_dir):
    """A5 + A8: cumulative counts of documents with >= 4k ... 256k tokens per tier, plus the medium+high total."""
    per = A.token_distribution(labelled_tiers(spark, sf_dir))
    return A.with_grand_total(per, ["bucket"], ["n"]).select("tier", "bucket", "n")


@register("token_ranges", _dist_sql("SELECT tier, bucket, n FROM dist_all WHERE n > 10 AND bucket <> '4k'")
          .replace("AS BIGINT) AS token_count", "AS BIGINT) * 20 AS token_count"))
def q_token_ranges(spark, sf_dir):
    """Ranges with more than ``min_count`` documents, ``4k`` excluded. Counts are taken 20-fold and the minimum is 10,
    so that the ranges of these short documents aren't empty."""
    per = A.token_distribution(labelled_tiers(spark, sf_dir).withColumn("token_count", F.col("token_count") * 20))
    return A.keep_ranges(A.with_grand_total(per, ["bucket"], ["n"]), min_count=10).select("tier", "bucket", "n")


@register("tokens_per_collection", TIERED_SQL + """
SELECT quality_label AS tier, split_part(collection || '_n0_gpu0_00001.jsonl.gz', '_', 1) AS collection,
       CAST(sum(token_count) AS BIGINT) AS tokens
FROM t GROUP BY ALL""")
def q_tokens_per_collection(spark, sf_dir):
    """A7 + F14: tokens per collection, the collection read from the tier file name prefix."""
    t = labelled_tiers(spark, sf_dir).withColumn(
        "file_name", F.concat(F.col("collection"), F.lit("_n0_gpu0_00001.jsonl.gz")))
    t = t.withColumn("collection", S.collection_of(F.col("file_name")))
    return A.tokens_per_collection(t, tier_col="quality_label")


def _fmt_sql(x: str) -> str:
    return (f"CASE WHEN {x} >= 1000000 THEN CAST(({x} + 50000) // 1000000 AS VARCHAR) || '.' || "
            f"CAST((({x} + 50000) // 100000) % 10 AS VARCHAR) || 'M' "
            f"WHEN {x} >= 1000 THEN CAST(({x} + 50) // 1000 AS VARCHAR) || '.' || "
            f"CAST((({x} + 50) // 100) % 10 AS VARCHAR) || 'K' ELSE CAST({x} AS VARCHAR) END")


@register("formatted_counts", TIERED_SQL + f"""
SELECT doc_id, token_count, {_fmt_sql('token_count')} AS tokens_fmt,
       {_fmt_sql('token_count * 1000')} AS tokens_x1000_fmt FROM t""")
def q_formatted_counts(spark, sf_dir):
    """K/M count labels (half-up), applied to every document's token count and to 1000 times it."""
    t = labelled_tiers(spark, sf_dir)
    return t.select("doc_id", "token_count", A.format_count(F.col("token_count")).alias("tokens_fmt"),
                    A.format_count(F.col("token_count") * 1000).alias("tokens_x1000_fmt"))


@register("pretty_reasons", _wf_sql("""
, c AS (SELECT DISTINCT filter_step, filter_reason FROM lab WHERE filter_step IS NOT NULL)
SELECT filter_step, filter_reason,
       array_to_string(list_transform(string_split(replace(filter_step, '_', ' '), ' '),
                       lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), ' ') AS step_label,
       upper(substr(replace(filter_reason, '_', ' '), 1, 1)) || lower(substr(replace(filter_reason, '_', ' '), 2))
         AS reason_label
FROM c"""))
def q_pretty_reasons(spark, sf_dir):
    """Chart labels for the removal reasons and steps."""
    c = labelled_documents(spark, sf_dir).where(F.col("filter_step").isNotNull()).select(
        "filter_step", "filter_reason").distinct()
    return c.select("filter_step", "filter_reason", A.pretty_step(F.col("filter_step")).alias("step_label"),
                    A.pretty_reason(F.col("filter_reason")).alias("reason_label"))


# --- end to end -------------------------------------------------------------------------------------------------------

from textsift.plans import corpus as CP  # noqa: E402


@register("curated_corpus", _mh_sql(f""", {_quality_sql('src')}
SELECT c.id AS doc_id, c.source AS collection, s.quality_label, src.token_count, c.size AS minhash_cluster_size, {O.upsampling_sql('c.size')} AS upsampling_weight, s.edu_score, s.binary_edu_score
FROM clusters c JOIN scored s ON s.id = c.id JOIN src ON src.id = c.id WHERE c.cluster_id = c.id""", scope=("source",),
    src=f"(SELECT f.doc_id AS id, f.text, d.source, f.token_count FROM ({_formatted_sql()}) f JOIN documents d ON d.doc_id = f.doc_id)"))
def q_curated_corpus(spark, sf_dir):
    """Whole flow on the fixture: waterfall (target en) -> formatters -> per-collection MinHash dedup -> quality
    model -> tiers."""
    docs = table(spark, sf_dir, "documents", cpu_heavy=True)
    model = quality_model(spark, sf_dir)
    base = docs.select("doc_id", "text", F.col("source").alias("collection"), F.col("lang").alias("language"),
                       F.lit(1.0).alias("language_score"))
    tiered, _ = CP.curate(base, model, params=PARAMS)
    return tiered.select("doc_id", "collection", "quality_label", "token_count", "minhash_cluster_size",
                         "upsampling_weight", "edu_score", "binary_edu_score")
