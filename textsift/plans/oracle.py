"""Independent DuckDB SQL for the rule queries (the correctness oracle).

The SQL is written relationally (unnest + window functions) rather than mirroring the Spark array code: lines are
de-duplicated with ``row_number() over (partition by trimmed line)``, n-grams are counted with ``group by`` and
repeats found with ``row_number() over (partition by n-gram)``. Thresholds come from the same ``FilterParams``.
"""

from __future__ import annotations

from textsift.functions import text as T
from textsift.functions import rules as R
from textsift.functions import normalize as N
from textsift.operators.waterfall import (FilterParams, STEP_DOC_QUALITY, STEP_LANGUAGE, STEP_LINE_QUALITY,
                                          STEP_POST_SCRAPE, STEP_REPETITION)

WORD = T.WORD_RE
NONBLANK = T.NONBLANK_RE
NORM = T.NORM_WORD_RE
ANY = r"[^ \t\n\r\f\x0B]"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def ratio(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) > 0 THEN CAST(({num}) AS DOUBLE) / CAST(({den}) AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)"


def post_scrape_ctes(src: str, id_col: str, text_col: str, p: FilterParams) -> str:
    """CTE ``ps(id, text)``: duplicate lines (trimmed, first kept) and short lines removed; blank lines kept."""
    dedup = "rn = 1" if p.remove_dup_lines else "TRUE"
    short = (f"len(regexp_extract_all(line, {lit(WORD)})) >= {p.min_line_words}"
             if p.remove_short_lines else "TRUE")
    return f"""
ps_lines AS (
  SELECT d.{id_col} AS id, u.line, u.p
  FROM {src} d, unnest(string_split(d.{text_col}, chr(10))) WITH ORDINALITY AS u(line, p)),
ps_ranked AS (
  SELECT id, line, p, regexp_matches(line, {lit(NONBLANK)}) AS nb,
         row_number() OVER (PARTITION BY id, trim(line) ORDER BY p) AS rn
  FROM ps_lines),
ps_kept AS (
  SELECT id, string_agg(line, chr(10) ORDER BY p) AS text
  FROM ps_ranked WHERE NOT nb OR ({dedup} AND {short})
  GROUP BY id),
ps AS (
  SELECT d.{id_col} AS id, coalesce(k.text, '') AS text
  FROM {src} d LEFT JOIN ps_kept k ON d.{id_col} = k.id)"""


def metric_ctes(src: str = "ps", stop_words=R.STOP_WORDS_PT) -> str:
    """CTE ``mx``: bound arrays plus n-gram metrics for every row of ``src(id, text)``."""
    stops = "[" + ", ".join(lit(s) for s in stop_words) + "]"
    return f"""
m1 AS (
  SELECT id, text,
         regexp_extract_all(text, {lit(WORD)}) AS w,
         regexp_extract_all(lower(text), {lit(NORM)}) AS nw,
         string_split(text, chr(10)) AS l
  FROM {src}),
m2 AS (
  SELECT *, list_filter(l, lambda x: regexp_matches(x, {lit(NONBLANK)})) AS nb,
         list_filter(string_split_regex(text, '\\n\\n+'), lambda x: regexp_matches(x, {lit(NONBLANK)})) AS para,
         {stops} AS stops
  FROM m1),
ng AS (
  SELECT m.id, nn.n, r.i, array_to_string(list_slice(m.w, r.i, r.i + nn.n - 1), ' ') AS g
  FROM m2 m, (VALUES (2), (3), (4), (5), (6), (7), (8), (9), (10)) nn(n), range(1, len(m.w) - nn.n + 2) r(i)),
ng_cnt AS (SELECT id, n, g, count(*) AS c FROM ng WHERE n <= 4 GROUP BY id, n, g),
ng_top AS (
  SELECT id, n, c * length(g) AS v FROM (
    SELECT *, row_number() OVER (PARTITION BY id, n ORDER BY c DESC, length(g) DESC) AS rk FROM ng_cnt) t
  WHERE rk = 1),
ng_rep AS (
  SELECT id, n, i FROM (
    SELECT id, n, i, row_number() OVER (PARTITION BY id, n, g ORDER BY i) AS rn FROM ng WHERE n >= 5) t
  WHERE rn > 1),
ng_cov AS (SELECT DISTINCT id, n, r.pos FROM ng_rep, range(ng_rep.i, ng_rep.i + ng_rep.n) r(pos)),
wpos AS (SELECT m.id, u.word, u.pos FROM m2 m, unnest(m.w) WITH ORDINALITY AS u(word, pos)),
ng_dup AS (
  SELECT c.id, c.n, sum(length(w.word)) AS v
  FROM ng_cov c JOIN wpos w ON c.id = w.id AND c.pos = w.pos GROUP BY c.id, c.n),
ng_all AS (SELECT * FROM ng_top UNION ALL SELECT * FROM ng_dup),
ngm AS (
  SELECT id, {", ".join(f"max(v) FILTER (WHERE n = {n}) AS {'top' if n <= 4 else 'dup'}_{n}gram_chars"
                         for n in range(2, 11))}
  FROM ng_all GROUP BY id),
mx AS (
  SELECT m2.*,
         CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(nb) AS BIGINT) AS n_lines,
         CAST(len(nb) - len(list_distinct(nb)) AS BIGINT) AS dup_lines,
         CAST(len(para) AS BIGINT) AS n_paras,
         CAST(len(para) - len(list_distinct(para)) AS BIGINT) AS dup_paras,
         CAST(length(text) AS BIGINT) AS n_chars,
         CAST(coalesce(list_sum(list_transform(nb, lambda x: length(x))), 0) AS BIGINT) AS line_chars,
         CAST(coalesce(list_sum(list_transform(nb, lambda x: length(x))), 0)
              - coalesce(list_sum(list_transform(list_distinct(nb), lambda x: length(x))), 0) AS BIGINT)
              AS dup_line_chars,
         CAST(coalesce(list_sum(list_transform(para, lambda x: length(x))), 0)
              - coalesce(list_sum(list_transform(list_distinct(para), lambda x: length(x))), 0) AS BIGINT)
              AS dup_para_chars,
         CAST(len(list_filter(nb, lambda x: regexp_matches(x, {lit(R.END_PUNCT_RE)}))) AS BIGINT) AS punct_lines,
         CAST(len(list_filter(nb, lambda x: length(x) < 30)) AS BIGINT) AS short_lines,
         CAST(len(l) - 1 AS BIGINT) AS newlines,
         CAST(len(list_filter(w, lambda x: regexp_matches(x, {lit(T.ALPHA_RE)}))) AS BIGINT) AS alpha_words,
         CAST(length(text) - length(replace(text, '#', '')) AS BIGINT) AS hashes,
         CAST((length(text) - length(replace(text, '...', ''))) // 3
              + (length(text) - length(replace(text, '…', ''))) AS BIGINT) AS ellipses,
         CAST(len(list_filter(nb, lambda x: regexp_matches(x, {lit(R.BULLET_LINE_RE)}))) AS BIGINT) AS bullet_lines,
         CAST(len(list_filter(nb, lambda x: regexp_matches(x, {lit(R.ELLIPSIS_LINE_RE)}))) AS BIGINT)
              AS ellipsis_lines,
         CAST(len(list_intersect(list_distinct(nw), stops)) AS BIGINT) AS stop_words,
         {", ".join(f"CAST(coalesce(ngm.{k}_{n}gram_chars, 0) AS BIGINT) AS {k}_{n}gram_chars"
                    for k, n in [("top", 2), ("top", 3), ("top", 4)] + [("dup", n) for n in range(5, 11)])}
  FROM m2 LEFT JOIN ngm ON m2.id = ngm.id)"""


def waterfall_case(p: FilterParams, language: bool = True) -> str:
    """SQL ``CASE`` returning 'step|reason' for the first failing rule, in the Spark rule order."""
    r: list[tuple[str, str, str]] = [(STEP_POST_SCRAPE, "empty_after_post_scrape",
                                      f"NOT regexp_matches(text, {lit(ANY)})")]
    if language:
        langs = ", ".join(lit(x) for x in p.languages)
        r.append((STEP_LANGUAGE, "language",
                  f"language NOT IN ({langs}) OR language_score IS NULL OR language_score < {dbl(p.language_threshold)}"))
    s = STEP_REPETITION
    if p.dup_line_frac is not None:
        r.append((s, "dup_line_frac", f"{ratio('dup_lines', 'n_lines')} > {dbl(p.dup_line_frac)}"))
    if p.dup_para_frac is not None:
        r.append((s, "dup_para_frac", f"{ratio('dup_paras', 'n_paras')} > {dbl(p.dup_para_frac)}"))
    if p.dup_line_char_frac is not None:
        r.append((s, "dup_line_char_frac", f"{ratio('dup_line_chars', 'n_chars')} > {dbl(p.dup_line_char_frac)}"))
    if p.dup_para_char_frac is not None:
        r.append((s, "dup_para_char_frac", f"{ratio('dup_para_chars', 'n_chars')} > {dbl(p.dup_para_char_frac)}"))
    for n, thr in p.top_n_grams:
        r.append((s, f"top_{n}_gram", f"{ratio(f'top_{n}gram_chars', 'n_chars')} > {dbl(thr)}"))
    for n, thr in p.dup_n_grams:
        r.append((s, f"duplicated_{n}_n_grams", f"{ratio(f'dup_{n}gram_chars', 'word_chars')} > {dbl(thr)}"))
    s = STEP_LINE_QUALITY
    if p.line_punct_thr is not None:
        r.append((s, "line_punct_ratio", f"{ratio('punct_lines', 'n_lines')} <= {dbl(p.line_punct_thr)}"))
    if p.short_line_thr is not None:
        r.append((s, "short_line_ratio", f"{ratio('short_lines', 'n_lines')} >= {dbl(p.short_line_thr)}"))
    if p.char_duplicates_ratio is not None:
        r.append((s, "char_dup_ratio", f"{ratio('dup_line_chars', 'line_chars')} >= {dbl(p.char_duplicates_ratio)}"))
    if p.new_line_ratio is not None:
        r.append((s, "list_ratio", f"{ratio('newlines', 'n_words')} > {dbl(p.new_line_ratio)}"))
    s = STEP_DOC_QUALITY
    if p.min_doc_words is not None:
        r.append((s, "gopher_short_doc", f"n_words < {p.min_doc_words}"))
    if p.max_doc_words is not None:
        r.append((s, "gopher_long_doc", f"n_words > {p.max_doc_words}"))
    if p.min_avg_word_length is not None:
        r.append((s, "gopher_below_avg_threshold", f"{ratio('word_chars', 'n_words')} < {dbl(p.min_avg_word_length)}"))
    if p.max_avg_word_length is not None:
        r.append((s, "gopher_above_avg_threshold", f"{ratio('word_chars', 'n_words')} > {dbl(p.max_avg_word_length)}"))
    if p.max_symbol_word_ratio is not None:
        r.append((s, "gopher_too_many_hashes", f"{ratio('hashes', 'n_words')} > {dbl(p.max_symbol_word_ratio)}"))
        r.append((s, "gopher_too_many_ellipsis", f"{ratio('ellipses', 'n_words')} > {dbl(p.max_symbol_word_ratio)}"))
    if p.max_bullet_lines_ratio is not None:
        r.append((s, "gopher_too_many_bullets", f"{ratio('bullet_lines', 'n_lines')} > {dbl(p.max_bullet_lines_ratio)}"))
    if p.max_ellipsis_lines_ratio is not None:
        r.append((s, "gopher_too_many_end_ellipsis",
                  f"{ratio('ellipsis_lines', 'n_lines')} > {dbl(p.max_ellipsis_lines_ratio)}"))
    if p.max_non_alpha_words_ratio is not None:
        r.append((s, "gopher_below_alpha_threshold",
                  f"{ratio('alpha_words', 'n_words')} < {dbl(p.max_non_alpha_words_ratio)}"))
    if p.min_stop_words is not None and p.stop_words:
        r.append((s, "gopher_enough_stop_words", f"stop_words < {p.min_stop_words}"))
    whens = "\n    ".join(f"WHEN {cond} THEN {lit(st + '|' + rs)}" for st, rs, cond in r)
    return f"CASE\n    {whens}\n  END"


def waterfall_sql(p: FilterParams, src: str, id_col: str, text_col: str, lang_expr: str, score_expr: str,
                  select: str) -> str:
    """Full waterfall over ``src``; ``select`` is the final SELECT over CTE ``lab(id, text, filter_step, filter_reason)``."""
    return f"""
WITH
{post_scrape_ctes(src, id_col, text_col, p)},
{metric_ctes("ps", list(p.stop_words))},
fr AS (
  SELECT mx.id, mx.text, src.language, src.language_score
  FROM mx JOIN (SELECT {id_col} AS id, {lang_expr} AS language, {score_expr} AS language_score FROM {src}) src
    ON mx.id = src.id),
lab0 AS (
  SELECT mx.id, mx.text, {waterfall_case(p)} AS sr
  FROM mx JOIN (SELECT {id_col} AS id, {lang_expr} AS language, {score_expr} AS language_score FROM {src}) src
    ON mx.id = src.id),
lab AS (
  SELECT id, text, split_part(sr, '|', 1) AS filter_step, split_part(sr, '|', 2) AS filter_reason
  FROM lab0)
{select}"""


# --- MinHash (independent relational form) ---------------------------------------------------------------------------

def md5_31(expr: str) -> str:
    return f"(CAST(('0x' || substr(md5({expr}), 1, 8)) AS BIGINT) % 2147483647)"


def minhash_ctes(src: str, cfg, scope: tuple[str, ...] = ()) -> str:
    """CTEs over ``src(id, text, scope...)``: sig(id, k, mh), bands, edges(scope..., id, band, dup_of),
    comp(id, component) via a recursive CTE, clusters(scope..., id, cluster_id, size)."""
    n, r, k = cfg.n_grams, cfg.rows, cfg.bands * cfg.rows
    sc = "".join(f"{c}, " for c in scope)
    sc_eq = "".join(f"b1.{c} = b2.{c} AND " for c in scope)
    return f"""
mh_w AS (SELECT {sc}id, regexp_extract_all(lower(text), {lit(NORM)}) AS w FROM {src}),
mh_sh AS (
  SELECT DISTINCT id, array_to_string(w, ' ') AS s FROM mh_w WHERE len(w) < {n} AND len(w) > 0
  UNION
  SELECT DISTINCT id, array_to_string(list_slice(w, r.i, r.i + {n - 1}), ' ') AS s
  FROM mh_w, range(1, len(w) - {n} + 2) r(i) WHERE len(w) >= {n}),
mh_h AS (SELECT id, {md5_31('s')} AS h FROM mh_sh),
mh_p AS (
  SELECT t.k, (CAST(('0x' || substr(md5('a' || t.k), 1, 8)) AS BIGINT) % 2147483646) + 1 AS a,
         {md5_31("'b' || t.k")} AS b
  FROM range(1, {k + 1}) t(k)),
sig AS (SELECT id, k, min((a * h + b) % 2147483647) AS mh FROM mh_h, mh_p GROUP BY id, k),
bands AS (
  SELECT {"".join(f"w.{c}, " for c in scope)}s.id, (s.k - 1) // {r} AS band,
         string_agg(CAST(s.mh AS VARCHAR), ',' ORDER BY s.k) AS key
  FROM sig s JOIN mh_w w ON s.id = w.id GROUP BY ALL),
bmin AS (SELECT {sc}band, key, min(id) AS dup_of FROM bands GROUP BY ALL HAVING count(*) > 1),
edges AS (
  SELECT {"".join(f"b1.{c}, " for c in scope)}b1.id, b1.band, b2.dup_of
  FROM bands b1 JOIN bmin b2 ON {sc_eq}b1.band = b2.band AND b1.key = b2.key
  WHERE b1.id <> b2.dup_of),
und AS (SELECT id AS a, dup_of AS b FROM edges UNION SELECT dup_of AS a, id AS b FROM edges),
reach(a, b) AS (SELECT a, b FROM und UNION SELECT r.a, u.b FROM reach r JOIN und u ON r.b = u.a),
comp AS (SELECT a AS id, least(a, min(b)) AS component FROM reach GROUP BY a),
csize AS (SELECT component, count(*) AS size FROM comp GROUP BY component),
clusters AS (
  SELECT {"".join(f"s.{c}, " for c in scope)}s.id, coalesce(c.component, s.id) AS cluster_id,
         CAST(coalesce(z.size, 1) AS BIGINT) AS size
  FROM {src} s LEFT JOIN comp c ON s.id = c.id LEFT JOIN csize z ON c.component = z.component)"""


def upsampling_sql(size: str) -> str:
    from textsift.operators.dedup import UPSAMPLING_STEPS
    whens = " ".join(f"WHEN {size} >= {lo} THEN {w}" for lo, w in reversed(UPSAMPLING_STEPS))
    return f"CAST(CASE {whens} ELSE 1 END AS INTEGER)"
