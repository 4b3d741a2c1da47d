"""Ordered filter waterfall.

A document is removed by the first rule it fails; later steps see survivors only; one (step, reason) per removed
document. A ``CASE WHEN`` chain numbers the first failing rule. It evaluates lazily and once, and is cut where a rule
first reads an array of tokens or the n-gram metrics (``rules.first_failing``), so these are only made for documents
that passed every rule before. No shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsift.functions import normalize as N
from textsift.functions import rules as R
from textsift.functions.text import ratio

STEP_POST_SCRAPE = "0_post_scraper"
STEP_LANGUAGE = "1_lang_exclusion"
STEP_REPETITION = "2_gopher_rep"
STEP_LINE_QUALITY = "3_fineweb_qual"
STEP_DOC_QUALITY = "4_gopher_qual"


# The reference's step names (above) and thresholds (below).
@dataclass(frozen=True)
class FilterParams:
    """Thresholds; defaults are the reference's call-site values (None disables a rule)."""
    # post-scrape
    remove_dup_lines: bool = True
    remove_short_lines: bool = True
    min_line_words: int = 3
    # language
    languages: tuple[str, ...] = ("pt",)
    language_threshold: float = 0.799
    # repetition
    dup_line_frac: float | None = 0.287
    dup_para_frac: float | None = None
    dup_line_char_frac: float | None = None
    dup_para_char_frac: float | None = None
    top_n_grams: tuple[tuple[int, float], ...] = ((2, 0.371), (3, 0.191), (4, 0.163))
    dup_n_grams: tuple[tuple[int, float], ...] = ((5, 0.163), (6, 0.153), (7, 0.141), (8, 0.13), (9, 0.119),
                                                  (10, 0.108))
    # line quality
    line_punct_thr: float | None = 0.077
    short_line_thr: float | None = 999.0
    short_line_length: int = 30
    char_duplicates_ratio: float | None = 0.1
    new_line_ratio: float | None = 0.186
    # document quality
    min_doc_words: int | None = 15
    max_doc_words: int | None = 100_000
    min_avg_word_length: float | None = 3
    max_avg_word_length: float | None = 13
    max_symbol_word_ratio: float | None = 0.1
    max_bullet_lines_ratio: float | None = 0.9
    max_ellipsis_lines_ratio: float | None = 0.3
    max_non_alpha_words_ratio: float | None = 0.814
    stop_words: tuple[str, ...] = tuple(R.STOP_WORDS_PT)
    min_stop_words: int | None = 2
    # optional user lexicon (bad words): remove when more than ``max_lexicon_hits`` occurrences; off by default
    lexicon: tuple[str, ...] = ()
    max_lexicon_hits: int | None = None


Rule = tuple[str, str, Callable[[R.Ctx], Column]]


def repetition_rules(p: FilterParams) -> list[Rule]:
    s = STEP_REPETITION
    out: list[Rule] = []
    if p.dup_line_frac is not None:
        out.append((s, "dup_line_frac", lambda c: ratio(R.T.n_dup(c.nb), F.size(c.nb)) > p.dup_line_frac))
    if p.dup_para_frac is not None:
        out.append((s, "dup_para_frac", lambda c: ratio(R.T.n_dup(R.T.nonblank(R.T.paragraphs(c.text))),
                                                        F.size(R.T.nonblank(R.T.paragraphs(c.text))))
                    > p.dup_para_frac))
    if p.dup_line_char_frac is not None:
        out.append((s, "dup_line_char_frac", lambda c: ratio(R.T.dup_chars(c.nb), F.length(c.text))
                    > p.dup_line_char_frac))
    if p.dup_para_char_frac is not None:
        out.append((s, "dup_para_char_frac", lambda c: ratio(R.T.dup_chars(R.T.nonblank(R.T.paragraphs(c.text))),
                                                             F.length(c.text)) > p.dup_para_char_frac))
    for n, thr in p.top_n_grams:
        out.append((s, f"top_{n}_gram", lambda c, n=n, thr=thr: ratio(R.top_chars(c, n), F.length(c.text))
                    > thr))
    for n, thr in p.dup_n_grams:
        out.append((s, f"duplicated_{n}_n_grams",
                    lambda c, n=n, thr=thr: ratio(R.dup_chars_n(c, n), c.word_chars) > thr))
    return out


def line_quality_rules(p: FilterParams) -> list[Rule]:
    s = STEP_LINE_QUALITY
    out: list[Rule] = []
    if p.line_punct_thr is not None:
        out.append((s, "line_punct_ratio", lambda c: ratio(
            F.size(F.filter(c.nb, lambda x: x.rlike(R.END_PUNCT_RE))), F.size(c.nb)) <= p.line_punct_thr))
    if p.short_line_thr is not None:
        out.append((s, "short_line_ratio", lambda c: ratio(
            F.size(F.filter(c.nb, lambda x: F.length(x) < p.short_line_length)), F.size(c.nb)) >= p.short_line_thr))
    if p.char_duplicates_ratio is not None:
        out.append((s, "char_dup_ratio", lambda c: ratio(R.T.dup_chars(c.nb), R.T.total_length(c.nb))
                    >= p.char_duplicates_ratio))
    if p.new_line_ratio is not None:
        out.append((s, "list_ratio", lambda c: ratio(R.T.count_substr(c.text, "\n"), c.n_words) > p.new_line_ratio))
    return out


def doc_quality_rules(p: FilterParams) -> list[Rule]:
    s = STEP_DOC_QUALITY
    out: list[Rule] = []
    nw = lambda c: c.n_words
    if p.min_doc_words is not None:
        out.append((s, "gopher_short_doc", lambda c: nw(c) < p.min_doc_words))
    if p.max_doc_words is not None:
        out.append((s, "gopher_long_doc", lambda c: nw(c) > p.max_doc_words))
    if p.min_avg_word_length is not None:
        out.append((s, "gopher_below_avg_threshold",
                    lambda c: ratio(c.word_chars, nw(c)) < p.min_avg_word_length))
    if p.max_avg_word_length is not None:
        out.append((s, "gopher_above_avg_threshold",
                    lambda c: ratio(c.word_chars, nw(c)) > p.max_avg_word_length))
    if p.max_symbol_word_ratio is not None:
        out.append((s, "gopher_too_many_hashes",
                    lambda c: ratio(R.T.count_substr(c.text, "#"), nw(c)) > p.max_symbol_word_ratio))
        out.append((s, "gopher_too_many_ellipsis", lambda c: ratio(
            R.T.count_substr(c.text, "...") + R.T.count_substr(c.text, "…"), nw(c)) > p.max_symbol_word_ratio))
    if p.max_bullet_lines_ratio is not None:
        out.append((s, "gopher_too_many_bullets", lambda c: ratio(
            F.size(F.filter(c.nb, lambda x: x.rlike(R.BULLET_LINE_RE))), F.size(c.nb)) > p.max_bullet_lines_ratio))
    if p.max_ellipsis_lines_ratio is not None:
        out.append((s, "gopher_too_many_end_ellipsis", lambda c: ratio(
            F.size(F.filter(c.nb, lambda x: x.rlike(R.ELLIPSIS_LINE_RE))), F.size(c.nb))
            > p.max_ellipsis_lines_ratio))
    if p.max_non_alpha_words_ratio is not None:
        out.append((s, "gopher_below_alpha_threshold", lambda c: ratio(c.alpha_words, nw(c)) < p.max_non_alpha_words_ratio))
    if p.max_lexicon_hits is not None and p.lexicon:
        out.append((s, "lexicon_hits", lambda c: R.lexicon_hits(c, list(p.lexicon)) > p.max_lexicon_hits))
    if p.min_stop_words is not None and p.stop_words:
        stops = F.array(*[F.lit(x) for x in p.stop_words])
        out.append((s, "gopher_enough_stop_words", lambda c: F.size(
            F.array_intersect(F.array_distinct(c.nw), stops)) < p.min_stop_words))
    return out


def default_rules(p: FilterParams) -> list[Rule]:
    return repetition_rules(p) + line_quality_rules(p) + doc_quality_rules(p)


def filter_where(step: str, reason: str, predicate: Column) -> Rule:
    """A user predicate as a waterfall rule (U1): documents for which ``predicate`` is true are removed."""
    return (step, reason, lambda c: predicate)


def label(df: DataFrame, params: FilterParams = FilterParams(), *, text_col: str = "text",
          language_col: str | None = "language", score_col: str | None = "language_score",
          rules: list[Rule] | None = None, extra_rules: list[Rule] = (), ngram_engine: str = "arrow") -> DataFrame:
    """Add ``text`` (post-scraped), ``filter_step`` and ``filter_reason`` (null when kept).

    Step order: post-scrape emptiness, language, then ``rules`` (default: repetition, line quality, document
    quality), then ``extra_rules``. The language step runs only when the language columns are given.
    """
    cleaned = N.post_scrape(F.col(text_col), params.remove_dup_lines, params.remove_short_lines,
                            params.min_line_words)
    out = df.withColumn(text_col, cleaned)
    chain = [(STEP_POST_SCRAPE, "empty_after_post_scrape", lambda c: N.is_empty_text(c.text))]
    if language_col is not None:
        langs = list(params.languages)
        chain.append((STEP_LANGUAGE, "language", lambda c: ~F.col(language_col).isin(langs)
                      | F.col(score_col).isNull() | (F.col(score_col) < params.language_threshold)))
    body = (rules if rules is not None else default_rules(params)) + list(extra_rules)
    chain += body

    rule = "_rule"
    while rule in map(str.lower, out.columns):
        rule = "_" + rule
    numbered = R.first_failing(out, [pred for _s, _r, pred in chain], text_col, ngram_engine, rule)
    # (``element_at`` counts as never null for an array without nulls, even where its index is null)
    named = lambda k: F.when(F.col(rule).isNotNull(), F.element_at(F.array(*[F.lit(r[k]) for r in chain]), F.col(rule)))
    return numbered.select(*out.columns, named(0).alias("filter_step"), named(1).alias("filter_reason"))


def split(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) from a labelled frame; persist ``labelled`` first when both are written."""
    return (labelled.where(F.col("filter_step").isNull()).drop("filter_step", "filter_reason"),
            labelled.where(F.col("filter_step").isNotNull()))


def format_survivors(kept: DataFrame, *, text_col: str = "text", fix_encoding: bool = True, mask_pii: bool = True,
                     symbols: tuple[str, ...] = ("|",), replace_char: str = "\n",
                     token_counter: Callable[[Column], Column] = N.token_count) -> DataFrame:
    """Formatters on survivors, in the reference's order, then the token count."""
    t = F.col(text_col)
    if fix_encoding:
        t = N.fix_encoding(t)
    if mask_pii:
        t = N.mask_ip(N.mask_email(t))
    if symbols:
        t = N.remove_symbol_lines(t, list(symbols), replace_char)
    out = kept.withColumn(text_col, t)
    return out.withColumn("token_count", token_counter(F.col(text_col)))
