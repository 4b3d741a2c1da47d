"""End-to-end plans: raw pages -> documents, and documents -> filtered, deduplicated, tiered corpus.

These chain the operators the way the reference chains its scripts, but as one Spark program per entry: the only
shuffles are the spread of small inputs, the MinHash band aggregation, the component rounds and the statistics.
The labelled frame is written once, as a table in the shared folder, because both its kept and removed halves are
consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsift.functions import urls as U
from textsift.operators import dedup as D
from textsift.operators import extract as X
from textsift.operators import language as LG
from textsift.operators import minhash as M
from textsift.operators import scoring as SC
from textsift.operators import waterfall as WF
from textsift.session import saved


def pages_to_documents(pages: DataFrame, *, id_col: str = "page_id", variant: str | None = "br",
                       lang_tok: str = "pt", date_col: str | None = None, file_col: str | None = None) -> DataFrame:
    """Archive route: URL filter (F4) before the costly extraction (X1), then non-empty text (F6) and the assembled
    ``document`` (X2: text, title, metadata with url, date and file path)."""
    p = pages.where(U.not_foreign_variant(F.col("url"), variant, lang_tok)) if variant else pages
    keep = [id_col, "url"] + [c for c in (date_col, file_col) if c]
    docs = p.select(*keep, X.page_parts(F.col("html")).alias("_x")).select(*keep, "_x.title", "_x.text")
    docs = docs.where(F.col("text") != "").withColumn("title", F.when(F.col("title") != "", F.col("title")))
    of = lambda c: F.col(c) if c else F.lit(None).cast("string")
    return docs.withColumn("document", X.to_document(F.col("text"), F.col("title"), F.col("url"), of(date_col), of(file_col)))


def curate(docs: DataFrame, quality_model, *, params: WF.FilterParams = WF.FilterParams(),
           language_model: LG.LanguageModel | None = None, id_col: str = "doc_id",
           collection_col: str = "collection", cfg: M.MinhashConfig = M.PER_COLLECTION):
    """Filter (language + waterfall + formatters), deduplicate per collection, score and tier.

    Returns ``(tiered, labelled)``: the final documents with ``quality_label`` etc., and the labelled frame with
    every removed document's step and reason (for the removed sinks and the reason statistics).
    """
    if language_model is not None:
        docs = LG.with_language(language_model, docs)
    labelled = saved(WF.label(docs, params), "labelled")  # an eager checkpoint would run the waterfall twice
    kept, _removed = WF.split(labelled)
    formatted = WF.format_survivors(kept)
    deduped, _dups = D.dedup(formatted, cfg, id_col=id_col, scope=(collection_col,))
    tiered = SC.score_documents(quality_model, deduped)
    return tiered, labelled
