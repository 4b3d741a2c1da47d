"""Corpus statistics as tidy aggregate tables.

Every statistic is a ``groupBy``/``rollup``/window over the labelled or classified corpus; nothing is collected to
the driver. Grouping keys are low-cardinality (step, reason, language, tier, collection, domain), so partial
aggregation collapses each map task's rows before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Token-length thresholds of the cumulative length distribution (label, minimum tokens).
TOKEN_BUCKETS = [("4k", 4000), ("8k", 8000), ("16k", 16000), ("32k", 32000), ("64k", 64000), ("128k", 128000),
                 ("256k", 256000)]


def reason_counts(labelled: DataFrame, step_col: str = "filter_step", reason_col: str = "filter_reason") -> DataFrame:
    """A3: removed documents per (step, reason) plus a ``total`` row per step (rollup levels 0 and 1)."""
    removed = labelled.where(F.col(step_col).isNotNull())
    g = (removed.rollup(step_col, reason_col)
         .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_gid")))
    return (g.where(F.col("_gid") < 3)
            .select(F.col(step_col).alias("filter_step"),
                    F.when(F.col("_gid") == 1, F.lit("total")).otherwise(F.col(reason_col)).alias("filter_reason"),
                    F.col("n").cast("bigint").alias("n")))


def language_score_hist(removed_lang: DataFrame, target: str, lang_col: str = "language",
                        score_col: str = "language_score") -> DataFrame:
    """A1: removed documents of the target language per exact score."""
    return (removed_lang.where(F.col(lang_col) == target).groupBy(score_col)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def removed_per_language(removed_lang: DataFrame, lang_col: str = "language") -> DataFrame:
    """A2: removed documents per detected language."""
    return removed_lang.groupBy(F.col(lang_col).alias("language")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def corpus_totals(docs: DataFrame, tier_col: str = "quality_label", tokens_col: str = "token_count") -> DataFrame:
    """A4: entries and tokens per tier."""
    return docs.groupBy(F.col(tier_col).alias("tier")).agg(
        F.count(F.lit(1)).cast("bigint").alias("total_entries"),
        F.coalesce(F.sum(tokens_col), F.lit(0)).cast("bigint").alias("total_token_count"))


def token_distribution(docs: DataFrame, tier_col: str = "quality_label", tokens_col: str = "token_count") -> DataFrame:
    """A5: cumulative counts of documents with at least 4k, 8k, ..., 256k tokens, per tier (long format)."""
    tok = F.coalesce(F.col(tokens_col), F.lit(0))
    wide = docs.groupBy(F.col(tier_col).alias("tier")).agg(
        *[F.sum(F.when(tok >= lo, 1).otherwise(0)).cast("bigint").alias(f"b_{name}") for name, lo in TOKEN_BUCKETS])
    stack = ", ".join(f"'{name}', b_{name}" for name, _ in TOKEN_BUCKETS)
    return wide.selectExpr("tier", f"stack({len(TOKEN_BUCKETS)}, {stack}) AS (bucket, n)")


def domain_counts(docs: DataFrame, url_col: str = "url", tier_col: str | None = None) -> DataFrame:
    """Documents per domain (``netloc``: userinfo and port included), empty domains skipped."""
    from textsift.functions.urls import netloc
    d = docs.select(*([F.col(tier_col).alias("tier")] if tier_col else []), netloc(F.col(url_col)).alias("domain"))
    keys = (["tier"] if tier_col else []) + ["domain"]
    return (d.where(F.col("domain").isNotNull() & (F.col("domain") != ""))
            .groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def tokens_per_collection(docs: DataFrame, collection_col: str = "collection", tokens_col: str = "token_count",
                          tier_col: str | None = None) -> DataFrame:
    """Token sum per collection."""
    keys = ([F.col(tier_col).alias("tier")] if tier_col else []) + [F.col(collection_col).alias("collection")]
    return docs.groupBy(*keys).agg(F.coalesce(F.sum(tokens_col), F.lit(0)).cast("bigint").alias("tokens"))


def with_grand_total(per_tier: DataFrame, key_cols: list[str], value_cols: list[str],
                     tiers: tuple[str, ...] = ("medium", "high"), total_label: str = "total") -> DataFrame:
    """Key-wise sums over the selected tiers only, as tier ``total``. Each row counts for its tier and, if the tier is
    selected, for the total: one pass over the input, not one branch for each."""
    shares = F.array_compact(F.array(F.struct(F.col("tier").alias("t")), F.when(F.col("tier").isin(list(tiers)), F.struct(F.lit(total_label).alias("t")))))
    rows = per_tier.select(F.explode(shares).alias("s"), *key_cols, *value_cols)
    out = rows.groupBy(F.col("s.t").alias("tier"), *key_cols).agg(*[F.sum(v).cast("bigint").alias(v) for v in value_cols])
    # without any selected tier there still is a total where there are no keys
    if key_cols:
        return out
    zero = per_tier.sparkSession.range(1).select(F.lit(total_label).alias("tier"), *[F.lit(None).cast("bigint").alias(v) for v in value_cols])
    return out.unionByName(zero).groupBy("tier").agg(*[F.sum(v).cast("bigint").alias(v) for v in value_cols])


def reason_share(counts: DataFrame) -> DataFrame:
    """100 * count / step total (0 when the total is 0), for the reason rows of ``reason_counts``."""
    tot = F.max(F.when(F.col("filter_reason") == "total", F.col("n"))).over(Window.partitionBy("filter_step"))
    out = counts.withColumn("_tot", tot).where(F.col("filter_reason") != "total")
    return out.select("filter_step", "filter_reason", "n",
                      F.when(F.col("_tot") > 0, F.round(F.lit(100.0) * F.col("n") / F.col("_tot"), 6))
                      .otherwise(F.lit(0.0)).alias("pct"))


def compare_runs(counts: DataFrame, run_col: str = "run") -> DataFrame:
    """A10: every (run, step, reason) combination present in any run, absent ones filled with 0.

    Runs are few (a handful of inputs); the key set is small. Built as distinct keys joined with distinct runs
    on the step, then a left join of the counts. ``counts`` is read three times, so it is checkpointed first (a
    small aggregate; reliable checkpoint in ``spark.checkpoint.dir``) instead of recomputing its input.
    """
    from textsift.session import checkpoint_dir
    checkpoint_dir(counts.sparkSession)
    counts = counts.checkpoint()
    keys = counts.select("filter_step", "filter_reason").distinct()
    runs = counts.select(run_col, "filter_step").distinct()
    grid = runs.join(keys, "filter_step")
    return (grid.join(counts, [run_col, "filter_step", "filter_reason"], "left")
            .select(run_col, "filter_step", "filter_reason", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def top_n_with_others(counts: DataFrame, key_col: str, n_col: str = "n", top: int = 40,
                      others: str = "Others") -> DataFrame:
    """The ``top`` keys by count (ties by key) and one ``Others`` row with the rest (0 when none).

    The head is a distributed top-k (``TakeOrderedAndProject``), at most ``top`` rows, so broadcasting it back is
    bounded; every other key is folded into ``Others`` by one aggregation.
    """
    head = (counts.orderBy(F.col(n_col).desc(), F.col(key_col).asc()).limit(top)
            .select(F.col(key_col).alias("_k"), F.lit(True).alias("_top")))
    marked = counts.join(F.broadcast(head), counts[key_col].eqNullSafe(head["_k"]), "left")
    rest = F.col("_top").isNull()
    key = F.when(~rest, F.col(key_col)).otherwise(F.lit(others))
    zero = counts.sparkSession.range(1).select(F.lit(True).alias("rest"), F.lit(others).alias("key"), F.lit(0).cast("bigint").alias("n"))
    rows = marked.select(rest.alias("rest"), key.alias("key"), F.col(n_col).cast("bigint").alias("n")).unionByName(zero)
    # a null key, or one named like the rest, stays a row of its own
    return rows.groupBy("rest", "key").agg(F.sum("n").cast("bigint").alias("n")).select("key", "n")


def top_k(counts: DataFrame, key_col: str, n_col: str = "n", k: int = 50) -> DataFrame:
    """The ``k`` largest keys by count (ties by key); ``TakeOrderedAndProject``, no full sort."""
    return counts.orderBy(F.col(n_col).desc(), F.col(key_col).asc()).limit(k)


def rounded_score_counts(hist: DataFrame, score_col: str = "language_score", n_col: str = "n",
                         digits: int = 3) -> DataFrame:
    """Merge score counts after rounding to ``digits`` decimals (half-up on the decimal form)."""
    r = F.round(F.col(score_col).cast("decimal(20,10)"), digits).cast("double")
    return hist.groupBy(r.alias("score")).agg(F.sum(n_col).cast("bigint").alias("n"))


def format_count(x: Column) -> Column:
    """>= 1e6 -> 'x.xM', >= 1e3 -> 'x.xK', else the integer; one decimal rounded half-up, in exact integer
    arithmetic (the Python original rounds the binary float, so 1250 gave '1.2K'; here it is '1.3K')."""
    v = x.cast("bigint")

    def tenths(unit: int) -> Column:
        t = F.floor((v + F.lit(unit // 20)) / F.lit(unit // 10)).cast("bigint")
        return F.concat(F.floor(t / 10).cast("bigint").cast("string"), F.lit("."), (t % 10).cast("string"))

    return (F.when(v >= 1_000_000, F.concat(tenths(1_000_000), F.lit("M")))
            .when(v >= 1_000, F.concat(tenths(1_000), F.lit("K")))
            .otherwise(v.cast("string")))


def pretty_reason(x: Column) -> Column:
    """A16: '_' -> ' ', first letter upper, rest lower (reasons)."""
    s = F.regexp_replace(x, "_", " ")
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))


def pretty_step(x: Column) -> Column:
    """A16: '_' -> ' ', every word capitalised (steps)."""
    return F.initcap(F.regexp_replace(x, "_", " "))


def keep_ranges(dist: DataFrame, min_count: int = 100, drop: tuple[str, ...] = ("4k",)) -> DataFrame:
    """Ranges with more than ``min_count`` documents, ``4k`` excluded."""
    return dist.where((F.col("n") > min_count) & ~F.col("bucket").isin(list(drop)))


def observe_counts(df: DataFrame, name: str):
    """Stage accounting without an extra job: ``df.observe`` metrics, read after the action."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("entries")), obs
