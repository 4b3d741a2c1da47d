"""Mixing sources to target weights by hierarchical budgeting (operator 3), in column expressions only.

The levels (domain, language, source) make a tree. Its root gets the token budget; every node shares its own among
its children by their weights, no child getting more than ``max_epochs`` times the tokens below it. What one child can't use goes to its siblings by their
weights (water-filling), so a shortage reaches a node's own siblings only when all of its children are full. A leaf
with budget b and a tokens is read in seeded epochs: b // a whole ones, and of the next, whose documents are ordered
by MD5 of seed, epoch and id, the first b % a tokens.

Scale: documents are reduced to (id, levels, tokens), aggregated to leaves and to ``4096`` ranges of the seeded order
for each leaf; running sums go over ranges first and then within one range, so the largest source is 4096 groups, not
one. Node tables have a row for each source.

Integers throughout; shares are rounded down, so at most one token for each child of a node is not given out.
Defined cases: a null level value is the value ``none``; a null or empty text has no tokens and is never taken. Rows
that share an id share its place in the order, the shorter first; rows without id share one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textsift.llm.common import fresh, n_words, saved

RANGE_DIGITS = 3  # leading hex digits of the order key: 16 ** 3 ranges
BIG = "decimal(38,0)"


def weight_of(level: str, value: Column, weights: dict[str, dict[str, int]]) -> Column:
    """Weight of a node among its siblings: by its own value, 1 where none is given."""
    given = weights.get(level, {})
    if not given:
        return F.lit(1).cast(BIG)
    table = F.create_map(*[F.lit(x) for kv in given.items() for x in kv])
    return F.coalesce(F.try_element_at(table, value), F.lit(1)).cast(BIG)


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget: int) -> DataFrame:
    """``leaves`` (levels, tokens, cap) with the budget of each."""
    total = leaves.agg(F.sum("cap")).first()[0] or 0
    given = None
    for depth in range(1, len(levels) + 1):
        up, here = levels[:depth - 1], levels[:depth]
        nodes = leaves.groupBy(*here).agg(F.sum("cap").cast(BIG).alias("cap")).withColumn("w", weight_of(levels[depth - 1], F.col(levels[depth - 1]), weights))
        nodes = nodes.join(given, up) if up else nodes.withColumn("budget", F.lit(min(budget, int(total))).cast("bigint"))  # the root's
        by = Window.partitionBy(*up) if up else Window.partitionBy(F.lit(0))
        order = by.orderBy((F.col("cap") / F.col("w")).asc(), F.col(levels[depth - 1]).asc()).rowsBetween(Window.unboundedPreceding, -1)
        zero = F.lit(0).cast(BIG)
        nodes = nodes.withColumn("cap_before", F.coalesce(F.sum("cap").over(order), zero)).withColumn(
            "w_rest", F.sum("w").over(by) - F.coalesce(F.sum("w").over(order), zero))
        # full: at the water level of what is left for it and those after it, its share is at least what it can use
        full = F.col("cap") * F.col("w_rest") <= (F.col("budget").cast(BIG) - F.col("cap_before")) * F.col("w")
        nodes = nodes.withColumn("full", full)
        nodes = nodes.withColumn("left", F.col("budget").cast(BIG) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(zero)).over(by))
        nodes = nodes.withColumn("w_left", F.sum(F.when(F.col("full"), zero).otherwise(F.col("w"))).over(by))
        share = F.when(F.col("full"), F.col("cap").cast("bigint")).otherwise(F.expr("(`left` * w) div w_left"))
        given = saved(nodes.select(*here, share.alias("budget")), "budgets")
    return leaves.join(given, levels)


def mixture(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], *, id_col: str = "doc_id", text_col: str = "text",
            budget: tuple[int, int] = (3, 2), max_epochs: int = 4, seed: int = 7) -> DataFrame:
    """(doc_id, levels..., n_tokens, copies, last_tokens) of every document taken: whole epochs, and tokens from the last.

    ``budget``: numerator and denominator of the share of all tokens that the mixture shall have.
    """
    names = list(levels)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), *[F.coalesce(c, F.lit("none")).alias(k) for k, c in levels.items()], n_words(F.col(text_col)).alias("n_tokens"))
    rows = saved(rows, "tokens").where(F.col("n_tokens") > 0)
    leaves = saved(rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")).withColumn("cap", F.col("tokens") * max_epochs), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = leaf_budgets(leaves, names, weights, total * budget[0] // budget[1])
    plan = saved(plan.select(*names, F.expr("budget div tokens").alias("copies"), (F.col("budget") % F.col("tokens")).alias("rest")), "plan")

    if plan.count() <= 50_000:  # a row for each source, some 100 bytes: at most 5 MB
        plan = F.broadcast(plan)
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("copies").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    placed = rows.join(plan, names).select("*", key.alias("key")).withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    ranges = placed.groupBy(*names, "range").agg(F.sum("n_tokens").alias("sum"))
    before = F.sum("sum").over(Window.partitionBy(*names).orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select(*names, "range", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy(*names, "range").orderBy("key", "n_tokens").rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.join(ranges, [*names, "range"]).select("*", (F.col("before") + F.coalesce(inside, F.lit(0))).alias("at"))
    last = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("n_tokens"), F.col("rest") - F.col("at")))
    return placed.select("doc_id", *names, "n_tokens", "copies", last.alias("last_tokens")).where((F.col("copies") > 0) | (F.col("last_tokens") > 0))


def select_documents(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], *, id_col: str = "doc_id", text_col: str = "text",
                     budget: tuple[int, int] = (9, 10), seed: int = 7) -> DataFrame:
    """The documents of one epoch's mixture, whole: those of which at least one token is taken. Columns are those of ``docs``.

    Rows that share an id stay or go together.
    """
    taken = mixture(docs, levels, weights, id_col=id_col, text_col=text_col, budget=budget, max_epochs=1, seed=seed)
    (rid,) = fresh(docs, "taken_id")
    return docs.join(taken.select(F.col("doc_id").alias(rid)).distinct(), F.col(id_col).eqNullSafe(F.col(rid)), "left_semi")


# The tables have no domain: one is derived from the source's number.
DOMAINS = {0: "web", 1: "books", 2: "code"}
WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}, "source": {"src0": 2}}


def document_levels() -> dict[str, Column]:
    n = F.regexp_extract(F.coalesce(F.col("source"), F.lit("")), "[0-9]{1,9}", 0)
    n = F.when(n != "", n.cast("int") % len(DOMAINS))
    domain = F.coalesce(*[F.when(n == k, F.lit(v)) for k, v in DOMAINS.items()], F.lit("none"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def oracle(budget: tuple[int, int], max_epochs: int, seed: int) -> str:
    """DuckDB form of ``mixture`` over ``documents`` with ``document_levels`` and ``WEIGHTS``."""
    names = ["domain", "lang", "source"]
    case = lambda level: "CASE " + level + "".join(f" WHEN '{k}' THEN {v}" for k, v in WEIGHTS[level].items()) + " ELSE 1 END"
    domain = "CASE try_cast(nullif(regexp_extract(source, '[0-9]{1,9}'), '') AS INTEGER) % 3" + "".join(f" WHEN {k} THEN '{v}'" for k, v in DOMAINS.items()) + " ELSE 'none' END"
    ctes = [f"""r AS (SELECT doc_id, {domain} AS domain, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS n_tokens FROM documents)""",
            f"leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens, CAST(sum(n_tokens) * {max_epochs} AS HUGEINT) AS cap FROM r WHERE n_tokens > 0 GROUP BY ALL)",
            f"b0 AS (SELECT least((SELECT sum(tokens) * {budget[0]} // {budget[1]} FROM leaf), (SELECT sum(cap) FROM leaf)) AS budget)"]
    for d in range(1, 4):
        here, up = ", ".join(names[:d]), ", ".join(names[:d - 1]) or "0"
        join = f"JOIN b{d - 1} USING ({', '.join(names[:d - 1])})" if d > 1 else "CROSS JOIN b0"
        ctes += [f"n{d} AS (SELECT *, CAST({case(names[d - 1])} AS HUGEINT) AS w FROM (SELECT {here}, CAST(sum(cap) AS HUGEINT) AS cap FROM leaf GROUP BY ALL) {join})",
                 f"""f{d} AS (SELECT *, cap * (sum(w) OVER (PARTITION BY {up}) - coalesce(sum(w) OVER o, 0)) <= (budget - coalesce(sum(cap) OVER o, 0)) * w AS is_full FROM n{d}
  WINDOW o AS (PARTITION BY {up} ORDER BY CAST(cap AS DOUBLE) / CAST(w AS DOUBLE), {names[d - 1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
                 f"""b{d} AS (SELECT {here}, CAST(CASE WHEN is_full THEN cap ELSE CAST((budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER p) * w AS HUGEINT)
    // CAST(greatest(sum(CASE WHEN is_full THEN 0 ELSE w END) OVER p, 1) AS HUGEINT) END AS HUGEINT) AS budget FROM f{d} WINDOW p AS (PARTITION BY {up}))"""]
    ctes.append(f"""k AS (SELECT doc_id, domain, lang, source, n_tokens, CAST(budget // tokens AS BIGINT) AS copies, CAST(budget % tokens AS BIGINT) AS rest,
  md5('{seed}:' || (budget // tokens) || ':' || coalesce(CAST(doc_id AS VARCHAR), 'none')) AS key FROM r JOIN leaf USING (domain, lang, source) JOIN b3 USING (domain, lang, source) WHERE n_tokens > 0)""")
    ctes.append("""t AS (SELECT doc_id, domain, lang, source, n_tokens, copies, CAST(greatest(0, least(n_tokens, rest - coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, n_tokens
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS last_tokens FROM k)""")
    return "WITH " + ",\n".join(ctes) + "\nSELECT * FROM t WHERE copies > 0 OR last_tokens > 0"
