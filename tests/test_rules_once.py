"""Waterfall rules are evaluated once, arrays made for the documents that get to a rule that reads them."""

import pytest
from pyspark.sql import functions as F

from textsift.functions import rules as R
from textsift.operators import waterfall as WF

ENGLISH = "Night fell over the quiet harbour, and one by one its lamps were lit.\nNobody spoke until the last boat was in."


@pytest.mark.parametrize("engine", ["arrow", "catalyst"])
def test_rules_are_evaluated_once(spark, engine):
    """A rule stands in the plan once, and the labels are those of the plain order."""
    texts = [ENGLISH, "x\n \n", None, "the same words the same words the same words the same words the same words", "a marked text de a que com " + ENGLISH.replace("\n", " ") * 2]
    df = spark.createDataFrame([(i, t, lang, s) for i, t in enumerate(texts) for lang, s in (("pt", 0.9), ("pt", None), ("en", 1.0), (None, 0.9))],
                               "id long, text string, language string, language_score double")
    out = WF.label(df, extra_rules=[WF.filter_where("u", "own", F.col("text").contains("marked"))], ngram_engine=engine)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("marked") == 1
    bound, c = R.bind(df.withColumn("text", WF.N.post_scrape(F.col("text"))), ngram_engine=engine)
    p = WF.FilterParams()
    rules = [("0_post_scraper", "empty_after_post_scrape", lambda c: WF.N.is_empty_text(c.text)),
             ("1_lang_exclusion", "language", lambda c: ~F.col("language").isin("pt") | F.col("language_score").isNull() | (F.col("language_score") < 0.799)),
             *WF.default_rules(p), ("u", "own", lambda c: c.text.contains("marked"))]
    plain = bound.select("id", "language", "language_score", *[F.coalesce(f(c), F.lit(False)).alias(f"r{i}") for i, (_, _, f) in enumerate(rules)]).collect()
    want = sorted(repr((r.id, r.language, r.language_score, *next(((s, k) for i, (s, k, _) in enumerate(rules) if r[f"r{i}"]), (None, None)))) for r in plain)
    got = sorted(repr((r.id, r.language, r.language_score, r.filter_step, r.filter_reason)) for r in out.collect())
    assert got == want and len(set(got)) == len(got)


def test_arrays_are_made_for_open_documents_only(spark):
    df = spark.createDataFrame([(1, "one two"), (2, "three")], "id long, text string")
    seen = R.first_failing(df, [lambda c: c.text == "three", lambda c: F.size(c.w) == 2])
    assert {r.id: r._rule for r in seen.collect()} == {1: 2, 2: 1}
    assert "CASE WHEN isnull(_rule" in seen._jdf.queryExecution().optimizedPlan().toString()


def test_survivors_are_unlabelled(spark):
    """A document that passes every rule has no step and no reason."""
    survivor = "A casa que fica no alto foi vista com a lua.\nO mar entrou para uma sala de pedra, e ninguém falou.\nDepois chegaram três barcos pequenos de pesca, cada um com dois homens cansados a bordo.\nUma criança trouxe pão quente, queijo fresco, figos maduros; todos comeram em silêncio sob estrelas."
    df = spark.createDataFrame([(1, survivor, "pt", 1.0), (2, "one two three", "pt", 1.0)], "id long, text string, language string, language_score double").repartition(1)
    out = WF.label(df)
    assert [(r.id, r.filter_step is None, r.filter_reason is None) for r in out.orderBy("id").collect()] == [(1, True, True), (2, False, False)]
    assert WF.split(out)[0].count() == 1


def test_words_are_counted_once(spark):
    """the rules on repetition and length read counts, not the array of words, which was joined anew by each."""
    df = spark.createDataFrame([(1, "one two three", "pt", 1.0)], "id long, text string, language string, language_score double")
    p = WF.label(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "_w#" not in p and p.count("AS _ws#") == 1


def test_lines_without_repeats_are_left(spark):
    """the cheap ways of post-scrape cleaning keep and drop the lines that the plain rule does."""
    lines = ["a b c", " a b c ", "a b", "", "\t", "\t", "one\x0btwo three", "one two ", "\x0b a  b\tc", "x" * 50_000, "a b\r", "a\rb\rc", "é è", "a b c d"]
    texts = ["\n".join(lines[i:j]) for i in range(len(lines)) for j in (i + 1, i + 2, len(lines))] + [None, "\n\n", "a b c\n\na b c\n"]

    def plain(text, n):
        seen, out = set(), []
        for x in text.split("\n"):
            words = x.encode().split()
            if words and (x.strip(" ") in seen or len(words) < n):
                seen.add(x.strip(" "))
                continue
            seen.add(x.strip(" "))
            out.append(x)
        return "\n".join(out)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for n in (0, 1, 2, 3, 5):
        got = {r.id: r.t for r in df.select("id", WF.N.post_scrape(F.col("text"), min_line_words=n).alias("t")).collect()}
        assert got == {i: None if t is None else plain(t, n) for i, t in enumerate(texts)}


def test_ngram_words():
    """words are split as bytes; the metrics are those of plain counts of characters."""
    from textsift.functions import ngrams as G
    for words in (["a"] * 7, list("abcabcabxabc"), ["é", "日本", "é", "日本", "z"], ["x"], [], list("abcdefg")):
        tops, dups = [], []
        for n in (1, 2, 3, 5):
            grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
            tops.append(max(((grams.count(g), len(" ".join(g))) for g in grams), default=(0, 0)))
            again = {i + j for i, g in enumerate(grams) if g in grams[:i] for j in range(n)}
            dups.append(sum(len(words[i]) for i in again))
        assert G.metrics("\x0b ".join(words), (1, 2, 3, 5), (1, 2, 3, 5)) == (*[c * x for c, x in tops], *dups)
