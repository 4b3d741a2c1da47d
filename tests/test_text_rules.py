"""Rule metrics and formatters on literal rows: values at, just below and just above each threshold."""
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textsift.functions import normalize as N
from textsift.functions import ngrams as G
from textsift.functions import rules as R
from textsift.operators import waterfall as WF


def one(spark, text, col):
    return spark.createDataFrame([(text,)], "text string").select(col.alias("x")).collect()[0]["x"]


def metrics(spark, text, builder, engine="catalyst"):
    df = spark.createDataFrame([(1, text)], "id long, text string")
    b, c = R.bind(df, ngram_engine=engine)
    m = builder(c)
    return b.select(*[m[k].alias(k) for k in m]).collect()[0].asDict()


def test_dedup_lines_keeps_first_and_blank(spark):
    t = "a b c\n\nx y z\n a b c \n\nq r s"
    assert one(spark, t, N.post_scrape(F.col("text"), True, False)) == "a b c\n\nx y z\n\nq r s"


def test_short_lines_dropped_blank_kept(spark):
    t = "one two\n\nthree four five\nsix"
    assert one(spark, t, N.post_scrape(F.col("text"), False, True)) == "\nthree four five"


def test_post_scrape_empty(spark):
    for t in ["", "\n\n", "one", "a b\nc d"]:
        out = one(spark, t, N.post_scrape(F.col("text")))
        assert one(spark, out, N.is_empty_text(F.col("text"))) is True


def test_null_text(spark):
    df = spark.createDataFrame([(1, None)], "id long, text string")
    lab = WF.label(df.withColumn("language", F.lit("pt")).withColumn("language_score", F.lit(1.0)))
    r = lab.collect()[0]
    assert r["filter_step"] == WF.STEP_POST_SCRAPE


def test_mask_email_and_ip(spark):
    t = "mail me at john.doe@example.org or 10.0.0.1 and 1.2.3.4 5.6.7.8 but not 999.1.1.1 or v1.2.3.4.5"
    out = one(spark, t, N.mask_ip(N.mask_email(F.col("text"))))
    assert "john.doe" not in out and "email@example.com" in out
    assert "10.0.0.1" not in out and "1.2.3.4 " not in out and "5.6.7.8" not in out
    assert "999.1.1.1" in out and "1.2.3.4.5" in out


def test_symbol_lines(spark):
    assert one(spark, "a\n|\nb", N.remove_symbol_lines(F.col("text"))) == "a\nb"
    assert one(spark, "a | b", N.remove_symbol_lines(F.col("text"))) == "a | b"
    assert one(spark, "a\n|\n | \nb", N.remove_symbol_lines(F.col("text"))) == "a\nb"


def test_fix_encoding(spark):
    assert one(spark, "nÃ£o", N.fix_encoding(F.col("text"))) == "não"
    assert one(spark, "não", N.fix_encoding(F.col("text"))) == "não"
    assert one(spark, "Ã", N.fix_encoding(F.col("text"))) == "Ã"
    assert one(spark, "日本 Ã£", N.fix_encoding(F.col("text"))) == "日本 Ã£"


def test_token_count(spark):
    assert one(spark, "Olá, mundo! 42", N.token_count(F.col("text"))) == 5


def test_mean_word_length_boundaries(spark):
    p = WF.FilterParams(languages=("pt",))
    rules = WF.doc_quality_rules(WF.FilterParams(min_doc_words=None, max_symbol_word_ratio=None,
                                                 max_non_alpha_words_ratio=None, min_stop_words=None))

    def reason(text):
        df = spark.createDataFrame([(text,)], "text string").withColumn("language", F.lit("pt")) \
            .withColumn("language_score", F.lit(1.0))
        return WF.label(df, WF.FilterParams(remove_short_lines=False), rules=rules).collect()[0]["filter_reason"]

    assert reason("ab abc abcd") is None                       # mean 3.0: kept (< 3 removes)
    assert reason("ab ab abcd") == "gopher_below_avg_threshold"  # 2.67
    assert reason("abcdefghijklm abcdefghijklm") is None         # 13: kept (> 13 removes)
    assert reason("abcdefghijklmn abcdefghijklm") == "gopher_above_avg_threshold"
    assert p.min_avg_word_length == 3


def test_ellipsis_lines_boundary(spark):
    rules = WF.doc_quality_rules(WF.FilterParams(min_doc_words=None, max_symbol_word_ratio=None,
                                                 max_non_alpha_words_ratio=None, min_stop_words=None))

    def reason(lines):
        df = spark.createDataFrame([("\n".join(lines),)], "text string").withColumn("language", F.lit("pt")) \
            .withColumn("language_score", F.lit(1.0))
        return WF.label(df, WF.FilterParams(remove_short_lines=False, remove_dup_lines=False),
                        rules=rules).collect()[0]["filter_reason"]

    ell = [f"line number {i} ends…" for i in range(3)]
    plain = [f"line number {i} ends." for i in range(7)]
    assert reason(ell + plain) is None                                  # 0.3 kept
    assert reason(ell + [ell[0] + " x…"] + plain[:6]) == "gopher_too_many_end_ellipsis"  # 0.4


def test_ngram_python_equals_catalyst(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    b1, c1 = R.bind(docs, ngram_engine="catalyst")
    b2, c2 = R.bind(docs, ngram_engine="arrow")
    m1, m2 = R.repetition_metrics(c1), R.repetition_metrics(c2)
    a = {r[0]: tuple(r[1:]) for r in b1.select("doc_id", *[m1[k] for k in m1]).collect()}
    b = {r[0]: tuple(r[1:]) for r in b2.select("doc_id", *[m2[k] for k in m2]).collect()}
    assert a == b


def plain_metrics(text, tops, dups):
    """The metrics by counting every n-gram as a tuple of words."""
    w = text.split()
    out = []
    for n in tops:
        grams = [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
        count = Counter(grams)
        out.append(max((count[g] * len(" ".join(g)) for g in grams if count[g] == max(count.values())), default=0))
    for n in dups:
        seen, covered = set(), set()
        for i in range(len(w) - n + 1):
            g = tuple(w[i:i + n])
            covered.update(range(i, i + n) if g in seen else ())
            seen.add(g)
        out.append(sum(len(w[i]) for i in covered))
    return tuple(out)


def test_ngram_metrics_by_hand():
    assert G.metrics("a b a b a b", (2,), (2,)) == (3 * 3, 4)  # "a b" three times; words 2 to 5 are covered
    assert G.metrics("x x x", (), (5,)) == (0,) and G.metrics("x", (2,), ()) == (0,) and G.metrics("", (2,), (5,)) == (0, 0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "cc", "ddd", "é"]), max_size=60), st.lists(st.integers(1, 12), min_size=1, max_size=4, unique=True))
def test_ngram_metrics_equal_plain_counts(words, sizes):
    text = " ".join(words)
    assert G.metrics(text, tuple(sizes), tuple(sizes)) == plain_metrics(text, sizes, sizes)


def test_lexicon_rule_and_counts(spark):
    from textsift.functions.rules import lexicon_counts
    df = spark.createDataFrame([(1, "a foo b foo c"), (2, "clean text here")], "doc_id long, text string")
    rule_p = WF.FilterParams(remove_short_lines=False, lexicon=("foo",), max_lexicon_hits=1)
    lab = WF.label(df, rule_p, language_col=None, rules=WF.doc_quality_rules(
        WF.FilterParams(min_doc_words=None, min_avg_word_length=None, max_symbol_word_ratio=None,
                        max_non_alpha_words_ratio=None, min_stop_words=None, lexicon=("foo",),
                        max_lexicon_hits=1)))
    assert {r["doc_id"]: r["filter_reason"] for r in lab.collect()} == {1: "lexicon_hits", 2: None}
    lx = spark.createDataFrame([("foo",), ("here",)], "word string")
    assert {r["doc_id"]: r["hits"] for r in lexicon_counts(df, lx).collect()} == {1: 2, 2: 1}
