"""Personal data by fixed patterns and bootstrapped contextual extraction (operator 7), in column expressions only.

Seeds are the base matches: e-mail addresses, IPv4 addresses, card numbers (Luhn), phone numbers. The words around a
seed are lexical patterns (two or one to its left, one to its right), taken from the whole text for seeds and candidates
alike: the tokens that a span touches are left out, other matches are words like any. Candidates are other tokens with a digit or an
at sign. Patterns and instances (texts of seeds and candidates) form a graph that is scored in rounds: a pattern's
reliability for a kind is the share of its distinct instances that are of that kind, seeds counting 1 and candidates
their own score; a candidate's score is the reliability of its best pattern. Candidates that stand in a reliable
pattern, which enough distinct seeds support, become spans of the pattern's kind.

Scale: seeds, candidates and their context are found in one narrow pass over whole texts, and only they are stored.
The graph holds distinct (instance, pattern) pairs, so copies of a text weigh nothing. Only reliable patterns are
joined back, so a pattern as common as an article never meets its occurrences.

The regular expressions of the base are written so that no text can stall or overflow them: possessive runs, and a run
is entered only at its start or where the last match ended. They find what the plain forms find.

Defined cases: a null or empty text has no spans. Positions are code points, ends exclusive. Rows with equal id and
text get equal spans; each keeps its row. Spans of different kinds may overlap; masking joins what overlaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsift.llm.common import SPACE_CLASS, bind, fresh, saved

KINDS = ("email", "ip", "card", "phone")
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# \G: where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
WORD = SPACE_CLASS.replace("[", "[^", 1)
TOKEN = rf"(?<!{WORD}){WORD.replace(']', '0-9@]')}*+[0-9@]{WORD}*+"
EDGE = r"[\"'`(),.;:!?\[\]{}<>]"
#: Characters looked at on either side of a span; the next size where the words of its context aren't whole, at last the whole text.
WINDOWS = (80, 2048, 65_536)
PART = 200
BLOCK = 256
BLANK = "\x01"

SPAN = "struct<k:int,s:int,e:int,m:string,l:string,r:string>"


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def located(text: Column, kind: int | None, pattern: str) -> Column:
    """Matches of ``pattern`` in order, as SPAN: code point positions and the match; ``in_context`` adds the text next to it."""
    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["l"])
        span = F.struct(F.lit(kind).cast("int").alias("k"), start.alias("s"), (start + F.length(x["m"])).alias("e"), x["m"].alias("m"),
                        F.lit("").alias("l"), F.lit("").alias("r"))
        return F.struct((start + F.length(x["m"])).alias("at"), F.array_append(acc["out"], span).alias("out"))

    def walk(pieces: Column, found: Column) -> Column:
        zipped = F.transform(found, lambda m, i: F.struct(m.alias("m"), F.get(pieces, i).alias("l")))
        length = lambda a, x: a + F.length(x["l"]) + F.length(x["m"])
        add_up = lambda a, x: a + x
        # in parts of PART matches: appending to one long array would copy it for every match
        parts = lambda z: F.transform(F.sequence(F.lit(0), ((F.size(found) - 1) / PART).cast("int")), lambda c: F.slice(z, c * PART + 1, F.lit(PART)))
        return bind(bind(zipped, parts), lambda ps: bind(F.transform(ps, lambda p: F.aggregate(p, F.lit(0), length)), lambda sums: F.flatten(F.transform(
            ps, lambda p, c: F.aggregate(p, F.struct(F.aggregate(F.slice(sums, F.lit(1), c), F.lit(0), add_up).alias("at"), _none().alias("out")), add, lambda acc: acc["out"])))))
    return bind(F.split(text, pattern, -1), lambda pieces: F.when(F.size(pieces) == 1, _none()).otherwise(
        bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: walk(pieces, found))))


def in_blocks(text: Column) -> Column:
    """A text in blocks of BLOCK code points, so that a part of it costs its own length wherever it stands."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def part(blocks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text in blocks; what lies beyond it is empty."""
    first = (start / BLOCK).cast("int")
    n = F.greatest((end / BLOCK).cast("int") - first + 1, F.lit(1))
    return F.when(end <= start, F.lit("")).otherwise(F.substring(F.array_join(F.slice(blocks, first + 1, n), ""), start - first * BLOCK + 1, end - start))


#: A window whose words of context are whole: two words on the left, one on the right, beside what is joined to the span.
_LEFT_WHOLE = rf"{SPACE_CLASS}{WORD}++{SPACE_CLASS}++{WORD}++{SPACE_CLASS}++{WORD}*+\z"
_RIGHT_WHOLE = rf"\A{WORD}*+{SPACE_CLASS}++{WORD}++{SPACE_CLASS}"


def in_context(spans: Column, blocks: Column) -> Column:
    """``spans`` with the text on either side, as far as their words of context reach, however long these are."""
    def left(x: Column, sizes: tuple[int, ...]) -> Column:
        if not sizes:
            return part(blocks, F.lit(0), x["s"])
        window = part(blocks, F.greatest(x["s"] - sizes[0], F.lit(0)), x["s"])
        return bind(window, lambda w: F.when((x["s"] <= sizes[0]) | w.rlike(_LEFT_WHOLE), w).otherwise(left(x, sizes[1:])))

    def right(x: Column, sizes: tuple[int, ...]) -> Column:
        if not sizes:
            return part(blocks, x["e"], F.size(blocks) * BLOCK)
        window = part(blocks, x["e"], x["e"] + sizes[0])
        return bind(window, lambda w: F.when((F.length(w) < sizes[0]) | w.rlike(_RIGHT_WHOLE), w).otherwise(right(x, sizes[1:])))
    return F.transform(spans, lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), left(x, WINDOWS).alias("l"), right(x, WINDOWS).alias("r")))


def luhn(digits: Column) -> Column:
    def step(acc: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        d = F.when(i % 2 == 0, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)
        return acc + d
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def _card(m: Column) -> Column:
    return bind(_digits(m), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))


def _kinds(text: Column) -> list[tuple[str, Column, object]]:
    """(pattern, whether a text can have any, check of a match) by kind."""
    digit = text.rlike("[0-9]")
    return [
        (EMAIL, text.contains("@"), lambda m: F.lit(True)),
        (IP, digit & text.contains("."), lambda m: m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
        (CARD, digit, _card),
        (PHONE, text.contains("+"), lambda m: F.length(_digits(m)).between(8, 15)),
    ]


def base_spans(text: Column) -> list[Column]:
    """Arrays of SPAN by kind; ``text`` isn't null."""
    only = lambda spans, valid: F.filter(spans, lambda x: valid(x["m"]))
    return [F.when(gate, only(located(text, k, pattern), valid)).otherwise(_none()) for k, (pattern, gate, valid) in enumerate(_kinds(text))]


def blanked(text: Column) -> list[Column]:
    """The text in blocks by kind, with the code points of the kind's base spans blanked."""
    def without(pattern: str, valid) -> Column:
        gone = lambda m: F.when(valid(m), F.repeat(F.lit(BLANK), F.length(m))).otherwise(m)
        return bind(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), gone), lambda found: F.array_join(
            F.transform(F.split(text, pattern, -1), lambda p, i: F.concat(p, F.coalesce(F.get(found, i), F.lit("")))), ""))
    return [in_blocks(without(pattern, valid)) for pattern, _, valid in _kinds(text)]


def candidates(text: Column, base: Column, min_length: int) -> Column:
    """Tokens with a digit or an at sign, without the punctuation around them, that overlap no base span: they read the
    same in the text without the base spans of any kind, so each is tested by its own length."""
    def trimmed(x: Column) -> Column:
        lead = F.length(x["m"]) - F.length(F.regexp_replace(x["m"], f"^{EDGE}+", ""))
        m = F.regexp_replace(F.regexp_replace(x["m"], f"^{EDGE}+", ""), rf"(?<!{EDGE}){EDGE}+$", "")
        return F.struct(x["k"].alias("k"), (x["s"] + lead).alias("s"), (x["s"] + lead + F.length(m)).alias("e"), m.alias("m"), x["l"].alias("l"), x["r"].alias("r"))
    some = F.when(text.rlike("[0-9@]"), F.filter(F.transform(located(text, None, TOKEN), trimmed), lambda x: F.length(x["m"]) >= min_length)).otherwise(_none())

    def free(spans: Column, k: int, blocks: Column) -> Column:
        same = lambda a: bind(blocks, lambda bs: F.filter(a, lambda x: part(bs, x["s"], x["e"]) == x["m"]))
        return bind(spans, lambda a: F.when((F.size(a) == 0) | ~F.exists(base, lambda b: b["k"] == k), a).otherwise(same(a)))
    for k, blocks in enumerate(blanked(text)):
        some = free(some, k, blocks)
    return some


def contexts(left: Column, right: Column) -> Column:
    """Lexical patterns of a span: its two and its last word to the left, its first to the right; digits as 0.

    What is joined to the span without white space is no word of its context."""
    left, right = F.regexp_replace(left, rf"(?<!{WORD}){WORD}++\z", ""), F.regexp_replace(right, rf"\A{WORD}+", "")
    norm = lambda t: F.array_remove(F.split(F.regexp_replace(F.lower(t), "[0-9]", "0"), SPACE_CLASS + "+", -1), "")
    return bind(norm(left), lambda a: bind(norm(right), lambda b: F.array_compact(F.array(
        F.when(F.size(a) > 1, F.concat(F.lit("2 "), F.array_join(F.slice(a, -2, 2), " "))),
        F.when(F.size(a) > 0, F.concat(F.lit("1 "), F.element_at(a, -1))),
        F.when(F.size(b) > 0, F.concat(F.lit("r "), F.element_at(b, 1)))))))


def observed(docs: DataFrame, id_col: str, text_col: str, min_length: int) -> DataFrame:
    """(doc_id, h, base, cand): base spans and candidates of each row; ``h`` is a hash of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("h"), text.alias("t"))
    df = df.select("*", F.concat(*base_spans(F.col("t"))).alias("base"))
    df = df.select("doc_id", "h", "t", "base", candidates(F.col("t"), F.col("base"), min_length).alias("cand"))
    some = F.size("base") + F.size("cand") > 0
    df = df.select("doc_id", "h", "base", "cand", F.when(some, in_blocks(F.col("t"))).alias("blocks"))
    return df.select("doc_id", "h", in_context(F.col("base"), F.col("blocks")).alias("base"), in_context(F.col("cand"), F.col("blocks")).alias("cand"))


def discovered(seen: DataFrame, *, rounds: int = 2, reliable: float = 0.8, min_support: int = 5) -> DataFrame:
    """(doc_id, h, added): spans (k, s, e) that reliable patterns add, for the rows that get any."""
    spans = seen.select("doc_id", "h", F.explode(F.concat("base", "cand")).alias("x"))
    occ = saved(spans.select("doc_id", "h", "x.k", "x.s", "x.e", F.xxhash64(F.lower("x.m")).alias("i"),
                             F.transform(contexts(F.col("x.l"), F.col("x.r")), lambda p: F.xxhash64(p)).alias("p")), "occurrences")
    # an instance that is a seed anywhere is a seed; it may have several kinds
    pairs = saved(occ.select("i", "k", F.explode("p").alias("p")).groupBy("i", "p").agg(F.sort_array(F.collect_set("k")).alias("ks")), "pairs")
    seeds = pairs.select("p", "i", F.explode("ks").alias("k")).groupBy("p", "k").agg(F.count(F.lit(1)).alias("support"))
    seeds = seeds.where(F.col("support") >= min_support)
    size = pairs.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    # at most len(KINDS) rows for a pattern; without enough seeds it can't become reliable
    known = saved(seeds.join(size, "p").select("p", "k", "support", "n"), "patterns")
    patterns = known.withColumn("score", F.col("support") / (F.col("n") + 1))
    for _ in range(rounds):
        best = patterns.where(F.col("score") >= reliable / 2).select("p", "k", "score")
        unknown = pairs.where(F.size("ks") == 0).select("i", "p")
        instance = unknown.join(best, "p").groupBy("i", "k").agg(F.max("score").alias("score"))
        gain = unknown.join(instance, "i").groupBy("p", "k").agg(F.sum("score").alias("gain"))
        patterns = saved(known.join(gain, ["p", "k"], "left").select(
            "p", "k", "support", "n", ((F.col("support") + F.coalesce("gain", F.lit(0.0))) / (F.col("n") + 1)).alias("score")), "patterns")
    good = patterns.where(F.col("score") >= reliable).select("p", F.col("k").alias("kind"), "score")
    hits = occ.where(F.col("k").isNull()).select("doc_id", "h", "s", "e", F.explode("p").alias("p")).join(good, "p")
    one = hits.groupBy("doc_id", "h", "s", "e").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b"))
    return one.groupBy("doc_id", "h").agg(F.collect_set(F.struct((-F.col("b.k")).alias("k"), "s", "e")).alias("added"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of sorted (k, s, e), comma-joined."""
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, **learning) -> DataFrame:
    """(doc_id, h, base, spans): sorted arrays of (k, s, e), a row per document; ``h`` is a hash of its text."""
    seen = saved(observed(docs, id_col, text_col, min_length), "spans")
    added = discovered(seen, **learning).withColumnRenamed("doc_id", "d").withColumnRenamed("h", "dh")
    bare = F.transform("base", lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e")))
    rows = seen.select("doc_id", "h", F.sort_array(bare).alias("base"))
    rows = rows.join(added, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("dh")), "left")
    return rows.select("doc_id", "h", "base", F.sort_array(F.concat("base", F.coalesce("added", F.array().cast("array<struct<k:int,s:int,e:int>>")))).alias("spans"))


def pii_digest(docs: DataFrame, **options) -> DataFrame:
    """The result of op7: counts and digest of the base spans, and all spans as text."""
    found = find_pii(docs, **options)
    of = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("bigint")
    counts = [of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by ``<KIND>``; of spans that overlap the first names the mask for all.

    Spans are walked in parts of PART, each from the furthest end before it, and the pieces are joined once."""
    name = lambda k: F.concat(F.lit("<"), F.upper(F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)), F.lit(">"))
    furthest = lambda a, at: F.aggregate(a, at, lambda acc, x: F.greatest(acc, x["e"]))

    def walk(blocks: Column, found: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            piece = F.when(x["s"] < acc["at"], F.lit("")).otherwise(F.concat(part(blocks, acc["at"], x["s"]), name(x["k"])))
            return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.array_append(acc["out"], piece).alias("out"))
        parts = F.transform(F.sequence(F.lit(0), ((F.size(found) - 1) / PART).cast("int")), lambda c: F.slice(found, c * PART + 1, F.lit(PART)))
        return bind(parts, lambda ps: bind(F.transform(ps, lambda p: furthest(p, F.lit(0))), lambda ends: F.concat(
            F.array_join(F.flatten(F.transform(ps, lambda p, c: F.aggregate(
                p, F.struct(F.coalesce(F.array_max(F.slice(ends, F.lit(1), c)), F.lit(0)).alias("at"), F.array().cast("array<string>").alias("out")), step, lambda acc: acc["out"]))), ""),
            part(blocks, F.array_max(ends), F.size(blocks) * BLOCK))))
    in_order = F.sort_array(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    return F.when(F.size(spans) == 0, text).otherwise(bind(in_blocks(text), lambda blocks: bind(in_order, lambda found: walk(blocks, found))))


def mask_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the personal data in ``text_col`` masked; all rows and columns stay."""
    found = find_pii(docs, id_col=id_col, text_col=text_col, **options).where(F.size("spans") > 0)
    d, h, spans = fresh(docs, "pii_id", "pii_hash", "pii_spans")
    found = found.groupBy(F.col("doc_id").alias(d), F.col("h").alias(h)).agg(F.max("spans").alias(spans))  # equal rows, equal spans
    joined = docs.join(found, F.col(id_col).eqNullSafe(F.col(d)) & (F.xxhash64(F.col(text_col)) == F.col(h)), "left")
    new = F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(masked(F.col(text_col), F.col(spans)))
    return joined.select(*[new.alias(c) if c == text_col else F.col(c) for c in docs.columns])
