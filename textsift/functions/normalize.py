"""Text formatters (post-scrape cleaning before the filters, PII masks and symbol lines after them)."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from textsift.functions import text as T

# ---------------------------------------------------------------------------------------------------------------
# Fixed values (our decisions; parameters everywhere).
EMAIL_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
# What Java runs: the same addresses, in time linear in the text. A local part is entered only where its run begins (or the
# last match ended) and never given back; at most 127 labels, the limit of the domain name system, bound the recursion.
EMAIL_JAVA_RE = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}"
                 r"\.[A-Za-z]{2,}")
EMAIL_MASK = "email@example.com"
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# An IPv4 address not glued to other digits or dots; the neighbours are captured and written back.
IPV4_RE = r"(^|[^0-9.])(" + _OCTET + r"\." + _OCTET + r"\." + _OCTET + r"\." + _OCTET + r")([^0-9.]|$)"
IP_MASK = "<ip>"  # must not itself match the address pattern (the second pass relies on it)
TOKEN_RE = r"[\p{L}\p{N}]+|[^ \t\n\r\f\x0B\p{L}\p{N}]"
# ---------------------------------------------------------------------------------------------------------------


def dedup_lines(ls: Column) -> Column:
    """Drop second and later occurrences of a line (compared trimmed); blank lines are kept as separators.

    Sort (trimmed line, position) pairs, keep the first position of each run, then restore document order.
    O(k log k) per document, no shuffle. Lines of which none repeats are left as they are.
    """
    def repeats(ls: Column) -> Column:
        return T.let(F.transform(T.nonblank(ls), lambda x: F.trim(x)), lambda t: F.size(F.array_distinct(t)) < F.size(t))

    def dedup(ls: Column) -> Column:
        k = F.size(ls)
        tagged = F.transform(F.sequence(F.lit(1), k),
                             lambda i: F.struct(F.trim(F.element_at(ls, i)).alias("t"), i.alias("p")))

        def firsts(srt: Column) -> Column:
            return F.filter(
                F.transform(F.sequence(F.lit(1), k),
                            lambda j: F.when((j == 1) | (F.element_at(srt, j)["t"]
                                                         != F.element_at(srt, F.greatest(j - 1, F.lit(1)))["t"]),
                                             F.element_at(srt, j)["p"])),
                lambda x: x.isNotNull())

        blanks = F.filter(F.sequence(F.lit(1), k), lambda p: ~F.element_at(ls, p).rlike(T.NONBLANK_RE))
        keep = F.array_sort(F.array_union(T.let(F.array_sort(tagged), firsts), blanks))
        return F.transform(keep, lambda p: F.element_at(ls, p))

    return T.let(ls, lambda ls: F.when(repeats(ls), dedup(ls)).otherwise(ls))


def drop_short_lines(ls: Column, min_words: int = 3) -> Column:
    """Drop non-blank lines with fewer than ``min_words`` words."""
    space, word = r"[ \t\r\f\x0B]", T.NONBLANK_RE
    enough = rf"\A{space}*+(?:{word}++{space}++){{{max(min_words, 1) - 1}}}{word}"
    return F.filter(ls, lambda x: ~x.rlike(T.NONBLANK_RE) | x.rlike(enough))


def post_scrape(text: Column, remove_dup_lines: bool = True, remove_short_lines: bool = True,
                min_line_words: int = 3) -> Column:
    ls = T.lines(text)
    if remove_dup_lines:
        ls = dedup_lines(ls)
    if remove_short_lines:
        ls = T.let(ls, lambda x: drop_short_lines(x, min_line_words))
    return F.array_join(ls, "\n")


def is_empty_text(text: Column) -> Column:
    return text.isNull() | ~text.rlike(r"[^ \t\n\r\f\x0B]")


def mask_email(text: Column, mask: str = EMAIL_MASK) -> Column:
    return F.when(text.contains("@"), F.regexp_replace(text, F.lit(EMAIL_JAVA_RE), F.lit(mask))).otherwise(text)


def mask_ip(text: Column, mask: str = IP_MASK) -> Column:
    """Replace IPv4 addresses. Two passes: the first may consume the separator between two adjacent addresses."""
    once = F.regexp_replace(text, F.lit(IPV4_RE), F.lit(f"$1{mask}$7"))
    return F.regexp_replace(once, F.lit(IPV4_RE), F.lit(f"$1{mask}$7"))


def symbol_lines_re(symbols: list[str]) -> str:
    cls = "".join("\\" + s if s in "\\]^-[|.*+?(){}$" else s for s in symbols)
    return r"(\n|\A)([ \t]*[" + cls + r"][ \t" + cls + r"]*(\n|\z))+"


def remove_symbol_lines(text: Column, symbols: list[str] = ("|",), replace_char: str = "\n") -> Column:
    """Every run of lines made only of the symbols (and blanks) collapses into ``replace_char``.

    The run is matched possessively: Java loops over it instead of recursing once a line, and nothing follows the run
    that could make it give lines back.
    """
    rx = symbol_lines_re(list(symbols))
    return F.regexp_replace(text, F.lit(rx.replace("(\\n|\\z))+", "(?:\\n|\\z))++").replace("([ \\t]*", "(?:[ \\t]*+")), F.lit(replace_char))


def token_count(text: Column) -> Column:
    """Default tokenizer: letter/digit runs and single other non-space characters."""
    return F.size(F.regexp_extract_all(text, F.lit(TOKEN_RE), 0)).cast("bigint")


def subword_count(text: Column, tokenizer: str) -> Column:
    """Token count of a subword tokenizer: ``tokenizer`` is a file of the tokenizers library, on every executor. Null for a null text.

    Texts are encoded in Arrow batches, whole, without special tokens; a worker loads the file once."""
    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores busy
        from tokenizers import Tokenizer
        own = Tokenizer.from_file(tokenizer)
        own.encode_special_tokens = True
        for texts in batches:
            full = texts.notna()
            n = [len(e.ids) for e in own.encode_batch(texts[full].tolist(), add_special_tokens=False)]
            yield pd.Series(n, index=texts.index[full], dtype="Int64").reindex(texts.index)
    return count(text)


# --- encoding repair ---------------------------------------------------------------------------------------------
# Windows-1252 characters in 0x80-0x9F and the byte each stands for (the standard code page).
CP1252_SPECIALS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_BYTES = [0x80, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x8B, 0x8C, 0x8E,
                0x91, 0x92, 0x93, 0x94, 0x95, 0x96, 0x97, 0x98, 0x99, 0x9A, 0x9B, 0x9C, 0x9E, 0x9F]
MOJIBAKE_HINT = r"[ÃÂâ][\x80-\xBF€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]"


def fix_encoding(text: Column, levels: int = 2) -> Column:
    """Repair UTF-8-read-as-Latin-1/Windows-1252 mojibake, line by line, up to ``levels`` times over.

    A line is re-decoded only when it looks like mojibake, holds only code points that map back to single bytes
    and decodes to valid UTF-8; anything else is left untouched. What is decoded may have been broken before, so it is looked
    at again.
    """
    c1 = "".join(chr(b) for b in CP1252_BYTES)

    def fix_line(x: Column) -> Column:
        mapped = F.translate(x, CP1252_SPECIALS, c1)
        raw = F.encode(mapped, "ISO-8859-1")
        decoded = F.try_validate_utf8(raw.cast("string"))
        ok = x.rlike(MOJIBAKE_HINT) & mapped.rlike(r"\A[\x00-\xFF]*\z")
        return F.when(ok, F.coalesce(decoded, x)).otherwise(x)

    def fix(x: Column, left: int) -> Column:
        return x if not left else T.let(fix_line(x), lambda y: F.when(y == x, x).otherwise(fix(y, left - 1)))
    fixed = F.array_join(F.transform(T.lines(text), lambda x: fix(x, levels)), "\n")
    return F.when(text.rlike(MOJIBAKE_HINT), fixed).otherwise(text)
