"""Text cleaning, tokens and word n-grams as Spark column expressions.

Word characters, blanks and line ends are spelt out as explicit classes so that the result does not
depend on the regex dialect's own idea of ``\\w``, ``\\s``, ``\\b`` or ``.``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: must stay equal to the published cleaning rules -------------------------
BLANKS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BLANK = f"[{BLANKS}]"
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
REFERENCE_CODE_HEADS = ("NPAS", "SPC", "PWD", "ref", "MC", "TN", "ZILL", "TENDER")
NATIONAL_PREAMBLE = (
    "GOVERNMENT OF INDIA -- NATIONAL PROCUREMENT AGGREGATION SERVICE",
    "STANDARD TERMS AND CONDITIONS",
)
STATE_PREAMBLE = (
    "STATE PROCUREMENT CELL -- CONSOLIDATED TENDER BULLETIN",
    "GENERAL INSTRUCTIONS TO BIDDERS",
)
PREAMBLE_RULE = "=" * 79
TITLE_GRAM = 2
BODY_GRAM = 3
RAW_GRAM = 3
# ---------------------------------------------------------------------------------------------

TITLE_HEADS = (
    rf"(?i)^(tender{BLANK}+notice:?{BLANK}*|e-tender{BLANK}*-{BLANK}*"
    rf"|nit{BLANK}+for{BLANK}*|corrigendum{BLANK}*-{BLANK}*)+"
)
BRACKETED = r"\[[^\n]*?\]"
TRAILING_PLACE = rf"{BLANK}*-[a-zA-Z{BLANKS}]+$"
DISCLAIMER = r"(?isd)DISCLAIMER:.*?$"
# What a match begins with is looked at first: far fewer places than there are characters ask what stands before them.
REFERENCE_CODES = rf"(?i)(?=[{''.join(sorted({head[0].upper() for head in REFERENCE_CODE_HEADS}))}])(?<!{WORD})(?:{'|'.join(REFERENCE_CODE_HEADS)})[\p{{L}}\p{{N}}_/:\-]*{WORD}"
BARE_IDS = rf"(?=\p{{Nd}})(?<!{WORD})\p{{Nd}}{{5,8}}(?!{WORD})"
TOKEN = rf"(?<!{WORD})[a-z0-9]++(?!{WORD})"


def preamble_pattern(parts: tuple[str, str]) -> str:
    start, end = parts
    return rf"(?sd){start}.*?{end}.*?(?:\n\n|{PREAMBLE_RULE}|$)"


def strip_blanks(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{BLANK}+|{BLANK}+$", "")


def clean_title(title: Column) -> Column:
    """Drop announcement prefixes, bracketed references and a trailing ``- Place``; lower-case."""
    text = F.coalesce(title, F.lit(""))
    for pattern in (TITLE_HEADS, BRACKETED, TRAILING_PLACE):
        text = strip_blanks(F.regexp_replace(text, pattern, ""))
    return F.lower(text)


def clean_body(body: Column) -> Column:
    """Drop both legal preambles, the disclaimer footer, reference codes and bare ids; lower-case."""
    text = F.coalesce(body, F.lit(""))
    for pattern in (
        preamble_pattern(NATIONAL_PREAMBLE),
        preamble_pattern(STATE_PREAMBLE),
        DISCLAIMER,
        REFERENCE_CODES,
        BARE_IDS,
    ):
        text = F.regexp_replace(text, pattern, "")
    return F.lower(text)


def tokens(text: Column) -> Column:
    """ASCII words that are not part of a longer word, lower-cased, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once.

    A column used inside a lambda is otherwise evaluated again for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_grams(words: Column, n: int) -> Column:
    """Distinct word n-grams of a token array; a shorter text is one gram, no words give none."""

    def grams(w: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(w) - n), lambda at: F.concat_ws(" ", *[F.get(w, at + k) for k in range(n)])
        )
        return (
            F.when(F.size(w) >= n, F.array_distinct(runs))
            .when(F.size(w) > 0, F.array(F.array_join(w, " ")))
            .otherwise(F.array().cast("array<string>"))
        )

    return bound(words, grams)


def char_length(text: Column) -> Column:
    return F.length(text)


def blank_word_count(text: Column) -> Column:
    """Words separated by white space."""
    return F.size(F.regexp_extract_all(text, F.lit(f"[^{BLANKS}]++"), F.lit(0)))


def common_prefix_length(a: Column, b: Column) -> Column:
    """Length of the longest common prefix, by halving steps instead of one step per character."""
    limit = F.least(F.length(a), F.length(b))

    def longer(reached: Column, step: Column) -> Column:
        ahead = reached + step
        return F.when((ahead <= limit) & (F.left(a, ahead) == F.left(b, ahead)), ahead).otherwise(reached)

    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    return F.when(a.isNotNull() & b.isNotNull(), F.aggregate(steps, F.lit(0), longer))
