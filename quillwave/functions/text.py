"""Text expressions with the semantics of Unicode-aware scripts, as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Unicode-aware scripts strip it.
WHITESPACE = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_BLANK_RANGES = [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
BLANKS = "".join(chr(c) for a, b in _BLANK_RANGES for c in range(a, b + 1))  #: the same as a plain string
# Characters that a clean file name doesn't keep.
QUOTES = "'\"‘’“”「」『』"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Both ends without white space of any kind."""
    return F.btrim(col(c), F.lit(BLANKS))


def skipped(c: Column | str) -> Column:
    """Whether a cue's text is a remark: its first character that isn't blank is * or an ASCII parenthesis."""
    return col(c).rlike(rf"\A[{WHITESPACE}]*[*(]")


def clean_name(c: Column | str) -> Column:
    """A file name without blanks and quotes: each run becomes one underscore, none at the ends; `_` if nothing is left."""
    parting = BLANKS.replace(" ", "") + QUOTES
    parts = F.split(F.translate(col(c), parting, " " * len(parting)), " ")
    out = F.btrim(F.array_join(F.filter(parts, lambda x: x != ""), "_"), F.lit("_"))
    return F.when(col(c).isNotNull(), F.coalesce(F.nullif(out, F.lit("")), F.lit("_")))


def ass_text(c: Column | str) -> Column:
    r"""Styled subtitle text without override blocks; the breaks \N and \n become blanks."""
    out = F.regexp_replace(col(c), r"(?s)\{.*?\}", "")
    return strip(F.replace(F.replace(out, F.lit("\\N"), F.lit(" ")), F.lit("\\n"), F.lit(" ")))


def label(text: Column | str, index: Column | str) -> Column:
    """The text, or `[Segment n]` where it is null or empty."""
    return F.when(F.coalesce(col(text), F.lit("")) != "", col(text)).otherwise(F.format_string("[Segment %d]", col(index)))


def breaks(c: Column | str) -> Column:
    """Whether a line may break after the text: it is empty, or ends in white space, an opening bracket or quote, or a dash."""
    # The marks a line may end in.
    return (col(c) == "") | F.right(col(c), F.lit(1)).rlike(rf"[{WHITESPACE}(“—]")


def tidy_breaks(c: Column | str) -> Column:
    """Opening marks before a line break move behind it, then closing marks behind one move before it."""
    out = col(c)
    # The marks that move.
    for mark in "(“‘":
        out = F.replace(out, F.lit(f"{mark}\n"), F.lit(f"\n{mark}"))
    for mark in ")”’":
        out = F.replace(out, F.lit(f"\n{mark}"), F.lit(f"{mark}\n"))
    return out


def half_even(c: Column | str) -> Column:
    """Rounded to a whole number, halves to the even one."""
    return F.rint(col(c)).cast("long")
