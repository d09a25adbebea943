"""Text normalisation as column expressions (they stay in whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode whitespace set (Java's bare \s is ASCII only) and the
# characters without a printed form. Newer Unicode versions assign more characters,
# so code points unassigned in the JVM's tables count as non-printable here.
WHITESPACE_CODES = (
    *range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITESPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# The negated ASCII class comes first so that plain text is rejected by one range test.
NON_PRINTABLE = r"[[^\x20-\x7E]&&[\p{C}\p{Z}]]+"
_NOT_SPACE = "".join(map(chr, WHITESPACE_CODES))


def _plain_spaces(text: Column, drop: str = "") -> Column:
    """Every whitespace character as U+0020 and the characters of ``drop`` deleted."""
    return F.translate(text, _NOT_SPACE + drop, " " * len(_NOT_SPACE))


def remove_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\u0000"), F.lit(""))


def collapse_whitespace(text: Column) -> Column:
    """Turn each run of Unicode whitespace into one space."""
    return F.regexp_replace(_plain_spaces(text), "  +", " ")


def strip_nonprintable(text: Column) -> Column:
    """Delete control, format, private-use, unassigned and separator characters but the space."""
    return F.regexp_replace(text, NON_PRINTABLE, "")


def strip_whitespace(text: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.trim(text, F.lit(_NOT_SPACE + " "))


def clean_text(text: Column) -> Column:
    """Null becomes empty; NULs go, whitespace runs collapse, non-printables go, ends are trimmed.

    The order is part of the contract: a NUL between two spaces leaves one space, any
    other non-printable character there leaves two. One translate (NULs out, whitespace
    to spaces) and one pattern (a space after a space, or a non-printable) do all of it:
    nesting one regular expression per step took two to three times as long.
    """
    text = _plain_spaces(F.coalesce(text, F.lit("")), drop="\u0000")
    return F.trim(F.regexp_replace(text, f"(?<= ) +|{NON_PRINTABLE}", ""))


def reclean_text(text: Column) -> Column:
    """``clean_text`` of text cut out of a cleaned text: only double spaces can be left."""
    return F.trim(F.regexp_replace(text, "  +", " "))


def has_nul(text: Column) -> Column:
    return F.coalesce(F.instr(text, "\u0000") > 0, F.lit(False))


def has_visible_text(text: Column) -> Column:
    """Same as ``clean_text(text) != ''``, but decided at the first visible character.

    Filters use this one: a filter on the cleaned text would be pushed below the
    projection and clean every text twice.
    """
    return F.coalesce(text.rlike(r"[^\p{C}\p{Z}]"), F.lit(False))


def is_blank(text: Column) -> Column:
    """True for null and for text of nothing but whitespace."""
    return ~F.coalesce(text.rlike(f"[^{WHITESPACE}]"), F.lit(False))
