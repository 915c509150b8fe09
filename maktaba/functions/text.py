"""Column functions for text: Python-compatible white space, lines, language tests. All run in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes.
WHITE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
WHITE_BUT_FEED = r"[\t\x0b-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LINE_ENDS = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]"
WHITE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Before a class of rare characters: visible ASCII, the most of a text, fails at one range.
NOT_SEEN = "(?![!-~])"
#: White space that ends no line, and line ends other than \n.
WHITE_IN_LINE = r"[\t\x1f\x20\xa0\u1680\u2000-\u200a\u202f\u205f\u3000]"
OTHER_LINE_ENDS = r"[\x0b-\r\x1c-\x1e\x85\u2028\u2029]"
ARABIC_NARROW = r"[\u0600-\u06ff\u0750-\u077f]"
ARABIC = r"[\u0600-\u06ff\u0750-\u077f\u08a0-\u08ff\ufb50-\ufdff\ufe70-\ufeff]"
LATIN = r"[a-zA-ZÀ-ÿœæŒÆ]"
FRENCH_ACCENTS = "[àâäéèêëïîôùûüÿçœæÀÂÄÉÈÊËÏÎÔÙÛÜŸÇŒÆ]"
FRENCH_WORDS = ("les", "des", "une", "dans", "pour", "avec", "sur", "par", "est", "sont", "aux", "cette", "entre")
#: Letters in either case are spelt out, and a first letter is looked for before what stands around it: no case folding a character.
_ANY_CASE = {c: f"[{c}{c.upper()}{'ſ' if c == 's' else ''}]" for w in FRENCH_WORDS for c in w}
_FRENCH = rf"(?=[{''.join(sorted({c for w in FRENCH_WORDS for c in _ANY_CASE[w[0]][1:-1]}))}])(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(''.join(_ANY_CASE[c] for c in w) for w in FRENCH_WORDS)})(?![\p{{L}}\p{{N}}_])"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often `use` names it: branches share no subexpressions."""
    return F.transform(F.array(value), use)[0]


def strip(text: Column) -> Column:
    """text without white space at either end, as Python's str.strip() sees it."""
    return F.trim(text, F.lit(WHITE_CHARS))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def unix_lines(text: Column) -> Column:
    """The lines of text, as Python's str.splitlines() parts them, with \\n between them alone."""
    text = let(text, lambda t: F.when(t.rlike(OTHER_LINE_ENDS), F.regexp_replace(t, LINE_ENDS, "\n")).otherwise(t))
    return let(text, lambda t: F.when(F.endswith(t, F.lit("\n")), F.regexp_replace(t, r"\n\z", "")).otherwise(t))


def lines(text: Column) -> Column:
    """The lines of text, as Python's str.splitlines() parts them; a last line end opens no further line."""
    return F.split(unix_lines(text), "\n")


def words(text: Column) -> Column:
    """The words of text, as Python's str.split() parts it."""
    bare = strip(text)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, rf"{WHITE}+"))


def has_arabic(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(ARABIC_NARROW)


def has_french(text: Column) -> Column:
    """An accented letter or one of the function words."""
    text = F.coalesce(text, F.lit(""))
    return text.rlike(FRENCH_ACCENTS) | text.rlike(_FRENCH)


def one_space(text: Column) -> Column:
    """Runs of white space but \\n as one space each. Single plain spaces, the most of them, are no match."""
    return F.regexp_replace(text, rf"{NOT_SEEN}{WHITE_BUT_FEED}(?:{WHITE_BUT_FEED}+|(?<! ))", " ")


def few_line_feeds(text: Column) -> Column:
    """Four line feeds or more as three."""
    return let(text, lambda t: F.when(F.contains(t, F.lit("\n" * 4)), F.regexp_replace(t, r"\n{4,}", "\n\n\n")).otherwise(t))


def clean_text(text: Column) -> Column:
    """White space runs become one space, long runs of line feeds three, lines and the whole are stripped; null becomes empty."""
    return strip(F.regexp_replace(few_line_feeds(one_space(F.coalesce(text, F.lit("")))), r"(?dm)^ +| +$", ""))


def nonempty(text: Column) -> Column:
    """text, or null if it is empty."""
    return F.when(text != "", text)
