"""Text rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.schemas import CATEGORIES

#: Unicode white space, as the class of strip() and split().
WS = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"
BAD = r"[\x{FFFD}\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]"


#: The characters of WS.
WS_CHARS = "".join(x for x in map(chr, range(0x3001)) if x.isspace())


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WS_CHARS))


def normalize_typography(c: Column) -> Column:
    """Fraction slash, curly quotes and bullets as plain characters."""
    return F.translate(c, "⁄‘’“”•", "/''\"\"·")


def bad_chars(c: Column) -> Column:
    """Replacement and private-use characters."""
    return F.length(c) - F.length(F.regexp_replace(c, BAD, ""))


def garbled(c: Column) -> Column:
    """Glyph names instead of text."""
    return c.rlike(r"GLYPH<[0-9A-Fa-f]+>") | c.rlike(r"(/G\d+){2,}") | c.rlike(r"(?U)^(/\w+\s*){2,}")


def corrupted(c: Column) -> Column:
    return (bad_chars(c) >= 1) | garbled(c)


def to_category(label: Column) -> Column:
    key = F.translate(F.lower(label), " -", "__")
    return F.when(key.isin(*CATEGORIES), key).otherwise("text")


def n_words(c: Column) -> Column:
    """Runs of what isn't white space. All of that becomes spaces first, so that the text is split at one character and no regular expression runs over it."""
    spaced = c
    for x in WS_CHARS.replace(" ", ""):
        spaced = F.replace(spaced, F.lit(x), F.lit(" "))
    return F.when(c.isNotNull(), F.size(F.array_remove(F.split(spaced, " "), "")))


#: Characters that end a line; a carriage return with a line feed is one end.
ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def n_lines(c: Column) -> Column:
    """Line ends, and one for a last line without one. Counted by what is left without them: no regular expression runs over the text."""
    without = c
    for x in ENDS:
        without = F.replace(without, F.lit(x), F.lit(""))
    ends = F.length(c) - F.length(without)
    pairs = (F.length(c) - F.length(F.replace(c, F.lit("\r\n"), F.lit("")))) / 2
    return (ends - pairs.cast("int") + F.when((c != "") & ~F.lit(ENDS).contains(F.right(c, F.lit(1))), 1).otherwise(0)).cast("int")


def escape(c: Column) -> Column:
    """HTML escapes, ampersand first."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def render(heading: Column, text: Column) -> Column:
    """Heading and text, of those that aren't empty, joined by a comma."""
    return F.concat_ws(", ", F.nullif(heading, F.lit("")), F.nullif(text, F.lit("")))


def window_starts(length: Column, size: int, overlap: int) -> Column:
    """Starts of windows of `size` characters that step by size - overlap until one reaches the end."""
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("a window needs 0 <= overlap < size")
    step = size - overlap
    last = F.greatest(F.ceil((length - size) / step), F.lit(0)).cast("int")
    return F.when(length > 0, F.transform(F.sequence(F.lit(0), last), lambda i: i * step)).otherwise(F.array().cast("array<int>"))


def similarity(a: Column, b: Column) -> Column:
    """The matching-blocks ratio of two texts, by difflib: the measure that compares records with expected ones. For samples, not for a corpus."""
    from difflib import SequenceMatcher

    from pyspark.sql.types import DoubleType

    return F.udf(lambda x, y: None if x is None or y is None else SequenceMatcher(None, x, y).ratio(), DoubleType(), useArrow=True)(a, b)
