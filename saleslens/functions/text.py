"""Text normalisation as built-in expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# All characters that count as white space.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
_MARK = "\u0001 "


def strip(value: Column) -> Column:
    """Remove white space of any kind from both ends (SQL `trim` takes blanks only).

    Texts between two visible ASCII characters are told by comparing; the pattern only runs on texts that begin or
    end with white space.
    """
    first, last = F.substring(value, 1, 1), F.substring(value, -1, 1)
    white = F.lit(WHITE_SPACE)
    padded = F.contains(white, first) | F.contains(white, last)
    stripped = F.regexp_replace(value, f"^{_SPACE}+|{_SPACE}+$", "")
    return F.when(first.between("!", "~") & last.between("!", "~"), value).when(padded, stripped).otherwise(value)


def title_case(value: Column) -> Column:
    """Capital after every non-letter: `home-office o'neil` -> `Home-Office O'Neil`.

    Spark's `initcap` begins words after blanks only. Where another non-letter stands before a letter (or before what
    may have a capital, so anything but ASCII), each gets a mark with a blank behind it, taken out again afterwards.
    Most texts have none but hyphens, which are marked without a pattern.
    """
    every_word = _unmarked(F.regexp_replace(value, r"([^\p{L} ])", f"$1{_MARK}"))
    hyphenated = _unmarked(F.replace(value, F.lit("-"), F.lit(f"-{_MARK}")))
    simple = F.when(F.contains(value, F.lit("-")), hyphenated).otherwise(F.initcap(value))
    return F.when(value.rlike(r"[^\p{L} \-](?:\p{L}|[^\x00-\x7F])|\x01"), every_word).otherwise(simple)


def _unmarked(marked: Column) -> Column:
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def zero_pad(value: Column, width: int) -> Column:
    """Left-pad with zeros; longer values are kept whole (`lpad` alone cuts them)."""
    text = value.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def shorten(value: Column, width: int) -> Column:
    """First `width` characters and an ellipsis where the text is longer."""
    cut = F.concat(F.substring(value, 1, width), F.lit("…"))
    return F.when(F.length(value) > width, cut).otherwise(value)
