"""String scalars as native Column expressions (T1-T11, XO8-XO10).

Everything here compiles to Catalyst expressions (whole-stage codegen), no
Python UDF. Regexes are spelled for Java so that they give the same text as
Python's ``re`` on Unicode strings: Java's ``\\s`` misses NBSP, FS and
U+2028, so whitespace is one explicit class, ``WS``, equal to the set of
characters for which Python's ``str.isspace()`` is true.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# Python's Unicode whitespace (str.isspace): \t \n \v \f \r, FS GS RS US,
# space, NEL, NBSP, OGHAM SPACE MARK, EN QUAD .. HAIR SPACE, LINE SEPARATOR,
# PARAGRAPH SEPARATOR, NARROW NBSP, MEDIUM MATH SPACE, IDEOGRAPHIC SPACE.
WS = (r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
# Clock stamps such as "3.15pm GMT" (T2).
CLOCK_PATTERN = r"\b\d{1,2}\.\d{2}[apmAPM]+\s+[GMTgmt]+\b"
# Site boilerplate sentence removed from every body (T5).
BOILERPLATE_PATTERN = (r"© \d+ BBC\. The BBC is not responsible for the content of external "
                       r"sites\. Read about our approach to external linking\.")
# ---------------------------------------------------------------------------

# Java spellings: (?d) makes '.' stop only at '\n' like Python; (?U) makes
# \d and \b Unicode-aware like Python; \s is replaced by the explicit class.
_TAG_RE = r"(?d)<.*?>"
_CLOCK_RE = "(?U)" + CLOCK_PATTERN.replace(r"\s", WS)
# a lone ' ' is already collapsed: match only runs that change the text
# (a space followed by more whitespace, or any other whitespace character)
_WS_NOSPACE = WS.replace(r"\x{1c}-\x{20}", r"\x{1c}-\x{1f}")
# the lookahead turns away what nearly every position is, a letter or a space before
# one, by plain ranges before the union of the whitespace class is tried
_WS_RUN_RE = r"(?! ?[!-~\x{c0}-\x{24f}])(?: " + WS + "+|" + _WS_NOSPACE + WS + "*)"
_BOILER_RE = "(?U)" + BOILERPLATE_PATTERN


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_tags(c) -> Column:
    """Delete ``<.*?>`` (non-greedy, never across a newline)."""
    text = _c(c)  # most texts have no tag: a byte search tells before the pattern runs
    return F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, _TAG_RE, "")).otherwise(text)


def strip_clock(c) -> Column:
    """Delete clock stamps like ``3.15pm GMT``."""
    return F.regexp_replace(_c(c), _CLOCK_RE, "")


def collapse_ws(c) -> Column:
    """Every whitespace run becomes one space (no trim). T4 is a no-op after it."""
    return F.regexp_replace(_c(c), _WS_RUN_RE, " ")


def strip_boilerplate(c) -> Column:
    """T5: delete the site boilerplate sentence, keeping the spaces around it."""
    return F.regexp_replace(_c(c), _BOILER_RE, "")


def remove_tags(c) -> Column:
    """T1 -> T2 -> T3 -> (T4) -> T5, in that order. NULL stays NULL."""
    return strip_boilerplate(collapse_ws(strip_clock(strip_tags(c))))


def trim_ws(c) -> Column:
    """XO10: Python ``str.strip()``; SQL ``trim`` only strips spaces."""
    return F.regexp_replace(F.regexp_replace(_c(c), "^" + WS + "+", ""), WS + "+$", "")


def squeeze(c) -> Column:
    """XO9: ``' '.join(s.split())`` = collapse whitespace runs, then trim."""
    return trim_ws(collapse_ws(c))


def preview(c, n: int = 50) -> Column:
    """``question[:50] + '...'``."""
    return F.concat(F.substring(_c(c), 1, n), F.lit("..."))


def host_of(url) -> Column:
    """Host part of a URL; the landed pages name their source by host."""
    return F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)


def truthy(c) -> Column:
    """Python truthiness of an optional string: not NULL and not empty."""
    return _c(c).isNotNull() & (F.length(_c(c)) > 0)


def fmt2(c) -> Column:
    """Two-decimal display text (keep the number numeric for logic)."""
    return F.format_string("%.2f", _c(c))
