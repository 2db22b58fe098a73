"""Text expressions: whitespace tokenising, XML escaping and element text.

All are Spark SQL expressions, evaluated JVM-side inside whole-stage codegen
where Spark supports it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five predefined XML entities, decoded in this order
# (``&amp;`` last so that ``&amp;lt;`` stays ``&lt;``).
XML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text: Column | str) -> Column:
    """Split on runs of whitespace with Java ``String.split`` rules.

    * ``''`` gives one empty token;
    * a leading blank run gives a leading empty token;
    * trailing empty tokens are dropped, so an all-blank text gives none;
    * no case folding, no punctuation handling; NULL stays NULL.

    ``split(text, '\\s+')`` keeps a trailing empty string and returns
    ``['', '']`` for an all-blank text; a blank run merges, so an empty part
    can only be first or last, which is all the fix-up has to look at.

    The common case (no trailing blank) is the first condition: that
    condition is always evaluated, so Spark's subexpression elimination
    computes the split once and reuses it in every branch. With the array
    only inside later branches, each branch would split the text again.
    """
    text = _col(text)
    parts = F.split(text, r"\s+")
    n = F.size(parts)
    return (
        F.when(F.get(parts, n - 1) != F.lit(""), parts)
        .when(text == F.lit(""), F.array(F.lit("")))
        .when((n == 2) & (F.get(parts, 0) == F.lit("")), F.array().cast("array<string>"))
        .otherwise(F.slice(parts, 1, n - 1))
    )


def xml_escape(c: Column | str, keep_cr: bool = False) -> Column:
    """Escape ``&``, ``<`` and ``>`` (in that order) for XML element content.

    With ``keep_cr`` a carriage return becomes ``&#13;``: a parser turns a raw
    one into a line feed, the reference survives. Characters XML 1.0 cannot
    carry at all (most C0 controls) are left as they are; such a page fails
    to parse and is quarantined.
    """
    c = _col(c)
    out = F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                    F.lit(">"), F.lit("&gt;"))
    return F.replace(out, F.lit("\r"), F.lit("&#13;")) if keep_cr else out


def xml_unescape(c: Column | str) -> Column:
    """Decode the five predefined XML entities (literal replaces, no regex)."""
    c = _col(c)
    for ent, ch in XML_ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def _code_point(number: Column, base: int) -> Column:
    """The character of a numeric reference; U+FFFD for one that names none."""
    digits = F.regexp_replace(number, "^0+(?=.)", "")
    n = F.when(F.length(digits) <= 7, F.conv(digits, base, 10).cast("bigint"))
    known = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    return F.when(known, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise("�")


def decode_references(c: Column | str) -> Column:
    """Decode numeric character references and the five predefined entities, once each."""
    c = _col(c)
    parts = F.regexp_extract_all(c, F.lit(r"&#[xX][0-9A-Fa-f]+;|&#[0-9]+;|[^&]+|&"), F.lit(0))
    # an ampersand that a reference stands for must not start an entity of its own
    mark = "&amp;"
    one = lambda ch: F.when(ch == "&", F.lit(mark)).otherwise(ch)
    text = F.array_join(F.transform(parts, lambda p: F.when(
        p.rlike("^&#[xX]"), one(_code_point(F.regexp_extract(p, r"^&#[xX]([0-9A-Fa-f]+);$", 1), 16)))
        .when(p.rlike("^&#[0-9]"), one(_code_point(F.regexp_extract(p, r"^&#([0-9]+);$", 1), 10))).otherwise(p)), "")
    return xml_unescape(F.when(F.instr(c, "&#") > 0, text).otherwise(c))


def extract_title(html: Column | str, decode: bool = True) -> Column:
    """Text of the first ``<title>`` element of markup that need not be XML.

    Tag names in any case, with or without attributes; NULL when there is no
    such element. With ``decode`` numeric references and the predefined
    entities are decoded, as a DOM's text content would be.
    """
    pattern = r"(?is)<title(?:\s[^>]*)?>(.*?)</title[\s>]"
    element = F.regexp_extract(_col(html), pattern, 0)  # up to the first element; '' without one
    raw = F.when(element != "", F.regexp_extract(element, pattern, 1))
    return decode_references(raw) if decode else raw
