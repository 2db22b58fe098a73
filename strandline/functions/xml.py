"""Article field extraction from one XML page fragment.

Semantics to keep: the text content of the *first* ``title`` and ``text``
element anywhere below the page (entities decoded, inner tags dropped, CDATA
and blanks kept), a missing element is an error, malformed XML is an error.

Plan per row, all JVM-side:

1. ``from_xml`` in PERMISSIVE mode decides well-formedness without throwing
   (its ``_corrupt_record`` column); plus a check that nothing can follow the
   page's root element, the one case that parser lets pass.
2. Only for well-formed rows, a single ``xpath_string`` call returns element
   counts and first-element text joined by U+0001, a character XML 1.0 cannot
   carry, so the split back is exact. ``xpath_string`` is the DOM string
   value, i.e. descendant text with tags removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEP = "\u0001"

_GUARD_SCHEMA = "_probe STRING, _corrupt_record STRING"
_GUARD_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def _first_texts_xpath(names: list[str]) -> str:
    """One XPath giving ``count(//n)`` for each name, then ``string((//n)[1])``."""
    items = [f"count(//{n})" for n in names] + [f"string((//{n})[1])" for n in names]
    return "concat(" + f", '{SEP}', ".join(items) + ")"


def well_formed(fragment: Column, root: str = "page") -> Column:
    """True when ``fragment`` is one well-formed XML element ``root``.

    NULL for a NULL fragment.
    """
    guard = F.from_xml(fragment, _GUARD_SCHEMA, _GUARD_OPTS)
    close = f"</{root}"
    # Content after the root's end tag passes the guard but makes XPath throw.
    # The usual fragment holds its only root end tag at the very end, so the
    # regex runs only when an earlier one exists (e.g. ``</page >``); nested
    # elements named like the root are then rejected too.
    first_close = F.instr(fragment, close)
    final_pos = F.length(fragment) - F.lit(len(close))
    early = (first_close > 0) & (first_close < final_pos)
    trailing = early & fragment.rlike(close + r"\s*>\s*\S")
    return guard.getField("_corrupt_record").isNull() & ~trailing


def extract_first_elements(df: DataFrame, fragment: str, names: list[str], root: str = "page",
                           prefix: str = "") -> DataFrame:
    """Add ``{prefix}ok``, ``n_<name>`` and ``<name>`` for each element name.

    ``ok`` is false for malformed input; the other columns are then NULL and no
    XPath is evaluated (``xpath_string`` throws on malformed XML). The guard
    and the XPath sit in their own projections so that each is evaluated once
    per row: Spark does not share a subexpression that only occurs inside
    ``CASE`` branches, and does not inline an expensive one into several uses.
    """
    ok, xp = f"{prefix}ok", f"{prefix}_xp"
    path = _first_texts_xpath(names)
    out = df.withColumn(ok, F.coalesce(well_formed(F.col(fragment), root), F.lit(False)))  # NULL: not ok
    out = out.withColumn(xp, F.split(F.when(F.col(ok), F.xpath_string(F.col(fragment), F.lit(path))),
                                     SEP, 2 * len(names)))
    cols = [F.get(F.col(xp), i).cast("int").alias(f"{prefix}n_{n}") for i, n in enumerate(names)]
    cols += [F.get(F.col(xp), len(names) + i).alias(f"{prefix}{n}") for i, n in enumerate(names)]
    return out.select("*", *cols).drop(xp)
