"""Tag-delimited record scan over large XML files (A1) and a dump writer.

The scan reads the file as text with the *end* tag as record separator, so
each input split is cut independently: the file is read by as many tasks as
it has splits, and no record reader has to see the whole document. A record
keeps the part after its *last* begin tag; a record holding more than one
begin tag had a page without an end tag before it, and that head is returned
for quarantine instead of being glued to the next page. Begin and end tags
are matched byte for byte (``<page id="1">`` is not a begin tag).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.text import xml_escape


def scan_fragments(
    spark: SparkSession,
    path: str,
    begin: str = "<page>",
    end: str = "</page>",
) -> DataFrame:
    """One row per ``begin``...``end`` record: ``fragment``, ``unclosed_head``.

    ``fragment`` is the record from its last begin tag with the end tag put
    back; ``unclosed_head`` is the text from the first to the last begin tag
    when there is more than one (pages whose end tag is missing), else NULL.
    Records without a begin tag (file header, footer, blanks) are dropped.
    No shuffle: a map-only plan over the text splits.
    """
    raw = spark.read.text(path, lineSep=end)
    value = F.col("value")
    first = F.instr(value, begin)
    body = F.substring_index(value, begin, -1)
    head_len = F.length(value) - F.length(body) - F.lit(len(begin)) - first + 1
    return raw.where(first > 0).select(
        F.concat(F.lit(begin), body, F.lit(end)).alias("fragment"),
        F.when(head_len > 0, F.substring(value, first, head_len)).alias("unclosed_head"),
    )


def render_page(title: Column, text: Column) -> Column:
    """``<page><title>..</title><revision><text>..</text></revision></page>``."""
    return F.concat(
        F.lit("<page><title>"), xml_escape(title, keep_cr=True), F.lit("</title><revision><text>"),
        xml_escape(text, keep_cr=True), F.lit("</text></revision></page>"),
    )


def _frame_partition(root: str):
    head, tail = f"<{root}>\n", f"\n</{root}>"

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Wrap each output file (= partition) in the root element: prefix the
        # first row, suffix the last one. Whole batches pass through untouched.
        prev = None
        first = True
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if first:
                col = batch.column(0)
                fixed = pa.concat_arrays([pc.binary_join_element_wise(head, col.slice(0, 1), ""),
                                          col.slice(1)])
                batch = pa.RecordBatch.from_arrays([fixed], schema=batch.schema)
                first = False
            if prev is not None:
                yield prev
            prev = batch
        if prev is not None:
            col = prev.column(0)
            n = prev.num_rows
            fixed = pa.concat_arrays([col.slice(0, n - 1),
                                      pc.binary_join_element_wise(col.slice(n - 1), tail, "")])
            yield pa.RecordBatch.from_arrays([fixed], schema=prev.schema)

    return frame


def write_dump(pages: DataFrame, path: str, root: str | None = "mediawiki") -> None:
    """Write one page per line (column ``page``) as XML text files.

    With ``root`` every file is a well-formed document ``<root>...</root>``.
    The pages stay in their partitions (one file each); only the first and
    last line of a partition are touched, in Arrow batches.
    """
    lines = pages.select(F.col("page").alias("value"))
    if root:
        lines = lines.mapInArrow(_frame_partition(root), "value string")
    lines.write.mode("overwrite").text(path)
