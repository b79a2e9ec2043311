"""Line dedup: repeated windows of three consecutive lines lose their later occurrences.

Lines are the parts of a text between newlines; blank lines (only spaces, tabs, returns) take no
part in windows and always stay. A window is ``width`` consecutive non-blank lines, compared after
trimming. Of equal windows anywhere in the corpus the first by (doc_id, version of the text, place)
stays; the lines covered by any later one go, overlapping windows merging into one stretch.

Edge cases: a null text stays null with no lines, an empty text is one blank line; texts with fewer
than ``width`` non-blank lines have no window and stay as they are; a null doc_id sorts first; rows
that repeat both id and text are one document and are treated alike, rows with the same id but another
text are documents of their own; very long texts are cut whole; an empty table gives no rows. Columns beside
``doc_id`` and ``text`` are carried along untouched, whatever their names.

Only built-in functions run here. A common window is one partial count per task before the shuffle;
the join of its many places with its one first place is left to Spark's split of skewed joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import materialize, packed

BLANKS = " \t\r"


def _with_marks(docs: DataFrame) -> DataFrame:
    """row, doc, ver, lines, marks: marks are the places (from 0) of the non-blank lines."""
    lines = F.split("row.text", "\n", -1)
    rows = packed(docs).select("row", F.col("row.doc_id").alias("doc"), F.xxhash64("row.text").alias("ver"), lines.alias("lines"))
    blank = lambda line: F.btrim(line, F.lit(BLANKS)) == ""
    places = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1))
    return rows.withColumn("marks", F.filter(places, lambda i: ~blank(F.get(F.col("lines"), i))))


def line_windows(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc, ver, place, h1, h2): one row per window; place counts non-blank lines from 0."""
    keys = F.transform("marks", lambda i: F.btrim(F.get(F.col("lines"), i), F.lit(BLANKS)))
    rows = _with_marks(docs).where(F.size("marks") >= width).select("doc", "ver", keys.alias("keys"))

    def window(p: Column) -> Column:
        part = F.slice(F.col("keys"), p, F.lit(width))
        return F.struct((p - 1).alias("place"), F.xxhash64(part).alias("h1"), F.xxhash64(F.lit(width), part).alias("h2"))

    windows = F.transform(F.sequence(F.lit(1), F.size("keys") - width + 1), window)
    return rows.select("doc", "ver", F.explode(windows).alias("w")).select("doc", "ver", "w.place", "w.h1", "w.h2")


def repeated_places(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc, ver, starts): per document the places of its windows that repeat an earlier one."""
    windows = materialize(line_windows(docs, width), "line-windows")
    first = windows.groupBy("h1", "h2").agg(F.min(F.struct("doc", "ver", "place")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = materialize(first.select("h1", "h2", "first"), "first-windows")  # a plain shuffle on both sides can be split where it is skewed
    again = windows.join(first, ["h1", "h2"]).where(~F.struct("doc", "ver", "place").eqNullSafe(F.col("first")))
    return again.groupBy("doc", "ver").agg(F.collect_set("place").alias("starts"))


def drop_repeated_lines(docs: DataFrame, width: int = 3) -> DataFrame:
    """(row, lines_before, lines_removed, kept): every row of ``docs`` packed, with its remaining text."""
    base = _with_marks(docs)
    hits = repeated_places(docs, width).withColumnsRenamed({"doc": "hit_doc", "ver": "hit_ver"})
    joined = base.join(hits, F.col("doc").eqNullSafe(F.col("hit_doc")) & (F.col("ver") == F.col("hit_ver")), "left")
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (width - 1)))))
    gone = F.transform(covered, lambda q: F.get(F.col("marks"), q))
    rows = joined.select("row", "lines", F.coalesce(gone, F.array().cast("array<int>")).alias("gone"))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.transform(F.array_except(places, F.col("gone")), lambda i: F.get(F.col("lines"), i))
    text = F.when(F.size("gone") == 0, F.col("row.text")).otherwise(F.array_join(left, "\n"))
    return rows.select("row", F.greatest(F.size("lines"), F.lit(0)).alias("lines_before"), F.size("gone").alias("lines_removed"), text.alias("kept"))
