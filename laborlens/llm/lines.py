"""Line deduplication by winnowing, in built-in functions only.

Lines are hashed. A window is the shortest stretch of lines from one line on, or up to one line, that has a least number of
characters: a long line alone, or several short ones. Of each window the line with the smallest hash is selected as its
fingerprint, so that any two equal stretches of that many characters share a fingerprint at the same place, and a long line
always is one. Positions are joined on fingerprints; those that stand once drop out. A match is extended from its fingerprint
to both sides over its window, and windows that touch make up longer runs. What is repeated later is deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens.llm.frames import checkpoint, row_hash, same, split_join

#: Names that the result adds.
ADDED = ["kept_text", "n_lines", "n_removed", "n_runs"]


def _lines(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _filled(lines: str) -> Column:
    """Places of the lines that are not empty."""
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.length(F.get(lines, i)) > 0)


def _windows(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, h, start and size (in non-empty lines) of each window, its fingerprint, and the hash of what lies to the left
    and to the right of it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("h"), _lines().alias("lines"))
    filled = F.filter("lines", lambda x: F.length(x) > 0)
    rows = rows.select("doc_id", "h", filled.alias("lines")).filter(F.size("lines") > 0).select(
        "doc_id", "h", F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"),
        F.transform("lines", lambda x: F.least(F.length(x), F.lit(min_chars))).alias("chars"),
    )

    def needed(chars: Column) -> Column:
        """How many of these lines have the characters together, and how many characters these are."""
        start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
        more = lambda a, x: F.struct((a["sum"] + x).alias("sum"), (a["n"] + 1).alias("n"))
        return F.aggregate(chars, start, lambda a, x: F.when(a["sum"] >= min_chars, a).otherwise(more(a, x)))

    # A line has one character at least, so no window has more than min_chars lines. A long line is a window by itself.
    def onward(s: Column) -> Column:
        end = needed(F.slice("chars", s + 1, min_chars))
        size = F.when(F.get("chars", s) >= min_chars, 1).otherwise(F.when(end["sum"] >= min_chars, end["n"]))
        return F.struct(s.alias("start"), size.alias("size"))

    def back(e: Column) -> Column:
        begin = F.greatest(e - (min_chars - 1), F.lit(0))
        end = needed(F.reverse(F.slice("chars", begin + 1, e - begin + 1)))
        last = F.get("chars", e)
        # Without its last line it must still be long enough, or it is the window onward from its start.
        size = F.when(last < min_chars, F.when(end["sum"] - last >= min_chars, end["n"]))
        return F.struct((e - size + 1).alias("start"), size.alias("size"))

    def match(w: Column) -> Column:
        """A window with its fingerprint and what lies on both sides of it."""
        first = F.get("hashes", w["start"])
        least = F.array_min(F.transform(
            F.sequence(F.lit(0), w["size"] - 1), lambda d: F.struct(F.get("hashes", w["start"] + d).alias("value"), d.alias("at"))
        ))
        at = F.when(w["size"] == 1, 0).otherwise(least["at"])
        left = F.xxhash64(F.slice("hashes", w["start"] + 1, at))
        right = F.xxhash64(F.slice("hashes", w["start"] + at + 2, w["size"] - at - 1))
        return F.struct(
            w["start"].alias("start"), w["size"].alias("size"), F.get("hashes", w["start"] + at).alias("fingerprint"),
            (w["start"] + at).alias("line"),
            F.when(w["size"] == 1, F.lit(0).cast("long")).otherwise(left).alias("left"),
            F.when(w["size"] == 1, F.lit(0).cast("long")).otherwise(right).alias("right"),
        )

    places = F.sequence(F.lit(0), F.size("hashes") - 1)
    found = F.filter(F.concat(F.transform(places, onward), F.transform(places, back)), lambda w: w["size"].isNotNull())
    found = rows.select("doc_id", "h", "hashes", found.alias("windows"))
    return found.select("doc_id", "h", F.explode(F.transform("windows", match)).alias("w")).select("doc_id", "h", "w.*")


def repeated_windows(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """doc_id, h, start and size of the windows that an earlier window equals, by doc_id, row hash and line."""
    windows = _windows(docs, min_chars)
    # Two places at least: a fingerprint whose first and last place agree has no partner.
    where = F.xxhash64("doc_id", "h", "line")
    prints = windows.groupBy("fingerprint").agg(F.min(where).alias("first"), F.max(where).alias("last"))
    shared = prints.filter("first <> last").select("fingerprint")
    matched = checkpoint(split_join(windows, shared, "fingerprint", "left_semi"))
    # From the fingerprint to both sides.
    extent = ["fingerprint", "left", "right", "size"]
    here = F.struct("doc_id", "h", "start")
    first = matched.groupBy(*extent).agg(F.min(here).alias("first"))
    later = split_join(matched, first, extent)
    return later.filter(~same(here, F.col("first"))).select("doc_id", "h", "start", "size")


def deduplicate(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines``, ``n_removed`` and ``n_runs``.

    A line goes if it lies in a stretch of lines with ``min_chars`` characters or more together that stands earlier: in a row
    of smaller doc_id (null first, ties by a hash of the row) or before in the same row. One long line is such a stretch, and
    so are several short ones. Lines are cut at \\n. Empty lines are left out of the comparison; they go where the nearest
    other lines on both sides go (or there is none on one side). n_runs counts the stretches of removed lines.

    Null text is empty and counts one empty line. Rows that repeat id and text are one document and keep the same lines. Lines
    and stretches are told apart by 64 bits or more. Columns of those four names are replaced, others stay.
    """
    gone = repeated_windows(docs, min_chars)
    spans = gone.groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).agg(
        F.collect_set(F.struct("start", "size")).alias("_spans")
    )
    keyed = docs.drop(*ADDED).withColumn("_row", row_hash())
    joined = keyed.join(spans, same(F.col("doc_id").cast("long"), F.col("_id")) & (F.col("_row") == F.col("_h")), "left")
    cut = joined.withColumn("_lines", _lines())
    some, last = F.col("_spans").isNotNull(), F.size("_lines") - 1
    # The non-empty lines that go, in order; each takes along the empty ones after it if the next one goes too or is missing.
    each = F.flatten(F.transform("_spans", lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1)))
    cut = cut.withColumn("_gone", F.when(some, F.sort_array(F.array_distinct(each)))).withColumn("_filled", F.when(some, _filled("_lines")))

    def places(g: Column, i: Column) -> Column:
        begin = F.when(g == 0, 0).otherwise(F.get("_filled", g))
        follows = F.get("_gone", i + 1) == g + 1
        end = F.when(g == F.size("_filled") - 1, last).when(follows, F.get("_filled", g + 1) - 1).otherwise(F.get("_filled", g))
        return F.sequence(begin, end)

    cut = cut.withColumn("_out", F.flatten(F.transform("_gone", places)))
    stay = F.array_except(F.sequence(F.lit(0), last), F.col("_out"))
    kept = F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    opens = F.filter("_out", lambda x, i: (i == 0) | (F.get("_out", i - 1) != x - 1))
    result = F.struct(
        F.when(some, kept).otherwise(F.col("text")).alias("kept_text"), F.size("_lines").cast("long").alias("n_lines"),
        F.when(some, F.size("_out")).otherwise(0).cast("long").alias("n_removed"),
        F.when(some, F.size(opens)).otherwise(0).cast("long").alias("n_runs"),
    )
    # Exploded, so that a filter on the result is not moved into the functions above, which it would evaluate for each line.
    others = [c for c in docs.columns if c not in ADDED]
    out = cut.select(*[cut[c] for c in others], F.explode(F.array(result)).alias("_result"))
    return out.select(*others, *[F.col("_result")[c].alias(c) for c in ADDED])


def report(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs and the digest of the text that stays; nulls, ties, repeated rows and extra columns
    as in :func:`deduplicate`."""
    out = deduplicate(docs.select("doc_id", "text"), min_chars)
    digest = F.sha2(F.coalesce(F.col("kept_text"), F.lit("")), 256)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_removed", "n_runs", digest.alias("kept_sha256"))


def keep_first(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """``docs`` with repeated runs taken out of ``text``; rows of which nothing is left go. Columns stay as they are, also those
    whose names :func:`deduplicate` adds."""
    key = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_whole"))
    out = deduplicate(key, min_chars).filter((F.col("n_removed") < F.col("n_lines")) | (F.col("n_removed") == 0))
    return out.select(*[F.col("kept_text").alias(c) if c == "text" else F.col("_whole")[c].alias(c) for c in docs.columns])
