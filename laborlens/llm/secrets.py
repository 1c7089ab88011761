"""Secrets in documents, and how many documents and owners share each of them.

Candidates are found by built-in regular expressions. Their hashes are aggregated over the corpus by distinct documents
and owners: a value that many owners carry is a copied example, one that few owners carry looks live. The frequencies also
decide which opaque strings, found without a keyword beside them, are reported at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens.llm.frames import checkpoint, row_hash, same, split_join

#: Kinds in the order that breaks ties of the start.
KINDS = ["assign", "access", "hex", "opaque"]
#: Values of this contract: the pattern of an assignment, its value in group 2.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The runs of these two are maximal, so a minimum in the pattern finds the same ones as a filter afterwards.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: A long run of the characters of keys; it must hold a digit and letters in both cases.
OPAQUE = r"[A-Za-z0-9+/_-]{20,}"

_SPAN = "struct<start:int,kind_no:int,end:int,value:string>"


def _spans(text: Column, pattern: str, kind: str, group: int = 0) -> Column:
    """Matches of ``pattern`` as structs by start; positions are code points.

    Position is not among what the built-in functions return, so it is summed up from the lengths of the pieces
    between the matches and of the matches.
    """
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    parts = F.arrays_zip(between.alias("between"), whole.alias("whole"), value.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def step(acc: Column, part: Column) -> Column:
        begin = acc["at"] + F.length(part["between"])
        end = begin + F.length(part["whole"])
        span = F.struct(
            begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), end.alias("end"), part["value"].alias("value")
        )
        return F.struct(
            F.coalesce(end, begin).alias("at"),
            F.when(part["whole"].isNull(), acc["spans"]).otherwise(F.array_append(acc["spans"], span)).alias("spans"),
        )

    return F.aggregate(parts, start, step, lambda acc: acc["spans"])


def candidates(docs: DataFrame, owner: str = "source") -> DataFrame:
    """doc_id, h, owner and ``spans`` (start, kind_no, end, value) of the documents with a candidate.

    Opaque strings that overlap a span of another kind are left out. Null text is empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast(f"array<{_SPAN}>")
    assigned = F.when(
        text.rlike(ASSIGN), F.filter(_spans(text, ASSIGN, "assign", 2), lambda s: F.length(s["value"]) >= 8)
    ).otherwise(none)
    access = F.when(text.rlike(ACCESS), _spans(text, ACCESS, "access")).otherwise(none)
    hexes = F.when(text.rlike(HEX), _spans(text, HEX, "hex")).otherwise(none)
    opaque = F.when(
        text.rlike(OPAQUE),
        F.filter(
            _spans(text, OPAQUE, "opaque"),
            lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]"),
        ),
    ).otherwise(none)
    base = F.concat(assigned, access, hexes)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("h"), F.col(owner).cast("string").alias("owner"),
        base.alias("base"), opaque.alias("opaque"),
    ).filter((F.size("base") > 0) | (F.size("opaque") > 0))
    free = F.filter(
        "opaque", lambda o: ~F.exists("base", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"]))
    )
    return rows.select("doc_id", "h", "owner", F.concat("base", free).alias("spans")).filter(F.size("spans") > 0)


def scan(docs: DataFrame, owner: str = "source", example_owners: int = 3) -> DataFrame:
    """One row per document with a finding: doc_id, h and ``spans`` by start, then kind.

    A span has kind, start, end (code points, end exclusive), value_sha256, n_docs, n_owners and live. A value is live
    while fewer than ``example_owners`` owners carry it; opaque strings that are not live are no finding. Rows without
    an owner count as one owner. Rows repeated with the same id and text are one document. Extra columns are ignored.
    """
    found = candidates(docs, owner).dropDuplicates(["doc_id", "h"])
    spans = found.select("doc_id", "h", "owner", F.explode("spans").alias("s")).select(
        "doc_id", "h", "owner", F.col("s.kind_no"), F.col("s.start"), F.col("s.end"), F.sha2("s.value", 256).alias("value")
    )
    spans = checkpoint(spans)  # findings only; read twice
    # Each level shrinks before it moves: a value in a third of all documents is spread by document, then by owner.
    by_document = spans.groupBy("value", "owner", "doc_id", "h").agg(F.lit(1).alias("one"))
    by_owner = by_document.groupBy("value", "owner").agg(F.count("*").alias("n"))
    owned = by_owner.groupBy("value").agg(F.sum("n").alias("n_docs"), F.count("*").alias("n_owners"))
    judged = split_join(spans, owned, "value").withColumn("live", F.col("n_owners") < example_owners)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind_no") + 1)
    judged = judged.filter(F.col("live") | (F.col("kind_no") < KINDS.index("opaque")))
    span = F.struct(
        "start", "kind_no", "end", kind.alias("kind"), F.col("value").alias("value_sha256"), "n_docs", "n_owners", "live"
    )
    return judged.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame, owner: str = "source", example_owners: int = 3) -> DataFrame:
    """One row per row of ``docs`` with counts and the list of spans; documents without a finding have empty lists."""
    found = scan(docs, owner, example_owners).withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("h"))
    joined = rows.join(found, same(F.col("doc_id"), F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    spans = F.coalesce(F.col("spans"), F.array().cast(found.schema["spans"].dataType))
    base = F.filter(spans, lambda s: s["kind_no"] < 3)

    def number(i: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind_no"] == i)).cast("long")

    return joined.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["live"])).cast("long").alias("n_live"),
    )


def redact(docs: DataFrame, owner: str = "source", example_owners: int = 3) -> DataFrame:
    """``docs`` with each found span replaced by a mark that names its kind and whether it looks live.

    Overlapping spans become one mark, that of the first. All columns stay; other rows are unchanged.
    """
    found = scan(docs, owner, example_owners).select(
        F.col("doc_id").alias("_id"), F.col("h").alias("_h"), F.col("spans").alias("_spans")
    )
    keyed = docs.withColumn("_row", row_hash())
    joined = keyed.join(found, same(F.col("doc_id"), F.col("_id")) & (F.col("_row") == F.col("_h")), "left")

    def step(acc: Column, s: Column) -> Column:
        mark = F.concat(F.lit("["), F.when(s["live"], "live ").otherwise("example "), s["kind"], F.lit("]"))
        gap = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], gap, mark)).alias("out"),
        )

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    masked = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.aggregate("_spans", first, step, rest))
    return joined.withColumn("text", masked).select(*docs.columns)
