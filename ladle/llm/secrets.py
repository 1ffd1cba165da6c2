"""Secret scans over an incremental blob ledger.

Every version of a text is addressed by its content (SHA-256), so copies and
unchanged versions are one blob. The ledger holds one row per blob and rule
version with all findings in it, also for clean blobs (an empty list). A scan
takes the distinct blobs, leaves out those the ledger already has under this
rule version, runs the rules over the rest, and joins findings back to every
path that holds the blob.

Defined results: a null text is the empty text; empty texts are clean; equal
texts share a blob whatever their ids, and repeated rows are all reported; a
null id is kept as it is; other columns of the input are not read. Texts are
scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import bounded_batches, tidy

#: Name of the rules below; a ledger keeps what each version has found.
RULE_VERSION = "rules-1.1"
#: Kinds in order of report; the first three are the base rules (fixed values).
KINDS = ("assign", "access", "hex", "pem", "jwt", "hook")
BASE = KINDS[:3]

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_KEYWORDS = ("passw", "secret", "token", "api")
# runs of at least the least length are the runs of any length less the short ones
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
_HOOK = re.compile(r"https?://[^\s/:@]++:[^\s/:@]++@[A-Za-z0-9.-]+")

LEDGER = "blob string, rule_version string, findings array<struct<kind:string,start:bigint,end:bigint>>"


def findings(text: str) -> list[tuple[str, int, int]]:
    """All (kind, start, end) in a text, by start, then kind; code points, end exclusive."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        out += [(m.start(), 3, m.end()) for m in _PEM.finditer(text)]
    if "eyJ" in text:
        out += [(m.start(), 4, m.end()) for m in _JWT.finditer(text)]
    if "://" in text and "@" in text:
        out += [(m.start(), 5, m.end()) for m in _HOOK.finditer(text)]
    return [(KINDS[k], s, e) for s, k, e in sorted(out)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        found = [[dict(zip(("kind", "start", "end"), x)) for x in findings(t)] for t in batch["_text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["_blob"], pa.array(found, kind)], ["_blob", "findings"])


def address(df: DataFrame, text_col: str) -> DataFrame:
    """Add ``_text`` (null as empty) and ``_blob``, its content address."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return df.withColumn("_text", text).withColumn("_blob", F.sha2(F.encode("_text", "UTF-8"), 256))


def scan_unseen(df: DataFrame, text_col: str = "text", ledger: DataFrame | None = None,
                rule_version: str = RULE_VERSION) -> DataFrame:
    """New ledger rows: every distinct blob of ``df`` that ``ledger`` lacks under ``rule_version``."""
    bounded_batches(df.sparkSession)
    blobs = address(df.select(F.col(f"`{text_col}`").alias("_t")), "_t").select("_blob", "_text")
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == rule_version).select(F.col("blob").alias("_blob")).distinct()
        blobs = blobs.join(seen, "_blob", "left_anti")
    found = blobs.dropDuplicates(["_blob"]).mapInArrow(
        tidy(_scan), "_blob string, findings array<struct<kind:string,start:bigint,end:bigint>>")
    return found.select(F.col("_blob").alias("blob"), F.lit(rule_version).alias("rule_version"), "findings")


def report(df: DataFrame, ledger: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           rule_version: str = RULE_VERSION) -> DataFrame:
    """(id, blob, findings) for every row of ``df``, from a ledger that covers its blobs."""
    known = ledger.where(F.col("rule_version") == rule_version).select(F.col("blob").alias("_blob"), "findings")
    rows = address(df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t")), "_t")
    return rows.select("_id", "_blob").join(known, "_blob").select(
        F.col("_id").alias(id_col), F.col("_blob").alias("blob"), "findings")


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the characters of every finding replaced by asterisks, same columns.

    Each distinct blob that has findings is scanned once; the spans are joined
    back to all rows that hold it. A null text stays null, a clean text as it is."""
    kept = df.columns
    dirty = scan_unseen(df, text_col).where(F.size("findings") > 0).select(F.col("blob").alias("_blob"), F.col("findings").alias("_found"))
    inner = [f"_c{i}" for i in range(len(kept))]
    text = F.col(inner[kept.index(text_col)])
    rows = df.toDF(*inner).withColumn("_blob", F.sha2(F.encode(text, "UTF-8"), 256))
    masked = F.aggregate(F.coalesce("_found", F.array()), text, lambda t, x: F.concat(
        F.substring(t, F.lit(1), x["start"].cast("int")), F.repeat(F.lit("*"), (x["end"] - x["start"]).cast("int")),
        F.substring(t, (x["end"] + 1).cast("int"), F.length(t))))
    joined = rows.join(dirty, "_blob", "left")
    return joined.select(*[(masked if c == text_col else F.col(n)).alias(c) for c, n in zip(kept, inner)])


def digests(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and joined spans of each row of ``report``."""
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("findings", lambda x: x["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("findings", lambda x: x["kind"] == k)).cast("long")
    return rows.select(F.col(f"`{id_col}`"), *[count(k).alias(f"n_{k}") for k in BASE],
                       F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))
