"""Secret scans over the history of files: an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. A blob is scanned once per rule version, and never again
while the ledger holds the pair; findings are joined back to all paths that hold the blob. Copies meet in map-side partial
aggregates before the exchange, so a blob that a third of all rows hold leaves each task once.

Defined cases: null text is the empty text; an empty text has no findings; repeated rows each get their result; a null path is
kept; an empty table gives no rows; columns beyond path and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import cut_lineage, table


@dataclass(frozen=True)
class Rule:
    """`least` characters of group `group` at least; shorter matches are dropped after matching."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0

    @property
    def version(self) -> str:
        return hashlib.sha256(f"{self.kind}\n{self.pattern}\n{self.least}\n{self.group}".encode()).hexdigest()[:12]


#: A private key from BEGIN to the next END. Without END (before another BEGIN): to the end of the body, that is header lines, long base64 runs
#: and short ones that end a line or are padded, between white space, quotes and escaped line ends.
KEY = (
    r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END (?:[A-Z]+ ){0,3}PRIVATE KEY-----"
    r"""|(?:(?:[\s>|"',]|\\[nrt])*(?:(?:Proc-Type|DEK-Info):[^\n\\]*|[A-Za-z0-9+/]{16,}={0,2}(?:[ \t]+[A-Za-z0-9+/]{1,15}={0,2}(?![A-Za-z0-9+/=]))?"""
    r"""|[A-Za-z0-9+/]+(?:={1,2}|(?=["']?[ \t\r]*(?:\n|\\[nr]|\Z)))))*)"""
)
#: The base kinds, in their order.
BASE = ("assign", "access", "hex")
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("private_key", KEY),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
SPAN = "struct<version:string,kind:string,start:int,end:int>"


def find(text: str, rules: list[tuple[Rule, re.Pattern]]) -> list[dict]:
    """Leftmost non-overlapping matches of each rule, in code points."""
    return [
        {"version": rule.version, "kind": rule.kind, "start": m.start(), "end": m.end()}
        for rule, pattern in rules
        for m in pattern.finditer(text)
        if not rule.least or len(m[rule.group]) >= rule.least
    ]


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, text, todo (rule versions to scan) -> blob, versions, spans."""
    span = pa.struct([("version", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(rule, re.compile(rule.pattern, re.ASCII)) for rule in rules]
        everything = {rule.version for rule in rules}
        for batch in batches:
            found = []
            for text, todo in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                own = compiled if set(todo) == everything else [c for c in compiled if c[0].version in todo]
                found.append(find(text.as_py(), own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.list_(span))], names=["blob", "versions", "spans"]
            )

    return blobs.select("blob", "text", "todo").mapInArrow(run, f"blob binary, versions array<string>, spans array<{SPAN}>")


def addressed(versions: DataFrame, text: str = "text") -> DataFrame:
    """Adds `blob`, the SHA-256 of the text; null text becomes empty."""
    return versions.withColumn(text, F.coalesce(F.col(text).cast("string"), F.lit(""))).withColumn("blob", F.unhex(F.sha2(text, 256)))


def update_ledger(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger entries (blob, versions, spans) for the pairs of blob and rule version that `ledger` lacks; written once."""
    current = F.array(*[F.lit(rule.version) for rule in rules])
    blobs = addressed(versions).groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        unseen = blobs.withColumn("todo", current)
    else:
        seen = ledger.select("blob", F.explode("versions").alias("version")).groupBy("blob").agg(F.collect_set("version").alias("_seen"))
        unseen = blobs.join(seen, "blob", "left").withColumn(
            "todo", F.array_except(current, F.coalesce("_seen", F.array().cast("array<string>")))
        )
        unseen = unseen.filter(F.size("todo") > 0)
    return cut_lineage(scan_blobs(unseen, rules))


def scan_versions(
    versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES
) -> tuple[DataFrame, DataFrame]:
    """All rows of `versions` (text, any other columns but `blob` and `spans`) with `blob` and `spans`; and the ledger with what was added."""
    added = update_ledger(versions, ledger, rules)
    whole = added if ledger is None else ledger.select(*added.columns).unionByName(added)
    current = [rule.version for rule in rules]
    found = whole.select("blob", F.filter("spans", lambda s: s["version"].isin(current)).alias("spans")).filter(F.size("spans") > 0)
    if ledger is not None:
        found = found.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    rows = addressed(versions).join(found, "blob", "left")
    order = F.create_map(*[x for i, rule in enumerate(rules) for x in (F.lit(rule.kind), F.lit(i))])
    ranked = F.transform("spans", lambda s: F.struct(s["start"], F.element_at(order, s["kind"]).alias("rank"), s["kind"], s["end"]))
    ordered = F.transform(F.array_sort(ranked), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return rows.withColumn("spans", F.coalesce(ordered, empty)), whole


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """Text with every run of covered characters replaced by the mask; spans in the order of their starts."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        gap = F.concat(done["out"], F.substring(text, done["at"] + 1, span["start"] - done["at"]), F.lit(mask))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"), F.when(span["start"] >= done["at"], gap).otherwise(done["out"]).alias("out")
        )

    rest = F.aggregate(spans, state, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.lit(2**31 - 1))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def redact_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Documents with their secrets masked; columns and rows stay, a null text stays null."""
    source = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text"))
    rows, _ = scan_versions(source, rules=rules)
    fields = [
        (redacted(F.col("text"), F.col("spans")) if n == "text" else F.col("_row")[n]).alias(n) for n in docs.columns
    ]
    return rows.select(*[F.when(F.col("_row")["text"].isNotNull(), c).alias("text") if n == "text" else c for n, c in zip(docs.columns, fields, strict=True)])


def op3_secrets(spark, folder: str) -> DataFrame:
    rows, _ = scan_versions(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE]
    return rows.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


__all__ = ["BASE", "RULES", "Rule", "find", "op3_secrets", "redact_documents", "scan_versions", "update_ledger"]
