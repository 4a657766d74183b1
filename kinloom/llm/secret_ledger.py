"""Secret scans over an incremental ledger of blobs.

A blob is the content of one historical version of a document, named by its
SHA-256. The ledger, a Parquet table that every run appends to, says which pairs of blob and
rule version were scanned and what was found. A run scans only the pairs that the ledger
lacks, once per blob, and joins findings back to every document that holds the blob.

Texts move once, hashed by the id of each blob's first holder, and are streamed
past the small side; hot contents cost one row per task before that and are split by
the adaptive join after it. Where a run has few new blobs (``FEW``), these are broadcast
and no text moves. Findings are broadcast up to ``MOST_BYTES`` of spans.

Defined cases: a null text is the empty blob, without findings; repeated rows and copies
share a blob and its findings; a null id is a holder like others; an empty table gives no rows
and an empty ledger; texts of any length are scanned whole; extra columns are ignored or, when
masking, kept, whatever their names. Spans count code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.llm.common import settle, ship

#: Rules by kind, in order: (version, pattern, group, least length of that group).
#: A run of hexadecimal digits starts where none stands before it.
BASE = {
    "assign": (1, r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (1, r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (1, r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
}
RULES = BASE | {
    "jwt": (1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    "private": (2, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----(?:(?:(?!-----)[\s\S])*-----END [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----)?", 0, 1),
}
FEW, MOST_BYTES = 10_000, 32 << 20
LEDGER = "blob binary, rule string, version int, spans string"


def spans(text: str, rules: dict, kind: str) -> list[tuple[int, int]]:
    _, pattern, group, least = rules[kind]
    return [m.span() for m in re.finditer(pattern, text) if len(m[group]) >= least]


def _scan(batches, rules: dict):
    """One row per blob and missing rule with findings as ``start:end`` lists."""
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for blob, text, missing in zip(*(batch.column(c).to_pylist() for c in ("blob", "text", "missing")), strict=True):
            for kind in missing:
                found = spans(text, rules, kind) if text else []
                for x, v in zip(out, (blob, kind, rules[kind][0], ",".join(f"{a}:{b}" for a, b in found)), strict=True):
                    x.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.binary(), pa.string(), pa.int32(), pa.string()), strict=True)], ["blob", "rule", "version", "spans"])


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def blobs_of(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.unhex(F.sha2(_text(), 256)).alias("blob"))


def update_ledger(docs: DataFrame, ledger: DataFrame | None = None, rules: dict = RULES) -> DataFrame:
    """Ledger rows for the pairs of blob and rule version that ``ledger`` lacks."""
    ship(docs.sparkSession)
    current = [F.lit(k) for k in rules]
    held = blobs_of(docs).withColumn("holder", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    first = held.groupBy("blob").agg(F.min("holder").alias("holder"))
    if ledger is None:
        unseen = first.withColumn("missing", F.array(*current))
    else:
        live = F.create_map(*(x for k, v in rules.items() for x in (F.lit(k), F.lit(v[0]))))
        seen = ledger.where(F.col("version") == F.get(F.map_values(F.map_filter(live, lambda k, _: k == F.col("rule"))), F.lit(0))).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        unseen = first.join(seen, "blob", "left").withColumn("missing", F.array_except(F.array(*current), F.coalesce("seen", F.array().cast("array<string>")))).where(F.size("missing") > 0).drop("seen")
    unseen = settle(unseen, "unseen")
    few = unseen.limit(FEW + 1).count() <= FEW
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("holder"), _text().alias("text"))
    ready = texts.join(F.broadcast(unseen) if few else unseen.hint("shuffle_hash"), "holder").where(F.unhex(F.sha2("text", 256)) == F.col("blob")).select("blob", "text", "missing")
    return ready.mapInArrow(partial(_scan, rules=rules), LEDGER).distinct()


def stored_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger under ``path``, None before the first run."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.schema(LEDGER).parquet(path) if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where) else None


def run_ledger(docs: DataFrame, path: str, rules: dict = RULES) -> DataFrame:
    """Scans what the ledger under ``path`` lacks, appends it, and returns the ledger.

    A run that fails before its commit leaves the ledger as it was; one that is
    repeated finds nothing to scan.
    """
    spark = docs.sparkSession
    update_ledger(docs, stored_ledger(spark, path), rules).write.mode("append").parquet(path)
    return stored_ledger(spark, path)


def _gathered(rules: dict):
    """From ledger rows of a blob: counts, and spans as ``kind:start:end`` in order."""
    kinds = list(rules)

    def body(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for blob, rows in zip(batch.column("blob").to_pylist(), batch.column("rows").to_pylist(), strict=True):
                by = {r["rule"]: [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s] for r in rows}
                everything = sorted((a, kinds.index(k), b) for k, v in by.items() for a, b in v)
                base = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in everything if kinds[k] in BASE)
                values = (blob, *(len(by.get(k, ())) for k in BASE), hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in everything))
                for x, v in zip(out, values, strict=True):
                    x.append(v)
            kinds_out = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds_out, strict=True)], ["blob", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return body


def findings(ledger: DataFrame, rules: dict = RULES) -> DataFrame:
    """One row for each blob of the ledger in which a current rule found something."""
    live = ledger.where("spans <> ''").where(F.concat_ws("@", "rule", "version").isin([f"{k}@{v[0]}" for k, v in rules.items()]))
    rows = live.groupBy("blob").agg(F.collect_list(F.struct("rule", "spans")).alias("rows"))  # a row per rule
    return rows.mapInArrow(_gathered(rules), "blob binary, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _found(ledger: DataFrame, rules: dict) -> DataFrame:
    """Findings by blob, broadcast where their spans are few bytes."""
    found = settle(findings(ledger, rules), "findings")
    size = found.agg(F.sum(F.octet_length("spans") + 200)).first()[0] or 0
    return F.broadcast(found) if size <= MOST_BYTES else found


def findings_by_row(docs: DataFrame, ledger: DataFrame, rules: dict = RULES) -> DataFrame:
    """What the ledger says of every row of ``docs``."""
    none = hashlib.sha256(b"").hexdigest()
    per_doc = blobs_of(docs).join(_found(ledger, rules), "blob", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_assign", "n_access", "n_hex")}
    per_doc = per_doc.withColumns(zero | {"base_sha256": F.coalesce("base_sha256", F.lit(none)), "spans": F.coalesce("spans", F.lit(""))})
    return per_doc.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", F.lower(F.hex("blob")).alias("blob_sha256"))


def scan_secrets(docs: DataFrame, ledger: DataFrame | None = None, rules: dict = RULES) -> tuple[DataFrame, DataFrame]:
    """Findings per row of ``docs``, and the ledger after this run."""
    new = settle(update_ledger(docs, ledger, rules), "ledger")
    after = new if ledger is None else ledger.unionByName(new)
    return findings_by_row(docs, after, rules), after


def _masked(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for i, found in enumerate(batch.column("__spans").to_pylist()):
            if not found:
                continue
            out, at, text = [], 0, texts[i]
            for kind, a, b in sorted((x.split(":") for x in found.split(",")), key=lambda x: (int(x[1]), -int(x[2]))):
                if int(a) >= at:
                    out += [text[at : int(a)], f"[{kind}]"]
                at = max(at, int(b))
            texts[i] = "".join(out) + text[at:]
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(texts, pa.string())).drop_columns(["__spans"])


def mask_secrets(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """``docs`` with every finding replaced by ``[kind]``; overlapping ones are one.

    Columns, names and order are those of ``docs``; ``n_chars``, where there is
    one, follows the new text.
    """
    new = settle(update_ledger(docs, ledger), "ledger")
    found = _found(new if ledger is None else ledger.unionByName(new), RULES)
    keyed = docs.withColumn("__blob", F.unhex(F.sha2(_text(), 256)))
    marked = keyed.join(found.select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans")), "__blob", "left").drop("__blob")
    masked = marked.where("__spans is not null").mapInArrow(_masked, docs.schema)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return marked.where("__spans is null").drop("__spans").unionByName(masked).select(*docs.columns)
