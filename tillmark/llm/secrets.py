"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is a blob named by its SHA-256. The ledger keeps, for each
pair of blob and rule version, the findings of that rule; only pairs it does not hold yet
are scanned, and findings are joined back to all paths that hold or held the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillmark.llm.common import each_batch, sha, table, unused
from tillmark.staging import stage, staging_path

_ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?s:.*?)-----END [A-Z ]*PRIVATE KEY-----")
_BEARER = re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")

#: For a fast look whether a text can hold a match at all: ASCII only, so offsets stay.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IS_HEX = bytes(49 if chr(c) in "0123456789abcdef" else 48 for c in range(256))
_WORDS = (b"passw", b"secret", b"token", b"api")

Span = tuple[int, int]


def _assign(text: str, raw: bytes) -> Iterator[Span]:
    low = raw.translate(_LOWER)
    if any(w in low for w in _WORDS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                yield m.span()


def _access(text: str, raw: bytes) -> Iterator[Span]:
    if b"AKIA" in raw:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 16:
                yield m.span()


def _hex(text: str, raw: bytes) -> Iterator[Span]:
    if b"1" * 32 in raw.translate(_IS_HEX):
        for m in _HEX.finditer(text):
            if m.end() - m.start() >= 32:
                yield m.span()


def _pem(text: str, raw: bytes) -> Iterator[Span]:
    if b"PRIVATE KEY-----" in raw:
        yield from (m.span() for m in _PEM.finditer(text))


def _bearer(text: str, raw: bytes) -> Iterator[Span]:
    if b"eyJ" in raw:
        yield from (m.span() for m in _BEARER.finditer(text))


#: Rules in the order in which spans that start together are listed; a changed rule gets a new version.
BASE = ("assign", "access", "hex")
RULES = {"assign": _assign, "access": _access, "hex": _hex, "pem": _pem, "bearer": _bearer}
VERSIONS: Mapping[str, int] = {name: 1 for name in RULES}
FINDINGS = "blob string, rule string, version int, spans array<struct<start:int,stop:int>>"


def blob(text: str) -> Column:
    """Content address of a text column; NULL counts as the empty text."""
    return F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256)


def _unseen(versions: DataFrame, text: str, ledger: DataFrame | None, rules: Mapping[str, int]) -> DataFrame:
    """One text for each blob that lacks a (blob, rule version) pair, and the rules it lacks."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    blobs = versions.select(blob(text).alias("blob"), body.alias("body"))
    wanted = F.array(*[F.concat_ws("@", F.lit(r), F.lit(str(v))) for r, v in rules.items()])
    if ledger is None:
        return blobs.dropDuplicates(["blob"]).withColumn("todo", wanted)
    done = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("done"))
    todo = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    return (
        blobs.join(done, "blob", "left").withColumn("todo", todo).where(F.size("todo") > 0)
        .dropDuplicates(["blob"]).select("blob", "body", "todo")
    )


def _findings(batch: pa.RecordBatch) -> dict[str, list]:
    out: dict[str, list] = {"blob": [], "rule": [], "version": [], "spans": []}
    for name, body, todo in zip(*(batch.column(c).to_pylist() for c in ("blob", "body", "todo")), strict=True):
        raw = body.encode("utf-8", "surrogatepass")
        for rule, version in (x.split("@") for x in todo):
            out["blob"].append(name)
            out["rule"].append(rule)
            out["version"].append(int(version))
            out["spans"].append([{"start": a, "stop": b} for a, b in RULES[rule](body, raw)])
    return out


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger's table, or None before its first entry."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.schema(FINDINGS).parquet(path)


def update_ledger(
    spark: SparkSession, versions: DataFrame, ledger: str, text: str = "text", rules: Mapping[str, int] = VERSIONS
) -> int:
    """Scan what the ledger does not hold yet, append it, and return how many pairs were new (an action).

    ``versions`` holds every historical version of every path, one row each; only ``text`` is read.
    Copies of a blob are folded before they are scanned, whatever their number. A NULL text is the
    empty blob. An empty table adds nothing. Pairs without a finding are entered too, with no spans.
    """
    known = read_ledger(spark, ledger)
    found = stage(each_batch(_unseen(versions, text, known, rules), _findings, FINDINGS), "findings")
    found.write.mode("append").parquet(ledger)
    return found.count()


def findings(
    versions: DataFrame, ledger: DataFrame, text: str = "text", rules: Mapping[str, int] = VERSIONS
) -> DataFrame:
    """Rows of ``versions`` without the text, with ``secrets``: array of (start, rank, kind, stop), sorted.

    Offsets are code points, ends exclusive. Each row appears once, also when rows are equal.
    Columns of ``versions`` may have any names but ``secrets``, which is replaced.
    """
    own = unused(versions.columns)
    name, held = f"{own}blob", f"{own}secrets"
    order = {r: i for i, r in enumerate(RULES)}
    current = reduce(lambda a, b: a | b, [(F.col("rule") == r) & (F.col("version") == v) for r, v in rules.items()])
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])[F.col("rule")]
    listed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), rank.alias("rank"), F.col("rule").alias("kind"), s["stop"].alias("stop")))
    per_blob = (
        ledger.where(current & (F.size("spans") > 0)).select("blob", listed.alias("spans"))
        .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_set("spans"))).alias(held))
        .withColumnRenamed("blob", name)
    )
    rest = [c for c in versions.columns if c not in (text, "secrets")]
    slim = versions.select(*[F.col(f"`{c}`") for c in rest], blob(text).alias(name))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,stop:int>>")
    joined = slim.join(per_blob, name, "left")
    return joined.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(held, none).alias("secrets"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")


def digests(found: DataFrame) -> DataFrame:
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[_count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("secrets")).alias("spans"),
    )


def redact(spark: SparkSession, docs: DataFrame, ledger: str, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mask`` and ``n_chars`` set anew (an action).

    Overlapping spans are masked as one. Texts without a finding, NULL among them, stay as they are.
    """
    update_ledger(spark, docs.select("text"), ledger)
    held = read_ledger(spark, ledger)
    if held is None:
        return docs
    own = unused(docs.columns)
    name, spans = f"{own}blob", f"{own}spans"
    kept = held.where(F.size("spans") > 0).groupBy("blob").agg(F.flatten(F.collect_set("spans")).alias(spans))
    marked = docs.withColumn(name, blob("text")).join(kept.withColumnRenamed("blob", name), name, "left")
    new = {
        "text": F.when(F.col(spans).isNull(), F.col("text")).otherwise(_mask(mask)("text", spans)),
        "n_chars": F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")),
    }
    masked = marked.withColumn("text", new["text"]).withColumn("n_chars", new["n_chars"])
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])


def _mask(mask: str):
    @F.udf("string", useArrow=True)
    def cut(text: str, spans: list) -> str:
        if text is None or not spans:
            return text
        out, at = [], 0
        for a, b in sorted((s["start"], s["stop"]) for s in spans):
            if b <= at:
                continue
            if a >= at:
                out += [text[at:a], mask]
            at = b
        return "".join(out) + text[at:]

    return cut


def op10_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents, by way of a new ledger."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ledger = staging_path(spark, "ledger")
    update_ledger(spark, docs, ledger)
    return digests(findings(docs, spark.read.schema(FINDINGS).parquet(ledger)))


__all__ = ["RULES", "VERSIONS", "findings", "op10_secret_ledger", "redact", "sha", "update_ledger"]
