"""Secret scans by an incremental ledger of blobs.

A version of a path is addressed by the SHA-256 of its content, its blob. The ledger, a Parquet table, has for each blob
the rule versions that have scanned it and what they found. A run addresses all versions that it is given, scans only
pairs of blob and rule version that the ledger lacks, appends them, and joins the findings back to every path that has,
or had, that content. So copies and unchanged files are scanned once, and a new version of one rule scans old blobs with
that rule alone.

A blob that is new and stands in one place, the usual case, is scanned where its text is read. Bitmaps of 16 bits for
each other blob (2^28 bits at most; marks that coincide only cost time) tell tasks which texts to leave: repeated blobs
and those that the ledger knows in part are shuffled by blob, so that one task scans each once.

Cases: null text is empty content; null paths are paths like others; repeated rows are returned each; texts of any
length are read whole; a table without rows adds nothing to the ledger; extra columns are not read. A run that failed
before its append leaves nothing; findings that two runs at one time appended twice are counted once.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns_of, dropped, pieces, shared_dir, written

ENTRY = "blob binary, rules array<string>, findings array<struct<rule:string,start:long,end:long>>"
ARROW = pa.schema([
    ("blob", pa.binary()), ("rules", pa.list_(pa.string())),
    ("findings", pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
])

ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs, so a shorter one is none
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def _assign(text: str) -> Iterator[tuple[int, int]]:
    low = text.lower()
    if any(w in low for w in WORDS):
        yield from (m.span() for m in ASSIGN.finditer(text) if len(m[1]) >= 12)


def _access(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 18)


def _by(pattern: str) -> Callable[[str], Iterator[tuple[int, int]]]:
    found = re.compile(pattern).finditer
    return lambda text: (m.span() for m in found(text))


#: Rule: version and spans in a text. The first three are the base; the others are public formats of credentials.
RULES: dict[str, tuple[int, Callable]] = {
    "assign": (1, _assign),
    "access": (1, _access),
    "hex": (1, _by(HEX.pattern)),
    "key": (1, _by(r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----")),
    "jwt": (1, _by(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}")),
    "github": (1, _by(r"gh[oprsu]_[A-Za-z0-9]{36,}")),
    "slack": (1, _by(r"xox[abprs]-[A-Za-z0-9-]{10,}")),
    "url": (1, _by(r"://[^\s/:@]+:[^\s/:@]+@")),
}
BASE = ("assign", "access", "hex")


def versioned(rules: dict) -> dict[str, Callable]:
    """Rule functions by name and version, as the ledger names them."""
    return {f"{name}@{version}": spans for name, (version, spans) in rules.items()}


def findings(text: str, names: list[str], spans: dict[str, Callable]) -> list[dict]:
    return [{"rule": n, "start": a, "end": b} for n in names for a, b in spans[n](text)]


def _slot(digest: bytes, bits: int) -> int:
    return int.from_bytes(digest[:4], "big") >> 32 - bits


def slots(blobs: DataFrame, bits: int) -> Column:
    """The bitmap's place of a blob: its first `bits` bits."""
    return F.shiftrightunsigned(F.conv(F.hex(F.substring("blob", 1, 4)), 16, 10).cast("long"), 32 - bits)


def _bitmap(blobs: DataFrame, bits: int) -> np.ndarray:
    at = slots(blobs, bits)
    marks = blobs.select(F.shiftright(at, 15).alias("k"), (at % (1 << 15)).cast("long").alias("bit"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in marks.groupBy("k").agg(F.bitmap_construct_agg("bit").alias("m")).toLocalIterator():
        out[r["k"] << 12 : (r["k"] + 1) << 12] = np.frombuffer(r["m"], np.uint8)
    return out


def _marked(bits: np.ndarray, slot: int) -> bool:
    return bool(bits[slot >> 3] >> (slot & 7) & 1)


def _scan_in_place(left, bits: int, rules: dict):
    """Scans the texts whose blob has no mark, with all rules."""

    def run(batches: Iterator) -> Iterator:
        marks, spans = left.value, versioned(rules)
        names = list(spans)
        for batch in pieces(batches):
            rows = []
            for text in batch.column(0).to_pylist():
                blob = hashlib.sha256(text.encode()).digest()
                if not _marked(marks, _slot(blob, bits)):
                    rows.append({"blob": blob, "rules": names, "findings": findings(text, names, spans)})
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    return run


def _taken_along(wanted, bits: int):
    """(blob, text) of the texts whose blob has a mark; once in a task, as far as it remembers."""

    def run(batches: Iterator) -> Iterator:
        marks, before = wanted.value, set()
        for batch in pieces(batches):
            blobs, texts = [], []
            for text in batch.column(0).to_pylist():
                blob = hashlib.sha256(text.encode()).digest()
                if blob not in before and _marked(marks, _slot(blob, bits)):
                    if len(before) > 1 << 16:
                        before.clear()
                    before.add(blob)
                    blobs.append(blob)
                    texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), pa.array(texts, pa.string())], names=["blob", "text"])

    return run


def _scan_due(rules: dict):
    def run(batches: Iterator) -> Iterator:
        spans = versioned(rules)
        for batch in pieces(batches):
            rows = [{"blob": b, "rules": due, "findings": findings(t, due, spans)} for b, t, due in zip(*columns_of(batch, "blob", "text", "due"), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    return run


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows (blob, rules, findings); none if there is no ledger yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(ENTRY).parquet(ledger) if there else spark.createDataFrame([], ENTRY)


def scan(versions: DataFrame, ledger: str, rules: dict | None = None, path: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, blob, findings) of each row of versions, its findings by the given rules. The ledger gains what it lacked."""
    spark, rules = versions.sparkSession, RULES if rules is None else rules
    names = F.array(*[F.lit(n) for n in versioned(rules)])
    rows = versions.select(F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    paths = written(rows.select("path", F.unhex(F.sha2("text", 256)).alias("blob")), "paths")
    known = entries(spark, ledger)
    seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    blobs = paths.groupBy("blob").agg(F.count("*").alias("n")).join(seen, "blob", "left")
    blobs = written(blobs.select("blob", (F.col("seen").isNotNull() | (F.col("n") > 1)).alias("held"), F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))).alias("due")), "blobs")

    held = blobs.where("held")
    bits = min(28, max(18, (16 * held.count()).bit_length()))
    left = spark.sparkContext.broadcast(_bitmap(held, bits))
    # what a task leaves and the ledger lacks: held blobs, and new ones whose mark coincides with that of a held one
    same = held.select(slots(held, bits).alias("slot")).distinct()
    fresh = blobs.where("not held").withColumn("slot", slots(blobs, bits)).join(same, "slot", "left_semi").select("blob", "due")
    due = written(held.where(F.size("due") > 0).select("blob", "due").unionByName(fresh), "due")
    wanted = spark.sparkContext.broadcast(_bitmap(due, bits))
    texts = rows.select("text")
    once = texts.mapInArrow(_taken_along(wanted, bits), "blob binary, text string").groupBy("blob").agg(F.first("text").alias("text"))
    scanned = once.join(due, "blob").mapInArrow(_scan_due(rules), ENTRY).unionByName(texts.mapInArrow(_scan_in_place(left, bits, rules), ENTRY))
    scanned.write.mode("append").option("compression", "zstd").parquet(ledger)
    dropped(due)
    dropped(blobs)

    found = entries(spark, ledger).select("blob", F.filter("findings", lambda f: F.array_contains(names, f["rule"])).alias("findings")).where(F.size("findings") > 0)
    # a table, so that the join shuffles both sides directly and Spark can split a blob that very many paths have
    found = written(found.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings")), "findings")
    return paths.join(found, "blob", "left").select("path", "blob", F.coalesce("findings", F.array().cast("array<struct<rule:string,start:long,end:long>>")).alias("findings"))


def listed(found: Column, kinds: list[str]) -> Column:
    """kind:start:end of the findings of some kinds by start, then kind, comma-joined."""
    order = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    kind = lambda f: F.substring_index(f["rule"], "@", 1)
    own = F.transform(F.filter(found, lambda f: kind(f).isin(kinds)), lambda f: F.struct(f["start"], F.element_at(order, kind(f)).alias("k"), f["end"], kind(f).alias("kind")))
    return F.array_join(F.transform(F.array_sort(own), lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def secrets(docs: DataFrame, ledger: str | None = None, rules: dict | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans; with no ledger given, into a new one."""
    rules = RULES if rules is None else rules
    out = scan(docs, ledger or f"{shared_dir(docs.sparkSession)}/hydrapix/ledger-{uuid.uuid4().hex}", rules)
    number = lambda k: F.size(F.filter("findings", lambda f: F.substring_index(f["rule"], "@", 1) == k)).cast("long").alias(f"n_{k}")
    return out.select(
        F.col("path").alias("doc_id"), *[number(k) for k in BASE],
        F.sha2(listed(F.col("findings"), list(BASE)), 256).alias("base_sha256"), listed(F.col("findings"), list(rules)).alias("spans"),
    )
