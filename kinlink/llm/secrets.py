"""Secret scans over a ledger of content-addressed blobs; DataFrame functions only.

Every version of every text is a blob, named by its SHA-256.  A ledger, a folder
that every scan adds to, keeps which (blob, rule, rule version) pairs were
scanned and what was found; a scan reads only pairs that the ledger lacks, and
findings join back to every path (row) that holds the blob.

Null texts are the empty blob.  Repeated rows are one blob, scanned once, and
all get its findings; an empty table scans nothing and has none.  Texts of any
length are scanned whole.  Findings that start alike stand in the rules' order.
"""

from __future__ import annotations

from dataclasses import dataclass

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import free


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more; ``hint`` is a pattern that any such text has."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1
    hint: str | None = None


# Fixed values of the contract, in the order in which kinds are listed.
RULES = (
    Rule("assign", r"""((?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, group=2, hint="(?i)password|passwd|secret|token|api_?key"),
    Rule("access", r"AKIA[A-Z0-9]+", 20, hint="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}", 24, hint="[0-9a-f]{24}"),
)

#: Parts into which the paths of a blob are salted.
SALTS = 32

SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """The matches of a rule, leftmost and non-overlapping, as structs (start, rank, kind, end) in code points, end exclusive.

    The pieces between the matches and the matches themselves give the places:
    a running sum of their lengths.
    """
    gaps, found = F.split(text, F.lit(rule.pattern), -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    parts = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(found)),
        F.arrays_zip(found.alias("m"), kept.alias("g")),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["m"]).alias("all"), F.length(m["g"]).alias("part")),
    )
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPANS).alias("out"))
    empty = F.array().cast(SPANS)

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["gap"]
        hit = F.array(F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), (begin + p["all"]).alias("end")))
        return F.struct((begin + p["all"]).alias("at"), F.when(p["part"] >= rule.least, F.concat(F.coalesce(acc["out"], empty), hit)).otherwise(acc["out"]).alias("out"))

    there = F.regexp_like(text, F.lit(rule.hint or rule.pattern))
    return F.when(there, F.coalesce(F.aggregate(parts, start, step, lambda acc: acc["out"]), empty)).otherwise(empty)


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def rule_table(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> Column:
    """The rules as an array of structs (kind, version): what a scan of a blob is recorded under."""
    return F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])


def scan(versions: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """New ledger rows for ``versions``: blob, kind, version, spans — one a blob and rule that ``ledger`` lacks.

    Equal texts meet once: copies are dropped in each input task before the
    blobs travel, so a group of copies sends one row a task.
    """
    blobs = versions.select(blob_id(versions[text]).alias("blob"), F.coalesce(versions[text], F.lit("")).alias("_text")).groupBy("blob").agg(F.first("_text").alias("_text"))
    blobs = blobs.withColumn("_done", F.lit(None).cast("array<string>"))
    if ledger is not None:
        done = ledger.select("blob", F.concat_ws(":", "kind", F.col("version").cast("string")).alias("_pair")).groupBy("blob").agg(F.collect_set("_pair").alias("_done"))
        blobs = blobs.drop("_done").join(done, "blob", "left").where((F.col("_done").isNull()) | (F.size(F.array_except(F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules]), F.col("_done"))) > 0))
    rows = [
        F.when(F.col("_done").isNull() | ~F.array_contains("_done", f"{r.kind}:{r.version}"), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), spans(F.col("_text"), r, k).alias("spans")))
        for k, r in enumerate(rules)
    ]
    return blobs.select("blob", F.explode(F.array(*rows)).alias("_r")).where("_r IS NOT NULL").select("blob", "_r.*")


LEDGER = f"blob binary, kind string, version int, spans {SPANS}"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(path)


def record(versions: DataFrame, path: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scans what the ledger at ``path`` lacks of ``versions`` and adds it; returns the ledger.

    Each scan writes a folder of its own, so one that fails leaves the ledger
    as it was.
    """
    spark = versions.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    scan(versions, text, rules, read_ledger(spark, path) if there else None).write.parquet(f"{path}/scan-{uuid.uuid4().hex}")
    return read_ledger(spark, path)


def findings(versions: DataFrame, ledger: DataFrame, path: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of ``versions`` as its ``path`` columns, ``blob`` and ``spans``: all findings of the given rules, by place.

    A path column called ``blob`` or ``spans`` stays, and the operator's has an
    underscore behind its name.

    Only blobs with findings take part in the join, and rows travel without
    their texts.  Each blob's findings are sent ``SALTS`` times, so that the
    paths of a blob with many copies spread over as many tasks.  A row without
    findings has an empty array.
    """
    mine = F.concat_ws(":", "kind", F.col("version").cast("string")).isin([f"{r.kind}:{r.version}" for r in rules])
    found = ledger.where(mine & (F.size("spans") > 0)).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    found = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    of = [versions[c] for c in path]
    rows = versions.select(F.struct(*[c.alias(p) for c, p in zip(of, path, strict=True)]).alias("_path"), blob_id(versions[text]).alias("blob"), F.pmod(F.xxhash64(*of), F.lit(SALTS)).cast("int").alias("_salt"))
    met = rows.join(found, ["blob", "_salt"], "left")
    return met.select("_path.*", F.col("blob").alias(free("blob", path)), F.coalesce("spans", F.array().cast(SPANS)).alias(free("spans", path)))


def listed(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
