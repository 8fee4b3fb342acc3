"""Token counts of documents in flat token files without an index: a separator scan.

A file is a run of little-endian unsigned integers of one width; one value ends
each document.  Files are cut into blocks of equal bytes, read by range; each
block is searched for the separator by one vector comparison and gives its
number of tokens and of separators and the tokens after its last one.  A prefix
scan over these few numbers a block stitches the boundaries: it says how many
documents end before a block and how many tokens of an open document it
continues.

A file's last document may lack its separator.  Empty documents count 0, an
empty file has none, and a null text is an empty document; an empty table has
no files and an empty result.  Repeated rows are documents of their own, as are
rows with null ids.  Documents of any length span as many blocks as they need.
Columns beside the id and the text are left out, whatever their names.  A file
whose bytes are no whole number of tokens fails.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import materialize, small_batches

#: Bytes of a block; a multiple of every width.
BLOCK = 1 << 22
_SCANNED = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("ends", pa.list_(pa.int64()))])


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path and the path on it; ``file:/x`` is how Spark writes ``file:///x``."""
    return pa.fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


class Bpe:
    """An encoder of a published byte-pair vocabulary; only the driver reads the file of its ranks."""

    def __init__(self, ranks_file: str, pattern: str):
        with open(ranks_file, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = pattern

    def __call__(self) -> Callable[[str], list[int]]:
        """The encoding function, made once a task."""
        import tiktoken

        return tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary


def write_token_files(docs: DataFrame, path: str, encoder: Callable, separator: int, doc_id: str = "doc_id", text: str = "text", width: int = 2) -> DataFrame:
    """Each input task writes one flat token file below ``path``; the result is ``file, bytes, document, doc_id``, one row a document in the file's order.

    A task that runs again writes another file; only files that the rows name
    belong to the set.
    """
    spark, kind = docs.sparkSession, f"<u{width}"
    small_batches(spark)
    held = spark.sparkContext.broadcast(encoder)
    files, top = _open(path)
    files.create_dir(top, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ids, out, name, size = held.value(), [], None, f"{path}/{uuid.uuid4().hex}.tokens", 0
        for batch in batches:
            if out is None:
                fs, at = _open(name)
                out = fs.open_output_stream(at)
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = np.array([*encode(body.as_py() or ""), separator], dtype=kind).tobytes()
                out.write(data)
                size += len(data)
                ids.append(doc)
        if out is not None:
            out.close()
        for at in range(0, len(ids), 10_000):
            some = ids[at : at + 10_000]
            yield pa.record_batch([pa.array([name] * len(some)), pa.array([size] * len(some), pa.int64()), pa.array(range(at, at + len(some)), pa.int64()), pa.array(some, pa.int64())], names=["file", "bytes", "document", "doc_id"])

    rows = docs.select(docs[doc_id].cast("long"), docs[text]).mapInArrow(run, "file string, bytes long, document long, doc_id long")
    return materialize(rows, "manifest")


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, bytes`` of the token files below a path; their contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def document_lengths(files: DataFrame, separator: int, width: int = 2, block: int = BLOCK) -> DataFrame:
    """``file, document, n_tokens`` of every document, numbered from 0 in each file; ``files``: file, bytes."""
    kind = f"<u{width}"
    bad = F.raise_error(F.concat(F.col("file"), F.lit(" holds no whole number of tokens")))
    files = files.withColumn("bytes", F.when(F.col("bytes") % width == 0, F.col("bytes")).otherwise(bad.cast("long")))
    places = files.where("bytes > 0").select("file", F.explode(F.expr(f"sequence(0L, (bytes - 1) div {block})")).alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, at = _open(name)
                with fs.open_input_file(at) as f:
                    values = np.frombuffer(f.read_at(block, k * block), dtype=kind)
                yield pa.record_batch([pa.array([name]), pa.array([k], pa.int64()), pa.array([len(values)], pa.int64()), pa.array([np.flatnonzero(values == separator)], pa.list_(pa.int64()))], schema=_SCANNED)

    found = materialize(places.repartition("file", "block").mapInArrow(run, "file string, block long, n long, ends array<long>"), "separators")
    k = F.size("ends").cast("long")
    narrow = found.select("file", "block", "n", k.alias("k"), (F.col("n") - 1 - F.coalesce(F.try_element_at("ends", F.when(k > 0, -1)), F.lit(-1))).alias("tail"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = narrow.withColumn("_total", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("_docs", F.coalesce(F.sum("k").over(before), F.lit(0)))
    sums = sums.withColumn("_mark", F.when(F.col("k") > 0, F.col("_total") + F.col("n") - F.col("tail")))
    sums = sums.withColumn("_open", F.col("_total") - F.coalesce(F.last("_mark", True).over(before), F.lit(0)))
    each = found.join(sums.select("file", "block", "_docs", "_open"), ["file", "block"]).select("file", "_docs", "_open", "ends", F.posexplode("ends").alias("i", "end"))
    length = F.when(F.col("i") == 0, F.col("_open") + F.col("end")).otherwise(F.col("end") - F.try_element_at("ends", F.greatest(F.col("i"), F.lit(1))) - 1)
    done = each.select("file", (F.col("_docs") + F.col("i")).alias("document"), length.alias("n_tokens"))
    rest = sums.groupBy("file").agg(F.sum("k").alias("document"), (F.sum("n") - F.coalesce(F.max("_mark"), F.lit(0))).alias("n_tokens")).where("n_tokens > 0")
    return done.unionByName(rest)


def counts_by_document(manifest: DataFrame, separator: int, width: int = 2, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_tokens`` of every document of ``write_token_files``, counted in the files."""
    lengths = document_lengths(manifest.select("file", "bytes").distinct(), separator, width, block)
    return manifest.join(lengths, ["file", "document"], "left").select("doc_id", "file", "document", "n_tokens")
