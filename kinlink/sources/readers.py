"""SRC1-SRC13: readers with fixed schemas and gates that fail before any job starts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..config import NA_CELLS

RAW = ("entity_id", "business_name", "business_address", "country")
NORMALIZED = (*RAW, "name_normalized", "name_core", "address_normalized", "country_normalized", "name_missing", "address_missing", "name_length", "address_length")
# The names under which truth files may hold their columns, first match wins.
TRUTH_NAMES = {"source1_entity_id": ("source1_entity_id", "entity_id"), "matched_entity_ids": ("matched_entity_ids", "match_entity_ids", "matched_ids")}


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def require_inputs(spark: SparkSession, paths: Iterable[str]) -> None:
    """SRC11: all paths exist, on whatever file system, or FileNotFoundError names those that don't."""
    missing = [p for p in paths if not (lambda at, fs: fs.exists(at))(*_path(spark, p))]
    if missing:
        raise FileNotFoundError("missing inputs: " + ", ".join(missing))


def find_file(spark: SparkSession, folder: str, name: str) -> str:
    """SRC10: folder/name, else the only file of that name below the folder."""
    at, fs = _path(spark, f"{folder}/{name}")
    if fs.exists(at):
        return at.toString()
    top, fs = _path(spark, folder)
    found, files = [], fs.listFiles(top, True)
    while files.hasNext():
        p = files.next().getPath()
        if p.getName() == name:
            found.append(p.toString())
    if len(found) != 1:
        raise FileNotFoundError(f"{len(found)} files called {name} below {folder}")
    return found[0]


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> DataFrame:
    """SET5, SRC7, SRC13: a subset check by name; types and extra columns are free."""
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")
    return df


def _files(spark: SparkSession, path: str) -> list:
    """The data files at a path, in the order of their names."""
    at, fs = _path(spark, path)
    status = fs.listStatus(at)
    return sorted((s.getPath().toString(), s.getLen()) for s in status if s.isFile() and not s.getPath().getName().startswith(("_", ".")))


def file_bytes(spark: SparkSession, path: str) -> int:
    return sum(n for _, n in _files(spark, path))


def header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The first line of a TSV file (of the first part of a folder of them), cell by cell."""
    lines = spark.read.text(_files(spark, path)[0][0]).take(1)
    return tuple(lines[0][0].split("\t")) if lines else ()


def read_tsv(spark: SparkSession, path: str, columns: Iterable[str] | None = None, na_cells: Iterable[str] = (), quoted_line_ends: bool = False) -> DataFrame:
    """A tab-separated file with a header; every column a string, read by name.  ``na_cells`` become null; quotes double inside quotes.

    With ``quoted_line_ends`` a quoted cell may hold line ends; then a file is
    read by one task, where otherwise it is cut into many.
    """
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("multiLine", quoted_line_ends).option("mode", "PERMISSIVE")
    if columns is None:
        df = reader.csv(path)
    else:
        header = reader.option("inferSchema", False).csv(path).columns
        df = reader.schema(StructType([StructField(c, StringType()) for c in header])).csv(path)
        df = require_columns(df, columns, path).select(*columns)
    cells = list(na_cells)
    return df.select(*[F.when(~F.col(c).isin(cells), F.col(c)).alias(c) for c in df.columns]) if cells else df


def read_raw(spark: SparkSession, path: str, na_cells: Iterable[str] = NA_CELLS, quoted_line_ends: bool = True) -> DataFrame:
    """SRC1-SRC2: a raw source.  Its cells may hold quoted line ends; say no where they are known not to, and large files are read by many tasks."""
    return read_tsv(spark, path, RAW, na_cells, quoted_line_ends)


def read_truth(spark: SparkSession, path: str, na_cells: Iterable[str] = NA_CELLS, quoted_line_ends: bool = True) -> DataFrame:
    """SRC3, SRC8: known matches as (source1_entity_id, matched_entity_ids), under any of their accepted names."""
    df = read_tsv(spark, path, None, na_cells, quoted_line_ends)
    chosen = {}
    for name, accepted in TRUTH_NAMES.items():
        chosen[name] = next((c for c in accepted if c in df.columns), None)
        if chosen[name] is None:
            raise ValueError(f"{path} has none of the columns {', '.join(accepted)}")
    return df.select(*[F.col(c).alias(name) for name, c in chosen.items()])


def read_stage(spark: SparkSession, path: str, columns: Iterable[str] | None = None, split: str | None = None) -> DataFrame:
    """SRC4-SRC7, SRC9: a Parquet stage, partition folders included; projection and the split filter reach the scan."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.where(F.col("dataset_split") == split)
    return df if columns is None else require_columns(df, columns, path).select(*columns)
