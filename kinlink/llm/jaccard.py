"""Exact self-join of documents on the Jaccard similarity of word shingles, by a token-group matrix.

Documents with equal shingle sets are one node.  Nodes are partitioned into
groups of similar documents by minhash bands; the relation of tokens and groups
says which tokens a group's union holds.  A node meets a foreign group only
through it: the number of the node's leading tokens that the union holds bounds
its overlap with every member, and only groups where the bound reaches what
80 % demands are opened, member by member, with an exact check of the texts.

Leading tokens: all sets are ordered alike, frequent tokens last, else by hash.
Of n tokens a partner must share ceil(0.8 n), so the first fifth and some more
must hold common ones.  Which tokens count as frequent only orders them; no
pair depends on it.

Inside a group, links to the least member of a band are checked first; where
they leave a group in parts, the parts are searched as groups of their own.
So a group of near copies of any size costs a check a member, not a pair.

Exactness: two nodes under different labels are searched by the matrix.  Two
under one label hang on it by the same edges up; if all these pass the exact
check they are one component, and if they fall into several parts, however far
below the label the failing edge stands, the label's nodes are searched again,
part against part.

Null texts and texts without words have the empty set and no links; null ids
take no part and have no component.  Rows that repeat an id are reached
together, whether their texts are equal or not; an empty table has an empty
result.  Texts of any length are hashed whole, a chunk at a time.  Ties (equal
sets) are one node, named by the least id.  Columns beside the id and the text
never meet the operator's own names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graph import components, join_back
from .shared import materialize, small_batches, whole
from .shingles import mix, shingle_set

#: Frequent tokens that are ordered last, at most: what is broadcast is 8 bytes each.
FREQUENT = 1 << 16
_SEEDS = mix(np.arange(1, 9, dtype=np.uint64))
#: Least hash of each of 32 ranges; a band is three of them.
_RANGES, BANDS = np.arange(32, dtype=np.uint64) << np.uint64(59), 6
_SKETCH = "doc_id long, n long, s1 long, s2 long, bands array<long>, token long, seen long"
_COLUMNS = pa.schema([(c, pa.list_(pa.int64()) if c == "bands" else pa.int64()) for c in ("doc_id", "n", "s1", "s2", "bands", "token", "seen")])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sum(mixed: np.ndarray) -> np.int64:
    """One half of a set's identity."""
    return np.sum(mixed, dtype=np.uint64).view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[dict]:
    """A few rows at a time, so that a batch's texts never stand in memory twice."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows).to_pydict()


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row a document; and, a row each, the tokens that several documents of a stretch of input share."""
        held, size = [], 0

        def frequent() -> pa.RecordBatch:
            token, seen = np.unique(np.concatenate(held), return_counts=True)
            token, seen = _signed(token[seen >= 8]), seen[seen >= 8]
            return pa.record_batch([pa.nulls(len(token), _COLUMNS.field(c).type) for c in range(5)] + [pa.array(token), pa.array(seen, pa.int64())], schema=_COLUMNS)

        for part in _slices(batches):
            n, s1, s2, bands = [], [], [], []
            for text in part["text"]:
                s = shingle_set(text, k)
                mixed = mix(s * _SEEDS[1])
                n.append(len(s))
                s1.append(_sum(mixed))
                s2.append(np.bitwise_xor.reduce(mixed).view(np.int64) if len(s) else 0)
                if len(s):
                    at = np.searchsorted(s, _RANGES)
                    low = s[np.where(at < len(s), at, 0)][: 3 * BANDS].reshape(BANDS, 3)
                    bands.append(_signed(mix(low[:, 0] * _SEEDS[0] + low[:, 1] * _SEEDS[1] + low[:, 2] * _SEEDS[2])))
                    held.append(s)
                    size += len(s)
                else:
                    bands.append(None)
            none = pa.nulls(len(n), pa.int64())
            yield pa.record_batch([pa.array(part["doc_id"], pa.int64()), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), none, none], schema=_COLUMNS)
            if size > 1_000_000:
                yield frequent()
                held, size = [], 0
        if held:
            yield frequent()

    return run


#: How many of their leading tokens two partners share at least, by the smaller one's n: k.
_SPARE = "(n - (4 * n + 4) div 5 + 1) div 3 + 1"


def _lead(n: int) -> int:
    """How many tokens of a set of n lead: n - ceil(0.8 n) + k."""
    a = (4 * n + 4) // 5
    return n - a + (n - a + 1) // 3 + 1


def _leading(k: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text's leading tokens in order, of which the last ``late`` are frequent ones."""
        common = frequent.value
        for part in _slices(batches):
            ids, sizes, sums, tokens, frequents = [], [], [], [], []
            for doc, text in zip(part["doc_id"], part["text"], strict=True):
                s = shingle_set(text, k)
                if len(s):
                    ids.append(doc)
                    sizes.append(len(s))
                    sums.append(_sum(mix(s * _SEEDS[1])))
                    late = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s if len(common) else np.zeros(len(s), dtype=bool)
                    lead = _lead(len(s))
                    tokens.append(_signed(np.concatenate([s[~late], s[late]])[:lead]))
                    frequents.append(max(0, lead - int(len(s) - late.sum())))
            ints = [pa.array(x, pa.int64()) for x in (ids, sizes, sums)]
            yield pa.record_batch([*ints, pa.array(frequents, pa.int32()), pa.array(tokens, pa.list_(pa.int64()))], names=["doc_id", "n", "s1", "late", "tokens"])

    return run


def _checked(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for part in _slices(batches):
            good = []
            for x, y in zip(part["text_x"], part["text_y"], strict=True):
                if y != last:
                    last, kept = y, shingle_set(y, k)
                s = shingle_set(x, k)
                both = len(np.intersect1d(s, kept, assume_unique=True))
                good.append(bool(both) and 100 * both >= 80 * (len(s) + len(kept) - both))
            yield pa.record_batch([pa.array(part["x"], pa.int64()), pa.array(part["y"], pa.int64()), pa.array(good, pa.bool_())], names=["x", "y", "ok"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, k: int, name: str) -> DataFrame:
    """``pairs`` (x, y) with ``ok``, checked exactly on the whole texts."""
    rows = pairs.join(texts.select(F.col("node").alias("x"), F.col("text").alias("text_x")), "x").join(texts.select(F.col("node").alias("y"), F.col("text").alias("text_y")), "y")
    return materialize(rows.select("x", "y", "text_x", "text_y").mapInArrow(_checked(k), "x long, y long, ok boolean"), name)


def _opened(tokens: DataFrame) -> DataFrame:
    """Pairs (x < y) of nodes with different labels that share enough leading tokens.

    ``tokens``: within (labels meet only inside it), token, pos (place among the
    leading tokens), node, n, label.  A group is the nodes of a label of about
    one size.  First, the larger node of a pair has a k-th of its first
    n - ceil(0.8 n) + k tokens among the smaller one's first n - ceil(8/9 n) + k;
    groups with fewer such tokens in their union are not met.  Then all leading
    tokens are counted against the union: what two nodes share is at most that
    count and what follows the leading tokens of either.  Groups where this
    reaches 4/9 of both sizes are opened, and the same bound is held against
    each member.
    """
    spare = F.expr("(n - (4 * n + 4) div 5 + 1) div 4 + 1")
    key, group = ["within", "token"], ["label", "bin"]
    tokens = tokens.withColumns(
        {"k": spare, "bin": F.floor(F.log(F.col("n")) / math.log(1.06)).cast("int"), "rest": F.expr(f"n - least(n, n - (4 * n + 4) div 5 + {_SPARE})")}
    )
    split = tokens.groupBy(*key).agg(F.min("label").alias("_a"), F.max("label").alias("_b"), F.count("*").alias("_c")).where("_a <> _b").select(*key, "_c")
    rows = materialize(join_back(tokens, split, key, tokens.count()), "matrix")

    small = rows.where("pos < n - (8 * n + 8) div 9 + k")
    able = small.groupBy("within", "node", "n").agg(F.count("*").alias("_c"), F.max("k").alias("_k")).where("_c >= _k").select("within", "node", "n")
    union = small.join(able, ["within", "node", "n"], "left_semi").groupBy(*key, *group).agg(F.min("k").alias("_k"), F.min("n").alias("_low"), F.max("n").alias("_high"))
    large = rows.where("pos < n - (4 * n + 4) div 5 + k").select(*key, F.col("node").alias("x"), F.col("n").alias("n_x"), F.col("label").alias("_mine"))
    met = large.join(union, key).where("label <> _mine AND _low <= n_x AND 5 * _high >= 4 * n_x")
    met = met.groupBy("within", "x", "n_x", *group).agg(F.count("*").alias("_c"), F.min("_k").alias("_k")).where("_c >= _k").select("within", "x", "n_x", *group)
    met = materialize(met, "groups")

    of = rows.select(*key, F.col("node").alias("x"), F.col("n").alias("n_x"), F.col("rest").alias("rest_x"))
    union = rows.groupBy(*key, *group).agg(F.min("n").alias("n_y"), F.max("rest").alias("rest_y"))
    counted = of.join(met, ["within", "x", "n_x"]).join(union, [*key, *group])
    counted = counted.groupBy("within", "x", "n_x", *group).agg(F.count("*").alias("_c"), F.min("n_y").alias("n_y"), F.max(F.greatest("rest_x", "rest_y")).alias("_rest"))
    opened = materialize(counted.where("9 * (_c + _rest) >= 4 * (n_x + n_y)").select("within", "x", "n_x", *group), "groups")

    members = rows.select(*key, *group, F.col("node").alias("y"), F.col("n").alias("n_y"), F.col("rest").alias("rest_y"))
    pairs = of.join(opened, ["within", "x", "n_x"]).join(members, [*key, *group]).where("n_y <= n_x AND 5 * n_y >= 4 * n_x")
    pairs = pairs.groupBy("x", "y", "n_x", "n_y", "rest_x", "rest_y").agg(F.count("*").alias("_c")).where("9 * (_c + greatest(rest_x, rest_y)) >= 4 * (n_x + n_y)")
    return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x <> y").distinct()


def link_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the least id reachable by links of 80 % or more."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    found = materialize(rows.mapInArrow(_sketches(k), _SKETCH), "sketches")
    top = found.where("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen")).orderBy(F.desc("seen"), "token").limit(FREQUENT)
    frequent = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in top.select("token").collect()], dtype=np.int64).view(np.uint64)))

    sketches = found.where("n IS NOT NULL")
    key = ["n", "s1", "s2"]
    live = sketches.where("n > 0 AND doc_id IS NOT NULL")
    nodes = materialize(live.groupBy(*key).agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")), "nodes")
    # The node of every row; and, only where ids repeat, what that calls for.
    of_row = materialize(sketches.drop("bands", "token", "seen").join(nodes.select(*key, "node"), key, "left").select("doc_id", "n", "s1", "node"), "rows")
    repeated = not of_row.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty()
    rows = rows.where("doc_id IS NOT NULL")
    if repeated:
        rows = rows.dropDuplicates(["doc_id", "text"])

    # Groups: a node hangs on the least node with which it has a band in common.
    band = nodes.select("node", F.posexplode("bands").alias("i", "value"))
    least = band.groupBy("i", "value").agg(F.min("node").alias("up"), F.count("*").alias("_c")).where("_c > 1")
    up = materialize(join_back(band, least, ["i", "value"], nodes.count() * BANDS).groupBy("node").agg(F.min("up").alias("up")).where("up < node"), "up")
    star = up.select(F.col("up").alias("x"), F.col("node").alias("y"))

    def climb(edges: DataFrame) -> DataFrame:
        """``node, label``: three steps up, or as far as there are."""
        out = edges.select("node", F.col("up").alias("label"))
        for _ in range(2):
            out = out.join(edges.select(F.col("node").alias("label"), F.col("up").alias("_next")), "label", "left").select("node", F.coalesce("_next", "label").alias("label"))
        return out

    of = nodes.select("node").distinct().join(climb(up), "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    of = materialize(of, "labels")

    # Leading tokens, a row a node: copies go before anything is exploded.  Frequent tokens have partners in any case; of the others only those that two nodes have are kept.
    copies = of_row.where("doc_id <> node").select("doc_id", "n", "s1")
    tokens = rows.mapInArrow(_leading(k, frequent), "doc_id long, n long, s1 long, late int, tokens array<long>").join(copies, ["doc_id", "n", "s1"], "left_anti")
    tokens = tokens.select(F.col("doc_id").alias("node"), "n", (F.size("tokens") - F.col("late")).alias("plain"), F.posexplode("tokens").alias("pos", "token"))
    # Frequent ones are salted, so that none fills a task.
    every = Window.partitionBy("token", "_salt")
    tokens = tokens.withColumn("_salt", F.when(F.col("pos") >= F.col("plain"), F.pmod(F.xxhash64("node"), F.lit(1024))).otherwise(F.lit(0)))
    met = tokens.withColumn("_a", F.min("node").over(every)).withColumn("_b", F.max("node").over(every)).where("pos >= plain OR _a <> _b").select("token", "pos", "node", "n")
    # A node with a partner has k such tokens at least, k of the smallest partner it can have; so few have them that this stands before every other join.
    least = _SPARE.replace("n", "((4 * n + 4) div 5)")
    led = met.withColumn("_c", F.count("*").over(Window.partitionBy("node", "n"))).where(f"_c >= {least}").join(of, "node")
    led = materialize(led.select("token", "pos", "node", "n", "label"), "tokens")
    pairs = materialize(star.unionByName(_opened(led.withColumn("within", F.lit(0)))).distinct(), "pairs")

    # One exact check of each candidate, on texts that are fetched once.  The list of candidates grows with the corpus, so it is never broadcast.
    active = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    texts = materialize(rows.withColumnRenamed("doc_id", "node").join(active.hint("merge"), "node", "left_semi").dropDuplicates(["node", "text"]), "texts")
    first = _verified(pairs, texts, k, "checked")
    links = first.where("ok").select("x", "y").distinct()

    # Groups that the checks leave in parts: the parts are groups of their own.  A failing edge anywhere below a label tears it, so labels are told by their parts.
    sound = up.join(links.select(F.col("x").alias("up"), F.col("y").alias("node")), ["up", "node"], "left_semi")
    part = materialize(of.join(climb(sound).withColumnRenamed("label", "part"), "node", "left").select("node", F.col("label").alias("within"), F.coalesce("part", "node").alias("part")), "parts")
    torn = part.groupBy("within").agg(F.min("part").alias("_a"), F.max("part").alias("_b")).where("_a <> _b").select("within")
    # A label may be hot: its rows are salted for the join.
    torn = torn.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(31))))
    salted = led.withColumnRenamed("label", "within").withColumn("_salt", F.pmod(F.xxhash64("node", "token"), F.lit(32)).cast("int"))
    parts = salted.join(torn, ["within", "_salt"], "left_semi").drop("_salt").join(part.select("node", F.col("part").alias("label")), "node")
    parts = materialize(parts, "tokens")
    more = materialize(_opened(parts).join(first.select("x", "y"), ["x", "y"], "left_anti"), "pairs")
    links = links.unionByName(_verified(more, texts, k, "checked").where("ok").select("x", "y"))
    if repeated:
        several = of_row.where("node IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("x"), F.max("node").alias("_b")).where("x <> _b").drop("_b")
        links = links.unionByName(of_row.where("node IS NOT NULL").join(several, "doc_id").select("x", F.col("node").alias("y")))

    out = of_row.join(components(links), "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", F.when(F.col("n") > 0, F.col("node")), "doc_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    if not repeated:
        return out
    # Rows of an id without words go with its other rows.
    least = out.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("component_id").alias("_least"))
    return out.join(least, "doc_id", "left").select("doc_id", "n_shingles", F.col("_least").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """One row of each class of linked documents with its own columns, whatever their names: the least id's, a null id last.

    Rows without words all stay.  Where ids are null or repeat, rows are
    numbered and written first, so that rows equal in id and text are copies
    like any others, and of their class, too, one row stays.
    """
    ids = docs.select(docs[doc_id].cast("long").alias("doc_id"))
    row = whole(docs).alias("_row")
    if ids.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        gone = link_classes(docs, doc_id, text, k).where("component_id < doc_id").select(F.col("doc_id").alias("_gone"))
        return docs.select(row).join(gone, F.col(f"_row.`{doc_id}`").cast("long") == F.col("_gone"), "left_anti").select("_row.*")
    rows = materialize(docs.select(row, F.monotonically_increasing_id().alias("_id")), "numbered")
    classes = link_classes(rows.select("_id", F.col(f"_row.`{text}`").alias("text")), "_id", "text", k).where("n_shingles > 0").select(F.col("doc_id").alias("_id"), F.col("component_id").alias("_class"))
    order = F.struct(F.col(f"_row.`{doc_id}`").cast("long").isNull().alias("none"), F.col(f"_row.`{doc_id}`").cast("long").alias("id"), F.col("_id").alias("at"))
    ranked = materialize(rows.select("_id", order.alias("_at")).join(classes, "_id"), "classes")
    first = ranked.groupBy("_class").agg(F.min("_at").alias("_at")).select(F.col("_at.at").alias("_id"))
    gone = ranked.select("_id").join(first, "_id", "left_anti")
    return rows.join(gone, "_id", "left_anti").select("_row.*")
