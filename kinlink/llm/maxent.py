"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

The most frequent tokens stand in nested classes, eight to a class: a tree with
eight branches a node, built from the training counts so that all branches of a
node are about equally likely (Huffman's rule).  A token's probability is the
product of a softmax over the eight branches at each class on its way, and each
softmax sees hashed features of the context: the last token, the last two, and
skips to the second and the third last.  One leaf stands for all tokens outside
the tree, shared out by their smoothed training counts, so that every text has
a proper probability.

Biases are the logarithms of the counts in each branch.  What the features add
is trained in ``ROUNDS`` synchronous rounds: each document belongs to one round
by its hash; in a round all tasks compute the gradient of their texts at the
same weights, the gradients are summed, and the driver takes one step, scaled
by how often each weight row was met.  A sum doesn't depend on how texts lie in
partitions, so neither do the weights (but for the order of additions).

Sizes grow with the cube root of the training tokens T: the tree holds the most
frequent tokens, 500 cbrt(T) at most, and four times as many rows of eight
weights are hashed into.  So does a training
task's share of the input, which keeps the gradients that are sent in proportion
to the input.  Counts cover all training texts: per token, by its 64-bit hash, in a shuffled
table; tokens outside the tree get theirs by a join.

Null and empty texts have one token, the end.  A null id counts as the text "".
Without training texts every token has base probability 1; an empty table has an
empty result.  Repeated rows train and are scored as often as they stand; texts
of any length are scored whole; tokens that tie at the last count the tree could
hold are all outside it.  Other columns are left out, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialize, small_batches
from .shingles import mix, word_hashes

#: Branches of a class; rounds of training; rows of weights a message holds; tokens of a training task, as a multiple of cbrt(T).
WAYS, ROUNDS, CHUNK, SHARE = 8, 5, 1 << 14, 37_800
#: Tokens in a numpy batch of training, and of scoring.
LEARNED, BATCH = 1 << 18, 1 << 15
#: A step is the gradient over CURVE * visits + RIDGE, with visits of all rounds so far, and no larger than MOST; no weight is larger than LARGEST.
CURVE, RIDGE, MOST, LARGEST = 0.3, 8.0, 2.0, 8.0
#: Stands for the end of a text; no word is expected to hash to it.
END = np.uint64(0x5BD1E9955BD1E995)
#: Stands for what is before a text.
START = np.uint64(0x2545F4914F6CDD1D)
_HALF = np.uint64(32)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


def size_for(total: int) -> int:
    """Tokens in the tree at most, for so many training tokens."""
    return max(1 << 12, math.ceil(500 * math.cbrt(total)))


def rows_for(total: int) -> int:
    """Rows of weights, in whole chunks."""
    return CHUNK * math.ceil(4 * size_for(total) / CHUNK)


def tasks_for(total: int) -> int:
    """Training tasks of a round."""
    return max(1, math.ceil(math.cbrt(total) ** 2 / SHARE))


def tokens(text: str | None) -> np.ndarray:
    """The hashes of a text's words and its end."""
    return np.append(word_hashes(text), END) if text else np.array([END], dtype=np.uint64)


def tree(masses: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``parent, branch`` of every leaf (in the order of ``masses``, descending), then of every class, the root last; and each class's log masses by branch.

    The lightest eight stand together, again and again: the least number of
    softmaxes a token.  The first class takes what makes all others full.
    """
    n = len(masses)
    first, inner = (n - 2) % (WAYS - 1) + 2, max(1, math.ceil((n - 1) / (WAYS - 1)))
    first = min(first, n)
    mass = np.concatenate([masses, np.zeros(inner)])
    parent, branch = np.full(n + inner, -1, dtype=np.int32), np.zeros(n + inner, dtype=np.int8)
    bias = np.full((inner, WAYS), -np.inf, dtype=np.float32)
    light, made = n - 1, n
    for k in range(inner):
        me = n + k
        for j in range(first if k == 0 else WAYS):
            if light >= 0 and (made == me or masses[light] <= mass[made]):
                take, light = light, light - 1
            else:
                take, made = made, made + 1
            parent[take], branch[take] = k, j
            bias[k, j] = math.log(mass[take]) if mass[take] > 0 else -np.inf
            mass[me] += mass[take]
    return parent, branch, bias


class Head:
    """The tokens in the tree: an open-addressing table from hash to rank, their counts, and the tree.  Leaf 0 is all other tokens."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        n = len(hashes)
        self.total, self.distinct, self.counts = total, distinct, counts.astype(np.float64)
        self.slots = 1 << max(4, (4 * n).bit_length())
        self.keys, self.ranks = np.zeros(self.slots, dtype=np.uint64), np.zeros(self.slots, dtype=np.int32)
        at, left = (hashes & np.uint64(self.slots - 1)).astype(np.int64), np.arange(n)
        while len(left):  # each round, the first of those that want a free slot gets it
            free = self.keys[at[left]] == 0
            slot, who = np.unique(at[left[free]], return_index=True)
            won = left[free][who]
            self.keys[slot], self.ranks[slot] = hashes[won], won
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = np.where(self.keys[at[left]] != 0, (at[left] + 1) % self.slots, at[left])
        self.rest = total - self.counts.sum() + 0.5 * (distinct - n + 1)
        masses = np.concatenate([[self.rest], self.counts + 0.5])
        order = np.argsort(-masses, kind="stable")
        parent, branch, self.bias = tree(masses[order])
        self.bias -= self.bias.max(axis=1, keepdims=True)
        self.root = len(self.bias) - 1
        place = np.argsort(order, kind="stable")
        self.leaves = len(parent) - len(self.bias)
        self.parent, self.branch = np.concatenate([parent[place], parent[self.leaves :]]), np.concatenate([branch[place], branch[self.leaves :]])

    def find(self, h: np.ndarray) -> np.ndarray:
        """The rank of each hash; -1 for those that aren't in the table."""
        at = (h & np.uint64(self.slots - 1)).astype(np.int64)
        key = self.keys[at]
        out = np.where(key == h, self.ranks[at], -1)
        open_ = np.flatnonzero((key != h) & (key != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % self.slots
            key = self.keys[at[open_]]
            out[open_[key == h[open_]]] = self.ranks[at[open_[key == h[open_]]]]
            open_ = open_[(key != h[open_]) & (key != 0)]
        return out


class Model:
    def __init__(self, head: Head, w: np.ndarray | None = None):
        self.head = head
        self.w = np.zeros((rows_for(head.total), WAYS), dtype=np.float32) if w is None else w
        self.rows = np.uint64(len(self.w))

    @staticmethod
    def features(c1: np.ndarray, c2: np.ndarray, c3: np.ndarray) -> list[np.ndarray]:
        """Hashes of the last token, the last two, and the second and the third last."""
        return [mix(x) for x in (c1 * _ODD[0], (c1 * _ODD[1] + c2) * _ODD[0] + np.uint64(1), c2 * _ODD[2] + np.uint64(2), c3 * _ODD[3] + np.uint64(3))]

    def walk(self, ranks: np.ndarray, features: list[np.ndarray]) -> Iterator[tuple]:
        """Per level, from the leaves up: which tokens, the weight rows of each feature, each token's branch, and the branches' odds and their sums.

        Biases are logarithms of shares and weights are bounded, so no odds overflow.
        """
        at, node = None, ranks + 1
        top = self.head.leaves + self.head.root
        while len(node):
            cls, branch = self.head.parent[node], self.head.branch[node]
            of = (cls.astype(np.uint64) + np.uint64(1)) * _ODD[4]
            z = self.head.bias.take(cls, axis=0)
            more, rows = np.empty_like(z), []
            for f in features:
                x = f ^ of if at is None else f.take(at) ^ of
                x *= _ODD[0]
                x >>= _HALF
                x *= self.rows
                x >>= _HALF
                rows.append(x.view(np.int64))
                z += self.w.take(rows[-1], axis=0, out=more, mode="clip")
            mine = z.reshape(-1).take(np.arange(0, z.size, WAYS) + branch)
            np.exp(z, out=z)
            total = z[:, 0].copy()
            for j in range(1, WAYS):
                total += z[:, j]
            yield at, rows, branch, mine, z, total
            node = self.head.leaves + cls
            go = np.flatnonzero(node != top)
            at, node = go if at is None else at.take(go), node.take(go)

    def log10(self, ranks: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(ranks))
        for at, _, _, mine, _, total in self.walk(ranks, features):
            mine -= np.log(total)
            if at is None:
                out += mine
            else:
                out[at] += mine
        return out / math.log(10)

    def gradient(self, ranks: np.ndarray, features: list[np.ndarray], into: np.ndarray, visits: np.ndarray) -> None:
        """Adds what these tokens say to the gradient and the number of visits of each row."""
        for _, rows, branch, _, p, total in self.walk(ranks, features):
            p /= -total[:, None]
            p.reshape(-1)[np.arange(0, p.size, WAYS) + branch] += 1
            every, columns = np.concatenate(rows), p.T.astype(np.float64, order="C")
            visits += np.bincount(every, minlength=len(visits))
            for column, sums in zip(columns, into, strict=True):
                sums += np.bincount(every, np.tile(column, len(rows)), len(visits))


def sequences(texts, head: Head) -> tuple:
    """Hashes and ranks of all tokens of some texts, their features, the number of tokens of each text and where each starts."""
    hashes = [tokens(t) for t in texts]
    sizes = np.array([len(h) for h in hashes])
    h = np.concatenate(hashes)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(h)) - np.repeat(starts, sizes)

    def back(k: int) -> np.ndarray:
        out = np.full(len(h), START, dtype=np.uint64)
        out[k:] = h[:-k]
        out[place < k] = START
        return out

    return h, head.find(h), Model.features(back(1), back(2), back(3)), sizes, starts


def _groups(texts, size: int) -> Iterator[list]:
    out, held = [], 0
    for t in texts:
        out.append(t)
        held += len(t or "") // 5 + 1
        if held >= size:
            yield out
            out, held = [], 0
    if out:
        yield out


def gradients(texts, model: Model, into: np.ndarray, visits: np.ndarray) -> None:
    """Adds the gradient (a row a branch) and the visits of some texts' tokens."""
    for part in _groups(texts, LEARNED):
        _, ranks, features, _, _ = sequences(part, model.head)
        for i in range(0, len(ranks), LEARNED):
            model.gradient(ranks[i : i + LEARNED], [f[i : i + LEARNED] for f in features], into, visits)


def step(w: np.ndarray, gradient: np.ndarray, visits: np.ndarray, seen: np.ndarray) -> None:
    """One update of the weights (or of some rows); ``seen`` gathers the visits of all rounds."""
    seen += visits
    w += np.clip(gradient / (CURVE * seen[:, None] + RIDGE), -MOST, MOST).astype(np.float32)
    np.clip(w, -LARGEST, LARGEST, out=w)


MESSAGE = "chunk int, gradient binary, visits binary"


def _learn(head_held, w_held):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A task's sums, a row a chunk of the weights: the gradient a visit in half precision, and the visits."""
        model = Model(head_held.value, w_held.value)
        into, visits = np.zeros((WAYS, len(model.w)), dtype=np.float32), np.zeros(len(model.w), dtype=np.float32)
        gradients((t for batch in batches for t in batch["text"]), model, into, visits)
        for at in range(0, len(visits), CHUNK):
            v = visits[at : at + CHUNK]
            if v.any():
                mean = (into[:, at : at + CHUNK] / np.maximum(v, 1)).astype(np.float16)
                yield pd.DataFrame({"chunk": [at // CHUNK], "gradient": [mean.tobytes()], "visits": [v.tobytes()]})

    return run


def _summed(messages: pd.DataFrame) -> pd.DataFrame:
    visits = [np.frombuffer(x, dtype=np.float32) for x in messages["visits"]]
    means = [np.frombuffer(x, dtype=np.float16).reshape(WAYS, -1) for x in messages["gradient"]]
    total = sum(m.astype(np.float64) * v for m, v in zip(means, visits, strict=True))
    return pd.DataFrame({"chunk": messages["chunk"][:1], "gradient": [total.astype(np.float32).tobytes()], "visits": [np.sum(visits, axis=0, dtype=np.float64).astype(np.float32).tobytes()]})


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0

    def flush() -> pd.DataFrame:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pd.DataFrame({"h": h.view(np.int64), "c": n})

    for batch in batches:
        for t in batch["text"]:
            held.append(tokens(t))
            size += len(held[-1])
            if size > 2_000_000:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


SCORED = "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, h array<long>, times array<int>"


def _score(head_held, w_held):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, model = head_held.value, Model(head_held.value, w_held.value)
        base_rest, rest = math.log10(head.total + 0.5 * (head.distinct + 1)), math.log10(head.rest)
        for batch in batches:
            at = 0
            for part in _groups(batch["text"], 60_000):
                h, ranks, features, sizes, starts = sequences(part, head)
                logs = np.empty(len(h))
                for i in range(0, len(h), BATCH):
                    logs[i : i + BATCH] = model.log10(ranks[i : i + BATCH], [f[i : i + BATCH] for f in features])
                known = ranks >= 0
                # Tokens outside the tree get the logarithm of their count in the join.
                base = np.where(known, np.log10(np.append(head.counts, 0.5)[ranks] + 0.5), 0.0) - base_rest
                score = logs - np.where(known, 0.0, rest)
                away = [np.unique(h[s : s + n][~known[s : s + n]], return_counts=True) for s, n in zip(starts, sizes, strict=True)]
                rows = batch.iloc[at : at + len(part)]
                at += len(part)
                yield pd.DataFrame(
                    {
                        "doc_id": rows["doc_id"].astype("Int64").array, "held_out": rows["held_out"].array, "n_tokens": sizes, "known": np.add.reduceat(known.astype(np.int64), starts), "base": np.add.reduceat(base, starts),
                        "score": np.add.reduceat(score, starts), "h": [x[0].view(np.int64) for x in away], "times": [x[1].astype(np.int32) for x in away],
                    }
                )

    return run


def held_out(doc_id: Column) -> Column:
    # Fixed values of the contract.
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 1


def _head(vocabulary: DataFrame) -> Head:
    """The tree over the tokens above the least count at which they are not too many; at most one row a count reaches the driver beside them."""
    total, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    room, least = size_for(total), 1
    for c, n in sorted(map(tuple, vocabulary.groupBy("c").count().collect()), reverse=True):
        if n > room:
            least = c + 1
            break
        room -= n
    top = vocabulary.where(F.col("c") >= least).toPandas().sort_values(["c", "h"], ascending=[False, True])
    return Head(top["h"].to_numpy(dtype=np.int64).view(np.uint64), top["c"].to_numpy(dtype=np.int64), int(total), int(distinct))


def fit(training: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Head, np.ndarray]:
    """Counts of all tokens of ``training`` (text) as a table (h, c), the head, and the weights."""
    spark = training.sparkSession
    vocabulary = materialize(training.select("text").mapInPandas(_counts, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "vocabulary")
    head = _head(vocabulary)
    w = Model(head).w
    seen, held = np.zeros(len(w)), spark.sparkContext.broadcast(head)
    for k in range(rounds if head.total else 0):
        now = spark.sparkContext.broadcast(w)
        mine = training.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k).select("text").coalesce(tasks_for(head.total))
        sums = mine.mapInPandas(_learn(held, now), MESSAGE).groupBy("chunk").applyInPandas(_summed, MESSAGE)
        w = w.copy()
        for chunk, gradient, visits in sums.toLocalIterator():
            rows = slice(chunk * CHUNK, (chunk + 1) * CHUNK)
            step(w[rows], np.frombuffer(gradient, dtype=np.float32).reshape(WAYS, -1).T, np.frombuffer(visits, dtype=np.float32), seen[rows])
        now.destroy()
    return vocabulary, head, w


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), held_out(docs[doc_id]).alias("held_out"), docs[text].alias("text"))
    vocabulary, head, w = fit(rows.where(~F.col("held_out")), rounds)
    scored = rows.mapInPandas(_score(spark.sparkContext.broadcast(head), spark.sparkContext.broadcast(w)), SCORED)
    scored = materialize(scored.withColumn("_id", F.monotonically_increasing_id()), "scored")
    away = scored.select("_id", F.explode(F.arrays_zip("h", "times")).alias("x")).select("_id", "x.h", "x.times")
    found = away.join(vocabulary, "h", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    logs = F.col("times") * F.log10(F.col("c") + 0.5)
    sums = found.groupBy("_id").agg(F.sum(logs).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("also"))
    out = scored.drop("h", "times").join(sums, "_id", "left").withColumn("more", F.coalesce("more", F.lit(0.0)))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(head.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more")).alias("base_score"), (F.col("score") + F.col("more")).alias("score"),
    )
