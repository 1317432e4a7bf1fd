"""Nearest neighbours by inner product over a hierarchical k-means tree.

1. Equal vectors become one class with its smallest ids, so a vector that a
   third of the rows share costs one comparison.
2. A tree of k-means splits is trained on a bounded sample (``SAMPLE`` classes)
   and every class is sent down to its leaf.  Inner product is turned into
   distance by one further coordinate, ``sqrt(max_norm**2 - norm**2)``.
3. A query walks the tree best bin first: a priority queue holds the nodes
   seen, nearest first, and hands out leaves.
4. How many leaves to visit is calibrated: for ``CALIBRATION`` queries the true
   neighbours are found by brute force over all rows, and the visits widen
   until ``recall`` of them lie in visited leaves.  A walk goes on past them
   until its leaves hold as many classes as are asked for.
5. Queries and leaves meet in blocks; leaves and the queries of a leaf are cut
   into parts of bounded size.

Odd input: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part; rows repeated with the same id
count once; with fewer candidates than asked for, all are returned; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm import tables

SAMPLE = 32_768
BRANCHES = 8
LEAF_ROWS = 512
LEAF_SAMPLE = 16
CHUNK = 2048
QUERY_CHUNK = 4096
CALIBRATION = 128
RECALL = 0.97
SEED = 7

# Centres of all nodes, children of each node, leaf number of each node (or -1).
Tree = tuple[np.ndarray, list[list[int]], np.ndarray]


# --- the tree -------------------------------------------------------------------

def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Cluster number of each row."""
    centres = x[rng.choice(len(x), k, replace=False)]
    part = np.zeros(len(x), dtype=np.int64)
    for _ in range(rounds):
        part = (((centres ** 2).sum(1)) - 2 * x @ centres.T).argmin(1)
        for c in range(k):
            mine = x[part == c]
            centres[c] = mine.mean(0) if len(mine) else x[rng.integers(len(x))]
    return part


def train(x: np.ndarray, leaf_size: int, seed: int = SEED) -> Tree:
    """(centres of all nodes, children of each node, leaf number or -1)."""
    rng = np.random.default_rng(seed)
    centres, children, leaves = [x.mean(0)], [[]], [-1]
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        k = min(BRANCHES, -(-len(rows) // leaf_size))
        part = _kmeans(x[rows], k, rng) if k > 1 else np.zeros(len(rows), dtype=np.int64)
        groups = [rows[part == c] for c in range(k)]
        groups = [g for g in groups if len(g)]
        if len(groups) < 2:
            leaves[node] = sum(n >= 0 for n in leaves)
            continue
        for g in groups:
            children[node].append(len(centres))
            centres.append(x[g].mean(0))
            children.append([])
            leaves.append(-1)
            todo.append((children[node][-1], g))
    return np.array(centres), children, np.array(leaves)


def descend(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf that each row falls into, always taking the nearest child."""
    centres, children, leaves = tree
    out = np.zeros(len(x), dtype=np.int64)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if not children[node]:
            out[rows] = leaves[node]
            continue
        c = centres[children[node]]
        part = ((c ** 2).sum(1) - 2 * x[rows] @ c.T).argmin(1)
        todo += [(child, rows[part == i]) for i, child in enumerate(children[node])]
    return out


def best_bins(tree: Tree, q: np.ndarray, visits: int, held: np.ndarray | None = None,
              need: int = 0) -> list[list[int]]:
    """Per query the first ``visits`` leaves, best bin first; more of them
    until they hold ``need`` classes (``held``: classes per leaf)."""
    centres, children, leaves = tree
    out = []
    for far in (centres ** 2).sum(1) - 2 * q @ centres.T:
        queue = [(far[0], 0)]
        found: list[int] = []
        rows = 0
        while queue and (len(found) < visits or rows < need):
            _, node = heapq.heappop(queue)
            if children[node]:
                for child in children[node]:
                    heapq.heappush(queue, (far[child], child))
            else:
                found.append(int(leaves[node]))
                rows += int(held[leaves[node]]) if held is not None else 0
        out.append(found)
    return out


def _augment(x: np.ndarray, norm: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(norm ** 2 - (x ** 2).sum(1), 0))[:, None]])


def _as_query(x: np.ndarray, norm: float) -> np.ndarray:
    """Queries on the sphere of the augmented rows: only their direction counts."""
    return np.hstack([x * (norm / np.sqrt((x ** 2).sum(1)))[:, None], np.zeros((len(x), 1))])


def _matrix(values, width: int) -> np.ndarray:
    """Vectors from their bytes."""
    return np.frombuffer(b"".join(values), dtype=np.float64).reshape(-1, width)


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest scores of each row (all ties at the edge aside)."""
    if scores.shape[1] <= k:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def _top_ties(scores: np.ndarray, least: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the k best scores of each row that reach its floor;
    of equal scores those with the smallest ``least``."""
    if scores.shape[1] > k:
        at = scores.shape[1] - k
        floor = np.maximum(floor, np.partition(scores, at, axis=1)[:, at])
    row, column = np.nonzero(scores >= floor[:, None])
    order = np.lexsort((least[column], -scores[row, column], row))
    row, column = row[order], column[order]
    held = np.bincount(row, minlength=len(scores))
    place = np.arange(len(row)) - np.repeat(np.cumsum(held) - held, held)
    return row[place < k], column[place < k]


# --- the steps ------------------------------------------------------------------

def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec: array<double>) of the rows that take part."""
    vec = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))  # no negative zero
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = (vectors.where("vec_id is not null and embedding is not null").select("vec_id", vec.alias("vec"))
            .where(F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda x: x != 0)))
    width = rows.groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), "w").first()
    return rows.where(F.size("vec") == (width["w"] if width else 0))


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors: (cid, v: bytes, norm2, least, ids), ids the ``keep`` smallest.

    The rank limit is applied before the shuffle too, so a hot vector sends
    at most ``keep`` rows per task.
    """
    ranked = rows.withColumn("_rank", F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id")))
    grouped = (ranked.where(F.col("_rank") <= keep).groupBy("vec")
               .agg(F.array_sort(F.collect_set("vec_id")).alias("ids")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch["vec"]
            flat = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) if len(batch) else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in flat], pa.binary()), pa.array((flat ** 2).sum(1)), batch["ids"]],
                ["v", "norm2", "ids"])

    packed = grouped.mapInArrow(pack, "v binary, norm2 double, ids array<long>")
    return tables.materialize(packed.withColumn("cid", F.monotonically_increasing_id())
                              .withColumn("least", F.element_at("ids", 1)), "vectors")


def _assign(rows: DataFrame, tree: Tree, norm: float, width: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(tree)  # at most SAMPLE / LEAF_SAMPLE leaves

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.assign(leaf=descend(shared.value, _augment(_matrix(b["v"], width), norm)))

    return tables.materialize(rows.select("cid", "v", "least").mapInPandas(
        place, "cid long, v binary, least long, leaf long"), "leaves")


def _truth(index: DataFrame, q: np.ndarray, own: np.ndarray, k: int) -> pd.DataFrame:
    """True neighbours of a bounded number of queries, from every row."""
    width = q.shape[1]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            scores = q @ _matrix(b["v"], width).T
            scores[own[:, None] == b["cid"].to_numpy()[None, :]] = -np.inf
            top = _top(scores, k)
            at = np.arange(len(q))[:, None]
            yield pd.DataFrame({"q": np.repeat(np.arange(len(q)), top.shape[1]),
                                "leaf": b["leaf"].to_numpy()[top].ravel(), "score": scores[at, top].ravel()})

    best = Window.partitionBy("q").orderBy(F.desc("score"))
    return (index.mapInPandas(scan, "q long, leaf long, score double")
            .withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k).toPandas())


def calibrate(tree: Tree, index: DataFrame, asked: pd.DataFrame, norm: float, width: int, k: int,
              recall: float = RECALL) -> int:
    """The least number of visits, widened step by step, that reaches ``recall``."""
    leaves = int(tree[2].max()) + 1
    if not len(asked):
        return leaves
    q = _matrix(asked["v"], width)
    truth = _truth(index, q, asked["cid"].to_numpy(), k)
    truth = truth[np.isfinite(truth["score"])]
    order = best_bins(tree, _as_query(q, norm), leaves)
    place = np.zeros((len(q), leaves), dtype=np.int64)
    for row, found in enumerate(order):
        place[row, found] = np.arange(len(found))
    when = place[truth["q"], truth["leaf"]]
    visits = 1
    while visits < leaves and len(when) and (when < visits).mean() < recall:
        visits = min(leaves, max(visits + 1, visits * 9 // 8))
    return visits


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, recall: float = RECALL) -> DataFrame:
    """The k nearest rows of ``vectors`` for each row of ``queries`` (both with
    ``vec_id, embedding``), other than the query's own: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    known = classes(rows, k + 1)
    stats = known.agg(F.count("*").alias("n"), F.max("norm2").alias("norm2"),
                      F.max(F.octet_length("v")).alias("bytes")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not stats["n"]:
        return empty
    n, norm, width = stats["n"], float(np.sqrt(stats["norm2"])), stats["bytes"] // 8

    share = -(-n // SAMPLE)
    drawn = known.where(F.pmod(F.xxhash64("v"), F.lit(share)) == 0).select("v").limit(2 * SAMPLE).toPandas()
    if not len(drawn):
        drawn = known.select("v").limit(1).toPandas()
    sample = _augment(_matrix(drawn["v"], width), norm)
    tree = train(sample, max(LEAF_SAMPLE, LEAF_ROWS * len(sample) // n))
    index = _assign(known, tree, norm, width)

    # Queries by class: each distinct vector is searched once.
    wanted = usable(queries).dropDuplicates()
    by_vector = known.select("cid", "v")
    asked_rows = _with_bytes(wanted, width).join(by_vector, "v").select("vec_id", "cid", "v")
    asked_rows = tables.materialize(asked_rows, "queries")
    asked = asked_rows.select("cid", "v").dropDuplicates(["cid"])
    tested = asked.orderBy(F.xxhash64("cid"), "cid").limit(CALIBRATION).toPandas()
    visits = calibrate(tree, index, tested, norm, width, k, recall)

    counted = index.groupBy("leaf").count().toPandas()  # one row per leaf
    held = np.zeros(int(tree[2].max()) + 1, dtype=np.int64)
    held[counted["leaf"]] = counted["count"]
    # At most 2 * SAMPLE vectors, with the leaf of each.
    shared = spark.sparkContext.broadcast((tree, sample[:, :width], descend(tree, sample), held))

    def floor(q: np.ndarray, found: list[list[int]]) -> np.ndarray:
        """A score that each query's last wanted class reaches: the sample holds
        that many classes, in the visited leaves, that do."""
        _, vectors, leaf, _ = shared.value
        if len(vectors) <= k:
            return np.full(len(q), -np.inf)
        visited = np.zeros((len(q), int(leaf.max()) + 1), dtype=bool)
        for row, leaves in enumerate(found):
            visited[row, [n for n in leaves if n < visited.shape[1]]] = True
        scores = np.where(visited[:, leaf], q @ vectors.T, -np.inf)
        least = np.partition(scores, len(vectors) - k - 1, axis=1)[:, len(vectors) - k - 1]
        # The same sum may round otherwise elsewhere.
        return np.where(np.isfinite(least), least - 1e-9 * (1 + np.abs(least)), -np.inf)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at:at + 256]
                q = _matrix(part["v"], width)
                found = best_bins(shared.value[0], _as_query(q, norm), visits, shared.value[3], k + 1)
                sizes = [len(f) for f in found]
                yield pd.DataFrame({"cid": np.repeat(part["cid"].to_numpy(), sizes),
                                    "v": np.repeat(part["v"].to_numpy(), sizes),
                                    "floor": np.repeat(floor(q, found), sizes), "leaf": np.concatenate(found)})

    probes = asked.mapInPandas(walk, "cid long, v binary, floor double, leaf long")
    sizes = (index.groupBy("leaf").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
             .join(probes.select("leaf").groupBy("leaf").agg(F.ceil(F.count("*") / QUERY_CHUNK).alias("parts")), "leaf"))
    sizes = F.broadcast(sizes)  # one row per leaf
    left = (index.join(sizes, "leaf").withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("leaf", "chunk", "part", "cid", "v", "least"))
    right = (probes.join(sizes, "leaf").withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("leaf", "chunk", "part", F.col("cid").alias("qid"), F.col("v").alias("qv"), "floor"))

    def compare(members: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(members) and len(visitors):
            m = _matrix(members["v"], width)
            cid, least = members["cid"].to_numpy(), members["least"].to_numpy()
            for at in range(0, len(visitors), 256):
                part = visitors.iloc[at:at + 256]
                scores = _matrix(part["qv"], width) @ m.T
                row, mine = _top_ties(scores, least, part["floor"].to_numpy(), k + 1)
                out.append(pd.DataFrame({"qid": part["qid"].to_numpy()[row], "cid": cid[mine],
                                         "least": least[mine], "score": scores[row, mine]}))
        return pd.concat(out) if out else pd.DataFrame({"qid": [], "cid": [], "least": [], "score": []})

    key = ["leaf", "chunk", "part"]
    scored = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        compare, "qid long, cid long, least long, score double")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "least")
    near = scored.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k + 1)
    # Ids of the nearest classes; one more than asked for, as the query's own is among them.
    by_id = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    listed = (near.join(known.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("vec_id"))
              .withColumn("_rank", F.row_number().over(by_id)).where(F.col("_rank") <= k + 1)
              .groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("_rank", "vec_id", "score"))).alias("found")))
    own = F.col("query_id")
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != own), 1, k)
    return (asked_rows.select(F.col("vec_id").alias("query_id"), F.col("cid").alias("qid")).join(listed, "qid")
            .select("query_id", F.posexplode(others).alias("_at", "_hit"))
            .select("query_id", (F.col("_at") + 1).alias("rank"), "_hit.vec_id", "_hit.score"))


def _with_bytes(rows: DataFrame, width: int) -> DataFrame:
    """Rows with the vector as bytes instead of an array."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["vec"].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array([r.tobytes() for r in flat], pa.binary())], ["vec_id", "v"])

    return rows.where(F.size("vec") == width).select("vec_id", "vec").mapInArrow(pack, "vec_id long, v binary")
