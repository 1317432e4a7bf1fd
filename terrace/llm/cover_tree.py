"""Hard negatives by inner product over a cover tree.

1. Components become ``floor(256 * x)``; rows of one vector and one label are
   one class with its smallest ids.
2. Every candidate gets one more coordinate, ``sqrt(max_norm**2 - norm**2)``, so
   all lie on one sphere and a larger inner product is a smaller distance.
3. The tree is grown level by level.  A node with more than ``LEAF`` classes is
   split around a net: centres taken from its own members that lie further
   apart than the level's radius, which shrinks by ``BASE`` from level to level
   until the net has at least ``LEAST`` and at most ``FANOUT`` centres.  The
   members go to their nearest centre, and the covering radius of each child
   is measured over all of them.
4. A centre's distance and the covering radius bound the inner products within
   a node from above and below.  A first walk takes the ``BEAM`` best nodes of
   each level (best first) and verifies their leaves, which yields a score to
   beat; a second walk follows every node that can still hold a result.  Nodes
   whose bounds lie outside the window of wanted scores, or that hold no row
   of a wanted label, are skipped.
5. Leaves are verified exactly in whole numbers, in parts of bounded size.

The net of a split is drawn from at most ``SAMPLE`` members of the node; radii,
bounds and results never depend on what is drawn.

Odd input: rows with a null id, a null label, a null vector or a null or
non-finite component take no part, nor do vectors of another length than most
and those whose squared length in whole numbers is 2**59 or more; rows that
repeat wholly count once, and of rows with one id but other contents each takes
part; anchors without positives and positives without negatives give no rows;
an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm import tables

LEAF = 1024
FANOUT = 64
LEAST = 8
BASE = 1.3
SAMPLE = 4096
MAX_DEPTH = 9
BEAM = 16
PART = 4096
ASKING = 8192
# Whole numbers up to this are exact in doubles, so matrix products are too.
EXACT = 2 ** 53
ROUNDING = 1e-9
LARGEST = 2 ** 59

CLASS = "cid long, v binary, norm2 long, label long, ids array<long>"
ASK = "qid long, v binary, norm2 long, label long, bit int, same boolean, lows binary, highs binary"


# --- rows -----------------------------------------------------------------------

def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v: packed whole numbers, norm2) of the rows that take part."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * 256).cast("double"))
    rows = (vectors.where("vec_id is not null and label is not null and embedding is not null")
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                    "embedding")
            .where(F.coalesce(F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c)
                                       & (F.abs(c.cast("double")) < float(2 ** 31))), F.lit(False)))
            .select("vec_id", "label", x.alias("x")))
    width = rows.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), "w").first()
    width = width["w"] if width else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
            square = (flat ** 2).sum(1)
            fits = pa.array(square < float(LARGEST))
            whole = np.where(square[:, None] < LARGEST, flat, 0).astype("<i8")
            norm2 = (whole * whole).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], pa.array([r.tobytes() for r in whole], pa.binary()), pa.array(norm2)],
                ["vec_id", "label", "v", "norm2"]).filter(fits)

    return rows.where(F.size("x") == width).mapInArrow(pack, "vec_id long, label long, v binary, norm2 long")


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """Rows of one vector and label as one: its ``keep`` smallest ids.  The limit
    holds before the shuffle too, so a hot vector sends few rows."""
    ranked = rows.withColumn("_rank", F.dense_rank().over(Window.partitionBy("v", "label").orderBy("vec_id")))
    return (ranked.where(F.col("_rank") <= keep).groupBy("v", "norm2", "label")
            .agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
            .withColumn("cid", F.monotonically_increasing_id()).select("cid", "v", "norm2", "label", "ids"))


def _matrix(values, dtype=np.float64) -> np.ndarray:
    values = list(values)
    return np.frombuffer(b"".join(values), "<i8").reshape(len(values), -1).astype(dtype)


def _lifted(x: np.ndarray, norm2: float) -> np.ndarray:
    """Candidates with the coordinate that puts them on the sphere."""
    return np.hstack([x, np.sqrt(np.maximum(norm2 - (x ** 2).sum(1), 0))[:, None]])


def _distance(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (x ** 2).sum(1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(1)
    return np.sqrt(np.maximum(square, 0))


# --- the tree ---------------------------------------------------------------------

def net(x: np.ndarray) -> np.ndarray:
    """Row numbers of centres: members further apart than the largest radius of
    the ladder that gives at least ``LEAST`` of them, at most ``FANOUT``."""
    far = _distance(x, x[:1])[:, 0].max()
    chosen = np.zeros(1, int)
    radius = far
    while radius > 1e-6 * far and len(chosen) < min(LEAST, len(x)):
        radius /= BASE
        taken, near = [0], _distance(x, x[:1])[:, 0]
        while len(taken) < FANOUT:
            left = np.flatnonzero(near > radius)
            if not len(left):
                break
            taken.append(int(left[0]))
            near = np.minimum(near, _distance(x, x[left[:1]])[:, 0])
        chosen = np.array(taken)
    return chosen


def _bit():
    return F.pmod(F.xxhash64("label"), F.lit(64)).cast("int")


def grow(members: DataFrame, norm2: int, width: int) -> tuple[DataFrame, list[DataFrame]]:
    """The classes with their leaf (``node``), and per level its split nodes:
    (node, centres, kids), kids as (child, radius, mask, low, high)."""
    whole = float(norm2)
    stride = 8 * (width + 1)
    rows = members.withColumn("node", F.lit(0).cast("long"))
    leaves, levels, old = [], [], []

    def centres(sample: pa.Table) -> pa.Table:
        sample = sample.sort_by("_rank")
        x = _lifted(_matrix(sample["v"].to_pylist()), whole)
        held = x[net(x)]
        if len(held) < 2:  # all at one place
            return pa.table({"node": pa.array([], pa.int64()), "centres": pa.array([], pa.binary())})
        return pa.table({"node": sample["node"].slice(0, 1), "centres": pa.array([held.astype("<f8").tobytes()])})

    def deal(mine: pa.Table, split: pa.Table) -> pa.Table:
        x = _lifted(_matrix(mine["v"].to_pylist()), whole)
        far = _distance(x, np.frombuffer(split["centres"][0].as_py(), "<f8").reshape(-1, width + 1))
        child = far.argmin(1)
        node = split["node"][0].as_py()
        return mine.select(["cid", "v", "norm2", "label", "ids"]).append_column(
            "node", pa.array(node * FANOUT + 1 + child)).append_column(
            "parent", pa.array(np.full(len(x), node))).append_column("far", pa.array(far[np.arange(len(x)), child]))

    for _ in range(MAX_DEPTH):
        large = rows.groupBy("node").agg(F.count("*").alias("many")).where(F.col("many") > LEAF)
        drawn = (rows.join(large, "node").select("node", "v", "cid")
                 .withColumn("_rank", F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("cid"), "cid")))
                 .where(F.col("_rank") <= SAMPLE).select("node", "v", "_rank"))
        nets = tables.materialize(drawn.groupBy("node").applyInArrow(centres, "node long, centres binary")
                                  .join(large, "node"), "nets")
        if nets.isEmpty():
            break
        parts = nets.withColumn("parts", F.ceil(F.col("many") / PART))
        left = (rows.join(parts.select("node", "parts"), "node")
                .withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts"))))
        right = parts.select("node", "centres", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        moved = tables.materialize(left.groupBy("node", "part").cogroup(right.groupBy("node", "part")).applyInArrow(
            deal, f"{CLASS}, node long, parent long, far double"), "members")
        kids = (moved.groupBy("parent", "node").agg(
            F.max("far").alias("radius"), F.bit_or(F.expr("shiftleft(1L, pmod(xxhash64(label), 64))")).alias("mask"),
            F.min("label").alias("low"), F.max("label").alias("high"))
            .groupBy(F.col("parent").alias("node"))
            .agg(F.sort_array(F.collect_list(F.struct(F.col("node").alias("child"), "radius", "mask", "low", "high")))
                 .alias("kids")))
        # Only centres with members are children.
        place = F.transform("kids", lambda c: F.substring(
            F.col("centres"), ((c["child"] - F.col("node") * FANOUT - 1) * stride + 1).cast("int"), F.lit(stride)))
        levels.append(tables.materialize(nets.join(kids, "node").select("node", place.alias("centres"), "kids"), "level"))
        leaves.append(rows.join(nets.select("node"), "node", "left_anti").select(*CLASS_COLUMNS, "node"))
        rows = moved.select(*CLASS_COLUMNS, "node")
        old += [moved, nets]
    for part in leaves:
        rows = rows.unionByName(part)
    sizes = rows.groupBy("node").agg(F.ceil(F.count("*") / PART).alias("parts"))
    placed = tables.materialize(rows.join(sizes, "node").withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts"))),
                                "leaves")
    tables.discard(nets, *old)
    return placed, levels


# --- walks --------------------------------------------------------------------------

def _bounds(q: np.ndarray, centres: np.ndarray, radius: np.ndarray, norm2: float) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) inner product of each query with any row of each node."""
    inner = q @ centres[:, :-1].T
    square = (q ** 2).sum(1)[:, None] + norm2
    far = np.sqrt(np.maximum(square - 2 * inner, 0))
    # Within the ball around the centre, by distance and by direction.
    reach = np.sqrt(square - norm2) * radius
    largest = np.minimum((square - np.maximum(far - radius, 0) ** 2) / 2, inner + reach)
    least = np.maximum((square - (far + radius) ** 2) / 2, inner - reach)
    slack = ROUNDING * (square + 1)
    return least - slack, largest + slack


def walk(asking: DataFrame, levels: list[DataFrame], norm2: int, turns: int, beam: int | None = None) -> DataFrame:
    """The leaves (as ``node``) that hold what the windows of ``asking`` want;
    with ``beam`` only the so many best nodes of each level are followed."""
    whole = float(norm2)
    front = asking.withColumn("node", F.lit(0).cast("long")).withColumn("best", F.lit(0.0))

    def step(asked: pa.Table, split: pa.Table) -> pa.Table:
        names = [*ASK_COLUMNS, "node", "best"]
        if not len(asked) or not len(split):  # a leaf stays as it is
            return asked.select(names)
        kids = split["kids"][0].as_py()
        centres = np.frombuffer(b"".join(split["centres"][0].as_py()), "<f8").reshape(len(kids), -1)
        child, radius, mask, low, high = (np.array([k[name] for k in kids]) for name in ("child", "radius", "mask", "low", "high"))
        least, largest = _bounds(_matrix(asked["v"].to_pylist()), centres, radius, whole)
        label, bit, same = (asked[c].to_numpy()[:, None] for c in ("label", "bit", "same"))
        mine = ((mask[None, :] >> bit) & 1).astype(bool) & (low <= label) & (label <= high)
        good = np.where(same, mine, (low != label) | (high != label))
        held = np.zeros_like(good)
        for row, (lows, highs) in enumerate(zip(asked["lows"].to_pylist(), asked["highs"].to_pylist())):
            for a, b in zip(np.frombuffer(lows, "<i8"), np.frombuffer(highs, "<i8")):
                held[row] |= (largest[row] >= a) & (least[row] <= b)
        row, column = np.nonzero(good & held)
        # Nearest to the windows' upper end first, by the centre's score.
        top = np.array([max(np.frombuffer(b, "<i8"), default=0) for b in asked["highs"].to_pylist()], float)
        middle = (least[row, column] + largest[row, column]) / 2
        best = np.minimum(middle, 2 * top[row] - middle)
        return (asked.select(ASK_COLUMNS).take(pa.array(row)).append_column("node", pa.array(child[column]))
                .append_column("best", pa.array(best)))

    every = F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))
    for split in levels:
        front = front.withColumn("part", F.pmod(F.xxhash64("qid"), F.lit(turns)).cast("int"))
        front = (front.groupBy("node", "part").cogroup(split.withColumn("part", every).groupBy("node", "part"))
                 .applyInArrow(step, f"{ASK}, node long, best double"))
        if beam is not None:
            order = Window.partitionBy("qid").orderBy(F.desc("best"), "node")
            front = front.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= beam).drop("_rank")
    return front


def _padded(values: list[bytes], none: int) -> np.ndarray:
    """Packed lists of longs as rows of one length, filled up with ``none``."""
    rows = [np.frombuffer(v, "<i8") for v in values]
    out = np.full((len(rows), max(1, max(map(len, rows)))), none, np.int64)
    for place, row in enumerate(rows):
        out[place, :len(row)] = row
    return out


def verify(front: DataFrame, placed: DataFrame, turns: int, k: int) -> DataFrame:
    """(qid, window, cid, least, score): the ``k`` best classes of each window
    in the leaves of ``front``, exactly."""

    def compare(members: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if len(members) and len(asked):
            largest = max(members["norm2"].to_numpy().max(), asked["norm2"].to_numpy().max())
            kind = np.float64 if largest < EXACT else np.int64
            x = _matrix(members["v"].to_pylist(), kind)
            cid, label, least = (members[c].to_numpy() for c in ("cid", "label", "least"))
            by_id = np.argsort(least, kind="stable")
            x, cid, label, least = x[by_id], cid[by_id], label[by_id], least[by_id]
            for at in range(0, len(asked), 256):
                part = asked.slice(at, 256)
                scores = _matrix(part["v"].to_pylist(), kind) @ x.T
                qid, mine, same = (part[c].to_numpy() for c in ("qid", "label", "same"))
                lows, highs = (_padded(part[c].to_pylist(), none) for c, none in (("lows", LARGEST), ("highs", -LARGEST)))
                near = (scores >= lows.min(1)[:, None]) & (scores <= highs.max(1)[:, None])
                row, column = np.nonzero(near & ((label == mine[:, None]) == same[:, None]))
                score = scores[row, column].astype(np.int64)
                for window in range(lows.shape[1]):
                    inside = np.flatnonzero((score >= lows[row, window]) & (score <= highs[row, window]))
                    # Columns ascend by id, so equal scores stay in that order.
                    inside = inside[np.lexsort((column[inside], -score[inside], row[inside]))]
                    held = np.bincount(row[inside], minlength=len(part))
                    place = np.arange(len(inside)) - np.repeat(np.cumsum(held) - held, held)
                    inside = inside[place < k]
                    out.append((qid[row[inside]], np.full(len(inside), window), cid[column[inside]],
                                least[column[inside]], score[inside]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
        return pa.table(dict(zip(("qid", "window", "cid", "least", "score"), columns)))

    front = tables.materialize(front, "reached")  # read twice below
    turn = F.pmod(F.xxhash64("qid"), F.lit(turns)).alias("turn")
    places = placed.select(F.col("node"), F.col("part").alias("cut")).distinct()
    asked = front.join(places, "node").select(*ASK_COLUMNS, "node", "cut", turn)
    members = (placed.join(front.select("node", turn).distinct(), "node")
               .select("node", F.col("part").alias("cut"), "turn", "cid", "v", "norm2", "label", F.element_at("ids", 1).alias("least")))
    key = ["node", "cut", "turn"]
    found = members.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(
        compare, "qid long, window long, cid long, least long, score long")
    order = Window.partitionBy("qid", "window").orderBy(F.desc("score"), "least", "cid")
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)


def best(asking: DataFrame, placed: DataFrame, levels: list[DataFrame], norm2: int, k: int) -> DataFrame:
    """(qid, window, cid, least, score): the ``k`` best classes in each window
    (``lows`` to ``highs``) of each query, over the whole tree."""
    turns = max(1, -(-asking.count() // ASKING))
    if levels:
        # What a few leaves yield is a floor under the wanted scores.
        first = verify(walk(asking, levels, norm2, turns, BEAM), placed, turns, k)
        floor = (first.where(F.col("_rank") == k).groupBy("qid")
                 .agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("floor")))
        raised = asking.join(floor, "qid", "left")

        def raise_lows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lows = []
                for low, found in zip(batch["lows"].to_pylist(), batch["floor"].to_pylist()):
                    now = np.frombuffer(low, "<i8").copy()
                    for window, score in found or []:
                        now[window] = max(now[window], score)
                    lows.append(now.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lows, pa.binary()) if c == "lows" else batch[c] for c in ASK_COLUMNS], ASK_COLUMNS)

        asking = tables.materialize(raised.mapInArrow(raise_lows, ASK), "asking")
    return verify(walk(asking, levels, norm2, turns), placed, turns, k).drop("_rank")


# --- hard negatives -------------------------------------------------------------------

def _asking(rows: DataFrame, same: bool, lows, highs) -> DataFrame:
    """Queries of classes (qid, v, norm2, label) with windows as arrays of longs."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.array(w, "<i8").tobytes() for w in batch[c].to_pylist()], pa.binary())
                 if c in ("lows", "highs") else batch[c] for c in ASK_COLUMNS], ASK_COLUMNS)

    return rows.select("qid", "v", "norm2", "label", _bit().alias("bit"), F.lit(same).alias("same"),
                       lows.alias("lows"), highs.alias("highs")).mapInArrow(pack, ASK)


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10,
         low: int = 3, high: int = 9) -> DataFrame:
    """Hard negatives of ``anchors`` among ``vectors`` (both ``vec_id, embedding,
    label``): each anchor's first rows of its label, and for each of them the
    first rows of other labels whose score is from ``low`` to ``high`` tenths of it."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    known = tables.materialize(classes(rows, max(positives, negatives) + 1), "classes")
    stats = known.agg(F.max("norm2").alias("norm2"), F.max(F.octet_length("v")).alias("bytes")).first()
    if stats["norm2"] is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    norm2, width = stats["norm2"], stats["bytes"] // 8
    placed, levels = grow(known, norm2, width)

    # Anchors of one class search once.
    asked = tables.materialize(
        usable(anchors).select(F.col("vec_id").alias("anchor_id"), "v", "label").distinct()
        .join(known.select(F.col("cid").alias("qid"), "v", "norm2", "label"), ["v", "label"]), "anchors")
    by_class = asked.select("qid", "v", "norm2", "label").dropDuplicates(["qid"])
    every = F.array(F.lit(LARGEST))
    near = best(_asking(by_class, True, F.transform(every, lambda x: -x), every), placed, levels, norm2, positives + 1)
    ids = known.select("cid", "ids")
    first = Window.partitionBy("anchor_id", "qid").orderBy(F.desc("score"), "vec_id")
    chosen = tables.materialize(
        asked.select("anchor_id", "qid").join(near, "qid").join(ids, "cid")
        .select("anchor_id", "qid", "score", F.explode("ids").alias("vec_id")).where("vec_id != anchor_id")
        .withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= positives)
        .select("anchor_id", "qid", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives")

    windows = (chosen.where("positive_score >= 0").groupBy("qid")
               .agg(F.array_sort(F.collect_set("positive_score")).alias("goals")))
    windows = tables.materialize(windows, "windows")
    lows = F.expr(f"transform(goals, p -> (p * {low}L + 9L) div 10L)")
    highs = F.expr(f"transform(goals, p -> p * {high}L div 10L)")
    hard = best(_asking(by_class.join(windows, "qid"), False, lows, highs), placed, levels, norm2, negatives)
    goals = windows.select("qid", F.posexplode("goals").alias("window", "positive_score"))
    order = Window.partitionBy("qid", "window").orderBy(F.desc("negative_score"), "negative_id")
    listed = (hard.join(ids, "cid")
              .select("qid", "window", F.col("score").alias("negative_score"), F.explode("ids").alias("negative_id"))
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
              .withColumn("window", F.col("window").cast("int")).join(goals, ["qid", "window"]))
    return (chosen.join(listed, ["qid", "positive_score"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


CLASS_COLUMNS = ["cid", "v", "norm2", "label", "ids"]
ASK_COLUMNS = ["qid", "v", "norm2", "label", "bit", "same", "lows", "highs"]


def relabelled(vectors: DataFrame) -> DataFrame:
    """The query's rows: labels of every seventh id are moved on by one."""
    return vectors.withColumn("label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))


ORACLE = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM (SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score,
                            row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
                     FROM s WHERE label = anchor_label) WHERE place <= 5),
n AS (SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
       AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10
"""
