"""Nearest neighbours by inner product in learned partitions.

A bounded sample of the vectors (by hash of id; ``SAMPLE``, and a quarter at most) gives a graph that joins each to its ``EDGES`` nearest.
The graph is cut into parts of equal size: halves along main axes first, then moves of nodes to the part of most of
their neighbours, within the parts' capacity.  A small network (one hidden layer, softmax) learns from a vector the shares of the
parts among its neighbours.  Every row of the table is indexed in the part of largest share that the network gives it.  A query
is routed to its most probable parts until their shares add up to a mass; the mass is calibrated on sampled vectors that the
network has not seen, so that ``RECALL`` of their sampled neighbours lie in the parts looked at.  There is no cap on
parts.  Parts of more than ``SPLIT`` times the wished size are cut again in the same way, each by a sample and a network of its own,
fitted in tasks; shares of the two levels multiply.

A query is compared with the sample first.  The sample's rows are found rows like any others, and the score of the last of
its nearest there is a lower bound: parts only tell of rows that reach it.

Routed queries meet the rows of their parts in blocks of bounded size on both sides, whatever the size of a part, and each
pair of blocks is reranked by matrix products.  What could be among the nearest is scored again in double precision,
component by component in order, so that equal vectors have equal scores wherever they are computed.

What is collected or broadcast is bounded: the sample, at most ``PARTS`` parts' counts and ``PARTS + 1`` networks.

Defined results: vectors that are null, zero, hold null or non-finite components, have no id, or are not of the most
frequent length take no part.  Rows with the same id count as one, whose nearness is that of its best row, and are never their own
neighbours; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

NEAREST = 20
#: Vectors that a level is fitted on, and of these one in CHECKED for calibration alone.
SAMPLE = 12_288
CHECKED = 8
EDGES = 16
HIDDEN = 128
#: Wished rows of a part, most parts of a level, and how many times the wished rows a part has before it is cut again.
WISHED = 1_024
PARTS = 64
SPLIT = 8
#: Share of sampled neighbours that must lie in the parts looked at.
RECALL = 0.94
#: Sides of a pair of blocks.
ROWS = 4_096
QUERIES = 1_024

_FOUND = "query_id long, vec_id long, score double"


# ---- fitting, in numpy --------------------------------------------------------------------------------


def nearest_in(sample: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k largest inner products of each row with the others."""
    k = min(k, len(sample) - 1)
    out = np.zeros((len(sample), max(k, 0)), np.int64)
    for at in range(0, len(sample), 1024):
        scores = sample[at : at + 1024] @ sample.T
        scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
        if k > 0:
            out[at : at + 1024] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(sample: np.ndarray, edges: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Part of each row: ``parts`` (a power of two) of nearly equal size that cut few edges."""
    part = np.zeros(len(sample), np.int64)
    for _ in range(parts.bit_length() - 1):
        side = np.zeros(len(sample), np.int64)
        for p in np.unique(part):
            here = np.flatnonzero(part == p)
            centred = sample[here] - sample[here].mean(axis=0)
            axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            order = np.argsort(centred @ axis, kind="stable")
            side[here[order[len(here) // 2 :]]] = 1
        part = 2 * part + side
    capacity = -(-len(sample) * 21 // (20 * parts))
    source = np.repeat(np.arange(len(sample)), edges.shape[1])
    target = edges.ravel()
    for _ in range(rounds):
        tally = np.zeros((len(sample), parts), np.int32)
        np.add.at(tally, (source, part[target]), 1)
        np.add.at(tally, (target, part[source]), 1)
        best = tally.argmax(axis=1)
        gain = tally[np.arange(len(sample)), best] - tally[np.arange(len(sample)), part]
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < capacity:
                sizes[part[i]] -= 1
                sizes[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


def shares(model: dict, vectors: np.ndarray) -> np.ndarray:
    """Predicted shares of the parts among each vector's neighbours."""
    hidden = np.maximum(vectors / model["scale"] @ model["w1"] + model["b1"], 0)
    out = hidden @ model["w2"] + model["b2"]
    out = np.exp(out - out.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def _train(vectors: np.ndarray, wanted: np.ndarray, rng: np.random.Generator, epochs: int = 12, rate: float = 2e-3) -> dict:
    """One hidden layer by Adam on the cross entropy to ``wanted`` shares."""
    d, parts = vectors.shape[1], wanted.shape[1]
    scale = np.sqrt((vectors**2).mean()) or 1.0
    x = vectors / scale
    w = {
        "w1": rng.normal(0, (2 / d) ** 0.5, (d, HIDDEN)),
        "b1": np.zeros(HIDDEN),
        "w2": rng.normal(0, HIDDEN**-0.5, (HIDDEN, parts)),
        "b2": np.zeros(parts),
    }
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            some = order[at : at + 256]
            hidden = np.maximum(x[some] @ w["w1"] + w["b1"], 0)
            out = hidden @ w["w2"] + w["b2"]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            off = (out / out.sum(axis=1, keepdims=True) - wanted[some]) / len(some)
            back = (off @ w["w2"].T) * (hidden > 0)
            slopes = {"w2": hidden.T @ off, "b2": off.sum(axis=0), "w1": x[some].T @ back, "b1": back.sum(axis=0)}
            step += 1
            for k, g in slopes.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return {**w, "scale": scale}


def fit(sample: np.ndarray, parts: int) -> dict:
    """Network and routing mass of one level."""
    rng = np.random.default_rng(7)
    edges = nearest_in(sample, EDGES)
    part = balanced_parts(sample, edges, parts)
    wanted = np.zeros((len(sample), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(sample)), edges.shape[1]), part[edges.ravel()]), 1)
    # a vector's own part counts as one neighbour more
    wanted[np.arange(len(sample)), part] += 1
    wanted /= wanted.sum(axis=1, keepdims=True)
    checked = np.arange(len(sample)) % CHECKED == CHECKED - 1
    if not checked.any():
        return {**_train(sample, wanted, rng), "mass": 1.0}
    model = _train(sample[~checked], wanted[~checked], rng)
    # neighbours lie where the network puts them, as rows of the table will
    placed = shares(model, sample).argmax(axis=1)
    order, reached = visits(shares(model, sample[checked]))
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(parts)[None, :].repeat(len(order), 0), axis=1)
    needed = np.take_along_axis(rank, placed[edges[checked]], axis=1)
    before = np.take_along_axis(reached, needed, axis=1)  # mass of the parts ahead of the one needed
    return {**model, "mass": float(np.quantile(before, RECALL))}


def visits(share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts by falling share, and for each the mass of those ahead of it."""
    order = np.argsort(-share, axis=1, kind="stable")
    sorted_ = np.take_along_axis(share, order, axis=1)
    return order, np.cumsum(sorted_, axis=1) - sorted_


def two_levels(networks: dict, vectors: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Shares of all leaves, and the leaves as (part, part within it or -1)."""
    top = shares(networks[None], vectors)
    columns, leaves = [], []
    for p in range(top.shape[1]):
        if p in networks:
            inner = shares(networks[p], vectors)
            columns.append(top[:, p : p + 1] * inner)
            leaves += [(p, k) for k in range(inner.shape[1])]
        else:
            columns.append(top[:, p : p + 1])
            leaves.append((p, -1))
    return np.concatenate(columns, axis=1), leaves


# ---- index and search ---------------------------------------------------------------------------------


def power_of_two(n: float, most: int) -> int:
    return min(most, 1 << max(0, int(np.ceil(np.log2(max(1.0, n))))))


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of the rows that take part; v is an array of double."""
    v = F.col("embedding").cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & sound)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1)
    return rows.join(F.broadcast(sizes), F.size("v") == F.col("d")).select("vec_id", "v")


def _matrix(values: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(values, pd.Series):
        return np.stack(values.to_numpy()).astype(np.float64)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def sampled(rows: DataFrame, share) -> DataFrame:
    """The rows whose hash of id, from 0 to 1, lies below a share; with the hash as ``h``."""
    return rows.withColumn("h", F.xxhash64("vec_id") / F.lit(2.0**64) + 0.5).filter(F.col("h") < share)


def _fit_parts(rows: DataFrame, counts: dict[int, int], wished: int) -> dict[int, dict]:
    """Networks of the parts that are cut again: each is fitted by a task on a bounded sample of its rows."""
    sizes = F.create_map(*[F.lit(x) for p, n in counts.items() for x in (p, n)])
    picked = sampled(rows.filter(F.col("part").isin(list(counts))), F.lit(float(SAMPLE)) / F.element_at(sizes, F.col("part")))

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        group = group.sort_values(["h", "vec_id"]).head(SAMPLE)
        model = fit(_matrix(group["v"]), power_of_two(counts[part] / wished, PARTS))
        return pd.DataFrame({"part": [part], "model": [pickle.dumps(model)]})

    found = picked.groupBy("part").applyInPandas(fitted, "part int, model binary").collect()
    return {r["part"]: pickle.loads(r["model"]) for r in found}


def learn(rows: DataFrame, wished: int = WISHED, parts: int = PARTS) -> tuple[dict, pd.DataFrame]:
    """Networks by part, that of the first level under None, and the sample; ``rows`` as of ``usable``, written."""
    n = rows.count()
    most = min(SAMPLE, -(-n // 4))
    picked = sampled(rows, F.lit(most / max(1, n))).orderBy("h", "vec_id", "v").limit(most).toPandas()
    if not len(picked):
        picked = rows.limit(1).toPandas()
    if not n:
        return {}, picked
    networks = {None: fit(_matrix(picked["v"]), power_of_two(min(n / wished, len(picked) / (2 * EDGES)), parts))}
    if n > parts * wished:
        placed = stage(index(rows, networks), "ann-first")
        counts = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}
        large = {p: c for p, c in counts.items() if c > SPLIT * wished}
        if large:
            networks |= _fit_parts(placed, large, wished)
    return networks, picked[["vec_id", "v"]]


def index(rows: DataFrame, networks: dict) -> DataFrame:
    """``vec_id, v, part, sub``: every row in its most probable leaf."""
    held = rows.sparkSession.sparkContext.broadcast(pickle.dumps(networks))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(held.value)
        for batch in batches:
            if not len(batch):
                continue
            share, leaves = two_levels(known, _matrix(batch.column("v")))
            best = np.array(leaves, np.int32)[share.argmax(axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(best[:, 0]), pa.array(best[:, 1])], ["vec_id", "v", "part", "sub"])

    return rows.mapInArrow(place, "vec_id long, v array<double>, part int, sub int")


def route(rows: DataFrame, networks: dict) -> DataFrame:
    """``query_id, q, bound, part, sub``: every query (vec_id, v, bound) with each of the leaves it looks at."""
    held = rows.sparkSession.sparkContext.broadcast(pickle.dumps(networks))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(held.value)
        mass = max(m["mass"] for m in known.values())
        for batch in batches:
            for at in range(0, len(batch), 1024):
                some = batch.slice(at, 1024)
                share, leaves = two_levels(known, _matrix(some.column("v")))
                order, ahead = visits(share)
                row, place = np.nonzero(ahead <= mass)
                leaf = np.array(leaves, np.int32)[order[row, place]]
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(c).take(pa.array(row)) for c in ("vec_id", "v", "bound")], pa.array(leaf[:, 0]), pa.array(leaf[:, 1])], ["query_id", "q", "bound", "part", "sub"]
                )

    return rows.mapInArrow(send, "query_id long, q array<double>, bound double, part int, sub int")


def near_sample(queries: DataFrame, sample: pd.DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the k nearest of the sample to each query."""
    held = queries.sparkSession.sparkContext.broadcast(sample)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), QUERIES):
                yield rerank(held.value, batch.iloc[at : at + QUERIES].rename(columns={"vec_id": "query_id", "v": "q"}), k)

    return queries.mapInPandas(search, _FOUND)


def rerank(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of a block, by distinct id, of each query of a block."""
    x, q = _matrix(rows["v"]), _matrix(queries["q"])
    order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")
    x, ids, asked = x[order], rows["vec_id"].to_numpy()[order], queries["query_id"].to_numpy()
    scores = q @ x.T
    scores[asked[:, None] == ids[None, :]] = -np.inf
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    best = np.maximum.reduceat(scores, first, axis=1)
    near = np.sort(best, axis=1)[:, -min(k, best.shape[1])]
    if "bound" in queries:
        near = np.maximum(near, queries["bound"].to_numpy())
    slack = 1e-12 * x.shape[1] * np.abs(q).max(axis=1) * np.abs(x).max()
    row, column = np.nonzero((scores >= (near - slack)[:, None]) & (scores > -np.inf))
    exact = np.zeros(len(row))
    for d in range(x.shape[1]):
        exact += q[row, d] * x[column, d]
    found = pd.DataFrame({"query_id": asked[row], "vec_id": ids[column], "score": exact})
    found = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).drop_duplicates(["query_id", "vec_id"])
    return found.groupby("query_id").head(k)


def nearest(vectors: DataFrame, queries, k: int = NEAREST, wished: int = WISHED, parts: int = PARTS, rows_side: int = ROWS, queries_side: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every row for which the condition ``queries`` holds."""
    spark = vectors.sparkSession
    rows = stage(usable(vectors), "ann-rows")
    networks, sample = learn(rows, wished, parts)
    if not networks:
        return spark.range(0).select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    leaf = ["part", "sub"]
    placed = stage(index(rows, networks), "ann-index")
    asked = rows.filter(queries)
    close = stage(near_sample(asked, sample, k), "ann-sample")
    # a query id whose rows stood in several batches has more than k and goes without a bound
    bounds = close.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("known")).filter(F.col("known") == k)
    bounded = asked.join(bounds, F.col("vec_id") == F.col("query_id"), "left").select("vec_id", "v", F.coalesce("least", F.lit(float("-inf"))).alias("bound"))
    routed = stage(route(bounded, networks), "ann-queries")
    counts = placed.groupBy(*leaf).agg(F.count("*").alias("n"))
    heard = routed.groupBy(*leaf).agg(F.count("*").alias("m"))
    # at most PARTS * PARTS leaves, with their numbers of blocks
    sides = counts.join(heard, leaf).select(*leaf, F.ceil(F.col("n") / rows_side).alias("across"), F.ceil(F.col("m") / queries_side).alias("down"))
    sides = stage(sides, "ann-leaves")
    deal = lambda name, by, salt: F.pmod(F.xxhash64(name, F.lit(salt)), F.col(by))
    left = placed.join(F.broadcast(sides), leaf).select(
        *leaf, deal("vec_id", "across", 1).alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)).alias("q_block"), "vec_id", "v"
    )
    right = routed.join(F.broadcast(sides), leaf).select(
        *leaf, F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)).alias("block"), deal("query_id", "down", 2).alias("q_block"), "query_id", "q", "bound"
    )
    by = [*leaf, "block", "q_block"]

    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"query_id": pd.Series([], "int64"), "vec_id": pd.Series([], "int64"), "score": pd.Series([], "float64")})
        return rerank(rows, queries, k)

    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(search, _FOUND).unionByName(close)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
