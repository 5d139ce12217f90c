"""Nearest neighbours by largest inner product: probed lists, scanned by adaptive numbers of dimensions.

A vector gets one more component, sqrt(M^2 - |x|^2) with M the largest norm, a query a zero: largest inner product is
then smallest distance. Lists are the cells of k-means over a bounded sample; every vector is in the list of its
nearest centre. Within a list vectors are rotated at random, so that the first components of a difference are a fair
sample of it, and lie in blocks of columns. A query scans block by block: a candidate goes as soon as its partial
distance, scaled up, is significantly beyond the k-th best that the query has in the sample. What remains is scored exactly in double
precision on the original vectors. Long lists and many queries of a list are cut by hash into bounded tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import Scratch

#: Vectors of the sample (about as many, if the table has more), rows of a list on average, lists at most.
SAMPLE, LIST_ROWS, MAX_LISTS = 20_000, 1000, 4096
#: Share of a sample query's neighbours within the sample that the probed lists hold, and the queries it is measured on.
COVERAGE, TRIALS = 0.96, 200
#: Vectors and queries of one task.
CHUNK, QUERIES = 8192, 2048
BLOCK = 16
#: Standard deviations beyond which the test abandons a candidate.
SIGNIFICANCE = 2.1
ROUNDS = 10


def usable(vec):
    """Whether a vector takes part: present, not zero, all components present and finite."""
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vec) > 0) & ~odd & F.exists(vec, lambda x: x != 0), F.lit(False))


def rotation(n: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))
    return q * np.sign(np.diag(r))


def extended(x: np.ndarray, largest: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(largest - (x * x).sum(axis=1), 0))])


def centres(sample: np.ndarray, n: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Lloyd's k-means from random members; a centre without members stays where it is."""
    rng = np.random.default_rng(seed)
    found = sample[rng.choice(len(sample), min(n, len(sample)), replace=False)]
    for _ in range(rounds):
        own = nearest(sample, found, 1)[:, 0]
        sums = np.zeros_like(found)
        np.add.at(sums, own, sample)
        counts = np.bincount(own, minlength=len(found))
        found = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], found)
    return found


def nearest(x: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of each row, nearest first."""
    far = (found * found).sum(axis=1)[None, :] - 2 * x @ found.T
    if n == 1:
        return far.argmin(axis=1)[:, None]
    return np.argsort(far, axis=1, kind="stable")[:, :n]


def probes_needed(sample: np.ndarray, found: np.ndarray, k: int, coverage: float = COVERAGE, trials: int = TRIALS) -> int:
    """Nearest lists to probe so that they hold ``coverage`` of the true neighbours of sample members in the sample.

    Neighbours within the sample are farther off than those in the whole table, so the share there is no smaller.
    """
    own = nearest(sample, found, 1)[:, 0]
    tried = sample[:: max(1, len(sample) // trials)].copy()
    tried[:, -1] = 0
    turns = []
    for query in tried:
        near = np.argsort(-(sample @ query), kind="stable")[: k + 1]
        place = np.argsort(nearest(query[None, :], found, len(found))[0])
        turns.append(place[own[near]])
    return int(np.quantile(np.concatenate(turns), coverage, method="higher")) + 1


def scan(query: np.ndarray, columns: np.ndarray, k: int, skip: np.ndarray | None = None, limit: float = math.inf) -> np.ndarray:
    """Rows of ``columns`` (dimensions x candidates, rotated) that may be among the ``k`` nearest of a rotated query.

    ``limit`` is a squared distance that the k-th nearest is known not to exceed.
    """
    size, n = columns.shape
    alive = np.arange(n) if skip is None else np.flatnonzero(~skip)
    sure = np.empty(0, int)
    if limit == math.inf:
        if len(alive) <= max(4 * k, 64):
            return alive
        first = alive[:: max(1, len(alive) // (4 * k))]
        far = ((columns[:, first] - query[:, None]) ** 2).sum(axis=0)
        limit = np.partition(far, k - 1)[k - 1]
        sure = first[far <= limit]
    worst = limit * (1 + 1e-9) + 1e-12
    partial = np.zeros(len(alive))
    for a in range(0, size, BLOCK):
        b = min(a + BLOCK, size)
        part = columns[a:b, alive] if len(alive) < n else columns[a:b]
        partial = partial + ((part - query[a:b, None]) ** 2).sum(axis=0)
        bound = worst if b == size else worst * (b / size) * (1 + SIGNIFICANCE / math.sqrt(b)) ** 2
        keep = partial <= bound
        alive, partial = alive[keep], partial[keep]
    return np.union1d(alive, sure) if len(sure) else alive


def seeds(ids: np.ndarray, queries: np.ndarray, known_ids: np.ndarray, known: np.ndarray, open_to: np.ndarray, k: int):
    """Of each query the ``k`` sample members of largest inner product, and the smallest of these.

    ``open_to`` (queries x sample) tells which members are in lists that the query probes; its own id is none. With
    fewer than ``k`` members there is no floor.
    """
    places, scores, floor = [], [], np.full(len(ids), -math.inf)
    for i, (q_id, query) in enumerate(zip(ids, queries)):
        mine = np.flatnonzero(open_to[i] & (known_ids != q_id))
        score = known[mine] @ query
        if len(mine) > k:
            top = np.argpartition(-score, k - 1)[:k]
            mine, score = mine[top], score[top]
        if len(mine) == k:
            floor[i] = score.min() - 1e-9 * (1 + abs(score.min()))
        places.append(known_ids[mine])
        scores.append(score)
    return places, scores, floor


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _search(left: pa.Table, right: pa.Table, k: int, largest: float, turn: np.ndarray) -> pa.Table:
    q_ids, ids = left.column("query_id").to_numpy(), right.column("vec_id").to_numpy()
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not len(q_ids) or not len(ids):
        return schema.empty_table()
    queries = _matrix(left.column("vec").combine_chunks())
    vectors = _matrix(right.column("vec").combine_chunks())
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    columns = np.ascontiguousarray((extended(vectors, largest) @ turn).T)
    turned = np.column_stack([queries, np.zeros(len(queries))]) @ turn
    floors = left.column("floor").to_numpy()
    limits = np.where(floors > -math.inf, (queries * queries).sum(axis=1) + largest - 2 * floors, math.inf)
    out = []
    for q_id, query, t, floor, limit in zip(q_ids, queries, turned, floors, limits):
        near = scan(t, columns, k, ids == q_id, limit)
        scores = vectors[near] @ query
        near, scores = near[scores >= floor], scores[scores >= floor]
        best = np.lexsort((ids[near], -scores))[:k]
        out.append((np.full(len(best), q_id), ids[near][best], scores[best]))
    return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)


def neighbours(
    embeddings: DataFrame, is_query, vec_id: str = "vec_id", vec: str = "embedding", k: int = 20, list_rows: int = LIST_ROWS, probes: int | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): of every row for which ``is_query`` the ``k`` rows of largest inner product found.

    Equal scores go to the smaller id; a query's own id is no candidate. Vectors that are null, zero, or hold a null or
    non-finite component take no part, nor do those of another length than most, or rows without an id. Rows that repeat
    an id are one row, with the largest of their scores. ``is_query`` is a column over ``embeddings``. Queries probe the
    ``probes`` nearest lists, by default :func:`probes_needed`, and more while those hold fewer than 10 k rows.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "neighbours")
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    shapes = rows.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n"), F.max(square).alias("largest")).orderBy(F.desc("n"), "size").limit(1).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not shapes:
        return spark.createDataFrame([], empty)
    size, n, largest = shapes[0]["size"], shapes[0]["n"], shapes[0]["largest"]
    rows = rows.where(F.size("vec") == size)
    # by hash alone, so that every part of the table is in it; repeated rows of an id are one member
    drawn = rows.withColumn("h", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40))).where(F.col("h") < math.ceil(min(1.0, SAMPLE / n) * (1 << 40)))
    drawn = sorted(drawn.groupBy("h", "vec_id").agg(F.max("vec").alias("vec")).collect(), key=lambda r: (r["h"], r["vec_id"]))
    sample_ids, plain = np.array([r["vec_id"] for r in drawn], dtype=np.int64), np.array([r["vec"] for r in drawn], dtype=float).reshape(-1, size)
    sample = extended(plain, largest)
    lists = max(1, min(MAX_LISTS, math.ceil(n / list_rows), len(sample)))
    found, turn = centres(sample, lists) if len(sample) else np.zeros((1, size + 1)), rotation(size + 1)

    sample_list = nearest(sample, found, 1)[:, 0] if len(sample) else np.empty(0, int)
    probes = probes or (probes_needed(sample, found, k) if len(sample) else 1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = nearest(extended(_matrix(batch.column("vec")), largest), found, 1)[:, 0]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=[*batch.schema.names, "list"])

    listed = scratch.keep(rows.mapInArrow(assign, "vec_id long, vec array<double>, q boolean, list int"))
    counts = dict.fromkeys(range(len(found)), 0) | {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}
    sizes = np.array([counts[i] for i in range(len(found))])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("vec"))
                order = nearest(np.column_stack([x, np.zeros(len(x))]), found, len(found))
                enough = (np.cumsum(sizes[order], axis=1) < 10 * k).sum(axis=1) + 1
                taken = [o[: max(probes, e)] for o, e in zip(order, enough)]
                taken = [t[sizes[t] > 0] for t in taken]
                probed = np.zeros((len(x), len(found)), bool)
                for row, t in zip(probed, taken):
                    row[t] = True
                near, scores, least = seeds(batch.column("query_id").to_numpy(), x, sample_ids, plain, probed[:, sample_list], k)
                lists_of = (pa.array([t.tolist() for t in taken], pa.list_(pa.int32())), pa.array(near, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays([*batch.columns, *lists_of, pa.array(least)], names=["query_id", "vec", "lists", "near", "scores", "floor"])

    queries = listed.where("q").select(F.col("vec_id").alias("query_id"), "vec").mapInArrow(probe, "query_id long, vec array<double>, lists array<int>, near array<long>, scores array<double>, floor double")
    queries = scratch.keep(queries)
    asked = {r["list"]: r["count"] for r in queries.select(F.explode("lists").alias("list")).groupBy("list").count().collect()}
    if not asked:
        return spark.createDataFrame([], empty)
    shape = [(i, max(1, -(-counts[i] // CHUNK)), max(1, -(-m // QUERIES))) for i, m in asked.items()]

    def shaped(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(spark.createDataFrame(shape, "list int, chunks int, blocks int")), "list")  # a row per list

    left = queries.select("query_id", "vec", "floor", F.explode("lists").alias("list"))
    left = shaped(left)
    left = left.withColumn("block", F.expr("cast(pmod(xxhash64(query_id), blocks) as int)")).withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
    right = shaped(listed.select("vec_id", "vec", "list"))
    right = right.withColumn("chunk", F.expr("cast(pmod(xxhash64(vec_id), chunks) as int)")).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    task = ["list", "chunk", "block"]
    near = left.groupBy(*task).cogroup(right.groupBy(*task)).applyInArrow(
        lambda a, b: _search(a, b, k, largest, turn), "query_id long, vec_id long, score double"
    )
    known = queries.select("query_id", F.explode(F.arrays_zip("near", "scores")).alias("s")).select("query_id", "s.near", "s.scores")
    best = near.union(known).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
