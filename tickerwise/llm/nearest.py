"""Approximate nearest neighbours by an adaptive dimension scan within probed lists.

Vectors are dealt to lists around centres fitted on a bounded sample; a query probes its nearest lists.  Inside a list
the randomly rotated vectors lie in column blocks.  The scan adds up a candidate's squared distance block by block; after t
of d dimensions the part seen, scaled by d / t, estimates the whole, and the candidate is abandoned when the estimate is so
far beyond the query's radius that, by a bound on random projections, the true distance is inside it only with
negligible probability (factor ``1 + EPSILON / sqrt(t)``).  Survivors get their exact distance on the original vectors.

A query's radius is its ``WIDE * k``-th nearest distance within the fitting sample: more than k rows surely lie within it, so
it is a true upper bound, and far lists send hardly any row.  A query that still finds fewer than k rows in its
lists looks into all of them.  Lists are cut into blocks of bounded size and queries into groups of bounded size, so neither a
very common vector nor a large query set meets in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerwise.llm.common import Workspace

SAMPLE = 8_192       # rows the centres and radii are fitted on, the smallest by a hash of the id
LISTS = 128          # most lists; fewer for small samples
PROBED = 0.6         # share of the lists a query looks into
WIDE = 4
BLOCK = 2_048        # vectors of a list scanned by one task
QUERIES = 4_096      # queries of one task
COLUMNS = 8          # dimensions in a column block
EPSILON = 2.1


def _fit(sample: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
    centres = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(12):
        near = np.argmin((centres ** 2).sum(1) - 2 * sample @ centres.T, axis=1)
        count = np.bincount(near, minlength=lists)
        total = np.zeros_like(centres)
        np.add.at(total, near, sample)
        some = count > 0
        centres[some] = total[some] / count[some, None]
    return centres


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _assign(centres: np.ndarray):
    def run(batches):
        for b in batches:
            if b.num_rows:
                v = _matrix(b.column(1))
                near = np.argmin((centres ** 2).sum(1) - 2 * v @ centres.T, axis=1)
                yield pa.record_batch([b.column(0), b.column(1), pa.array(near, pa.int32())], names=["vec_id", "v", "list"])
    return run


def _probe(centres: np.ndarray, probes: int, ids: np.ndarray, sample: np.ndarray, near: int):
    """Queries -> their nearest lists and a radius that surely holds ``near`` rows (infinite if the sample is too small)."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            q, own = _matrix(b.column(1)), b.column(0).to_numpy()
            far = (centres ** 2).sum(1) - 2 * q @ centres.T
            lists = np.argsort(far, axis=1, kind="stable")[:, :probes].astype(np.int32)
            radius = np.full(len(q), np.inf)
            for i in range(len(q)):
                d = ((sample - q[i]) ** 2).sum(1)[ids != own[i]]
                if len(d) >= near:
                    radius[i] = np.partition(d, near - 1)[near - 1]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(radius), pa.array(list(lists), pa.list_(pa.int32()))],
                                  names=["query_id", "q", "radius", "lists"])
    return run


def _scan(rotation: np.ndarray, k: int):
    """One block of a list against the queries that probe it: (query_id, vec_id, score) of what is left."""
    dims = len(rotation)

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            v, q = _matrix(left["v"].combine_chunks()), _matrix(right["q"].combine_chunks())
            ids, own = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
            radius = right["radius"].to_numpy()
            rv, rq = v @ rotation, q @ rotation
            blocks = [(a, min(a + COLUMNS, dims), np.ascontiguousarray(rv[:, a:a + COLUMNS])) for a in range(0, dims, COLUMNS)]
            for i in range(len(q)):
                alive, seen, r = np.flatnonzero(ids != own[i]), None, radius[i]
                slack = 1e-12 * (1 + q[i] @ q[i])  # the two rotations of equal vectors may be rounded differently
                for a, b, part in blocks:
                    d = ((part[alive] - rq[i, a:b]) ** 2).sum(1)
                    seen = d if seen is None else seen + d
                    keep = seen * (dims / b) <= r * (1 + EPSILON / np.sqrt(b)) ** 2 + slack if b < dims else seen <= r * (1 + 1e-9) + slack
                    alive, seen = alive[keep], seen[keep]
                    if not len(alive):
                        break
                if len(alive):
                    exact = np.sqrt(((v[alive] - q[i]) ** 2).sum(1))
                    best = np.lexsort((ids[alive], exact))[:k]
                    out.append((np.full(len(best), own[i]), ids[alive][best], exact[best]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, seed: int = 7) -> DataFrame:
    """The ``k`` nearest ``vectors`` found for each of ``queries`` (both: vec_id, embedding), by Euclidean distance.

    Returns query_id, rank (from 1, ties to the smaller vec_id), vec_id, score (distance of the original vectors in double
    precision); all candidates where there are fewer than k.  A query never finds its own vec_id.  Vectors that are
    null, empty, all zero or hold a null, NaN or infinite component take no part, nor do those whose number of components is
    not the most frequent one (ties: the larger).  Rows with one vec_id count once (the smallest vector).  Empty table: empty result.
    """
    spark = vectors.sparkSession
    work = Workspace(spark)

    def valid(df):
        fine = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists("v", lambda x: x != 0)
        return (df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
                .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(fine).groupBy("vec_id").agg(F.min("v").alias("v")))

    out = "query_id long, rank int, vec_id long, score double"
    table = work.table(valid(vectors), "vectors")
    dims = table.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if dims is None:
        return spark.createDataFrame([], out)
    d, n = dims["d"], dims["n"]
    table = table.where(F.size("v") == d)
    asked = valid(queries).where(F.size("v") == d)
    taken = table.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    ids, sample = taken["vec_id"].to_numpy(), _matrix(taken["v"].combine_chunks())
    rng = np.random.default_rng(seed)
    lists = max(1, min(LISTS, int(np.sqrt(len(sample)))))
    centres = _fit(sample, lists, rng)
    rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
    probes = max(1, int(np.ceil(PROBED * lists)))
    placed = work.table(table.mapInArrow(_assign(centres), "vec_id long, v array<double>, list int"), "placed")
    size = {r["list"]: r["n"] for r in placed.groupBy("list").agg(F.count("*").alias("n")).collect()}
    blocks = F.array(*[F.lit(max(1, -(-size.get(i, 0) // BLOCK))) for i in range(lists)])
    reach = "query_id long, q array<double>, radius double, lists array<int>"
    probing = work.table(asked.mapInArrow(_probe(centres, probes, ids, sample, WIDE * k), reach), "probing")
    keys, scan = ["list", "block", "part"], _scan(rotation, k)

    def search(wanted: DataFrame) -> DataFrame:
        groups = max(1, -(-wanted.count() // QUERIES))
        left = placed.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks[F.col("list")]).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        right = (wanted.select("query_id", "q", "radius", F.explode("lists").alias("list"))
                 .withColumn("block", F.explode(F.sequence(F.lit(0), blocks[F.col("list")] - 1)))
                 .withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")))
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(scan, "query_id long, vec_id long, score double")
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    best = work.table(search(probing), "best")
    enough = best.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= min(k, n - 1)).select("query_id")
    short = work.table(probing.join(enough, "query_id", "left_anti")
                       .select("query_id", "q", F.lit(float("inf")).alias("radius"), F.sequence(F.lit(0), F.lit(lists - 1)).alias("lists")), "short")
    if short.isEmpty():
        return best
    again = work.table(search(short), "again")
    return best.join(short, "query_id", "left_anti").unionByName(again)
