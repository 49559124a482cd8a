"""Nearest neighbours by Euclidean distance: a vantage-point tree per shard.

The top of one tree is fitted on at most ``ROUTE_SAMPLE`` vectors (those with the
smallest hashes) of each length that has more than ``SHARD_VECTORS`` of them; its
leaves are regions.  Every vector is routed to its region, and a region is cut by
hash into shards of about ``SHARD_VECTORS``, so one that holds a third of all rows
is split as well.  A task reads one shard, builds its tree, and streams the queries
sent to it in blocks of ``QUERY_BLOCK``: it holds one shard and one block.

Queries go out twice: first to the shards of their own region, which gives each a
k-th distance, then with that distance as radius to those regions that it reaches.
The best of both rounds are the result.

A node of the tree is a vantage point, the median distance to it, and the near
and far half.  All queries of a block walk it together, first to their own side.
The triangle inequality bounds what the other side can offer by
``abs(distance - median)``; it is skipped if that bound, times ``factor``, exceeds
the query's k-th distance so far.  Factor 1 is exact; larger factors skip more.

Distances are taken on the original vectors in double precision, as the square
root of the sum of squared differences.  Ties go to the smaller vec_id; a bound
equal to the k-th distance is still followed, so ties are complete at factor 1.

Defined results.  Vectors that are NULL, all zero, or hold NULL or non-finite
components take no part, as queries or candidates.  Vectors are only compared
with vectors of the same number of components.  A candidate is every row but the
query's own: a repeated row (same vec_id) counts as the query's own.  A NULL
vec_id takes no part.  Repeated query ids are asked once per distinct vector and
merged.  Fewer than k candidates give fewer rows; an empty table gives none;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultmart.functions.lineage import cut
from vaultmart.llm.common import named

SHARD_VECTORS = 8_192
ROUTE_SAMPLE = 16_384    # most vectors of a length that its regions are fitted on
LEAST_SAMPLE = 16        # a region is no smaller than this many of them
QUERY_BLOCK = 512
LEAF = 512               # many small distance blocks cost more than a few large ones


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between columns of a and of b; the squares are added one
    component after the other, so the last bits do not depend on the shapes."""
    with np.errstate(over="ignore"):
        if a.shape[1] * b.shape[1] <= 2048:    # one call for few pairs: cumsum adds in order as well
            return np.sqrt(np.cumsum((a[:, :, None] - b[:, None, :]) ** 2, axis=0)[-1])
        total = np.zeros((a.shape[1], b.shape[1]))
        work = np.empty_like(total)
        for x, y in zip(a, b):
            np.subtract(x[:, None], y, out=work)
            np.multiply(work, work, out=work)
            total += work
    return np.sqrt(total, out=total)


def _crosses(d: np.ndarray, middle: float, factor: float, radius: np.ndarray) -> np.ndarray:
    """Whether a radius reaches the other side of a node: the least distance that it
    can offer, less its rounding error (NaN: nothing known, nothing is pruned)."""
    with np.errstate(invalid="ignore"):
        return ~((np.abs(d - middle) - 1e-12 * (d + middle)) * factor > radius)


class Regions:
    """The top of a vantage-point tree; its leaves are numbered from ``first``."""

    def __init__(self, sample: np.ndarray, vectors: int, shard_vectors: int, first: int = 0):
        self.columns = np.ascontiguousarray(sample.T)
        self.least = max(LEAST_SAMPLE, len(sample) * shard_vectors // vectors)
        self.first = self.end = first
        self.root = self._node(np.arange(len(sample)))
        del self.columns                       # nodes hold their own vantage points

    def _node(self, rows: np.ndarray):
        if len(rows) > self.least:
            vantage = self.columns[:, [rows[0]]]
            d = distances(vantage, self.columns[:, rows])[0]
            middle = float(np.median(d))
            near = d <= middle
            if not near.all():
                return vantage, middle, self._node(rows[near]), self._node(rows[~near])
        self.end += 1
        return self.end - 1

    def route(self, vectors: np.ndarray) -> np.ndarray:
        """The region of each vector (one a row)."""
        out, asked = np.empty(len(vectors), np.int64), np.ascontiguousarray(vectors.T)

        def walk(node, q):
            if not isinstance(node, tuple):
                out[q] = node
            elif len(q):
                vantage, middle, near, far = node
                inner = distances(vantage, asked[:, q])[0] <= middle
                walk(near, q[inner])
                walk(far, q[~inner])

        walk(self.root, np.arange(len(vectors)))
        return out

    def reached(self, vectors: np.ndarray, radius: np.ndarray, factor: float):
        """(row, region) of every other region that a vector's radius reaches."""
        out, asked = [], np.ascontiguousarray(vectors.T)

        def walk(node, q, own):
            if not isinstance(node, tuple):
                out.append((q[~own], np.full((~own).sum(), node)))
            elif len(q):
                vantage, middle, near, far = node
                d = distances(vantage, asked[:, q])[0]
                inner, other = d <= middle, _crosses(d, middle, factor, radius[q])
                for side, mine in ((near, inner), (far, ~inner)):
                    walk(side, q[mine | other], (own & mine)[mine | other])

        walk(self.root, np.arange(len(vectors)), np.ones(len(vectors), bool))
        return np.concatenate([r for r, _ in out]), np.concatenate([n for _, n in out])


class Tree:
    """A vantage-point tree over rows of ``vectors``."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.columns, self.ids = np.ascontiguousarray(vectors.T), ids
        self.root = self._node(np.argsort(ids, kind="stable"))

    def _node(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        vantage, rest = rows[0], rows[1:]
        far = distances(self.columns[:, [vantage]], self.columns[:, rest])[0]
        middle = float(np.median(far))
        near = far <= middle
        if near.all():                        # equal distances: nothing to divide by
            return rows
        return vantage, middle, self._node(rest[near]), self._node(rest[~near])

    def search(self, queries: np.ndarray, own: np.ndarray, radius: np.ndarray, k: int, factor: float):
        """(distances, ids), each queries x k, nearest first; NaN where fewer.  A distance
        may be infinite: its square may exceed a double.  What lies beyond a query's
        ``radius`` may be left out."""
        best = np.full((len(queries), k), np.nan)
        found = np.full((len(queries), k), np.iinfo(np.int64).max)
        asked = np.ascontiguousarray(queries.T)

        def limit(q):                          # NaN stands for fewer than k
            return np.fmin(best[q, -1], radius[q])

        def offer(q, rows):
            d = distances(asked[:, q], self.columns[:, rows])
            d[own[q][:, None] == self.ids[rows][None, :]] = np.nan
            useful = d <= limit(q)[:, None]
            some, place = useful.any(1), useful.any(0)
            if not some.any():
                return
            q, rows, d = q[some], rows[place], np.where(useful, d, np.nan)[np.ix_(some, place)]
            ids = np.broadcast_to(self.ids[rows], d.shape)
            all_d, all_i = np.hstack([best[q], d]), np.hstack([found[q], ids])
            all_i = np.where(np.isnan(all_d), np.iinfo(np.int64).max, all_i)
            order = np.lexsort([all_i, all_d])[:, :k]
            best[q], found[q] = np.take_along_axis(all_d, order, 1), np.take_along_axis(all_i, order, 1)

        def walk(node, q):
            if not len(q):
                return
            if not isinstance(node, tuple):
                for at in range(0, len(q), 64):            # bounds the distance block
                    for row in range(0, len(node), 4096):
                        offer(q[at:at + 64], node[row:row + 4096])
                return
            vantage, middle, near, far = node
            offer(q, np.array([vantage]))
            d = distances(asked[:, q], self.columns[:, [vantage]])[:, 0]
            inner = d <= middle
            walk(near, q[inner])
            walk(far, q[~inner])
            other = _crosses(d, middle, factor, limit(q))
            walk(far, q[inner & other])
            walk(near, q[~inner & other])

        walk(self.root, np.arange(len(queries)))
        return best, found


def _element(vector_col: str, *tables: DataFrame) -> str:
    """float if all the vectors hold floats (half the bytes to move), else double."""
    kinds = {df.select(named(vector_col).alias("v")).schema["v"].dataType.simpleString() for df in tables}
    return "float" if kinds == {"array<float>"} else "double"


def usable(vectors: DataFrame, id_col: str, vector_col: str, element: str = "double") -> DataFrame:
    rows = vectors.select(named(id_col).cast("long").alias("vec_id"),
                          named(vector_col).cast(f"array<{element}>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite
                      & F.exists("vector", lambda x: x != 0))


def _matrix(column) -> np.ndarray:
    """A list column of one length as rows, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _by_length(batch):
    """(rows, their vectors) for each length of a batch."""
    column = batch.column("vector")
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, _matrix(column.take(pa.array(rows)))


def _distinct(vectors: np.ndarray, ids: np.ndarray):
    """Without rows that repeat both id and vector: they would take places."""
    if len(np.unique(ids)) == len(ids):
        return vectors, ids
    first = list({(i, v.tobytes()): n for n, (i, v) in enumerate(zip(ids.tolist(), vectors))}.values())
    return vectors[first], ids[first]


def _regions(rows: DataFrame, shard_vectors: int) -> dict[int, Regions]:
    """The regions of each length with more than a shard of vectors.  Of every such
    length the driver gets at most ROUTE_SAMPLE vectors."""
    dim, out, first = F.size("vector"), {}, 0
    for size, count in sorted(rows.groupBy(dim).count().where(F.col("count") > shard_vectors).collect()):
        sample = (rows.where(dim == size).select("vector", F.xxhash64("vec_id", "vector").alias("h"), "vec_id")
                      .orderBy("h", "vec_id").limit(ROUTE_SAMPLE).select("vector").toArrow())
        out[size] = Regions(_matrix(sample.column("vector").combine_chunks()), count, shard_vectors, first)
        first = out[size].end
    return out


def _routed(regions, factor: float | None = None):
    """Adds ``region``: a vector's own (-length for lengths without regions) or,
    with a ``factor``, one row for each other region that ``radius`` reaches."""

    def run(batches):
        for batch in batches:
            for size, rows, vectors in _by_length(batch):
                top = regions.value.get(size)
                if factor is None:
                    region = np.full(len(rows), -size) if top is None else top.route(vectors)
                elif top is None:
                    continue
                else:
                    at, region = top.reached(vectors, batch.column("radius").to_numpy()[rows], factor)
                    rows = rows[at]
                part = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(region, pa.int64())],
                                                 names=[*batch.schema.names, "region"])

    return run


def _searched(candidates: DataFrame, asked: DataFrame, tasks: int, k: int, factor: float) -> DataFrame:
    """(query_id, vec_id, score): the best k of its shard for every row of ``asked``
    (shard, vec_id, vector, radius)."""
    both = candidates.select("shard", "vec_id", "vector", F.lit(None).cast("double").alias("radius")).unionByName(
        asked.select("shard", "vec_id", "vector", "radius"))
    # shards are numbered, so each has a task of its own; lengths without regions share them
    both = both.repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int")).sortWithinPartitions(
        "shard", F.col("radius").isNotNull())

    def run(batches):
        key, held, block, tree = None, [], [], None

        def answers():
            nonlocal tree, held
            if block and held and tree is None:
                tree = Tree(*_distinct(np.concatenate([v for _, v in held]), np.concatenate([i for i, _ in held])))
                held = [None]
            if not block or tree is None:
                return
            own, vectors, radius = (np.concatenate(part) for part in zip(*block))
            for at in range(0, len(own), QUERY_BLOCK):
                ask = own[at:at + QUERY_BLOCK]
                best, found = tree.search(vectors[at:at + QUERY_BLOCK], ask, radius[at:at + QUERY_BLOCK], k, factor)
                ok = ~np.isnan(best)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.broadcast_to(ask[:, None], best.shape)[ok]), pa.array(found[ok]), pa.array(best[ok])],
                    names=["query_id", "vec_id", "score"])

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            query = batch.column("radius").is_valid().to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate([[True], (shards[1:] != shards[:-1]) | (query[1:] != query[:-1])]))
            for start, end in zip(starts, [*starts[1:], len(shards)]):
                if shards[start] != key:
                    key, held, tree = shards[start], [], None
                part = batch.slice(start, end - start)
                ids, vectors = part.column("vec_id").to_numpy(), _matrix(part.column("vector"))
                if query[start]:
                    block = [(ids, vectors, part.column("radius").to_numpy())]
                    yield from answers()
                else:
                    held.append((ids, vectors))

    return both.mapInArrow(run, "query_id long, vec_id long, score double").distinct()


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_vectors: int = SHARD_VECTORS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest rows of ``vectors``
    found for each row of ``queries`` (same columns)."""
    spark = vectors.sparkSession
    element = _element(vector_col, vectors, queries)
    rows = usable(vectors, id_col, vector_col, element)
    tops = _regions(rows, shard_vectors)
    known = spark.sparkContext.broadcast(tops)           # at most ROUTE_SAMPLE / LEAST_SAMPLE vectors a length
    schema = f"vec_id long, vector array<{element}>"
    routed = cut(rows.mapInArrow(_routed(known), f"{schema}, region long"), "ann-vectors")
    asked = cut(usable(queries, id_col, vector_col, element).distinct()
                .mapInArrow(_routed(known), f"{schema}, region long"), "ann-queries")
    # shards of each region, numbered one after the other; -length is a shard itself
    regions = max((top.end for top in tops.values()), default=0)
    counts = dict(routed.where("region >= 0").groupBy("region").count().collect())
    parts = [max(1, -(-counts.get(r, 0) // shard_vectors)) for r in range(regions)]
    first = np.concatenate([[0], np.cumsum(parts)]).astype(int).tolist()
    tasks = max(first[-1], 1 if tops else spark.sparkContext.defaultParallelism)
    plan = spark.createDataFrame([(r, first[r], n) for r, n in enumerate(parts)], "region long, first long, parts long")
    small = F.col("region") < 0

    def in_shards(df, one):
        df = df.join(F.broadcast(plan), "region", "left")        # one row a region
        # repeated rows are spread as well: each shard drops its own repeats, the offers theirs
        pick = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.col("parts"))
        return df.withColumn("shard", F.when(small, F.col("region")).otherwise(F.col("first") + pick)) if one else \
            df.withColumn("shard", F.explode(F.when(small, F.array("region")).otherwise(
                F.sequence("first", F.col("first") + F.col("parts") - 1))))

    candidates = in_shards(routed, True)
    offers = _searched(candidates, in_shards(asked, False).withColumn("radius", F.lit(float("inf"))), tasks, k, factor)
    if tops:
        offers = cut(offers, "ann-offers")
        radius = _ranked(offers, k).groupBy("query_id").agg(
            F.when(F.count("*") >= k, F.max("score")).otherwise(float("inf")).alias("radius"))
        sent = (asked.drop("region").join(radius, F.col("vec_id") == F.col("query_id"), "left")
                .select("vec_id", "vector", F.coalesce("radius", F.lit(float("inf"))).alias("radius"))
                .mapInArrow(_routed(known, factor), f"{schema}, radius double, region long"))
        offers = offers.unionByName(_searched(candidates, in_shards(sent, False), tasks, k, factor)).distinct()
    return _ranked(offers, k).select("query_id", "rank", "vec_id", "score")


def _ranked(offers: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return offers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
