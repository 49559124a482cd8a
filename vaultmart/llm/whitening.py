"""Whitening of embeddings by a covariance weighted with multiplicities.

A vector becomes whole numbers x = floor(1024 c) + 100000 per entry.  Identical x
vectors are grouped, so that all later work is done once per distinct vector:

1. Group rows by the whole x (its bytes, not a digest); the group's size is its fit
   weight (``weights="counts"``: the fit list is all rows; ``"one"``: the distinct
   vectors).  A vector that a third of the rows share is combined map-side.
2. Exact weighted sums S per dimension (as high and low halves, so nothing overflows).
3. The covariance: every task centres its vectors, scales them by the weights' square
   roots and multiplies (one GEMM a batch); the matrices of the tasks are added row by row
   of the matrix, so no reducer holds more than one row of each task.  The sum, one
   matrix of dimension x dimension, is decomposed on the driver.
4. Each distinct vector is projected on the leading components once, and written.
5. Rows get their vector's values by a join on x.  Vectors that ``HOT`` of the rows or more
   share (at most 1 / HOT of them) are joined by broadcast, the others by a shuffle.

The matrix, its components and the hot vectors are all that is broadcast or reaches the
driver; their sizes depend on the dimension only.

Defined results.  Rows whose vector is NULL or has a NULL or non-finite entry take no
part.  Vectors of different lengths are whitened apart, each length with its own n, sums
and components; a vector without entries has no components.  Components whose eigenvalue
is not above rounding error (1e-12 of the trace) cannot be scaled and are left out, so a
single distinct vector, or fewer than ``COMPONENTS`` dimensions, give fewer rows.  x is
held within +-2**62.  A deviation that exceeds a long is NULL.  Every remaining row gives its own output rows,
repeated or not, NULL ids too; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.functions.lineage import cut
from vaultmart.llm.common import named

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
HOT = 1e-3
ROUNDING = 1e-12
BATCH = 1 << 22          # numbers of a matrix multiplied at once
_LIMIT = float(1 << 61)


def whole_numbers(vector: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = np.floor(vector * SCALE) + SHIFT
    return np.clip(x, -_LIMIT, _LIMIT).astype(np.int64)


def integer_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): the remaining rows, x as the bytes of its longs."""

    def run(batches):
        for batch in batches:
            column = batch.column("vector")
            offsets, values = column.offsets.to_numpy(), column.values
            bad = values.is_null().to_numpy(zero_copy_only=False)
            number = np.where(bad, 0.0, values.fill_null(0.0).to_numpy(zero_copy_only=False))
            # one running count of entries that are no finite number
            wrong = np.concatenate([[0], np.cumsum(bad | ~np.isfinite(number))])
            good = column.is_valid().to_numpy(zero_copy_only=False) & (wrong[offsets[1:]] == wrong[offsets[:-1]])
            x = whole_numbers(np.where(np.isfinite(number), number, 0.0))
            raw = [x[a:b].tobytes() if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], good)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(raw, pa.binary())], names=["vec_id", "x"])

    return (vectors.select(named(id_col).cast("long").alias("vec_id"),
                           named(vector_col).cast("array<double>").alias("vector"))
            .mapInArrow(run, "vec_id long, x binary").where(F.col("x").isNotNull()))


def _matrices(batch, column: str, kind):
    """(size, places of the batch's rows of that size, their matrix), some rows at a time.
    ``size`` is the length of the x vector, whatever ``column`` holds."""
    raw, sizes = batch.column(column).to_pylist(), batch.column("size").to_numpy()
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        width = len(raw[places[0]]) // 8
        if width:
            for some in np.array_split(places, max(1, len(places) * width // BATCH)):
                yield int(size), some, np.frombuffer(b"".join(raw[i] for i in some), kind).reshape(len(some), width)


def _weights(batch) -> np.ndarray:
    return batch.column("weight").to_numpy(zero_copy_only=False).astype(np.int64)


def sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """size -> (n, the exact weighted sum per dimension); one row per size and dimension."""

    def run(batches):
        n, low, high = {}, {}, {}
        for batch in batches:
            weight = _weights(batch)
            for size, some, x in _matrices(batch, "x", np.int64):
                w = weight[some, None]
                n[size] = n.get(size, 0) + int(w.sum())
                high[size] = high.get(size, 0) + ((x >> 32) * w).sum(0)
                low[size] = low.get(size, 0) + ((x & 0xFFFFFFFF) * w).sum(0)
        for size in n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size), pa.array(range(size), pa.int64()), pa.array([n[size]] * size),
                 pa.array(high[size]), pa.array(low[size])], names=["size", "place", "n", "high", "low"])

    rows = (distinct.select("size", "weight", "x").mapInArrow(run, "size long, place long, n long, high long, low long")
            .groupBy("size", "place")
            .agg(*[F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("n", "high", "low")]).collect())
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        n, total = out.setdefault(r["size"], (int(r["n"]), [0] * r["size"]))
        total[r["place"]] = (int(r["high"]) << 32) + int(r["low"])
    return out


def covariances(distinct: DataFrame, column: str, centre: dict, kind=np.int64) -> dict[int, np.ndarray]:
    """size -> sum of weight (v - mean)(v - mean)' / n.  ``centre``: size -> (n, whole
    part of the mean, the rest of it)."""

    def run(batches):
        total = {}
        for batch in batches:
            weight = _weights(batch)
            for size, some, v in _matrices(batch, column, kind):
                _, whole, rest = centre[size]
                scaled = ((v - whole) - rest) * np.sqrt(weight[some, None])
                total[size] = total.get(size, 0) + scaled.T @ scaled
        for size, matrix in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * len(matrix)), pa.array(range(len(matrix)), pa.int64()),
                 pa.array([row.tobytes() for row in matrix], pa.binary())], names=["size", "place", "line"])

    def added(lines):        # one line of the matrix from every task
        total = sum(np.frombuffer(line) for line in lines.column("line").to_pylist())
        return pa.table({"size": lines.column("size")[:1], "place": lines.column("place")[:1],
                         "line": pa.array([total.tobytes()], pa.binary())})

    schema = "size long, place long, line binary"
    lines = (distinct.select("size", "weight", column).mapInArrow(run, schema)
             .groupBy("size", "place").applyInArrow(added, schema).collect())     # the matrices
    out: dict[int, np.ndarray] = {}
    for r in lines:
        line = np.frombuffer(r["line"]) / centre[r["size"]][0]
        out.setdefault(r["size"], np.zeros((len(line), len(line))))[r["place"]] = line
    return out


def _centre(n: int, total: list) -> tuple:
    whole = [s // n for s in total]
    return n, np.array(whole), np.array([(s - w * n) / n for s, w in zip(total, whole)])


def components(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors as columns, eigenvalues, shares of the trace), by falling eigenvalue."""
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    trace = float(np.trace(matrix))
    order = [i for i in np.argsort(-values, kind="stable")[:most] if values[i] > ROUNDING * trace]
    return vectors[:, order], values[order], values[order] / trace if trace > 0 else values[order]


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Per row the sum of (n x - S)^2; NULL where it exceeds a long."""
    # the true differences fit where the check says so; on the way there numbers wrap round
    with np.errstate(over="ignore"):
        wrapped = np.array([s & (1 << 64) - 1 for s in total], np.uint64).view(np.int64)
        exact = x * np.int64(n) - wrapped
        squares = (exact * exact).sum(1)
    _, whole, rest = _centre(n, total)
    estimate = ((((x - whole) - rest) * n) ** 2).sum(1)
    return [int(q) if e < 2.0 ** 61 else _slow_deviation(row, n, total) for q, e, row in zip(squares, estimate, x)]


def _slow_deviation(row, n: int, total: list[int]) -> int | None:
    value = sum((n * int(v) - s) ** 2 for v, s in zip(row, total))
    return value if value < 1 << 63 else None


def whitened_distinct(distinct: DataFrame, model: dict) -> DataFrame:
    """(x, size, weight, deviation, white: the projections as the bytes of doubles)."""

    def run(batches):
        for batch in batches:
            white, deviation = [b""] * batch.num_rows, [None] * batch.num_rows
            for size, some, x in _matrices(batch, "x", np.int64):
                total, (n, whole, rest), axes, values, _ = model[size]
                projected = (((x - whole) - rest) @ axes) / np.sqrt(values)
                for i, w, d in zip(some, projected, deviations(x, n, total)):
                    white[i], deviation[i] = w.tobytes(), d
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("size"), batch.column("weight"), pa.array(deviation, pa.int64()),
                 pa.array(white, pa.binary())], names=["x", "size", "weight", "deviation", "white"])

    return distinct.select("x", "size", "weight").mapInArrow(
        run, "x binary, size long, weight long, deviation long, white binary")


def means(white: DataFrame, n: dict[int, int]) -> dict[int, np.ndarray]:
    """size -> the weighted mean of the whitened vectors (nought but for rounding)."""

    def run(batches):
        total = {}
        for batch in batches:
            weight = _weights(batch)
            for size, some, v in _matrices(batch, "white", np.float64):
                total[size] = total.get(size, 0) + weight[some] @ v
        for size, t in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([size] * len(t)), pa.array(range(len(t)), pa.int64()), pa.array(t)],
                                             names=["size", "place", "total"])

    rows = (white.select("size", "weight", "white").mapInArrow(run, "size long, place long, total double")
            .groupBy("size", "place").agg(F.sum("total").alias("total")).orderBy("size", "place").collect())
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r["size"], []).append(r["total"] / n[r["size"]])
    return {size: np.array(m) for size, m in out.items()}


def identity_errors(white: DataFrame, n: dict[int, int]) -> dict[int, float]:
    """size -> largest absolute entry of the whitened vectors' covariance minus the identity."""
    centre = {size: (n[size], 0.0, mean) for size, mean in means(white, n).items()}
    return {size: float(np.abs(matrix - np.eye(len(matrix))).max())
            for size, matrix in covariances(white, "white", centre, np.float64).items()}


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS,
           weights: str = "counts", hot: float = HOT) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per
    remaining row of ``vectors`` and component."""
    if weights not in ("counts", "one"):
        raise ValueError("weights: counts or one")
    rows = integer_rows(vectors, id_col, vector_col)
    grouped = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    weight = F.col("copies") if weights == "counts" else F.lit(1).cast("long")
    table = cut(grouped.select("x", (F.octet_length("x") / 8).cast("long").alias("size"), "copies",
                               weight.alias("weight")), "distinct")

    fitted = {size: (total, _centre(n, total)) for size, (n, total) in sums(table).items()}
    matrices = covariances(table, "x", {size: centre for size, (_, centre) in fitted.items()})
    model = {size: (*fitted[size], *components(matrix, most)) for size, matrix in matrices.items()}
    white = cut(whitened_distinct(table, model), "whitened")
    errors = identity_errors(white, {size: centre[0] for size, (_, centre) in fitted.items()})

    facts = vectors.sparkSession.createDataFrame(            # one row per vector length
        [(size, m[1][0], [float(e) for e in m[4]], errors.get(size)) for size, m in model.items()],
        "size long, n long, explained array<double>, identity_error double")
    whole = table.agg(F.sum("copies").alias("n")).first()["n"] or 0
    # HOT of all rows or more: at most 1 / HOT vectors
    often = cut(table.where((F.col("copies") >= hot * whole) & (F.col("copies") > 1)).select("x"), "hot")
    found = white.select("x", "size", "deviation", "white")
    common = F.broadcast(found.join(F.broadcast(often), "x", "left_semi"))
    joined = (rows.join(common, "x")
              .unionByName(rows.join(F.broadcast(often), "x", "left_anti").join(found, "x")))
    return _unrolled(joined.drop("x").join(F.broadcast(facts), "size"))


def _unrolled(joined: DataFrame) -> DataFrame:
    """One row per component from the bytes of the projections."""

    def run(batches):
        for batch in batches:
            raw = batch.column("white").to_pylist()
            counts = np.array([len(r) // 8 for r in raw], np.int64)
            row = pa.array(np.repeat(np.arange(len(raw)), counts))
            component = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            explained = [e for shares, k in zip(batch.column("explained").to_pylist(), counts) for e in shares[:k]]
            taken = {c: batch.column(c).take(row) for c in ("vec_id", "n", "deviation", "identity_error")}
            yield pa.RecordBatch.from_arrays(
                [taken["vec_id"], pa.array((component + 1).astype(np.int32)), taken["n"], taken["deviation"],
                 pa.array(np.frombuffer(b"".join(raw))), pa.array(explained, pa.float64()), taken["identity_error"]],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return joined.select("vec_id", "n", "deviation", "white", "explained", "identity_error").mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, "
             "identity_error double")
