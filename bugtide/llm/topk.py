"""Exact top-k search by branch and bound over vertical vectors.

Candidates lie dimension by dimension. For a query, blocks of dimensions are taken in
the order of the query's largest components; each block adds to the partial inner
products of the candidates still alive. What the remaining dimensions can add or take
is at most the product of the lengths that query and candidate have left (their
remaining mass). A candidate whose upper bound lies below the k-th largest lower bound
is dropped, and the survivors are compacted. After the last block scores are exact.

Components are whole numbers floor(`SCALE` * x). Sums below 2**53 are exact in doubles; a
cell whose vectors could exceed this is computed with whole Python numbers.

As a job: rows are stored under a number of their own. Every query is first scored against
a bounded sample of `SAMPLE` rows; its k-th best score there is a floor that all tasks start
from, so each of them drops what cannot come in before it has found k rows itself.
Candidates and queries are then dealt by hash into blocks, and every pair of a
query block and a candidate block is a cell of its own; a cell returns at most k rows a
query, and the rows of a query are ranked at the end.

Defined cases: vectors that are missing, or hold a missing, infinite or undefined
component, take no part; a shorter vector counts as filled up with zeros. Every row
counts for itself: of rows that share an id each is a candidate, and a query, of its own,
the other ones included among its candidates; rows without an id are candidates only, and
come last among equal scores. Equal scores go to the smaller id; scores beyond 64 bits are
given as the largest or smallest number of 64 bits, but ranked by their real values within a
cell; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bugtide.llm.tools import Batches, grouped, in_arrow
from bugtide.storage import written

SCALE = 256
#: Dimensions of a block.
DIMENSIONS = 16
CANDIDATES = 4096
QUERIES = 8192
#: Rows against which every query's floor is found.
SAMPLE = 1024
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _table(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """Vectors as columns of a matrix, filled up with zeros."""
    sizes = pc.list_value_length(vectors).to_numpy().astype(np.int64)
    flat = vectors.flatten().to_numpy()
    table = np.zeros((max(1, width, int(sizes.max(initial=0))), len(sizes)))
    column = np.repeat(np.arange(len(sizes)), sizes)
    row = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    table[row, column] = flat
    return table


def _whole(table: np.ndarray) -> tuple[np.ndarray, bool]:
    """floor(`SCALE` * x) of a matrix, and whether all sums of products are exact in doubles."""
    largest = np.abs(table).max(initial=0)
    if (largest * SCALE + 1) ** 2 * len(table) < 2.0**53:
        return np.floor(table * SCALE), True
    # A double beyond 2**52 is whole already.
    number = lambda x: int(x) * SCALE if abs(x) >= 2.0**52 else math.floor(x * SCALE)
    return np.array([[number(x) for x in row] for row in table.tolist()], dtype=object).reshape(table.shape), False


def best(
    query: np.ndarray, table: np.ndarray, mass: np.ndarray, ids: np.ndarray, alive: np.ndarray, k: int, floor: float = -math.inf
) -> np.ndarray:
    """Indices, out of ``alive``, of the k columns with the largest products, ties to smaller ids.

    Columns that stay below ``floor`` may be left out.
    """
    order = np.argsort(-np.abs(query), kind="stable")
    partial, left = np.zeros(len(alive)), mass[alive]
    rest = float((query * query).sum())
    for at in range(0, len(order), DIMENSIONS):
        if not len(alive) or not rest:
            break
        block = order[at : at + DIMENSIONS]
        values = table[np.ix_(block, alive)] if len(alive) < table.shape[1] else table[block]
        weight = query[block]
        partial = partial + weight @ values
        left = left - np.einsum("ij,ij->j", values, values)
        rest -= float(weight @ weight)
        if rest > 0:
            slack = np.sqrt(rest * np.maximum(left, 0)) + 1e-6
            least = floor
            if len(alive) > k:
                least = max(least, np.partition(partial - slack, len(alive) - k)[len(alive) - k])
            kept = partial + slack >= least
            alive, partial, left = alive[kept], partial[kept], left[kept]
    return alive[np.lexsort((ids[alive], -partial))[:k]]


def _scores(
    queries: np.ndarray, own: np.ndarray, floors: np.ndarray, table: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, list[int]]]:
    """For each query column its best candidates and their scores; ``own`` are the queries' rows."""
    both, exact = _whole(np.concatenate([queries, table], axis=1))
    q, c = both[:, : queries.shape[1]], both[:, queries.shape[1] :]
    mass = np.einsum("ij,ij->j", c, c) if exact else None
    for i, row in enumerate(own):
        alive = np.flatnonzero(rows != row)
        if exact:
            found = best(q[:, i], c, mass, ids, alive, k, floors[i])
            yield found, [int(x) for x in (q[:, i] @ c[:, found]).tolist()]
        else:
            scores = [int(sum(a * b for a, b in zip(q[:, i], c[:, j], strict=True))) for j in alive]
            order = sorted(range(len(alive)), key=lambda j: (-scores[j], ids[alive[j]]))[:k]
            yield alive[order], [min(max(scores[j], LEAST), MOST) for j in order]


#: Ranks a missing id behind all others.
NO_ID = MOST


def _columns(rows: pa.Table | pa.RecordBatch, width: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = rows.column("_vector")
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    ids = pc.fill_null(rows.column("_id"), NO_ID).to_numpy()
    return rows.column("_row").to_numpy(), ids, _table(vectors, width)


def _with_floors(batches: Batches, sample: pa.Table, k: int) -> Batches:
    """The queries with the k-th best score that each reaches in the sample."""
    for batch in batches:
        if not len(batch):
            continue
        width = max(int(pc.max(pc.list_value_length(x)).as_py() or 0) for x in (batch.column("_vector"), sample.column("_vector")))
        rows, _, queries = _columns(batch, width)
        others, ids, table = _columns(sample, width)
        found = _scores(queries, rows, np.full(len(rows), -math.inf), table, others, ids, k)
        floors = [float(scores[-1]) if len(scores) == k else -math.inf for _, scores in found]
        # A floor that a double does not hold exactly is taken one step lower.
        floors = [f if abs(f) < 2.0**53 else math.nextafter(f, -math.inf) for f in floors]
        yield batch.append_column("_floor", pa.array(floors, pa.float64()))


def _search(batches: Batches, k: int) -> Batches:
    for rows in grouped(batches, "_cell"):
        rows = rows.combine_chunks()
        numbers, ids, table = _columns(rows)
        is_query = rows.column("_query").to_numpy()
        queries, candidates = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        floors = rows.column("_floor").to_numpy()[queries]
        names, missing = ids[candidates], rows.column("_id").is_null().to_numpy()[candidates]
        found = _scores(table[:, queries], numbers[queries], floors, table[:, candidates], numbers[candidates], names, k)
        out = [
            (int(numbers[q]), int(ids[q]), None if missing[c] else int(names[c]), score)
            for q, (chosen, scores) in zip(queries, found, strict=True)
            for c, score in zip(chosen, scores, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], pa.int64()) for i in range(4)], names=["_asked", "query_id", "vec_id", "score"]
        )


def nearest(
    vectors: DataFrame, query: Column, k: int = 5, key: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best rows but itself.

    ``query`` says of a row of ``vectors`` whether it is a query.
    """
    sound = F.forall(F.col(embedding), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    rows = vectors.where(F.col(embedding).isNotNull() & sound).select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(key).cast("bigint").alias("_id"),
        F.coalesce(query & F.col(key).isNotNull(), F.lit(False)).alias("_query"),
        F.col(embedding).cast("array<double>").alias("_vector"),
    )
    rows = written(rows)
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("_query").alias("q")).first()
    across, down = (max(1, -(-n // most)) for n, most in ((sizes["n"], CANDIDATES), (sizes["q"], QUERIES)))
    sample = rows.orderBy(F.xxhash64("_row"), "_row").limit(SAMPLE).select("_row", "_id", "_vector").toArrow()
    floored = in_arrow(
        rows.where("_query"),
        lambda batches: _with_floors(batches, sample, k),
        "_row bigint, _id bigint, _query boolean, _vector array<double>, _floor double",
    )
    place = lambda n: F.pmod(F.xxhash64("_row"), F.lit(n)).cast("int")
    cell = lambda other, own: F.explode(F.transform(F.sequence(F.lit(0), F.lit(other - 1)), own)).alias("_cell")
    columns = ["_query", "_row", "_id", "_vector", "_floor"]
    candidates = rows.withColumns({"_query": F.lit(False), "_floor": F.lit(0.0)})
    candidates = candidates.select(cell(down, lambda d: d * across + place(across)), *columns)
    queries = floored.select(cell(across, lambda a: place(down) * across + a), *columns)
    dealt = candidates.unionByName(queries).repartitionById(across * down, "_cell").sortWithinPartitions("_cell")
    found = in_arrow(dealt, lambda batches: _search(batches, k), "_asked bigint, query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("_asked").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
