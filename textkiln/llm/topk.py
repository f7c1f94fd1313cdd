"""Exact top-k by integer inner product with a three-phase uniform threshold.

Vectors are cut into ``slices`` of dimensions; a block of rows holds, for every query, one list of
local scores a slice, and a total is the sum of the local scores.

1. Blocks take turns at the lists: each gathers the ``k`` best entries of one of its lists and resolves
   their totals. The k-th best total over all blocks is a bound that the final k-th score can't fall below.
2. The bound, one long a query, is broadcast with a block of queries. Blocks score their first list.
   An entry whose local score, with the largest that the other lists can add (product of their norms),
   stays below the bound is left there. An entry that reaches bound ``b`` also has a local score of at
   least ``b / slices`` in some list (signs don't matter); only such entries are collected.
3. Lists are scored one after another for what is left, so most entries are never resolved; each block
   sends on at most ``k`` a query, ties by smaller id, and one ranking takes the final ``k``.

Queries go in blocks of at most ``QUERY_BYTES``, each of which is compared with all rows; only such a
block is ever broadcast. Hot vectors (equal rows) tie, and a block keeps the k smallest ids of a tie.

Defined results: null vectors, and vectors with a null or non-finite component, take no part; nor do
null ids. Vectors compare with those of equal length only. Rows are told apart by ``row``, not by id:
rows that share an id are candidates of each other, and each row that asks gets its own ranks. No queries
or fewer than k candidates give what there is. Scores beyond 64 bits are held at their limits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkiln.llm.tables import dropped, written

QUERY_BYTES = 16 << 20
ROWS = 4096
QUERIES = 512
_EXACT, _WHOLE = float(1 << 53), float(1 << 62)
_NONE = np.iinfo(np.int64).min


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", factor: int = 256) -> DataFrame:
    """``id, row, v`` (array<long>): floor(factor * x) of rows that take part. ``row`` numbers the rows; write the table before it is used twice."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    fine = F.col(vector).isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        df.where(F.col(id_col).isNotNull() & fine)
        .select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.transform(x, lambda c: F.floor(c * factor).cast("long")).alias("v"))
    )


def _matrices(b: pa.RecordBatch | pa.Table, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, row numbers and matrix of each vector length, ``rows`` at a time."""
    ids, row, v = b["id"].to_numpy(), b["row"].to_numpy(), b["v"]
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    lengths = v.value_lengths().to_numpy(zero_copy_only=False)
    flat = v.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        m = flat if len(at) == len(ids) else np.concatenate([flat[starts[i]:starts[i + 1]] for i in at]) if n else flat[:0]
        m = m.reshape(len(at), n)
        for i in range(0, len(at), rows):
            yield ids[at[i:i + rows]], row[at[i:i + rows]], m[i:i + rows]


def _most(q: np.ndarray, m: np.ndarray) -> float:
    """A bound of the sums of absolute products."""
    return float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(m.astype(np.float64)).max(initial=0)) * max(1, q.shape[-1])


def _whole(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact inner products of any size, held at the limits of 64 bits."""
    return np.clip(q.astype(object) @ m.T.astype(object), _NONE + 1, np.iinfo(np.int64).max).astype(np.int64)


def _dot(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact inner products: floats where every sum stays below 2^53, else 64-bit integers."""
    if _most(q, m) < _EXACT:
        return (q.astype(np.float64) @ m.T.astype(np.float64)).astype(np.int64)
    return q @ m.T


def _cuts(n: int, slices: int) -> list[tuple[int, int]]:
    c = np.linspace(0, n, min(slices, max(1, n)) + 1).astype(int).tolist()
    return list(zip(c[:-1], c[1:]))


def _norms(m: np.ndarray, cuts: list[tuple[int, int]]) -> np.ndarray:
    """[list + 1, row]: norm of what lies in lists ``j`` and after; zero after the last."""
    squares = [(m[:, s:e].astype(np.float64) ** 2).sum(axis=1) for s, e in cuts]
    return np.sqrt(np.cumsum([np.zeros(len(m)), *squares[::-1]], axis=0)[::-1])


class _Queries:
    """A block of queries by vector length."""

    def __init__(self, table: pa.Table):
        self.of = {}
        for ids, row, m in _matrices(table, len(table)):
            self.of[m.shape[1]] = (ids, row, m)


def lower_bounds(queries: _Queries, k: int, slices: int, work: list | None = None):
    """Phase 1, for mapInArrow: ``query_row, score`` of resolved entries, the ``k`` best of a task. ``work`` counts multiplications."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {n: np.full((len(q[0]), k), _NONE) for n, q in queries.of.items()}
        turn = 0
        for b in batches:
            for _, row, m in _matrices(b, ROWS):
                n = m.shape[1]
                if n not in queries.of:
                    continue
                _, qrow, qm = queries.of[n]
                cuts = _cuts(n, slices)
                s, e = cuts[turn % len(cuts)]
                turn += 1
                for at in range(0, len(qrow), QUERIES):
                    qs, q = qrow[at:at + QUERIES], qm[at:at + QUERIES]
                    big = _most(q, m) >= _WHOLE
                    local = _whole(q, m) if big else _dot(q[:, s:e], m[:, s:e])
                    own = qs[:, None] == row[None, :]
                    local[own] = _NONE
                    top = np.argpartition(local, -k, axis=1)[:, -k:] if len(row) > k else np.tile(np.arange(len(row)), (len(qs), 1))
                    total = np.take_along_axis(local, top, 1) if big else np.einsum("qkd,qd->qk", m[top], q)
                    total[np.take_along_axis(own, top, 1)] = _NONE
                    both = np.concatenate((best[n][at:at + QUERIES], total), axis=1)
                    best[n][at:at + QUERIES] = np.partition(both, -k, axis=1)[:, -k:]
                    if work is not None:
                        work.append(local.size * (e - s) + top.size * n)
        for n, x in best.items():
            got = x > _NONE
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(queries.of[n][1], got.sum(axis=1))), pa.array(x[got])], ["query_row", "score"])

    return run


def _best(score: np.ndarray, ids: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids, then rows."""
    at = np.arange(len(score))
    if len(score) > 4 * k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((row[at], ids[at], -score[at]))[:k]]


def sufficient_entries(queries: _Queries, k: int, slices: int, bounds: dict[int, int], work: list | None = None):
    """Phases 2 and 3, for mapInArrow: entries that reach their query's bound, the ``k`` best of a task."""
    def resolved(q: np.ndarray, m: np.ndarray, cuts: list, qnorm: np.ndarray, norms: np.ndarray, first: np.ndarray, alive: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
        """Of one query: the entries that reach the bound, list by list, and their totals."""
        at = np.flatnonzero(alive)
        total, top = first[at], first[at]
        for j, (s, e) in list(enumerate(cuts))[1:]:
            if not len(at):
                break
            x = _dot(q[None, s:e], m[at, s:e])[0]
            if work is not None:
                work.append(len(at) * (e - s))
            total, top = total + x, np.maximum(top, x)
            may = total + qnorm[j + 1] * norms[j + 1, at] * (1 + 1e-9) + 1 + np.abs(total) * 1e-9 >= bound
            at, total, top = at[may], total[may], top[may]
        # what reaches the bound has a local score at the uniform threshold
        go = (total >= bound) & (top >= np.floor_divide(bound, len(cuts)))
        return at[go], total[go]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        for b in batches:
            for ids, row, m in _matrices(b, ROWS):
                n = m.shape[1]
                if n not in queries.of:
                    continue
                qid, qrow, qm = queries.of[n]
                cuts = _cuts(n, slices)
                norms = _norms(m, cuts)
                s, e = cuts[0]
                for at in range(0, len(qrow), QUERIES):
                    qs, q = qrow[at:at + QUERIES], qm[at:at + QUERIES]
                    bound = np.array([bounds.get(x, _NONE) for x in qs.tolist()], np.int64)
                    big = _most(q, m) >= _WHOLE
                    first, qnorms = _whole(q, m) if big else _dot(q[:, s:e], m[:, s:e]), _norms(q, cuts)
                    if work is not None:
                        work.append(first.size * (e - s))
                    alive = first.astype(np.float64) * (1 + 1e-9 * np.sign(first)) + (0 if big else np.outer(qnorms[1], norms[1]) * (1 + 1e-9)) + 1 >= bound[:, None].astype(np.float64)
                    alive &= qs[:, None] != row[None, :]
                    for r in np.flatnonzero(alive.any(axis=1)).tolist():
                        if big:
                            c = np.flatnonzero(alive[r] & (first[r] >= bound[r]))
                            score = first[r, c]
                        else:
                            c, score = resolved(q[r], m, cuts, qnorms[:, r], norms, first[r], alive[r], int(bound[r]))
                        if not len(c):
                            continue
                        i, w = ids[c], row[c]
                        key = int(qs[r])
                        if key in best:
                            i, w, score = np.concatenate((best[key][1], i)), np.concatenate((best[key][2], w)), np.concatenate((best[key][3], score))
                        p = _best(score, i, w, k)
                        best[key] = (int(qid[at + r]), i[p], w[p], score[p])
        if best:
            sizes = [len(v[1]) for v in best.values()]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.array(list(best), np.int64), sizes)), pa.array(np.repeat(np.array([v[0] for v in best.values()], np.int64), sizes)),
                *[pa.array(np.concatenate([v[i] for v in best.values()])) for i in (1, 2, 3)]], ["query_row", "query_id", "vec_id", "row", "score"])

    return run


_ENTRY = "query_row long, query_id long, vec_id long, row long, score long"


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 5, slices: int = 4) -> DataFrame:
    """``id, row, v`` tables (written) -> ``query_id, rank, vec_id, score``: the k best rows of ``vectors`` for each row of ``queries``, other than itself."""
    stats = queries.agg(F.count(F.lit(1)), F.sum(8 * F.size("v") + 24)).first()
    if not stats[0]:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n_blocks = max(1, -(-int(stats[1]) // QUERY_BYTES))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    done = []
    for i in range(n_blocks):
        mine = queries if n_blocks == 1 else queries.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == i)
        block = _Queries(mine.select("id", "row", "v").toArrow())  # at most about QUERY_BYTES
        some = vectors.select("id", "row", "v").mapInArrow(lower_bounds(block, k, slices), "query_row long, score long")
        kth = some.withColumn("rank", F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score")))).where(F.col("rank") == k)
        bounds = {r["query_row"]: r["score"] for r in kth.select("query_row", "score").collect()}  # one long a query of the block
        found = vectors.select("id", "row", "v").mapInArrow(sufficient_entries(block, k, slices, bounds), _ENTRY)
        done.append(written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "topk"))
    if len(done) > 1:
        whole = written(reduce(DataFrame.unionByName, done), "topk-all")
        dropped(*done)
        done = [whole]
    return done[0].select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
