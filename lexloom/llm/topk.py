"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are dealt over partitions by length, longest first, ties of length by
a hash, and stored.  A task reads its partition in buckets of vectors of like
length.  A query that needs a score of ``t`` to enter its list needs from a
bucket with greatest length ``l`` a cosine of ``t / (|q| l)``, the bucket's
local threshold for it:

* over 1: the bucket is skipped;
* high: coordinates.  A unit vector with that cosine to q has each of its
  coordinates in an interval around q's; rows within the intervals of q's
  largest coordinates are looked up in sorted lists;
* else: lengths.  Only the rows with ``|p| >= t / |q|``, a prefix.

Rows that are left are verified by their products.  ``t`` starts from the
longest vectors, of which a bounded number is broadcast, and grows with what
the task finds.  Queries are broadcast in blocks of bounded size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_map, shared_dir, stored

#: Rows of a bucket, queries of a block, longest vectors that thresholds start from.
BUCKET, BLOCK, SEEDS = 4096, 16_384, 256
#: Queries that are multiplied with a bucket at a time.
PRODUCT = 256
#: Local threshold from which coordinates prune, and how many of them.
COORDINATES_FROM, FOCUS = 0.35, 3
_SLACK = 1e-9


def quantise(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ids and integer vectors of the rows that take part."""
    own = batch.filter(pa.compute.and_(batch.column(0).is_valid(), batch.column(1).is_valid()))
    ids, lists = own.column(0).to_numpy(zero_copy_only=False).astype(np.int64), own.column(1)
    sizes = np.unique(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    if len(sizes) == 1 and sizes[0] and not flat.null_count:
        # as a rule all are of one length
        x = np.floor(flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, int(sizes[0])) * scale)
        good = np.isfinite(x).all(1)
        return ids[good], list(x[good].astype(np.int64))
    kept, out = [], []
    for i, v in zip(ids.tolist(), lists):
        if not v.values.null_count:
            x = np.floor(v.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            if np.isfinite(x).all():
                kept.append(i)
                out.append(x.astype(np.int64))
    return np.array(kept, np.int64), out


def vectors(table: DataFrame, id: str, embedding: str, scale: int) -> DataFrame:
    """(id, norm, v): floor(scale * component), as bytes of 64-bit integers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = quantise(batch, scale)
            norms = np.array([np.sqrt((x.astype(np.float64) ** 2).sum()) for x in found], np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(norms), pa.array([x.tobytes() for x in found], pa.binary())], names=["id", "norm", "v"])

    return arrow_map(table.select(F.col(id).cast("long"), F.col(embedding)), work, "id long, norm double, v binary")


def _matrix(blobs: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows; missing components are 0."""
    if all(len(x) == width * 8 for x in blobs):
        return np.frombuffer(b"".join(blobs), np.int64).reshape(len(blobs), width).astype(np.float64)
    out = np.zeros((len(blobs), width))
    for row, x in zip(out, blobs):
        v = np.frombuffer(x, np.int64)[:width]
        row[: len(v)] = v
    return out


class _Queries:
    """A block of queries with the best that was found for each so far."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, start: np.ndarray, k: int) -> None:
        self.ids, self.q, self.k = ids, q, k
        self.norm = np.sqrt((q * q).sum(1))
        self.start = start  # scores that the list's end is known to reach
        unit = q / np.maximum(self.norm, 1e-300)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        self.unit = np.take_along_axis(unit, self.focus, 1)
        self.scores: list[np.ndarray] = [np.empty(0)] * len(ids)
        self.found: list[np.ndarray] = [np.empty(0, np.int64)] * len(ids)

    def threshold(self, i: int) -> float:
        full = len(self.scores[i]) == self.k
        return max(self.start[i], self.scores[i][-1]) if full else self.start[i]

    def offer(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = (scores >= self.threshold(i)) & (ids != self.ids[i])
        if keep.any():
            s, d = np.concatenate([self.scores[i], scores[keep]]), np.concatenate([self.found[i], ids[keep]])
            order = np.lexsort((d, -s))[: self.k]
            self.scores[i], self.found[i] = s[order], d[order]

    def search(self, ids: np.ndarray, p: np.ndarray, norms: np.ndarray) -> None:
        """Look through a bucket, whose rows are longest first."""
        longest = float(norms[0])
        t = np.array([self.threshold(i) for i in range(len(self.ids))])
        reach = self.norm * longest
        local = np.divide(t, reach, out=np.full(len(t), -1.0), where=reach > 0)
        wanted = t <= reach * (1 + _SLACK)
        steep = wanted & (local >= COORDINATES_FROM)
        self._by_coordinates(np.flatnonzero(steep), local, ids, p, norms)
        # lengths: norms fall, so the rows that are long enough are a prefix; queries of like prefixes are one product
        rest = np.flatnonzero(wanted & ~steep)
        least = np.divide(t[rest], self.norm[rest], out=np.full(len(rest), -np.inf), where=(self.norm[rest] > 0) & (t[rest] > 0))
        ends = np.searchsorted(-norms, -least * (1 - _SLACK), side="right")
        order = np.argsort(ends, kind="stable")
        for low in range(0, len(order), PRODUCT):
            part = order[low : low + PRODUCT]
            who, end = rest[part], int(ends[part].max())
            if not end:
                continue
            scores = p[:end] @ self.q[who].T
            bar = t[who]
            if end > self.k + 1:
                # one more than k, as a query's own row may be among them
                bar = np.maximum(bar, np.partition(scores, end - self.k - 1, axis=0)[end - self.k - 1])
            rows, columns = np.nonzero(scores >= bar)
            by = np.argsort(columns, kind="stable")
            rows, columns = rows[by], columns[by]
            bounds = np.searchsorted(columns, np.arange(len(who) + 1))
            for j in np.flatnonzero(np.diff(bounds)).tolist():
                own = rows[bounds[j] : bounds[j + 1]]
                self.offer(int(who[j]), ids[own], scores[own, j])

    def _by_coordinates(self, who: np.ndarray, local: np.ndarray, ids: np.ndarray, p: np.ndarray, norms: np.ndarray) -> None:
        """Rows whose largest coordinates are near enough to the query's are verified."""
        if not len(who):
            return
        unit = p / np.maximum(norms, 1e-300)[:, None]
        sorted_by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for i in who.tolist():
            c = min(1.0, float(local[i])) * (1 - _SLACK)
            hits = None
            for f, x in zip(self.focus[i].tolist(), self.unit[i].tolist()):
                if f not in sorted_by:
                    order = np.argsort(unit[:, f], kind="stable")
                    sorted_by[f] = order, unit[order, f]
                order, values = sorted_by[f]
                reach = np.sqrt(max(0.0, (1 - c * c) * (1 - x * x)))
                low = c * x - reach if x > -c else -1.0
                high = c * x + reach if x < c else 1.0
                a, b = np.searchsorted(values, [low - 1e-9, high + 1e-9])
                part = order[a:b]
                hits = part if hits is None else np.intersect1d(hits, part, assume_unique=True)
                if len(hits) < 64:
                    break
            self.offer(i, ids[hits], p[hits] @ self.q[i])


def search(table: DataFrame, queries: DataFrame, k: int = 10, id: str = "vec_id", embedding: str = "embedding", scale: int = 1024, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows of ``table`` with the highest inner product.

    ``queries`` has the columns ``id`` and ``embedding``.  Components become
    floor(scale * x); products are exact below 2**53.  A query's own id is no
    candidate; ties go to the smaller id; repeated rows are rows of their own,
    repeated queries one.  Vectors that are null or hold null or non-finite
    components take no part; missing components are 0.  Fewer than ``k``
    candidates are all returned.  Other columns are ignored; an empty table, or
    no queries, give no rows.
    """
    spark = table.sparkSession
    rows = stored(
        vectors(table, id, embedding, scale)
        .repartitionByRange(F.col("norm").desc(), F.xxhash64("id"))
        .sortWithinPartitions(F.col("norm").desc(), "id"),
        "vectors",
    )
    # bounded: SEEDS vectors
    seeds = rows.orderBy(F.col("norm").desc(), "id").limit(SEEDS).toArrow()
    seed_ids = seeds.column("id").to_numpy()
    asked = stored(vectors(queries, id, embedding, scale).dropDuplicates(["id"]), "queries")
    blocks = max(1, -(-asked.count() // block))
    path = f"{shared_dir(spark).rstrip('/')}/found-{uuid.uuid4().hex}"
    for at in range(blocks):
        # bounded: about ``block`` queries
        got = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == at).orderBy("id").toArrow()
        blobs, seed_blobs = got.column("v").to_pylist(), seeds.column("v").to_pylist()
        width = max([len(x) // 8 for x in blobs + seed_blobs], default=0)
        ids, q = got.column("id").to_numpy(), _matrix(blobs, width)
        start = np.full(len(ids), -np.inf)
        if len(seed_ids) > k and len(ids):
            s = q @ _matrix(seed_blobs, width).T
            s[ids[:, None] == seed_ids[None]] = -np.inf
            start = np.sort(s, 1)[:, -k]
        sent = spark.sparkContext.broadcast((ids, q, start))

        def work(batches: Iterator[pa.RecordBatch], sent=sent, width=width) -> Iterator[pa.RecordBatch]:
            state = _Queries(*sent.value, k)
            held: list[tuple[np.ndarray, np.ndarray, list[bytes]]] = []
            count = 0

            def look() -> None:
                ids = np.concatenate([x for x, _, _ in held])
                norms = np.concatenate([x for _, x, _ in held])
                order = np.argsort(-norms, kind="stable")
                state.search(ids[order], _matrix([b for _, _, x in held for b in x], width)[order], norms[order])

            for batch in batches:
                if batch.num_rows:
                    held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()))
                    count += batch.num_rows
                if count >= bucket:
                    look()
                    held, count = [], 0
            if held:
                look()
            sizes = np.array([len(x) for x in state.found], np.int64)
            if sizes.sum():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(state.ids, sizes)), pa.array(np.concatenate(state.found)), pa.array(np.concatenate(state.scores).astype(np.int64))],
                    names=["query_id", "id", "score"],
                )

        # each block's result is written, so that the plan doesn't grow with the queries
        arrow_map(rows, work, "query_id long, id long, score long").write.mode("append").parquet(path)
        sent.unpersist()
    parts = spark.read.schema("query_id long, id long, score long").parquet(path)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return parts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id), "score")
