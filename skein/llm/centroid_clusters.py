"""Centroid clustering: k-means over blocks of a space-filling curve.

Vectors are put in the order of a Hilbert curve through all their dimensions, cut into blocks, and each block
keeps the smallest and largest value of every dimension (a zone map), its sums and its size. In a round, the
distances of a centroid to the nearest and the farthest point of a block's box bound the distances of all its
vectors; a centroid whose nearest point is farther than another's farthest one cannot win there. The rest
are the block's candidates, with which the vectors are compared exactly. A block with one candidate is added by
its stored sums, without a look at its vectors. Arithmetic is in integers throughout, so results do not depend on the
order of anything.

Scale: the curve's key orders the rows by range partitions; equal vectors are told apart by a hash of their
identifier, so one very common vector spreads over tasks. Blocks are stored in the shared checkpoint folder and stay
where they lie; a round moves k x (dimensions + 1) numbers a task, which are summed by key before the driver takes
k x (dimensions + 1) of them. What goes out to the tasks is the centroids.

Defined results: vectors with another number of components, or with a null or non-finite one, are left out; so are
null arrays. A component x becomes floor(256 * x); beyond 2**27 either way it counts as that bound, because squared
distances would not fit a long. Rows count one by one, repeated ones too. Start centroids of equal hash (repeated
identifiers) are taken in the order of their components. With fewer vectors than k there are as many centroids as
vectors. A null identifier hashes as an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm import common

#: Vectors of a block.
BLOCK_ROWS = 512
#: Vectors of a range partition, about.
PART_ROWS = 1 << 14
#: Bits of each dimension's cell on the curve.
BITS = 4
LIMIT = 1 << 27


def integers(values: np.ndarray, scale: float = 256.0) -> np.ndarray:
    """floor(scale * x), held within the limit."""
    return np.clip(np.floor(values.astype(float) * scale), -LIMIT, LIMIT).astype(np.int64)


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of cells (rows x dimensions, ``bits`` bits each), as bits from the
    highest, one row each (rows x dimensions * bits)."""
    x = cells.T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):  # undo the rotations and reflections of each level, all rows at once
        q, below = 1 << level, (1 << level) - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(high, below, swap)
            x[i] ^= swap
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip
    planes = (x[None, :, :] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1
    return planes.reshape(bits * dims, -1).T.astype(np.uint8)


def box_bounds(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of each centroid to the nearest and the farthest point of a box."""
    outside = np.maximum(np.maximum(lo - centroids, centroids - hi), 0)
    far = np.maximum(np.abs(centroids - lo), np.abs(centroids - hi))
    return (outside * outside).sum(1), (far * far).sum(1)


def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to (or tie for) some point of the box, ascending."""
    near, far = box_bounds(lo, hi, centroids)
    return np.flatnonzero(near <= far.min())


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance), exact; ties go to the smaller number."""
    top = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * vectors.shape[1] * top * top < 1 << 53:  # every term is a whole number that a double holds
        v, c = vectors.astype(float), centroids.astype(float)
        d = (c * c).sum(1) - 2 * (v @ c.T)
        best = d.argmin(1)
        return best, (d[np.arange(len(v)), best] + (v * v).sum(1)).astype(np.int64)
    best, least = np.zeros(len(vectors), np.int64), np.full(len(vectors), np.iinfo(np.int64).max)
    for j, c in enumerate(centroids):
        d = ((vectors - c) ** 2).sum(1)
        best, least = np.where(d < least, j, best), np.minimum(d, least)
    return best, least


def kept_vectors(table: DataFrame, dims: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): the rows whose vector has ``dims`` components, all of them finite numbers."""
    v = F.col(vector_col).cast("array<double>")
    fine = (F.size(v) == dims) & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return table.select(F.col(id_col).alias("id"), v.alias("v")).filter(F.coalesce(fine, F.lit(False)))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def zone_blocks(vectors: DataFrame, dims: int, block_rows: int = BLOCK_ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """(n, ids, lo, hi, sums, vectors): blocks of vectors that follow each other on the curve."""
    kind = vectors.schema["id"].dataType.simpleString()

    def moments(batches):
        n, s, s2 = 0, np.zeros(dims), np.zeros(dims)
        for batch in batches:
            x = integers(_matrix(batch.column(0), dims)).astype(float)
            n, s, s2 = n + len(x), s + x.sum(0), s2 + (x * x).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(np.full(dims, n)), pa.array(s),
                                              pa.array(s2)], ["dim", "n", "s", "s2"])

    stats = (vectors.select("v").mapInArrow(moments, "dim long, n long, s double, s2 double").groupBy("dim")
             .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("s2").alias("s2")).orderBy("dim").collect())
    n = stats[0]["n"] if stats else 0
    mean = np.array([r["s"] / n for r in stats])
    spread = np.sqrt(np.maximum([r["s2"] / n for r in stats] - mean ** 2, 0)) if n else mean
    axes = np.argsort(-spread, kind="stable")  # the widest dimensions turn the curve first
    width = np.where(spread > 0, spread, 1.0) * 4 / (1 << BITS)  # the cells span two deviations either way
    words = -(-BITS * dims // 64)

    def keyed(batches):
        for batch in batches:
            x = integers(_matrix(batch.column(1), dims))
            cells = np.clip(np.floor((x - mean) / width) + (1 << BITS - 1), 0, (1 << BITS) - 1).astype(np.int64)
            bits = np.zeros((len(x), words * 64), np.uint8)
            bits[:, :BITS * dims] = hilbert_key(cells[:, axes], BITS)
            key = np.packbits(bits, axis=1).view(">u8").astype(np.uint64) ^ np.uint64(1 << 63)  # signed order
            rows = [r.tobytes() for r in x.astype("<i4")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.ascontiguousarray(key[:, i]).view(np.int64)) for i in range(words)),
                 pa.array(rows, pa.binary())], ["id", *(f"k{i}" for i in range(words)), "x"])

    keys = [f"k{i}" for i in range(words)]
    parts = max(1, -(-n // part_rows))
    ordered = (vectors.mapInArrow(keyed, f"id {kind}, {', '.join(f'{k} long' for k in keys)}, x binary")
               .withColumn("salt", F.xxhash64("id")).repartitionByRange(max(parts, 2), *keys, "salt")
               .sortWithinPartitions(*keys, "salt"))

    def blocks(batches):
        held, rows = [], 0

        def cut(whole: bool):
            nonlocal held, rows
            t = pa.Table.from_batches(held).combine_chunks()
            x = np.frombuffer(b"".join(t["x"].to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)
            end = rows if whole else rows // block_rows * block_rows
            for a in range(0, end, block_rows):
                b = min(a + block_rows, end)
                part = x[a:b]
                ids = t["id"].slice(a, b - a).combine_chunks()
                ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b - a]), pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids),
                     *(pa.array([f.astype(np.int64).tobytes()]) for f in (part.min(0), part.max(0), part.sum(0))),
                     pa.array([part.astype("<i4").tobytes()])], ["n", "ids", "lo", "hi", "sums", "vectors"])
            rest = t.slice(end)
            held, rows = rest.to_batches(), rest.num_rows

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 8 * block_rows:
                yield from cut(False)
        if rows:
            yield from cut(True)

    return common.materialise(ordered.select("id", "x").mapInArrow(
        blocks, f"n long, ids array<{kind}>, lo binary, hi binary, sums binary, vectors binary"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of smallest sha256 of ``seed:id``, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(name.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()  # k rows
    return integers(np.array([r["v"] for r in rows]))


def _assigned(row: dict, dims: int, centroids: np.ndarray):
    """(candidates, box) of a stored block and its vectors when there is more than one candidate."""
    lo, hi = (np.frombuffer(row[k], np.int64) for k in ("lo", "hi"))
    return candidates(lo, hi, centroids)


def _gathered(blocks: DataFrame, dims: int, centroids: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """(vectors of each centroid, their sums): one pass over the blocks."""
    k = len(centroids)

    def run(batches):
        size, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                near = _assigned(row, dims, centroids)
                if len(near) == 1:
                    size[near[0]] += row["n"]
                    sums[near[0]] += np.frombuffer(row["sums"], np.int64)
                    continue
                x = np.frombuffer(row["vectors"], "<i4").reshape(-1, dims).astype(np.int64)
                best = near[nearest(x, centroids[near])[0]]
                size += np.bincount(best, minlength=k)
                order = np.argsort(best, kind="stable")
                start = np.flatnonzero(np.diff(best[order], prepend=-1))
                sums[best[order][start]] += np.add.reduceat(x[order], start)
        c, d = np.nonzero(np.ones((k, dims + 1), bool))
        value = np.concatenate([size[:, None], sums], 1).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(d), pa.array(value)], ["c", "d", "value"])

    rows = (blocks.select("n", "lo", "hi", "sums", "vectors").mapInArrow(run, "c long, d long, value long")
            .groupBy("c", "d").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())
    out = [[0] * (dims + 1) for _ in range(k)]
    for r in rows:
        out[r["c"]][r["d"]] = int(r["value"])
    return np.array([o[0] for o in out]), [o[1:] for o in out]


def cluster(table: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, seed: int = 2, id_col: str = "vec_id",
            vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per vector that is kept: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    common.prepare(table.sparkSession)
    vectors = kept_vectors(table, dims, id_col, vector_col)
    kind = vectors.schema["id"].dataType.simpleString()
    ddl = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return table.sparkSession.createDataFrame([], ddl)
    blocks = zone_blocks(vectors, dims, block_rows, part_rows)
    for _ in range(rounds):
        size, sums = _gathered(blocks, dims, centroids)
        centroids = np.array([[s // n for s in row] if n else old.tolist()
                              for n, row, old in zip(size.tolist(), sums, centroids, strict=True)], np.int64)

    def assign(row):
        near = _assigned(row, dims, centroids)
        x = np.frombuffer(row["vectors"], "<i4").reshape(-1, dims).astype(np.int64)
        best, distance = nearest(x, centroids[near])
        return near[best], distance

    def inertias(batches):
        total = [0] * len(centroids)
        for batch in batches:
            for row in batch.to_pylist():
                best, distance = assign(row)
                for c in np.unique(best).tolist():
                    total[c] += sum(distance[best == c].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total))), pa.array([str(t) for t in total])], ["c", "t"])

    packed = blocks.select("ids", "lo", "hi", "vectors")
    by = {r["c"]: int(r["t"]) for r in packed.drop("ids").mapInArrow(inertias, "c long, t string").groupBy("c").agg(
        F.sum(F.col("t").cast("decimal(38,0)")).alias("t")).collect()}  # k rows
    fit = np.iinfo(np.int64).max
    of_cluster = np.array([min(by.get(c, 0), fit) for c in range(len(centroids))])
    whole = min(sum(by.values()), fit)
    names = np.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()])

    def told(batches):
        for batch in batches:
            ids = batch.column(0)
            for i, row in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                best, distance = assign(row)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, 1).flatten(), pa.array(best.astype(np.int32)), pa.array(distance), pa.array(of_cluster[best]),
                     pa.array(np.full(len(best), whole)), pa.array(names[best].tolist())],
                    ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return packed.mapInArrow(told, ddl)


# --- registered query -------------------------------------------------------------------------

CLUSTERS, ROUNDS, DIMS, SEED = 40, 5, 64, 2


def op11_centroid_clusters(spark, sf_dir: str) -> DataFrame:
    return cluster(common.table(spark, sf_dir, "embeddings"), CLUSTERS, ROUNDS, DIMS, SEED)


def _nearest_sql(i: int) -> str:
    return f"""
a{i} AS MATERIALIZED (
  SELECT row, arg_min(num, (dist, num)) AS num, min(dist) AS dist FROM (
    SELECT v.row, c.num, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS dist
    FROM v CROSS JOIN c{i} c) GROUP BY row)"""


def _moved_sql(i: int) -> str:
    """Centroids after a round: floor(sum / count) of whole numbers; those without vectors stay."""
    return f"""
c{i + 1} AS MATERIALIZED (
  SELECT c.num, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT num, list((s - ((s % n) + n) % n) // n ORDER BY d) AS x
    FROM (SELECT a.num, e.d, sum(e.y)::BIGINT AS s, count(*) AS n FROM a{i} a JOIN e ON e.row = a.row GROUP BY a.num, e.d)
    GROUP BY num) m ON m.num = c.num)"""


OP11_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
e AS MATERIALIZED (SELECT row, unnest(x) AS y, generate_subscripts(x, 1) AS d FROM v),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS num, x
  FROM (SELECT sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v ORDER BY h, x LIMIT {CLUSTERS})),
{",".join(f"{_nearest_sql(i)},{_moved_sql(i)}" for i in range(ROUNDS))},
{_nearest_sql(ROUNDS)},
s AS (SELECT num, sum(dist)::BIGINT AS cluster_inertia FROM a{ROUNDS} GROUP BY num)
SELECT v.vec_id, a.num::INTEGER AS cluster, a.dist AS distance, s.cluster_inertia,
       (SELECT sum(dist) FROM a{ROUNDS})::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM v JOIN a{ROUNDS} a ON a.row = v.row JOIN s ON s.num = a.num JOIN c{ROUNDS} c ON c.num = a.num"""
