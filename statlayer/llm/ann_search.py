"""Nearest neighbours by largest inner product: multiprobe p-stable hashing with exact reranking.

Vectors and queries are hashed by their direction, each scaled to length 1: of all scales a vector's own
norm brings it nearest to the queries it answers. Each of ``TABLES`` tables hashes by ``FUNCTIONS`` Gaussian
(2-stable) projections floor((a x + b) / WIDTH); a query visits its own bucket and the ``PROBES`` - 1
perturbed ones of largest estimated success, in order of the summed squared distances to the cell walls that
are crossed. What wins by its norm and not by its direction is found in its own norm range: ranges are half an
octave wide, have buckets of their own, and every query visits those of all ranges. Inside a range the direction
decides.

The recall of ``SAMPLE`` queries is measured against all vectors. While it is under ``LEAST_RECALL``, the index is
made again with twice the probes, and from ``MOST_PROBES`` on with wider cells, so more is found with every turn.

Every vector is indexed in every table; buckets have no cap. A bucket with more than ``BLOCK`` vectors or
probes is cut into blocks, and each pair of blocks is one task's group: the inner products of a block are
one matrix product in double precision, of which each query keeps its best ``K``. The best of all tables
are merged by aggregation, so candidate pairs never exist as rows.

Equal vectors are one class for hashing and products, as candidates and as queries, and only their
smallest ``K`` + 1 ids can appear in an answer; so a vector that a third of the rows hold costs nothing.

Defined results: vectors that are null, zero, or hold null or non-finite components, and rows with null
ids, take no part; nor do vectors of another length than most (ties: the longer), which have no inner product with
them; rows that repeat an id count once for each different vector. Fewer than ``K`` candidates: all that were
found. Ties: smaller id. An empty table gives an empty table.
"""
from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import share, stored

TABLES, FUNCTIONS, WIDTH, PROBES = 8, 4, 1.4, 16
MOST_PROBES = 64
WIDER = 1.5
RANGES = 2                    # norm ranges an octave
SAMPLE, LEAST_RECALL = 64, 0.93
K = 20
BLOCK = 8192
PAIRS = 1 << 16               # exact products at once
QUERY_EVERY = 20
SEED = 41


def hash_family(dim: int):
    """Projections [dim, TABLES * FUNCTIONS] and offsets in cells, the same at every run."""
    rng = np.random.default_rng(SEED)
    return rng.normal(size=(dim, TABLES * FUNCTIONS)), rng.uniform(0, 1, TABLES * FUNCTIONS)


def perturbations(within: np.ndarray, count: int):
    """Sets of (function, step) by growing score; ``within``: the query's place in its cell, 0..1."""
    walls = sorted([(f * f, i, -1) for i, f in enumerate(within)] + [((1 - f) ** 2, i, 1) for i, f in enumerate(within)])
    yield ()
    count -= 1
    heap = [(walls[0][0], (0,))]
    while count and heap:
        score, chosen = heapq.heappop(heap)
        steps = [walls[j][1:] for j in chosen]
        if len({i for i, _ in steps}) == len(steps):       # never both walls of one function
            yield tuple(steps)
            count -= 1
        last = chosen[-1]
        if last + 1 < len(walls):
            heapq.heappush(heap, (score - walls[last][0] + walls[last + 1][0], chosen[:-1] + (last + 1,)))
            heapq.heappush(heap, (score + walls[last + 1][0], chosen + (last + 1,)))


def bucket_keys(cells: np.ndarray, table: int) -> np.ndarray:
    """64-bit names of cells [n, FUNCTIONS] of a table."""
    key = np.full(len(cells), (table + 1) * 0xC4CEB9FE1A85EC53 % (1 << 64), dtype=np.uint64)
    for c in cells.T:
        key = (key + c.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def in_range(keys: np.ndarray, level) -> np.ndarray:
    """Bucket names of a norm range."""
    x = np.asarray(level, dtype=np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return (keys.view(np.uint64) ^ x ^ x >> np.uint64(32)).view(np.int64)


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, vec) of the rows that take part, and their length."""
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    own = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec")).where("id is not null and vec is not null").where(fine)
    lengths = own.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = lengths["dim"] if lengths else 0
    return own.where(F.size("vec") == dim), dim


def nearest(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
            query_every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, id, score: the nearest rows of every row whose id is divisible by ``query_every``."""
    own, dim = valid_vectors(rows, id_col, vector_col)
    kind = "f4" if rows.schema[vector_col].dataType.elementType.simpleString() == "float" else "f8"
    name = [F.xxhash64("vec").alias("name1"), F.xxhash64(F.lit(1), "vec").alias("name2")]
    named = stored(own.select("id", *name, "vec").distinct(), "vectors")
    by_name = Window.partitionBy("name1", "name2").orderBy("id")
    members = stored(named.withColumn("place", F.row_number().over(by_name)).where(F.col("place") <= k + 1)
                     .select("id", "place", "name1", "name2"), "members")
    first = members.where("place = 1").select("name1", "name2", F.col("id").alias("cid"))
    vectors = stored(named.join(first, ["name1", "name2"]).where("id = cid").select("cid", "name1", "name2", "vec"), "classes")
    queries = stored(named.where(F.col("id") % query_every == 0).select("id", "name1", "name2").join(first, ["name1", "name2"])
                     .select(F.col("id").alias("query_id"), F.col("cid").alias("qid")), "queries")
    # the norm of a vector divided by its largest entry, and that entry, so that nothing overflows
    largest = F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double"))))
    level = F.floor(RANGES * (F.log2(largest) + F.log2(F.aggregate("vec", F.lit(0.0), lambda s, x: s + F.pow(x.cast("double") / largest, F.lit(2.0)))) / 2))
    vectors = stored(vectors.withColumn("level", level.cast("long")), "leveled")
    levels = np.array([r["level"] for r in vectors.select("level").distinct().collect()], dtype=np.int64)     # a few thousand at most: exponents of doubles
    shipped = share(rows.sparkSession, hash_family(dim))

    def matrix(column) -> np.ndarray:
        return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), dim)

    def places(x, width):
        a, b = shipped()
        p = x @ a / width + b
        cell = np.floor(p)
        return cell.astype(np.int64).reshape(-1, TABLES, FUNCTIONS), (p - cell).reshape(-1, TABLES, FUNCTIONS)

    def directions(x):
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def listed(batch, x, found):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays(
            [batch.column("cid"), pa.array(found, type=pa.list_(pa.int64())), pa.array([v.tobytes() for v in x.astype("<" + kind)], type=pa.binary())],
            names=["cid", "buckets", "raw"])

    def index(width):
        def run(batches):
            for batch in batches:
                x = matrix(batch.column("vec"))
                cell, _ = places(directions(x), width)
                keys = np.stack([bucket_keys(cell[:, t], t) for t in range(TABLES)], axis=1)
                yield listed(batch, x, in_range(keys, np.asarray(batch.column("level"))[:, None]).tolist())
        return run

    def probe(width, probes):
        def run(batches):
            for batch in batches:
                x = matrix(batch.column("vec"))
                cell, within = places(directions(x), width)
                found = []
                for c, w in zip(cell, within):
                    own = []
                    for t in range(TABLES):
                        sets = list(perturbations(w[t], probes))
                        cells = np.repeat(c[t][None], len(sets), axis=0)
                        for n, steps in enumerate(sets):
                            for i, d in steps:
                                cells[n, i] += d
                        own.append(bucket_keys(cells, t))
                    found.append(in_range(np.concatenate(own)[:, None], levels).ravel().tolist())
                yield listed(batch, x, found)
        return run

    shape = "cid bigint, buckets array<bigint>, raw binary"
    asking = stored(vectors.join(queries.select(F.col("qid").alias("cid")).distinct(), "cid", "left_semi"), "asking")

    def products(vs, qs):
        """Best candidates of every query of a block among the vectors of a block."""
        import pandas as pd

        if not len(vs) or not len(qs):
            return pd.DataFrame({"qid": [], "cid": [], "score": []}).astype({"qid": "int64", "cid": "int64", "score": "float64"})
        v, q = (np.frombuffer(b"".join(d["raw"]), dtype="<" + kind).reshape(len(d), dim).astype(np.float64) for d in (vs, qs))
        cid, qid, out = vs["cid"].to_numpy(), qs["qid"].to_numpy(), []
        take = min(len(v), k + 1)
        longest = np.linalg.norm(v, axis=1).max()
        for at in range(0, len(q), 256):
            own = q[at:at + 256]
            s = own @ v.T
            # whatever reaches the last score that counts, less what rounding in the product can change
            least = np.partition(s, len(v) - take, axis=1)[:, len(v) - take] - 1e-12 * dim * longest * np.linalg.norm(own, axis=1)
            row, col = np.nonzero(s >= least[:, None])
            exact = np.concatenate([(v[col[i:i + PAIRS]] * own[row[i:i + PAIRS]]).sum(axis=1)       # the same sum for a pair in whichever block
                                    for i in range(0, len(row), PAIRS)])
            order = np.lexsort((cid[col], -exact, row))
            row, col, exact = row[order], col[order], exact[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < take
            out.append(pd.DataFrame({"qid": qid[at + row[best]], "cid": cid[col[best]], "score": exact[best]}))
        return pd.concat(out)

    top = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
    best = lambda pairs: pairs.distinct().withColumn("n", F.row_number().over(top)).where(F.col("n") <= k + 1).drop("n")

    def compared(indexed: DataFrame, probing: DataFrame) -> DataFrame:
        """qid, cid, score: the best k + 1 of each query among the vectors that share a bucket with it."""
        in_bucket = indexed.select(F.explode("buckets").alias("bucket"), "cid", "raw")
        at_bucket = probing.select(F.explode("buckets").alias("bucket"), F.col("cid").alias("qid"), "raw")
        blocks = lambda df, n: df.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(float(BLOCK))).cast("int").alias(n))
        sizes = stored(blocks(in_bucket, "vs").join(blocks(at_bucket, "qs"), "bucket"), "sizes")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
        left = in_bucket.join(sizes, "bucket").select("bucket", part("cid", "vs").alias("vb"), each("qs").alias("qb"), "cid", "raw")
        right = at_bucket.join(sizes, "bucket").select("bucket", each("vs").alias("vb"), part("qid", "qs").alias("qb"), "qid", "raw")
        return stored(best(left.groupBy("bucket", "vb", "qb").cogroup(right.groupBy("bucket", "vb", "qb"))
                           .applyInPandas(products, "qid bigint, cid bigint, score double")), "short")

    def least_scores(indexed: DataFrame):
        """Of ``SAMPLE`` queries: the score of the last of their best k + 1 among all vectors, and how many those are."""
        chosen = asking.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).select("cid").join(indexed, "cid").select("cid", "raw").toPandas() \
            .rename(columns={"cid": "qid"})
        if not len(chosen):
            return {}, 0
        asked = share(rows.sparkSession, chosen)

        def exact(batches):
            for part in batches:
                yield products(part, asked())

        whole = best(indexed.select("cid", "raw").mapInPandas(exact, "qid bigint, cid bigint, score double")).toPandas()
        return whole.groupby("qid")["score"].min().to_dict(), len(whole)

    probes, width, wanted = PROBES, WIDTH, None
    while True:
        indexed = stored(vectors.select("cid", "vec", "level").mapInArrow(index(width), shape), "index")
        probing = stored(asking.select("cid", "vec", "level").mapInArrow(probe(width, probes), shape), "probes")
        short = compared(indexed, probing)
        wanted = wanted or least_scores(indexed)
        least, many = wanted
        ours = short.where(F.col("qid").isin(list(least))).toPandas()
        if (ours["score"] >= ours["qid"].map(least)).sum() >= LEAST_RECALL * many:
            break
        probes, width = (2 * probes, width) if probes < MOST_PROBES else (probes, width * WIDER)
    ids = members.join(first, ["name1", "name2"]).select("cid", "id")
    spread = short.join(ids, "cid").select("qid", "id", "score")
    listed = spread.withColumn("n", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "id"))).where(F.col("n") <= k + 1)
    answers = queries.join(listed.drop("n"), "qid").where("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return answers.select("query_id", rank.alias("rank"), F.col("id").alias(id_col), "score").where(F.col("rank") <= k)
