"""Near duplicates: banded MinHash candidates, b-bit similarity estimate, exact confirmation, components.

A document's set holds the distinct ``SHINGLE``-word shingles of its whole text (A-Z lower-cased; words
are runs of anything but ASCII white space). Documents link when their sets have a Jaccard similarity of
at least ``LEAST_PERCENT`` / 100; a component is everything reachable over links.

1. One pass over the texts gives each document its set's size and 128-bit fingerprint, ``MINIMA`` minima
   in ``BANDS`` band keys, and the low ``B`` bits of every minimum packed into a signature.
2. Equal sets are one class (a thousand exact copies are one row from here on), numbered when it is written; a
   class fetches its set from one of its rows, named by id and text.
3. In each band bucket every class is compared with the bucket's smallest class only, never all with all.
   The signatures decide first: matching ``B``-bit lanes are counted and corrected for chance matches;
   a pair whose estimate is five deviations under the limit is dropped. The others are confirmed on the
   full shingle sets.
4. Components are found by large-star / small-star contraction. Buckets whose classes lie in one component
   are done. For the others all pairs of classes in different components are compared by signature inside
   the join, and those that pass are confirmed in the same way.

With 4 rows in 32 bands a pair at the limit shares no bucket with probability 5e-6 (0.75: (1 - 0.75^4)^32).

Defined results: null or empty texts have n_shingles 0 and link with nothing; a row without doc_id is
returned with component_id null and kept true, and links with nothing; rows that repeat a doc_id are
judged each by its own text (two texts under one id may stand in two components, both named by it); very long
texts are read whole, in slices of rows; an empty table gives an empty table. Extra columns are ignored
(``near_duplicates``) or kept (``keep_first``).
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F
from xxhash import xxh3_64_intdigest

from .common import map_rows, stored, strings

SHINGLE, LEAST_PERCENT = 5, 75
MINIMA, ROWS = 128, 4
BANDS = MINIMA // ROWS
B = 4
ROUNDS = 1                     # at most, before the remaining classes are searched exactly
CACHE_WORDS = 1 << 17
MOST_DIFFERENT = 54            # lanes of 128 that may differ: five deviations beyond a pair at the limit
P, C1, C2 = np.uint64(0x9FB21C651E98DF25), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_RNG = np.random.default_rng(20)
FLIP = _RNG.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)
SPREAD = _RNG.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


class WordHash(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * C1
    x = (x ^ (x >> np.uint64(33))) * C2
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, words: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    own = (text or "").encode("utf-8", "surrogatepass").lower().split()     # on bytes both are ASCII only
    if len(words) > CACHE_WORDS:
        words.clear()
    h = np.fromiter(map(words.__getitem__, own), dtype=np.uint64, count=len(own))
    if not len(h):
        return h
    width = min(SHINGLE, len(h))
    s = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        s = s * P + h[k:len(h) - width + 1 + k]
    return np.unique(mixed(s))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the permutations (32 bits)."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(MINIMA, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 1024):
        block = x[at:at + 1024, None] ^ FLIP
        block *= SPREAD
        np.minimum(out, block.min(axis=0), out=out)
    return out


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that name the set."""
    return int(mixed(shingles + C2).sum(dtype=np.uint64).astype(np.int64)), \
        int(np.bitwise_xor.reduce(mixed(shingles ^ C1)).astype(np.int64))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_name, n, set_a, set_b (the set's name), sig (packed low bits), bands (bucket of each band)."""
    def worker():
        import pyarrow as pa

        words = WordHash()
        lanes = np.arange(BANDS, dtype=np.uint64) * C2

        def work(batch):
            n, a, b, sig, bands = [], [], [], [], []
            for text in strings(batch.column("text")):
                s = shingle_set(text, words)
                n.append(len(s))
                if not len(s):
                    a.append(None), b.append(None), sig.append(None), bands.append(None)
                    continue
                names = fingerprint(s)
                a.append(names[0]), b.append(names[1])
                m = minima(s)
                low = (m & np.uint32(15)).astype(np.uint8)
                sig.append((low[0::2] | low[1::2] << 4).view("<i8"))
                key = lanes.copy()
                for row in m.reshape(BANDS, ROWS).T.astype(np.uint64):
                    key = (key + row) * P
                bands.append(mixed(key).view(np.int64))
            long = pa.int64()
            return pa.RecordBatch.from_arrays(
                [batch.column("id_"), batch.column("text_name"), pa.array(n, type=long), pa.array(a, type=long), pa.array(b, type=long),
                 pa.array(sig, type=pa.list_(long)), pa.array(bands, type=pa.list_(long))],
                names=["doc_id", "text_name", "n", "set_a", "set_b", "sig", "bands"])
        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("id_"), text_name(docs).alias("text_name"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, worker, "doc_id bigint, text_name bigint, n bigint, set_a bigint, set_b bigint, sig array<bigint>, bands array<bigint>")


def text_name(docs: DataFrame) -> Column:
    """64-bit hash of a row's text; with the id it names the rows of one text."""
    return F.xxhash64(docs["text"].cast("string"))


def lanes_apart(a: Column, b: Column) -> Column:
    """How many of the ``B``-bit lanes of two signatures differ, by bit counts."""
    total = None
    for i in range(MINIMA * B // 64):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        any_bit = x
        for k in range(1, B):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, k))
        count = F.bit_count(any_bit.bitwiseAND(F.lit(0x1111111111111111)))
        total = count if total is None else total + count
    return total


def estimated_similarity(apart: Column) -> Column:
    """Jaccard estimate from differing lanes: matches corrected for the 1 in 2^B that match by chance."""
    chance = 1.0 / (1 << B)
    return ((1 - apart / F.lit(float(MINIMA))) - chance) / (1 - chance)


def may_link(n1: Column, n2: Column, sig1: Column, sig2: Column) -> Column:
    """Sizes and signatures allow the limit."""
    return (100 * F.least(n1, n2) >= LEAST_PERCENT * F.greatest(n1, n2)) & (lanes_apart(sig1, sig2) <= MOST_DIFFERENT)


def shingle_arrays(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """rep, shingles (array of 64-bit hashes) of the classes ``ids`` (rep, doc_id, text_name of one of its rows)."""
    def worker():
        import pyarrow as pa

        words = WordHash()

        def work(batch):
            sets = [shingle_set(t, words).view(np.int64) for t in strings(batch.column("text"))]
            return pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(sets, type=pa.list_(pa.int64()))], names=["rep", "shingles"])
        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_name(docs).alias("text_name"), F.col("text").cast("string").alias("text"))
    return map_rows(rows.join(ids, ["doc_id", "text_name"]).select("rep", "text"), worker, "rep bigint, shingles array<bigint>")


def confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose full sets reach the limit."""
    ids = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    ids = classes.select("rep", "doc_id", "text_name").join(ids, "rep", "left_semi")
    sets = stored(shingle_arrays(docs, ids).dropDuplicates(["rep"]), "sets")
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(right, "b").join(left, "a") \
        .where(100 * common >= LEAST_PERCENT * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def prefix_pairs(docs: DataFrame, classes: DataFrame, placed: DataFrame) -> DataFrame:
    """All pairs (a, b) of different roots among the placed classes (rep, root) that can reach the limit.

    Shingles are ordered by frequency among these classes, rarest first. Two sets at the limit must share
    one of the first n - ceil(t n) + 1, and from where they first meet enough must be left in both: a
    passage that thousands of texts share stands at the end of the order and brings no pair together."""
    ids = classes.select("rep", "doc_id", "text_name").join(placed.select("rep"), "rep", "left_semi")
    sets = shingle_arrays(docs, ids).dropDuplicates(["rep"])
    tokens = stored(sets.select("rep", F.size("shingles").alias("n"), F.explode("shingles").alias("s")), "tokens")
    shared = tokens.groupBy("s").agg(F.count("*").alias("f")).where("f > 1")
    places = tokens.join(shared, "s", "left").select(
        "rep", "n", "s", "f", F.row_number().over(Window.partitionBy("rep").orderBy(F.col("f").asc_nulls_first(), "s")).alias("at"))
    prefix = places.where("f > 1").where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * LEAST_PERCENT / 100) + 1) \
        .join(placed, "rep").select("s", "rep", "root", "n", (F.col("n") - F.col("at") + 1).alias("left"))
    prefix = stored(prefix, "prefixes")
    one, two = (prefix.select("s", *[F.col(c).alias(c + k) for c in ("rep", "root", "n", "left")]) for k in "12")
    most = F.least("left1", "left2")
    return one.join(two, "s").where("rep1 < rep2 and root1 <> root2") \
        .where(100 * most >= LEAST_PERCENT * (F.col("n1") + F.col("n2") - most)) \
        .select(F.col("rep1").alias("a"), F.col("rep2").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (least node reachable) for every node of an edge (a, b), by star contraction."""
    few = edges.sparkSession.sparkContext.defaultParallelism        # edges are two numbers: one task a core writes them
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().coalesce(few), "edges")
    while True:
        # done when every node is either a root or hangs on one root
        sides = now.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
            .unionByName(now.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if not sides.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").take(1):
            break
        # large star: every neighbour greater than a node links to the least of the node and its neighbours
        near = both(now)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its lesser neighbours link to the least of them
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        links = large.join(small, "a")
        now = stored(links.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(links.select("a", F.col("m").alias("b")))
                     .where("a <> b").distinct().coalesce(few), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links: the forest so far and the new edges."""
    return stored(components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links)), "roots")


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text_name, n, root (number of the component, null without a set), component (its smallest doc_id)."""
    drawn = stored(sketches(docs), "sketches")
    own = drawn.where("n > 0 and doc_id is not null")
    classes = own.groupBy("set_a", "set_b").agg(F.min(F.struct("doc_id", "text_name")).alias("row"), F.first("n").alias("n"),
                                                F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("rep"), "set_a", "set_b", "row.doc_id", "row.text_name", "n", "sig", "bands"), "classes")
    sigs = classes.select("rep", "n", "sig")
    members = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).where("size > 1")
    bucketed = stored(members.join(shared.select("bucket", "hub"), "bucket"), "buckets")

    def signed(pairs: DataFrame) -> DataFrame:
        a = sigs.select(F.col("rep").alias("a"), F.col("n").alias("n1"), F.col("sig").alias("s1"))
        b = sigs.select(F.col("rep").alias("b"), F.col("n").alias("n2"), F.col("sig").alias("s2"))
        return pairs.join(b, "b").join(a, "a").where(may_link(F.col("n1"), F.col("n2"), F.col("s1"), F.col("s2"))).select("a", "b")

    stars = bucketed.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    links = stored(confirmed(docs, classes, stored(signed(stars), "stars")), "links")
    roots = stored(components(links), "roots")

    def unsettled(roots: DataFrame) -> DataFrame:
        """bucket, rep, root of the buckets that still hold classes of different components."""
        placed = bucketed.select("bucket", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left") \
            .select("bucket", "rep", F.coalesce("root", "rep").alias("root"))
        mixed_ = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("bucket")
        return stored(placed.join(mixed_, "bucket", "left_semi"), "open")

    # rounds: one member of a bucket's largest component, another each time, against all members of other
    # components; in a group whose members link by chance nearly all join the component at once
    rest, tested = unsettled(roots), stars
    for turn in range(ROUNDS):
        groups = rest.groupBy("bucket", "root").agg(F.count("*").alias("size"), F.min_by("rep", F.xxhash64("rep", F.lit(turn))).alias("pick"))
        hubs = groups.groupBy("bucket").agg(F.max_by(F.struct("root", "pick"), F.struct("size", "root")).alias("h")) \
            .select("bucket", F.col("h.root").alias("hub_root"), F.col("h.pick").alias("hub"))
        pairs = rest.join(hubs, "bucket").where("root <> hub_root").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
        fresh = stored(signed(pairs.distinct().join(tested, ["a", "b"], "left_anti")), "round")
        more = stored(confirmed(docs, classes, fresh), "more")
        if not more.take(1):
            break
        tested, roots = tested.unionByName(fresh), joined(roots, more)
        rest = unsettled(roots)

    # what is left is searched exactly, by prefixes of the sets
    found = prefix_pairs(docs, classes, rest.select("rep", "root").distinct())
    fresh = stored(signed(found.join(tested, ["a", "b"], "left_anti")), "cross")
    more = stored(confirmed(docs, classes, fresh), "more")
    if more.take(1):
        roots = joined(roots, more)

    placed = stored(classes.select("set_a", "set_b", "rep", "doc_id").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
                    .select("set_a", "set_b", "doc_id", F.coalesce("root", "rep").alias("root")), "placed")
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component"))
    named = stored(placed.drop("doc_id").join(smallest, "root"), "named")
    return drawn.select("doc_id", "text_name", "n", "set_a", "set_b").join(named, ["set_a", "set_b"], "left") \
        .select("doc_id", "text_name", "n", "root", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    return grouped(docs).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                                F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component, all columns as they are: one with the smallest doc_id. Different texts under one id stay
    if they link with nothing smaller; repeated rows become one; rows without doc_id stay."""
    first = grouped(docs).where("doc_id = component").groupBy("doc_id", F.coalesce("root", "text_name").alias("group")) \
        .agg(F.min("text_name").alias("text_name")).select(F.col("doc_id").alias("first_id"), F.col("text_name").alias("first_name"))
    spare = "_".join(docs.columns)                              # no column has this name
    kept = docs.withColumn(spare, text_name(docs))
    kept = kept.join(first, (F.col("doc_id").cast("long") == F.col("first_id")) & (F.col(spare) == F.col("first_name")), "left_semi")
    return kept.dropDuplicates(["doc_id", spare]).drop(spare).unionByName(docs.where("doc_id is null"))
