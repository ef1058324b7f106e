"""Mixing sources to target weights: packed blocks, multinomial shards, permuted indexes.

* Packing. The documents of a source stand in the order of their hashes, one behind the other, and are cut into
  blocks of ``BLOCK_WORDS`` words (the last one of a source may be shorter). Places are running sums over a
  range-partitioned order of (source, hash), so a source with a third of the rows spreads over many tasks, and only
  ids, hashes and sizes are moved.
* Targets. The sources' weights share out ``SHARE`` of all words; no target exceeds ``REPEATS`` times its source's
  size. What that cuts off is shared out again by weight until nothing is above: target = min(limit, level * weight),
  where the level is the largest of (total - limits of the first k) / (weight of the rest), sources in the order of
  limit / weight.
* Slots. A target is so many whole passes over a source's blocks and a part of one; its words decide how many blocks
  (slots) that is and where the last one ends, so the words taken meet the target to the word.
* Shards. The output has shards of ``SHARD_SLOTS`` slots. Each shard draws its slots' sources from one multinomial
  distribution, seeded by its number: first among at most ``GROUPS`` groups of sources, then within each group, so
  no task holds the weights of all sources. The draws of a source are numbered over the shards. Draws beyond a
  source's number of slots are free places; slots that a source did not draw are dealt to the free places, both
  joined by their running number. So the totals are the targets, whatever was drawn.
* Indexes. The i-th slot of a source is block P(i mod n) of its n blocks, where P is a pseudorandom permutation of
  0..n-1 keyed by source and pass (a Feistel network, walked along its cycle until it falls below n). Each pass
  visits every block once, so no document is taken more than ``REPEATS`` times its size. Places inside a shard are
  permuted alike. Slots and blocks are joined by (source, block).

Nothing depends on how rows are dealt to tasks, so reruns agree.

Defined results: null, empty and blank texts have no words and are taken 0 times; a null source is a source, the
last one; a null id is kept as it is; rows that are equal in id, source and text are interchangeable, each is packed
on its own; very long texts reach over many blocks; an empty table gives an empty table. Extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from .common import WORD_PATTERN, stored

BLOCK_WORDS = 512
SHARD_SLOTS = 1024
WEIGHTS = (3, 1, 2)        # of the sources in order, repeating
SHARE = 1.5
REPEATS = 2
GROUPS = 1024
SEED = 20_011
ROUNDS = 6                 # of the Feistel network
STEPS = [np.uint64((r + 1) * 0x9E3779B97F4A7C15 % 2**64) for r in range(ROUNDS)]


def mixed(half: np.ndarray, key: np.ndarray, step: np.uint64) -> np.ndarray:
    """Round function of the network."""
    h = (half + key + step) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(32)


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """P(index) of a pseudorandom permutation of 0..size-1 for every entry (``back``: the index whose P it is);
    entries of one key and size share one permutation."""
    index, size, key = (np.atleast_1d(np.asarray(a)).astype(np.uint64) for a in np.broadcast_arrays(index, size, key))
    bits = np.maximum(np.ceil(np.log2(np.maximum(size.astype(float), 2)) / 2), 1).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out, todo = index.copy(), np.flatnonzero(size > 1)
    while len(todo):
        x, b, m, k = out[todo], bits[todo], mask[todo], key[todo]
        left, right = x >> b, x & m
        for step in STEPS[::-1] if back else STEPS:
            if back:
                left, right = right ^ (mixed(left, k, step) & m), left
            else:
                left, right = right, left ^ (mixed(right, k, step) & m)
        out[todo] = left << b | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def pass_key(source: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Key of a source's permutation in a pass."""
    x = np.asarray(source, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.asarray(turn, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
    return x + np.uint64(SEED)


def running(df: DataFrame, order: list[Column], **values: Column) -> DataFrame:
    """The frame with, for every value, the sum over all rows before this one in the order (whole numbers).

    Rows are range-partitioned by the order, so no key is bound to one task; the sums before a partition come from one
    row a partition."""
    names = list(values)
    df = df.select("*", *[v.cast("long").alias(n) for n, v in values.items()])
    schema = df.schema
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)

    def sums(batches):
        import pyarrow as pa

        total = dict.fromkeys(names, 0)
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            for n in names:
                own = columns[n].to_numpy(zero_copy_only=False)
                columns[n] = pa.array(total[n] + np.cumsum(own) - own, type=pa.int64())
                total[n] += int(own.sum())
                columns[n + "_own"] = pa.array(own, type=pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    wide = T.StructType([*schema, *[T.StructField(n + "_own", T.LongType()) for n in names]])
    placed = stored(placed.mapInArrow(sums, wide).withColumn("task_", F.spark_partition_id()), "placed")
    ends = placed.groupBy("task_").agg(*[F.sum(n + "_own").alias(n) for n in names])
    before = Window.orderBy("task_").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("task_", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n + "_before") for n in names])
    found = placed.join(F.broadcast(ends), "task_")                 # one row a task
    return found.select(*[(F.col(n) + F.col(n + "_before")).alias(n) if n in names else F.col(n) for n in schema.names])


class Mix:
    """A mix of documents: ``sources`` (one row a source), ``packed`` (one row a document), ``slots`` (one row a slot)."""

    def __init__(self, packed: DataFrame, sources: DataFrame, slots: DataFrame):
        self.packed, self.sources, self.slots = packed, sources, slots

    def spans(self) -> DataFrame:
        """What the mix says, in order of shard, slot and place: row, doc_id, first word and number of words."""
        first = F.floor(F.col("place") / BLOCK_WORDS)
        last = F.floor((F.col("place") + F.col("size") - 1) / BLOCK_WORDS)
        parts = self.packed.where("size > 0").select("*", F.explode(F.sequence(first, last)).alias("block"))
        a = F.greatest(F.col("place"), F.col("block") * BLOCK_WORDS)
        b = F.least(F.col("place") + F.col("size"), F.col("block") * BLOCK_WORDS + F.col("words"))
        return parts.join(self.slots, ["source_no", "block"]).where(b > a) \
            .select("shard", "slot", "row", "name", "doc_id", "block", (a - F.col("place")).alias("first"), (b - a).alias("n_words"), a.alias("order"))

    def texts(self, docs: DataFrame) -> DataFrame:
        """shard, slot, text: the words of every slot, joined by one space."""
        known = docs.select(row_name(docs).alias("name"), F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD_PATTERN), F.lit(0)).alias("words")) \
            .dropDuplicates(["name"])
        said = self.spans().join(known, "name").select("shard", "slot", "order", F.slice("words", (F.col("first") + 1).cast("int"), F.col("n_words").cast("int")).alias("said"))
        return said.groupBy("shard", "slot").agg(F.array_sort(F.collect_list(F.struct("order", "said"))).alias("all")) \
            .select("shard", "slot", F.array_join(F.flatten(F.col("all.said")), " ").alias("text"))

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken: one row a document."""
        got = self.spans().groupBy("row").agg(F.sum("n_words").alias("taken"))
        return self.packed.join(self.sources.select("source_no", "source_size", "target"), "source_no").join(got, "row", "left") \
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def row_name(docs: DataFrame) -> Column:
    """Two hashes that name a document's id, source and text."""
    key = [docs["doc_id"].cast("string"), docs["source"].cast("string"), docs["text"].cast("string")]
    key += [c.isNull() for c in key]
    return F.struct(F.xxhash64(*key).alias("a"), F.xxhash64(F.lit(1), *key).alias("b"))


def targets(sources: DataFrame, weights: tuple, share: float, repeats: int) -> DataFrame:
    """The sources (source_no, source_size) and the target of each; weights are whole numbers."""
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    known = sources.select("*", weight.alias("weight"), (F.col("source_size") * repeats).alias("limit"))
    total, full = known.agg(F.sum("source_size"), F.sum("weight")).first()
    total = share * (total or 0)
    ranked = running(known, [F.col("limit") / F.col("weight"), F.col("source_no")],
                     limits=F.col("limit"), weights=F.col("weight"))
    level = ranked.agg(F.max((F.lit(float(total)) - F.col("limits")) / (F.lit(float(full or 0)) - F.col("weights")))).first()[0] or 0.0
    return known.select("*", F.least(F.col("limit").cast("double"), F.lit(float(level)) * F.col("weight")).alias("target")).drop("limit")


def with_slots(sources: DataFrame) -> DataFrame:
    """n_blocks, n_slots and last_words (words of the last slot) of every source, from its size and target."""
    def plan(batches):
        import pyarrow as pa

        for batch in batches:
            no, size, target = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("source_no", "source_size", "target"))
            blocks = -(-size // BLOCK_WORDS)
            words = np.rint(target).astype(np.int64)
            turns, rest = np.divmod(words, np.maximum(size, 1))
            # where the short last block comes in the pass that is not finished
            tail_words = size - (blocks - 1) * BLOCK_WORDS
            tail = permuted(np.maximum(blocks - 1, 0), blocks, pass_key(no, turns), back=True)
            lack = BLOCK_WORDS - tail_words
            slots = -(-rest // BLOCK_WORDS)
            slots = np.where(slots > tail, -(-(rest + lack) // BLOCK_WORDS), slots)
            said = slots * BLOCK_WORDS - np.where(slots > tail, lack, 0)
            in_last = np.where(slots - 1 == tail, tail_words, BLOCK_WORDS) - (said - rest)
            n_slots = turns * blocks + slots
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks), pa.array(n_slots), pa.array(np.where(slots > 0, in_last, BLOCK_WORDS))],
                                             names=[*batch.schema.names, "n_blocks", "n_slots", "last_words"])

    return sources.mapInArrow(plan, T.StructType([*sources.schema, *[T.StructField(n, T.LongType()) for n in ("n_blocks", "n_slots", "last_words")]]))


def drawn(sources: DataFrame, n_slots: int, n_sources: int) -> DataFrame:
    """shard, source_no, draws: multinomial draws of every shard, first among groups of sources, then inside them."""
    spark = sources.sparkSession
    groups = min(GROUPS, n_sources)
    grouped = sources.withColumn("group", F.floor(F.col("source_no") * groups / n_sources))
    slots_of = {r["group"]: r["slots"] for r in grouped.groupBy("group").agg(F.sum("n_slots").alias("slots")).collect()}    # GROUPS at most
    shares = np.array([slots_of.get(g, 0) for g in range(groups)], dtype=np.float64) / n_slots
    shards = -(-n_slots // SHARD_SLOTS)

    def among_groups(batches):
        import pyarrow as pa

        for batch in batches:
            out = [], [], []
            for shard in batch.column(0).to_pylist():
                size = min(SHARD_SLOTS, n_slots - shard * SHARD_SLOTS)
                counts = np.random.Generator(np.random.PCG64([SEED, shard])).multinomial(size, shares / shares.sum())
                hit = np.flatnonzero(counts)
                for column, values in zip(out, (np.full(len(hit), shard), hit, counts[hit])):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["shard", "group", "draws"])

    by_group = spark.range(shards).mapInArrow(among_groups, "shard bigint, group bigint, draws bigint")
    members = grouped.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("source_no", "n_slots"))).alias("members"))

    def inside_groups(batches):
        import pyarrow as pa

        for batch in batches:
            out = [], [], []
            for shard, group, draws, members in zip(*(batch.column(c).to_pylist() for c in ("shard", "group", "draws", "members"))):
                weight = np.array([m["n_slots"] for m in members], dtype=np.float64)
                counts = np.random.Generator(np.random.PCG64([SEED, shard, group + 1])).multinomial(draws, weight / weight.sum())
                for m, c in zip(members, counts.tolist()):
                    if c:
                        for column, value in zip(out, (shard, m["source_no"], c)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in out], names=["shard", "source_no", "draws"])

    return by_group.join(members, "group").mapInArrow(inside_groups, "shard bigint, source_no bigint, draws bigint")


def arranged(sources: DataFrame, draws: DataFrame) -> DataFrame:
    """shard, slot, source_no, block, words: every slot of the output and how many words of its block it says."""
    draws = stored(draws, "draws")
    by_source = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    by_shard = Window.partitionBy("shard").orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    numbered = draws.select("*", F.coalesce(F.sum("draws").over(by_source), zero).alias("ordinal"), F.coalesce(F.sum("draws").over(by_shard), zero).alias("at"))
    got = sources.join(draws.groupBy("source_no").agg(F.sum("draws").alias("drawn")), "source_no", "left").withColumn("drawn", F.coalesce("drawn", zero))
    over, under = F.greatest(F.col("drawn") - F.col("n_slots"), zero), F.greatest(F.col("n_slots") - F.col("drawn"), zero)
    settled = stored(running(got, [F.col("source_no")], over=over, under=under), "settled")
    each = F.explode(F.sequence(zero.cast("long"), F.col("draws") - 1))
    of_source = ["source_no", "n_blocks", "n_slots", "last_words", "source_size"]
    slots = numbered.join(settled.select(*of_source, "over"), "source_no").select("*", each.alias("k")) \
        .select("shard", (F.col("at") + F.col("k")).alias("slot"), (F.col("ordinal") + F.col("k")).alias("ordinal"), *of_source, "over")
    own = F.col("ordinal") < F.col("n_slots")
    free = slots.where(~own).select("shard", "slot", (F.col("over") + F.col("ordinal") - F.col("n_slots")).alias("free"))
    late = settled.where("n_slots > drawn").select(*of_source, "under", "drawn", F.explode(F.sequence(F.col("drawn"), F.col("n_slots") - 1)).alias("ordinal")) \
        .select("ordinal", *of_source, (F.col("under") + F.col("ordinal") - F.col("drawn")).alias("free"))
    columns = ["shard", "slot", "ordinal", *of_source]
    whole = slots.where(own).select(columns).unionByName(free.join(late, "free").select(columns))

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            no, shard, slot, ordinal, blocks, slots, last, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in (
                "source_no", "shard", "slot", "ordinal", "n_blocks", "n_slots", "last_words", "source_size"))
            turn, index = np.divmod(ordinal, np.maximum(blocks, 1))
            block = permuted(index, blocks, pass_key(no, turn))
            words = np.minimum(BLOCK_WORDS, size - block * BLOCK_WORDS)
            words = np.where(ordinal == slots - 1, np.minimum(words, last), words)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (no, block, shard, slot, words)], names=["source_no", "block", "shard", "slot", "words"])

    found = whole.mapInArrow(place, "source_no bigint, block bigint, shard bigint, slot bigint, words bigint")

    # places inside a shard are permuted, so its sources are mixed
    def shuffled(batches):
        import pyarrow as pa

        for batch in batches:
            shard, slot, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "slot", "size"))
            i = batch.schema.get_field_index("slot")
            yield batch.set_column(i, "slot", pa.array(permuted(slot, size, pass_key(shard, np.full(len(shard), 77))))).select(names)

    names = found.columns
    total = sources.agg(F.sum("n_slots")).first()[0] or 0
    sized = found.withColumn("size", F.least(F.lit(SHARD_SLOTS), F.lit(total) - F.col("shard") * SHARD_SLOTS).cast("long"))
    return sized.mapInArrow(shuffled, found.schema)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> Mix:
    """Mix documents (doc_id, text, source) by the weights of their sources, in order of the sources' code points."""
    size = F.size(F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD_PATTERN), F.lit(0))).cast("long")
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), row_name(docs).alias("name"), size.alias("size"))
    sized = stored(sized, "sized")
    known = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = running(known, [F.col("source").asc_nulls_last()], source_no=F.lit(1), start=F.col("source_size"))
    sources = stored(with_slots(targets(stored(sources, "sources"), weights, share, repeats)), "targets")
    placed = running(sized, [F.col("source").asc_nulls_last(), F.col("name"), F.col("doc_id")], row=F.lit(1), place=F.col("size"))
    packed = placed.join(sources.select(F.col("source").alias("s_"), "source_no", "start"), F.col("source").eqNullSafe(F.col("s_"))) \
        .select("row", "doc_id", "name", "size", "source_no", (F.col("place") - F.col("start")).alias("place"))
    n_sources, n_slots = sources.agg(F.count("*"), F.coalesce(F.sum("n_slots"), F.lit(0))).first()
    packed = stored(packed, "packed")
    if not n_slots:
        none = sources.sparkSession.createDataFrame([], "source_no bigint, block bigint, shard bigint, slot bigint, words bigint")
        return Mix(packed, sources, none)
    return Mix(packed, sources, stored(arranged(sources, drawn(sources, n_slots, n_sources)), "slots"))
