"""Toxicity by class-conditional Kneser-Ney word models.

Two bigram models, one of toxic and one of ordinary labelled texts, give every expression (word pair) of a
text a log-likelihood ratio; sums are normalised by length, and a logistic curve maps them to 0..1.

* Counts: for each word pair the number of toxic and of ordinary texts that hold it, over ALL labelled
  training rows. Tasks count their own rows first; Spark sums the rest by pair. A text counts a repeated
  pair once, so lines pasted a thousand times weigh like one.
* Kneser-Ney: absolute discounts estimated from the counts of counts; the word level uses continuation
  counts (distinct preceding words). Both classes back off to ONE shared distribution, the contexts in
  which both classes use a word, with one shared weight a history, and the pair level is used only for
  histories that both classes know. A rare expression thus falls back alike in both models and says
  nothing, however unequal the classes are in size.
* Words are named by 64-bit hashes. Counts stay a Spark table that grows with the words and pairs, packed by
  ``slot`` of the key (sorted keys as differences, ``SLOT_KEYS`` a slot or so).
* Scoring: equal texts are one. Texts are dealt out in chunks of about ``CHUNK_BYTES``; each chunk asks once for
  each of its words and pairs, in packed lists by slot, and gets the counts it needs. Inside a slot a key is known
  by its upper ``KEY_BITS`` bits, so a pair that was not counted is taken for another with a chance of about
  ``SLOT_KEYS`` / 2^``KEY_BITS``; whole numbers are kept exactly, probabilities to 8 bits. Pairs are asked for only where they can count: two bitmaps of fixed size, of
  the histories that both classes know and of the counted words, tell most of the others; where the bitmaps are
  full, more is asked and the result is the same. The chunks are scored in up to ``ROUNDS`` rounds.
* The logistic curve is fitted on at most ``CALIBRATION_ROWS`` labelled training rows (smallest hashes
  among an eighth of the training rows that the counts leave out).

Defined results: null and empty texts have no expression and get the curve's value at zero evidence; a
null id or label trains nothing; repeated rows are scored each; if a class has no training row the score
is 0. Extra columns are ignored (``score``) or kept as they are (``keep_clean``).
"""
from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from statlayer.session import scratch_path

from .common import discard, fold, release_executors, release_memory, release_shuffles, share, stored, strings

MAP_BITS = 18
TURN = 21                      # a pair's code: the first word's hash rotated by so many bits, xor the second's
START = 0x51ED270B1F3A6C95     # stands before the first word
CHUNK_BYTES = 4 << 20
SLOT_KEYS = 1 << 19
LEAST_SLOTS = 32
ROUNDS = 4                     # texts are scored in so many rounds, which one after the other take the same disk
ROUND_CHUNKS = 32              # a round has at least so many chunks
KEY_BITS, KEY_BYTES = 34, 5
WORD_BITS = 19                 # bitmaps of words have 2^(WORD_BITS + 6) bits
CALIBRATION_ROWS = 20_000
CALIBRATION_SHARE = 8          # one training row in so many is kept for the logistic curve
FLUSH_PAIRS = 1 << 19          # pairs a task holds before it sums them up
SEEN_TEXTS = 1 << 14           # texts a task remembers, to send repeated ones once
BLOCK_WORDS = 1 << 16          # words of a chunk whose features are computed at once (one text at least)
THRESHOLD = 0.7
find_words = re.compile(r"\w+").findall
#: of ASCII texts: word characters in lower case, all others a space
ASCII_WORDS = bytes(ord(chr(c).lower()) if c < 128 and (chr(c).isalnum() or c == ord("_")) else 32 for c in range(256))


def words_of(text: str) -> list:
    """The words of a text in lower case, as bytes or text."""
    return text.encode().translate(ASCII_WORDS).split() if text.isascii() else find_words(text.lower())


def normalised(text: str) -> bytes:
    """A text's words joined by one space."""
    words = words_of(text)
    return b" ".join(words) if text.isascii() else " ".join(words).encode("utf-8", "replace")


class Hasher:
    """Texts -> 64-bit word hashes and pair codes."""

    def word_ids(self, text: str) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words)).view(np.int64)

    def pairs(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of a text: codes, first words, second words."""
        second = self.word_ids(text or "")
        first = np.concatenate([np.full(min(1, len(second)), START, dtype=np.int64), second[:-1]])
        turned = first.view(np.uint64)
        turned = (turned << np.uint64(TURN) | turned >> np.uint64(64 - TURN)).view(np.int64)
        codes, at = np.unique(turned ^ second, return_index=True)
        return codes, first[at], second[at]

    def codes(self, text: str | None) -> np.ndarray:
        """Distinct pair codes of a text."""
        return self.pairs(text)[0]


def code_of(first: Column, second: Column) -> Column:
    """``Hasher.pairs``' code (Spark side)."""
    return F.shiftleft(first, TURN).bitwiseOR(F.shiftrightunsigned(first, 64 - TURN)).bitwiseXOR(second)


def pair_counts(labelled: DataFrame) -> DataFrame:
    """code, first, second, ordinary, toxic: in how many texts of each class a pair stands (text, toxic 0/1)."""
    def count(batches):
        import pyarrow as pa

        hasher, held, size = Hasher(), ([], []), 0

        def flush():
            ordinary, toxic = (sum(len(c) for c, *_ in h) for h in held)
            if not ordinary + toxic:
                return
            codes, first, second = (np.concatenate(x) for x in zip(*held[0], *held[1]))
            for h in held:
                h.clear()
            _, at, which = np.unique(codes, return_index=True, return_inverse=True)
            cols = [first[at], second[at], np.bincount(which[:ordinary], minlength=len(at)), np.bincount(which[ordinary:], minlength=len(at))]
            for a in range(0, len(at), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c[a:a + (1 << 16)]) for c in cols], names=["first", "second", "ordinary", "toxic"])

        for batch in batches:
            for text, toxic in zip(strings(batch.column("text")), batch.column("toxic").to_pylist()):
                found = hasher.pairs(text)
                held[int(toxic)].append(found)
                size += len(found[0])
                if size > FLUSH_PAIRS:
                    yield from flush()
                    size = 0
        yield from flush()
        del hasher
        release_memory()

    found = labelled.select("text", "toxic").mapInArrow(count, "first bigint, second bigint, ordinary bigint, toxic bigint")
    total = lambda c: F.sum(c).cast("int").alias(c)
    return found.groupBy("first", "second").agg(total("ordinary"), total("toxic")) \
        .select(code_of(F.col("first"), F.col("second")).alias("code"), "first", "second", "ordinary", "toxic")


class Counts:
    """Summed counts. ``pairs``: first, second, ordinary, toxic. ``words``: key, a to e: a word's probability in each
    class below the pair level, and as a history that both classes know what the discount leaves of each class and
    the weight of the lower level. Both are stored tables."""

    def __init__(self, pairs: DataFrame, words: DataFrame, discount: float, both: bool):
        self.pairs, self.words, self.discount, self.both = pairs, words, discount, both

    def table(self) -> DataFrame:
        """key, a to e: the rows of the words, and of the pairs (a, b: texts of each class that hold it)."""
        none = [F.lit(0.0).cast("float").alias(c) for c in "cde"]
        o, t = (F.col(c).cast("float") for c in ("ordinary", "toxic"))
        return self.pairs.select(code_of(F.col("first"), F.col("second")).alias("key"), o.alias("a"), t.alias("b"), *none).unionByName(self.words)

    def word_bits(self) -> tuple[np.ndarray, np.ndarray]:
        """Bitmaps of the histories that both classes know and of the counted words, 2^WORD_BITS rows of 64 bits."""
        bit = F.expr("shiftleft(1L, cast(key & 63 as int))")
        rows = self.words.groupBy(F.shiftrightunsigned("key", 64 - WORD_BITS).alias("row")) \
            .agg(F.bit_or(F.when(F.col("e") > 0, bit).otherwise(F.lit(0))).alias("known"), F.bit_or(bit).alias("counted")).toPandas()
        maps = np.zeros((2, 1 << WORD_BITS), dtype=np.uint64)
        maps[:, rows["row"].to_numpy(dtype=np.int64)] = rows[["known", "counted"]].to_numpy(dtype=np.int64).T.view(np.uint64)
        return maps[0], maps[1]


def learn_counts(labelled: DataFrame) -> Counts:
    """Counts, discounts and the word level of all labelled texts."""
    pairs = stored(pair_counts(labelled).drop("code"), "pairs")
    release_shuffles(pairs.sparkSession)
    release_executors(pairs.sparkSession)
    o, t = F.col("ordinary"), F.col("toxic")
    one = lambda c: F.sum(c.cast("long"))
    words = stored(pairs.groupBy(F.col("second").alias("key")).agg(
        one(o > 0).alias("n0"), one(t > 0).alias("n1"), one((o > 0) & (t > 0)).alias("shared"),
        one(o + t == 1).alias("once"), one(o + t == 2).alias("twice")), "words")
    got = words.agg(F.count("*").alias("size"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n0", "n1", "shared", "once", "twice")],
                    F.count_if(F.col("n1") == 1).alias("first"), F.count_if(F.col("n1") == 2).alias("second")).first()
    pair_discount = got["once"] / (got["once"] + 2 * got["twice"]) if got["once"] else 0.5
    word_discount = got["first"] / (got["first"] + 2 * got["second"]) if got["first"] else 0.5
    gamma = min(0.9, word_discount * got["size"] / max(1, got["n0"] + got["n1"]))
    spread = got["shared"] + 0.25 * (got["size"] + 1)              # one more word stands for all that were not counted
    kept = [F.greatest(F.col(c) - F.lit(word_discount), F.lit(0.0)) for c in ("n0", "n1")]
    sums = words.agg(*[F.coalesce(F.sum(k), F.lit(0.0)) for k in kept]).first()
    low = words.select("key", *[(F.lit((1 - gamma) / max(s, 1e-9)) * k + F.lit(gamma / spread) * (F.col("shared") + 0.25)).alias(c)
                                for k, s, c in zip(kept, sums, "ab")])
    d = F.lit(pair_discount)
    histories = pairs.groupBy(F.col("first").alias("key")).agg(
        (F.sum(o) - d * one(o > 0)).alias("c"), (F.sum(t) - d * one(t > 0)).alias("d"),
        F.least(F.greatest(d * F.count("*") / F.sum(o + t), F.lit(1e-3)), F.lit(1.0)).alias("e")).where("c > 1e-9 and d > 1e-9")
    both = low.join(histories, "key", "full")
    model = stored(both.select("key", *[F.coalesce(c, F.lit(0.0)).cast("float").alias(c) for c in "abcde"]), "model")
    discard(words)
    return Counts(pairs, model, pair_discount, bool(got["n0"] and got["n1"]))


def zipped(rows: np.ndarray, width: int) -> bytes:
    """Whole numbers or records as byte planes (the first ``width`` bytes of each), compressed."""
    import pyarrow as pa

    planes = np.ascontiguousarray(rows.view(np.uint8).reshape(len(rows), rows[:1].size * rows.itemsize if len(rows) else width)[:, :width].T)
    return len(rows).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unzipped(raw: bytes, width: int, size: int, kind) -> np.ndarray:
    """``zipped`` undone: [n, size / item size] of a numpy type, bytes beyond ``width`` are zero."""
    import pyarrow as pa

    n = int.from_bytes(raw[:8], "little")
    out = np.zeros((n, size), dtype=np.uint8)
    if n:
        out[:, :width] = np.frombuffer(pa.decompress(raw[8:], n * width, codec="zstd", asbytes=True), dtype=np.uint8).reshape(width, n).T
    return out.view(kind)


def shortened(values: np.ndarray) -> np.ndarray:
    """Counts as they are packed: whole numbers as they are, others to 8 bits."""
    values = values.astype(np.float32)
    rounded = (values.view(np.uint32) + np.uint32(0x8000) & np.uint32(0xFFFF0000)).view(np.float32)
    return np.where(values == np.floor(values), values, rounded)


def zipped_keys(keys: np.ndarray, width: int) -> bytes:
    """Ascending unsigned keys as differences."""
    return zipped(np.diff(keys, prepend=np.uint64(0)), width)


def unzipped_keys(raw: bytes, width: int) -> np.ndarray:
    return np.cumsum(unzipped(raw, width, 8, np.uint64).ravel(), dtype=np.uint64)


class Packed:
    """The counts as scoring reads them: a stored row a slot, the number of slots, and the bitmaps of words."""

    def __init__(self, counts: Counts):
        import pyarrow as pa

        self.slots = slots = max(LEAST_SLOTS, (counts.pairs.count() + counts.words.count()) // SLOT_KEYS)

        def pack(group):
            keys = group.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - KEY_BITS)
            order = np.argsort(keys)
            values = shortened(np.stack([group.column(c).to_numpy().astype(np.float32) for c in "abcde"], axis=1)[order])
            return pa.table({"slot": group.column("slot")[:1], "keys": pa.array([zipped_keys(keys[order], KEY_BYTES)], type=pa.binary()),
                             "counts": pa.array([zipped(values, 20)], type=pa.binary())})

        by_slot = counts.table().withColumn("slot", slot_of(F.col("key"), slots)).groupBy("slot")
        self.rows = stored(by_slot.applyInArrow(pack, "slot bigint, keys binary, counts binary"), "packed")
        self.bits = counts.word_bits()
        self.discount, self.both = counts.discount, counts.both


def slot_of(key, slots: int):
    """Where a key is looked up: its low 31 bits modulo the slots (numpy and Spark side)."""
    return (key.bitwiseAND(F.lit(0x7FFFFFFF)) if isinstance(key, Column) else key & 0x7FFFFFFF) % slots


def numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of normalised texts: words a text, the number of each word by first appearance, and the numbered words' hashes.

    Arrow cuts and numbers the words; Python sees each distinct one once."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = np.fromiter((t.count(b" ") + 1 if t else 0 for t in texts), dtype=np.int64, count=len(texts))
    if not sizes.any():
        return sizes, np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)
    words = pc.split_pattern(pa.array([b" ".join(filter(None, texts))], type=pa.large_string()), pattern=" ").flatten().dictionary_encode()
    hashes = np.fromiter(map(xxh3_64_intdigest, words.dictionary.to_numpy(zero_copy_only=False)), dtype=np.uint64, count=len(words.dictionary))
    return sizes, words.indices.to_numpy(), hashes.view(np.int64)


class ChunkPairs:
    """The distinct words and pairs of a chunk's texts (normalised: words joined by one space), as numbers.

    ``words``: 64-bit hashes of the chunk's vocabulary, START last. ``pairs``: the chunk's distinct pairs, first * v +
    second. ``sizes``, ``word`` and ``pair``: words a text, and each word and pair, repeats included, text by text."""

    def __init__(self, texts: list[bytes]):
        self.sizes, self.word, hashes = numbered(texts)
        self.n, self.v = len(texts), len(hashes) + 1
        self.words = np.append(hashes, START)
        self.pair = np.empty(len(self.word), dtype=np.int64)
        self.pair[1:] = self.word[:-1]
        self.pair[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = self.v - 1
        self.pair *= self.v
        self.pair += self.word
        pairs = np.sort(self.pair)
        self.pairs = pairs[np.concatenate([[True], np.diff(pairs) != 0])[:len(pairs)]]

    def firsts(self) -> np.ndarray:
        return self.pairs // self.v

    def seconds(self) -> np.ndarray:
        return self.pairs % self.v

    def codes(self) -> np.ndarray:
        """Pair codes, as ``Hasher.pairs`` gives them."""
        turned = self.words[self.firsts()].view(np.uint64)
        return (turned << np.uint64(TURN) | turned >> np.uint64(64 - TURN)).view(np.int64) ^ self.words[self.seconds()]

    def evidence(self, word: np.ndarray, pair: np.ndarray, discount: float) -> np.ndarray:
        """[texts, 10] features from the counts [n, 5] of the words and of the distinct pairs."""
        low = np.where(word[:, :2] > 0, word[:, :2], 1.0)
        first, second = self.firsts(), self.seconds()
        known = word[first, 4] > 0
        back = np.where(known, word[first, 4], 1.0)
        high = [(1 - back) * np.maximum(pair[:, c] - discount, 0) / np.where(known, word[first, 2 + c], np.inf) + back * low[second, c] for c in (0, 1)]
        word_ratio, pair_ratio = np.log(low[:, 1]) - np.log(low[:, 0]), np.log(high[1]) - np.log(high[0])
        del low, first, second, known, back, high
        ends, out = np.concatenate([[0], np.cumsum(self.sizes)]), np.zeros((self.n, 10))
        cuts = np.flatnonzero(np.diff(ends[:-1] // BLOCK_WORDS)) + 1
        for a, b in zip([0, *cuts], [*cuts, self.n]):   # a text's features need no other text
            own, text = slice(ends[a], ends[b]), np.repeat(np.arange(b - a, dtype=np.int32), self.sizes[a:b])
            of, found = distinct_of(text, self.word[own], self.v)
            out[a:b, :5] = level_features(word_ratio[found], of, b - a)
            of, found = distinct_of(text, self.pair[own], self.v * self.v)
            out[a:b, 5:] = level_features(pair_ratio[np.searchsorted(self.pairs, found)], of, b - a)
        return out


def distinct_of(text: np.ndarray, item: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, item), by text, then item; items lie below ``bound``."""
    if not len(text):
        return text, item
    if (int(text[-1]) + 1) * bound < 1 << 62:
        both = text * np.int64(bound)
        both += item
        both.sort()
        both = both[np.concatenate([[True], np.diff(both) != 0])]
        text = (both // bound).astype(np.int32)
        both %= bound
        return text, both
    order = np.lexsort((item, text))                    # very many small texts
    text, item = text[order], item[order]
    fresh = np.concatenate([[True], (np.diff(text) != 0) | (np.diff(item) != 0)])
    return text[fresh], item[fresh]


def level_features(ratio: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """[n, 5] for ratios grouped by text: the mean, the mean excess over 1, the mean of the strongest hundredth, the
    single strongest and the log of the whole excess; zeros for texts without any."""
    out = np.zeros((n, 5))
    size = np.bincount(text, minlength=n)
    has = np.flatnonzero(size)
    if not len(has):
        return out
    size = size[has]
    start = np.cumsum(size) - size
    over = np.add.reduceat(np.maximum(ratio - 1, 0), start)
    most = np.maximum.reduceat(ratio, start)
    top = most.copy()                                   # up to 199 items the strongest hundredth is one item
    for i in np.flatnonzero(size >= 200):
        k = size[i] // 100
        top[i] = np.partition(ratio[start[i]:start[i] + size[i]], size[i] - k)[-k:].mean()
    out[has] = np.c_[np.add.reduceat(ratio, start) / size, over / (size + 10), top, most, np.log1p(over)]
    return out


EVIDENCE = "name1 bigint, name2 bigint, evidence array<double>"


def stands(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key's bit is set."""
    keys = keys.view(np.uint64)
    return bits[(keys >> np.uint64(64 - WORD_BITS)).astype(np.int64)] >> (keys & np.uint64(63)) & np.uint64(1) > 0


def evidence(texts: DataFrame, packed: Packed) -> DataFrame:
    """name1, name2 (the text's 64-bit hashes), evidence: one row a distinct text, as a stored table. The texts are read
    once a round; a round takes its share of the chunks and frees its shuffles before the next one starts."""
    import pyarrow as pa

    named = texts.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .select(F.xxhash64("text").alias("name1"), F.xxhash64(F.lit(1), "text").alias("name2"), "text")
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, slots, discount = int(total) // CHUNK_BYTES + 1, packed.slots, packed.discount
    rounds = max(1, min(ROUNDS, chunks // ROUND_CHUNKS))
    spark = texts.sparkSession
    bits = share(spark, packed.bits)

    def first_seen(batches):
        """Each text once (of those in memory), as its words, compressed."""
        seen = set()
        for batch in batches:
            out = [], [], []
            for n1, n2, text in zip(batch.column("name1").to_pylist(), batch.column("name2").to_pylist(), strings(batch.column("text"))):
                if len(seen) > SEEN_TEXTS:
                    seen.clear()
                if (n1, n2) not in seen:
                    seen.add((n1, n2))
                    words = normalised(text)
                    for column, x in zip(out, (n1, n2, len(words).to_bytes(8, "little") + pa.compress(words, codec="zstd", asbytes=True))):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], type=pa.int64()), pa.array(out[1], type=pa.int64()), pa.array(out[2], type=pa.binary())],
                                             names=["name1", "name2", "words"])

    chunk = F.pmod("name1", F.lit(chunks))
    upper = np.uint64(64 - KEY_BITS)

    def read(group):
        """Names and pairs of the distinct texts of a chunk; its words' and pairs' keys, and which are asked for."""
        found = {}
        for n1, n2, raw in zip(*(group.column(c).to_pylist() for c in ("name1", "name2", "words"))):
            if (n1, n2) not in found:
                found[n1, n2] = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)
        pairs, (known, counted) = ChunkPairs(list(found.values())), bits()
        codes, words = pairs.codes(), pairs.words
        own = np.flatnonzero(stands(known, words)[pairs.firsts()] & stands(counted, words)[pairs.seconds()])
        keys = np.concatenate([words, codes[own]])
        return list(found), pairs, own, keys

    def by_slot(keys):
        """The order that sorts keys by slot and size, and for each slot its first and last place there."""
        order = np.argsort(keys.view(np.uint64))
        order = order[np.argsort(slot_of(keys[order], slots).astype(np.min_scalar_type(slots)), kind="stable")]
        slot = slot_of(keys[order], slots)
        start = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        return order, dict(zip(slot[start].tolist(), zip(start.tolist(), [*start[1:].tolist(), len(keys)])))

    def ask(group):
        *_, keys = read(group)
        order, places = by_slot(keys)
        tops = keys[order].view(np.uint64) >> upper
        out = pa.table({"chunk": pa.array([group.column("chunk")[0].as_py()] * len(places), type=pa.int64()), "slot": pa.array(list(places), type=pa.int64()),
                        "keys": pa.array([zipped_keys(tops[a:b], KEY_BYTES) for a, b in places.values()], type=pa.binary())})
        del keys, order, tops
        release_memory()
        return out

    def answer(asked, known):
        """Which keys of each list of a slot have counts, and these counts."""
        out = {"chunk": [], "slot": [], "places": [], "found": []}
        if known.num_rows:
            have = unzipped_keys(known.column("keys")[0].as_py(), KEY_BYTES)
            value = unzipped(known.column("counts")[0].as_py(), 20, 20, np.float32)
            for c, n, raw in zip(*(asked.column(x).to_pylist() for x in ("chunk", "slot", "keys"))):
                own = unzipped_keys(raw, KEY_BYTES)
                at = np.minimum(np.searchsorted(have, own), len(have) - 1)
                hit = have[at] == own
                for x, v in zip(out.values(), (c, n, np.packbits(hit).tobytes(), zipped(value[at[hit]], 20))):
                    x.append(v)
        return pa.table({k: pa.array(v, type=pa.int64() if k in ("chunk", "slot") else pa.binary()) for k, v in out.items()})

    def weigh(group, answers):
        names, pairs, own, keys = read(group)
        order, places = by_slot(keys)
        value = np.zeros((len(keys), 5), dtype=np.float32)
        for n, hits, found in zip(*(answers.column(x).to_pylist() for x in ("slot", "places", "found"))):
            a, b = places[n]
            value[order[a:b][np.unpackbits(np.frombuffer(hits, dtype=np.uint8), count=b - a).astype(bool)]] = unzipped(found, 20, 20, np.float32)
        pair = np.zeros((len(pairs.pairs), 2), dtype=np.float32)
        pair[own] = value[pairs.v:, :2]
        out = pairs.evidence(value[:pairs.v].astype(np.float64), pair, discount)
        scored = pa.table({"name1": pa.array([a for a, _ in names], type=pa.int64()), "name2": pa.array([b for _, b in names], type=pa.int64()),
                           "evidence": pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), 10).cast(pa.list_(pa.float64()))})
        del names, pairs, own, keys, order, value, pair, out
        release_memory()
        return scored

    def weighed(turn: int) -> DataFrame:
        dealt = named.where(chunk % rounds == turn).mapInArrow(first_seen, "name1 bigint, name2 bigint, words binary").withColumn("chunk", chunk)
        asked = dealt.groupBy("chunk").applyInArrow(ask, "chunk bigint, slot bigint, keys binary")
        answers = asked.groupBy("slot").cogroup(packed.rows.groupBy("slot")).applyInArrow(answer, "chunk bigint, slot bigint, places binary, found binary")
        return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(weigh, EVIDENCE)

    path = scratch_path(spark, "evidence")
    for turn in range(rounds):
        weighed(turn).write.mode("append").parquet(path)
        release_shuffles(spark)
        release_executors(spark)
    found = spark.read.schema(EVIDENCE).parquet(path)
    found.stored_at = path
    return found


class Model:
    """The counts, and the logistic curve over a text's features."""

    def __init__(self, counts: Packed | None):
        self.counts, self.both, self.curve = counts, counts is not None, None

    def fit_curve(self, features: np.ndarray, toxic: np.ndarray) -> None:
        """Ridge logistic regression by Newton steps."""
        if not self.both or not len(toxic) or toxic.min() == toxic.max():
            self.both = False
            return
        mean, dev = features.mean(axis=0), features.std(axis=0) + 1e-6
        x = np.c_[(features - mean) / dev, np.ones(len(features))]
        w, ridge = np.zeros(x.shape[1]), np.r_[np.full(x.shape[1] - 1, 0.5), 1e-6]
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
            w -= np.linalg.solve(hessian, x.T @ (p - toxic) + ridge * w)
        self.curve = (mean, dev, w)

    def probability(self, found: Column) -> Column:
        """The curve's value for a column of features."""
        mean, dev, w = self.curve
        z = F.lit(float(w[-1]))
        for k in range(len(mean)):
            z = z + (found[k] - float(mean[k])) / float(dev[k]) * float(w[k])
        return 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))


def train(docs: DataFrame, labels: DataFrame, holdout: tuple[int, int] = (3, 1)) -> Model:
    """Learn from the labelled rows outside the held-out fold (crc32 of the id mod first != second)."""
    parts, held = holdout
    own = labels.select(F.col("doc_id").alias("id_"), "toxic").where("toxic in (0, 1) and doc_id is not null") \
        .where(fold(F.col("doc_id"), parts) != held).groupBy("id_").agg(F.max("toxic").alias("toxic"))
    # unlabelled texts are left out before the shuffle by a bitmap of the labelled ids' hashes; it has at
    # most 2^MAP_BITS rows of 64 bits, so it can be broadcast, and a full one only spares nothing
    hashed = F.xxhash64("id_", F.lit(2))
    word, bit = F.shiftrightunsigned(hashed, 64 - MAP_BITS), F.expr("shiftleft(1L, cast(xxhash64(id_, 2) & 63 as int))")
    present = own.groupBy(word.alias("word_")).agg(F.bit_or(bit).alias("bits_"))
    rows = docs.select(F.col("doc_id").alias("id_"), F.col("text").cast("string").alias("text")) \
        .where(fold(F.col("id_"), parts) != held).withColumn("word_", word).join(F.broadcast(present), "word_") \
        .where(F.col("bits_").bitwiseAND(bit) != 0).select("id_", "text").join(own, "id_")
    part = F.pmod(F.xxhash64("id_"), F.lit(CALIBRATION_SHARE))
    counts = learn_counts(rows.where(part != 0))
    model = Model(Packed(counts) if counts.both else None)
    discard(counts.pairs, counts.words)
    release_executors(docs.sparkSession)
    if not model.both:
        return model
    text = F.coalesce("text", F.lit(""))
    drawn = stored(rows.where(part == 0).select(text.alias("text"), "toxic", F.xxhash64("id_", F.lit(1)).alias("order_"))
                    .orderBy("order_").limit(CALIBRATION_ROWS), "calibration")
    found = evidence(drawn, model.counts)
    sample = drawn.select("toxic", "order_", F.xxhash64("text").alias("name1"), F.xxhash64(F.lit(1), "text").alias("name2")) \
        .join(found, ["name1", "name2"]).select("toxic", "order_", "name1", "evidence").toPandas().sort_values(["order_", "name1", "toxic"])
    discard(drawn, found)
    model.fit_curve(np.array(sample["evidence"].tolist()).reshape(len(sample), 10), sample["toxic"].to_numpy(dtype=float))
    return model


def text_scores(docs: DataFrame, model: Model) -> DataFrame:
    """name1_, name2_, score_ of every distinct text."""
    found = evidence(docs.select("text"), model.counts)
    return found.select(F.col("name1").alias("name1_"), F.col("name2").alias("name2_"), model.probability(F.col("evidence")).alias("score_"))


def names_of(text: Column) -> tuple[Column, Column]:
    """The two hashes that name a text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0..1) for every row."""
    if not model.both or model.curve is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    a, b = names_of(F.col("text"))
    return docs.select("doc_id", a.alias("name1_"), b.alias("name2_")).join(text_scores(docs, model), ["name1_", "name2_"]) \
        .select("doc_id", F.col("score_").alias("score"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose score stays under the threshold, all columns as they are."""
    if not model.both or model.curve is None:
        return docs.where(F.lit(0.0 < threshold))
    toxic = stored(text_scores(docs, model).where(F.col("score_") >= threshold).select("name1_", "name2_"), "toxic")
    a, b = names_of(docs["text"])
    return docs.join(toxic, (a == toxic["name1_"]) & (b == toxic["name2_"]), "left_anti")
