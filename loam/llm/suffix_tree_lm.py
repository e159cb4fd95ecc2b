"""LM scoring: a probabilistic suffix tree over words, above an add-half model of single words."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.llm import common

FOLDS, HELD = 5, 1
#: Longest context, in words.
MAX_DEPTH = 3
#: Sequences that training texts have less often are no contexts, nor symbols after them; the same at every size.
MIN_COUNT = 5
#: A symbol diverges after a context if it comes this many times as often as after the context's longest retained
#: suffix, with a likelihood gain of this many nats. Contexts without a diverging symbol aren't retained.
MIN_RATIO, MIN_GAIN = 1.5, 6.0
#: Weight of the shorter context's distribution in the smoothing, as so many observations.
PRIOR = 2.0
#: A text's start, which is only a context, and its end, which is a token. No word has a blank.
START, END = b" <", b" >"
#: Tokens and texts of a block, the unit that is counted and scored together; a longer text is a block of its own.
BLOCK_TOKENS, BLOCK_DOCS = 2_000_000, 1 << 16
#: Tokens of the corpus for each bucket that sequences are dealt to by hash, and buckets at least.
BUCKET_TOKENS, MIN_BUCKETS = 1_000_000, 32
#: Sequences that are more frequent, and have more than this share of all tokens, are dealt to buckets with what follows.
HOT_COUNT, HOT_SHARE = 200_000, 1e-5
#: Bits of a filter, least and most, and of one of its pages.
FILTER_BITS, PAGE_BITS = (1 << 17, 1 << 28), 1 << 17


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased; bytes split and lower at exactly those characters."""
    return (text or "").encode().lower().split()


class Numbers(dict):
    """A number for each word, in the order of first appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(head: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The key of a sequence from the keys of it without its last and without its first word."""
    x = head * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x = (x + suffix) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def longer(keys: np.ndarray) -> np.ndarray:
    """Keys of the sequences one word longer, by their first word's place."""
    return mix(keys[:-1], keys[1:])


def inside(of: np.ndarray, size: int) -> np.ndarray:
    """Of `size` sequences by their first word's place: those within one text."""
    return of[:size] == of[len(of) - size :]


def starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new combination of keys begins, and the end."""
    n = len(sorted_keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = reduce(np.logical_or, [k[1:] != k[:-1] for k in sorted_keys])
    return np.append(np.flatnonzero(new), n)


def marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(len(bits) * 8 - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def mark(keys: DataFrame, n: int) -> np.ndarray:
    """Bits that are set for each of n keys. Others may share one of its bits, more often the more keys there are: who
    asks the filter compares afterwards."""
    size = min(max(1 << (16 * n).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])

    def page(of: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(PAGE_BITS, bool)
        for batch in batches:
            flags[batch.column("bit").to_numpy() % PAGE_BITS] = True
        yield pa.RecordBatch.from_arrays([pa.array([of[0].as_py()], pa.int64()), pa.array([np.packbits(flags, bitorder="little").tobytes()])], names=["page", "bits"])

    at = F.col("key").bitwiseAND(F.lit(size - 1))
    pages = keys.select(at.alias("bit"), F.shiftright(at, PAGE_BITS.bit_length() - 1).alias("page")).groupBy("page").applyInArrow(page, "page long, bits binary")
    out = np.zeros(size // 8, np.uint8)
    for r in pages.toLocalIterator():
        out[r.page * PAGE_BITS // 8 : (r.page + 1) * PAGE_BITS // 8] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def read_blocks(docs: DataFrame, key: str) -> DataFrame:
    """Texts as blocks: ids, held_out and n_tokens of a block's texts, its distinct words, and all its tokens as numbers of
    those words, in four planes of bytes, both packed. Words 0 and 1 are START and END, which enclose each text."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.return_memory()
        block, schema, pack = TaskContext.get().partitionId() << 32, None, zstandard.ZstdCompressor(level=3)
        numbers, ids, held, sizes, found, total = Numbers({START: 0, END: 1}), [], [], [], [], 0

        def handed() -> pa.RecordBatch:
            nonlocal block, numbers, ids, held, sizes, found, total
            flat = np.concatenate(found)
            # the most frequent words get the least numbers, whose higher bytes are mostly alike
            often = np.bincount(flat, minlength=len(numbers))
            often[:2] = len(flat) + 2, len(flat) + 1
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            words = list(numbers)
            packed = pack.compress(rank[flat].view(np.uint8).reshape(-1, 4).T.tobytes())
            joined = pack.compress(b" ".join([words[i] for i in order[2:].tolist()]))
            cols = [[block], [ids], [held], [sizes], [joined], [packed]]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, schema, strict=True)], names=["block", "ids", "held", "sizes", "words", "tokens"])
            block, numbers, ids, held, sizes, found, total = block + 1, Numbers({START: 0, END: 1}), [], [], [], [], 0
            return out

        for batch in batches:
            schema = [pa.int64(), pa.list_(batch.column(0).type), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            for i, held_out, text in zip(batch.column(0).to_pylist(), batch.column("held_out").to_pylist(), batch.column("text"), strict=True):
                ws = tokens(text.as_py())
                if total and (total + len(ws) > BLOCK_TOKENS or len(ids) == BLOCK_DOCS):
                    yield handed()
                found.append(np.fromiter(itertools.chain((0,), map(numbers.__getitem__, ws), (1,)), np.uint32, len(ws) + 2))
                ids.append(i), held.append(held_out), sizes.append(len(ws) + 1)
                total += len(ws) + 2
        if total:
            yield handed()

    rows = docs.select(key, "held_out", "text").mapInArrow(run, f"block long, ids array<{kind}>, held array<boolean>, sizes array<long>, words binary, tokens binary")
    return common.shared_table(rows, "lm-blocks")


class Block:
    """What a row of read_blocks holds: words, and for every token its number and the place of its text."""

    def __init__(self, words: bytes, packed: bytes, sizes: np.ndarray, held: np.ndarray) -> None:
        unpack = zstandard.ZstdDecompressor()
        self.words = [START, END, *unpack.decompress(words).split()]
        self.numbers = np.ascontiguousarray(np.frombuffer(unpack.decompress(packed), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
        self.of = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes + 1)
        self.trains = np.repeat(~held, sizes + 1)


def each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            block, words, packed = (batch.column(c)[i].as_py() for c in ("block", "words", "tokens"))
            yield block, Block(words, packed, batch.column("sizes")[i].values.to_numpy(), batch.column("held")[i].values.to_numpy(zero_copy_only=False))


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The runs of a sorted array of buckets."""
    cuts = starts(bucket)
    for a, b in itertools.pairwise(cuts.tolist()):
        yield int(bucket[a]), slice(a, b)


def word_buckets(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of a block but START and END in the order of their buckets, and these."""
    to = (hashes(words[2:]) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(to, kind="stable")
    return order + 2, to[order]


def count_words(blocks: DataFrame, buckets: int, least: int) -> DataFrame:
    """Counts of words in training texts. Each block sends its distinct words to buckets by hash; a bucket adds up. Rows with
    a block: the counts (data) of what that block has sent to a bucket. Other rows: keys and counts n of a bucket's words of
    `least` occurrences, and how many tokens and distinct words training texts have."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.return_memory()
        for block, b in each_block(batches):
            times = np.bincount(b.numbers[b.trains], minlength=len(b.words)).astype(np.uint32)
            order, to = word_buckets(b.words, buckets)
            rows = [(bucket, block, b" ".join([b.words[w] for w in order[at].tolist()]), times[order[at]].tobytes()) for bucket, at in by_bucket(to)]
            if rows:
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "block", "words", "times"])

    def add(of: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, sent = Numbers(), []
        for batch in batches:
            for block, words, times in zip(batch.column("block").to_pylist(), batch.column("words"), batch.column("times"), strict=True):
                ws = words.as_py().split()
                sent.append((block, np.fromiter(map(numbers.__getitem__, ws), np.int64, len(ws)), np.frombuffer(times.as_py(), np.uint32)))
        c = np.zeros(len(numbers), np.int64)
        for _, at, times in sent:
            c[at] += times  # a block has a word once
        out = [(block, of[0].as_py(), c[at].astype(np.uint32 if c.max(initial=0) < 1 << 32 else np.int64).tobytes(), None, None, None, None) for block, at, _ in sent]
        keys = hashes([w for w, n in zip(numbers, c.tolist(), strict=True) if n >= least]).view(np.int64)
        out.append((None, None, None, keys, c[c >= least], int(c.sum()), int((c > 0).sum())))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["block", "bucket", "data", "keys", "n", "tokens", "distinct"])

    sent = blocks.mapInArrow(send, "bucket int, block long, words binary, times binary")
    return common.shared_table(sent.groupBy("bucket").applyInArrow(add, "block long, bucket int, data binary, keys array<long>, n array<long>, tokens long, distinct long"), "lm-words")


def count_sequences(blocks: DataFrame, k: int, known: DataFrame, n_known: int, buckets: int, least: int, tokens_: int) -> DataFrame:
    """(key, head, suffix, n): sequences of k words that training texts have `least` times, with the keys of them without
    their last and without their first word. known: those of k - 1 words. Every block sends each sequence it has once,
    with its count, if `known` may have its head and its suffix, to the bucket of its head. What follows a head that is
    very frequent is dealt to all buckets."""
    spark = blocks.sparkSession
    hot = known.where(F.col("n") >= max(HOT_COUNT, HOT_SHARE * tokens_)).select("key").toArrow()  # 1 / HOT_SHARE rows at most
    hot = np.sort(np.array(hot.column("key"), np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast((mark(known, n_known), hot))
    # of a corpus so large that 1 / HOT_SHARE buckets are few, all heads are split by what follows, into so many parts
    split = max(0, int(buckets * HOT_SHARE)).bit_length()

    def bucket_of(head: np.ndarray, suffix: np.ndarray, hot: np.ndarray) -> np.ndarray:
        often = hot[np.minimum(np.searchsorted(hot, head), len(hot) - 1)] == head if len(hot) else np.zeros(len(head), bool)
        part = suffix >> np.uint64(64 - split) if split else np.uint64(0)
        return mix(head, np.where(often, suffix, part)) % np.uint64(buckets)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.return_memory()
        bits, hot = shared.value
        for _, b in each_block(batches):
            keys = hashes(b.words)[b.numbers]
            for _ in range(k - 2):
                keys = longer(keys)
            ok = marked(bits, keys)
            ok = ok[:-1] & ok[1:] & b.trains[: max(len(keys) - 1, 0)] & inside(b.of, max(len(keys) - 1, 0))
            at = np.flatnonzero(ok)
            key = mix(keys[at], keys[at + 1])
            order = np.argsort(key)
            cuts = starts(key[order])
            at, times = at[order[cuts[:-1]]], np.diff(cuts).astype(np.uint32)
            head, suffix = keys[at], keys[at + 1]
            to = bucket_of(head, suffix, hot)
            order = np.argsort((to << np.uint64(40)) | (head >> np.uint64(24)))
            head, suffix, times, to = head[order], suffix[order], times[order], to[order]
            rows = []
            for bucket, s in by_bucket(to):
                cuts = starts(head[s])
                rows.append((bucket, head[s][cuts[:-1]].tobytes(), np.diff(cuts).astype(np.uint32).tobytes(), suffix[s].tobytes(), times[s].tobytes()))
            if rows:
                kinds = [pa.int32(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "heads", "runs", "suffixes", "times"])

    def add(of: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for r in batch.to_pylist():
                found.append((np.repeat(np.frombuffer(r["heads"], np.uint64), np.frombuffer(r["runs"], np.uint32)), np.frombuffer(r["suffixes"], np.uint64), np.frombuffer(r["times"], np.uint32)))
        head, suffix, times = (np.concatenate(x) for x in zip(*found, strict=True))
        key = mix(head, suffix)
        order = np.argsort(key)
        cuts = starts(key[order])
        n = np.add.reduceat(times[order].astype(np.int64), cuts[:-1])
        at = order[cuts[:-1][n >= least]]
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (key[at], head[at], suffix[at], n[n >= least])], names=["key", "head", "suffix", "n"])

    sent = blocks.mapInArrow(send, "bucket int, heads binary, runs binary, suffixes binary, times binary")
    return common.shared_table(sent.groupBy("bucket").applyInArrow(add, "key long, head long, suffix long, n long"), f"lm-counts-{k}")


def weigh(blocks: DataFrame, known: DataFrame, root, buckets: int, least: int, max_depth: int, n_tokens: int) -> DataFrame | None:
    """(key, weight): what each occurrence of a sequence adds to the log10 probability of its text by single words.

    A token's probability is that of the longest retained context before it. If the token diverges there, this is its own
    p; else it is `fall` times its probability after the next shorter one. In logarithms that is a sum: a retained
    context adds `fall` to the token behind it, and a context with a diverging token adds the rest up to p. A sequence that is
    both has two rows. known: (key, n) of single words; root: log10 probability of a count."""
    known = common.shared_table(known.withColumn("log_p", root(F.col("n"))), "lm-sequences-1")
    tables, weights = [known], []
    for k in range(2, max_depth + 2):
        n = known.count()
        if not n:
            break
        found = count_sequences(blocks, k, known, n, buckets, least, n_tokens)
        common.release(blocks.sparkSession)
        of_head = known.select(F.col("key").alias("head"), F.col("n").alias("n_head"))
        of_suffix = known.select(F.col("key").alias("suffix"), F.col("log_p").alias("before"))
        was = F.pow(F.lit(10.0), "before")
        ratio = F.col("n") / F.col("n_head") / was
        p = (F.col("n") + PRIOR * was) / (F.col("n_head") + PRIOR)
        diverges = (ratio >= MIN_RATIO) & (F.col("n") * F.log(ratio) >= MIN_GAIN)
        own = found.join(of_suffix.hint("merge"), "suffix").join(of_head.hint("merge"), "head").select("key", "head", "n", "before", was.alias("was"), p.alias("p"), diverges.alias("diverges"))
        left = lambda c: F.greatest(1 - F.sum(c), F.lit(1e-12))
        # own is dealt by head already, so that neither the sums by head nor their join moves it again
        falls = own.where("diverges").groupBy("head").agg(F.log10(left("p") / left("was")).alias("fall"), F.min("key").alias("first"))
        joined = own.join(falls.hint("merge"), "head", "left")
        log_p = F.when(F.col("diverges"), F.log10("p")).otherwise(F.col("before") + F.coalesce(F.col("fall"), F.lit(0.0)))
        rest = F.when(F.col("diverges"), F.log10("p") - F.col("before") - F.col("fall")).alias("rest")
        # a context's weight stands beside the first of its diverging symbols
        once = lambda c: F.when(F.col("key") == F.col("first"), F.col(c)).alias(c)
        known = common.shared_table(joined.select("key", "n", log_p.alias("log_p"), rest, once("head"), once("fall")), f"lm-sequences-{k}")
        weights += [known.where("rest is not null").select("key", F.col("rest").alias("weight")), known.where("fall is not null").select(F.col("head").alias("key"), F.col("fall").alias("weight"))]
        tables.append(known)
        common.drop_tables(found)
    if not weights:
        return None
    out = common.shared_table(reduce(DataFrame.unionByName, weights), "lm-weights")
    common.drop_tables(*tables)
    return out


def asked(b: Block, bits: np.ndarray, max_depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For sequences of each length k: the distinct keys that may have a weight, in order, how often the block has each, and
    the places of the texts that have them, key by key. Single words come once, without places."""
    keys = hashes(b.words)
    own = np.sort(keys[marked(bits, keys)])
    yield 1, own, np.ones(len(own), np.int64), np.zeros(0, np.uint16)
    keys = keys[b.numbers]
    for k in range(2, max_depth + 2):
        keys = longer(keys)
        at = np.flatnonzero(marked(bits, keys) & inside(b.of, len(keys)))
        key, place = keys[at], b.of[at]
        order = np.argsort(key)
        key = key[order]
        cuts = starts(key)
        yield k, key[cuts[:-1]], np.diff(cuts), place[order]


def key_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the keys."""
    return ((keys >> np.uint64(33)) * np.uint64(buckets) >> np.uint64(31)).astype(np.int64)


def look_up(blocks: DataFrame, weights: DataFrame, bits, buckets: int, max_depth: int) -> DataFrame:
    """(block, bucket, k, data): the weights, 0 for none, of the sequences that a block has asked a bucket for."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.return_memory()
        for block, b in each_block(batches):
            for k, keys, _, _ in asked(b, bits.value, max_depth):
                rows = [(bucket, block, k, keys[at].tobytes()) for bucket, at in by_bucket(key_bucket(keys, buckets))]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "block", "k", "keys"])

    def reply(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, weight = (np.concatenate([np.zeros(0, t), *[c.to_numpy() for c in right.column(i).chunks]]) for i, t in ((1, np.int64), (2, np.float64)))
        keys = keys.astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        cuts, out = starts(keys[order]), []
        keys = keys[order][cuts[:-1]]
        weight = np.add.reduceat(weight[order], cuts[:-1]) if len(keys) else weight
        for bucket, block, k, want in zip(*(left.column(c).to_pylist() for c in ("bucket", "block", "k", "keys")), strict=True):
            want = np.frombuffer(want, np.uint64)
            found = np.zeros(len(want))
            if len(keys):
                at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                found = np.where(keys[at] == want, weight[at], 0.0)
            out.append((block, bucket, k, found.astype(np.float32).tobytes()))
        cols = list(zip(*out, strict=True)) if out else [()] * 4
        return pa.table([pa.array(c, x) for c, x in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["block", "bucket", "k", "data"])

    sent = blocks.mapInArrow(send, "bucket long, block long, k int, keys binary")
    top = F.shiftrightunsigned(F.col("key"), 33) * F.lit(buckets).cast("long")
    own = weights.select(F.shiftright(top, 31).alias("bucket"), "key", "weight")
    return common.shared_table(sent.groupBy("bucket").cogroup(own.groupBy("bucket")).applyInArrow(reply, "block long, bucket long, k int, data binary"), "lm-replies")


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", max_depth: int = MAX_DEPTH, min_count: int = MIN_COUNT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    A text's tokens are its words and one end. base_score adds log10 of their add-half probabilities. score is their
    log10 probability by the suffix tree, whose root is that model: each token is predicted from the longest retained
    context before it, which may reach back to the text's start. Null texts are empty. Null ids are not held out and so
    train. Repeated rows count and score as often as they come; other columns aren't read.

    Texts are split once, into blocks of word numbers; the passes after that work on arrays. All words, by themselves, and
    all sequences of up to max_depth + 1 words, by keys of 64 bits, are counted exactly, by shuffle; the tree is a table
    that grows with the input, and blocks ask its buckets for the weights of what they have. Sequences seen less than
    min_count times aren't in the tree, nor contexts of more than max_depth words, whatever they would add.
    """
    spark = docs.sparkSession
    common.bounded_batches(spark)
    held = F.coalesce(common.remainder(F.col(key), FOLDS) == HELD, F.lit(False))
    blocks = read_blocks(docs.select(key, held.alias("held_out"), F.col(text).alias("text")), key)
    of_all = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n"), F.sum(F.size(F.filter("held", lambda h: ~h))).alias("texts")).first()
    texts, buckets = of_all.texts or 0, max(MIN_BUCKETS, (of_all.n or 0) // BUCKET_TOKENS)
    words = count_words(blocks, buckets, min_count)
    n, v = words.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    n, v = n + texts, v + (texts > 0)
    total = float(np.log10(n + 0.5 * (v + 1)))

    def root(c: Column) -> Column:
        return F.log10(c + F.lit(0.5)) - F.lit(total)

    ends = spark.createDataFrame([(int(k), texts) for k in hashes([START, END]).view(np.int64)], "key long, n long")
    known = words.where("keys is not null").select(F.explode(F.arrays_zip("keys", "n")).alias("x")).select(F.col("x.keys").alias("key"), F.col("x.n").alias("n")).unionByName(ends)
    weights = weigh(blocks, known, root, buckets, min_count, max_depth, n) if texts else None
    replies = words.where("block is not null").select("block", F.col("bucket").cast("long"), F.lit(0).alias("k"), "data")
    bits = None
    if weights is not None:
        bits = spark.sparkContext.broadcast(mark(weights, weights.count()))
        replies = replies.unionByName(look_up(blocks, weights, bits, buckets, max_depth))
        common.drop_tables(weights)
    kind = docs.schema[key].dataType.simpleString()
    of_end = float(np.log10(texts + 0.5))

    def close(left: pa.Table, right: pa.Table) -> pa.Table:
        """The texts of a block with what the buckets have replied."""
        common.return_memory()
        ids, held_out, sizes = (left.column(c)[0].values for c in ("ids", "held", "sizes"))
        sizes = sizes.to_numpy()
        b = Block(left.column("words")[0].as_py(), left.column("tokens")[0].as_py(), sizes, held_out.to_numpy(zero_copy_only=False))
        said: dict[int, list] = {}
        for k, bucket, data in sorted(zip(*(right.column(c).to_pylist() for c in ("k", "bucket", "data")), strict=True)):
            said.setdefault(k, []).append(data)
        order, to = word_buckets(b.words, buckets)
        c = np.zeros(len(b.words))
        sent = [at.stop - at.start for _, at in by_bucket(to)]
        if len(order):
            c[order] = np.concatenate([np.frombuffer(d, np.uint32 if len(d) == 4 * m else np.int64) for d, m in zip(said[0], sent, strict=True)])
        own = b.numbers > 1
        places, numbers, m = b.of[own], b.numbers[own], len(sizes)
        known = np.bincount(places, (c > 0)[numbers], m).astype(np.int64) + (texts > 0)
        base = np.bincount(places, np.log10(c + 0.5)[numbers], m) + of_end - sizes * total
        gain = np.zeros(m)
        for k, keys, times, at in asked(b, bits.value, max_depth) if bits is not None else ():
            w = np.concatenate([np.zeros(0, np.float32), *[np.frombuffer(d, np.float32) for d in said.get(k, ())]]).astype(np.float64)
            if k > 1:
                gain += np.bincount(at, np.repeat(w, times), m)
            elif len(keys):
                of_word = hashes(b.words)
                place = np.minimum(np.searchsorted(keys, of_word), len(keys) - 1)
                gain += np.bincount(b.of, np.where(keys[place] == of_word, w[place], 0.0)[b.numbers], m)
        cols = [ids, held_out, pa.array(sizes), pa.array(known), pa.array(np.full(m, n)), pa.array(base), pa.array(base + gain)]
        return pa.table(cols, names=[key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(close, schema)


def op4_suffix_tree_lm(spark, sf_dir: str) -> DataFrame:
    return score_texts(common.table(spark, sf_dir, "documents"))
