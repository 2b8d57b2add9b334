"""Language-model scores by deleted interpolation.

A text is its lower-cased words and one end token; a token's probability mixes
the bigram, the unigram and the uniform estimate, with weights that depend on how
often the context was seen (a bucket per power of two). The weights are learned
by expectation-maximisation on counts that were deleted from training: one
training document in five is left out of the estimates and scored by them.

No count table ever meets a broadcast or the driver:

1. A task turns its texts into chunks of about 16 MB. A chunk knows its distinct
   words and bigrams and sends their hashed keys, with its own counts, to key
   ranges; the token numbers of its texts go along.
2. Each key range adds up counts over all chunks, and answers every chunk with the
   totals of its keys, in the order in which they came.
3. Each chunk puts totals to its tokens. Held-out tokens give a histogram over
   (context bucket, bigram estimate, unigram count), in quarter octaves; its size
   depends on the logarithm of the counts, and EM runs on it.
4. Texts are scored from the stored chunks.

A frequent word is one key of each chunk, so ranges are even. Words have 56-bit
keys; bigram keys have 40 bits beside those of the range, of which there is one
per million keys: one lookup in a million meets another bigram's count.

Defined results: NULL and empty texts consist of the end token; a NULL id counts
as empty text for the fold; repeated rows are scored and counted one by one; very
long texts are counted and scored in slices, all of them; with no training text all
counts are 0; an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import crc_fold, power_of_two, whole_text, written

#: Fixed values of the contract.
FOLDS, HELD_OUT = 7, 2
#: Within the training rows, one in so many is deleted from the estimates.
DELETED_FOLDS = 5
CHUNK_BYTES = 16_000_000
KEYS_A_RANGE = 1_000_000
TOKENS_AT_ONCE = 200_000
ROWS_AT_ONCE = 256
ROUNDS = 40
#: Tokens that no word can be, since words hold no space.
START, END = b" start", b" end"
_TESTED, _KEPT, _DELETED = 0, 1, 2
_TEXTS, _KEYS, _TOTALS, _SIZES, _SCORED, _HISTOGRAM = range(6)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed; planes of zeros take no room."""
    planes = np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


def bigram_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first ^ (first >> np.uint64(31))) * _MIX + second
    mixed ^= mixed >> np.uint64(32)
    return mixed * _MIX


def _before(tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The token before each token; the start, number 0, before a text's first one."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(lengths) - lengths] = 0
    return before


def _pairs_of(before: np.ndarray, tokens: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct bigrams as one number each, and which of them every token ends."""
    return np.unique(before.astype(np.int64) * words + tokens, return_inverse=True)


class _Chunk:
    """Texts of a task until they are enough."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {START: 0, END: 1}
        self.tokens: list[np.ndarray] = []
        self.ids: list = []
        self.roles: list[int] = []
        self.size = 0

    def add(self, id_: object, text: bytes, role: int) -> None:
        words = text.lower().split()
        known = self.words
        own = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))
        self.tokens.append(np.append(own, np.int32(1)))
        self.ids.append(id_)
        self.roles.append(role)
        self.size += len(text) + 8

    def rows(self, number: int, bits: int) -> Iterator[tuple]:
        tokens = np.concatenate(self.tokens)
        lengths = np.array([len(t) for t in self.tokens])
        self.tokens.clear()
        hashes = np.array([word_hash(w) for w in self.words], np.uint64)
        roles = np.array(self.roles, np.int8)
        role = np.repeat(roles, lengths)
        both = packed(np.concatenate([lengths, roles]))
        # Task and place in it both count, so texts are spread over all ranges.
        route = (number + (number >> 32)) & ((1 << bits) - 1)
        yield route, number, _TEXTS, self.ids, packed(tokens), both, _narrow(hashes, 7), None
        pairs, place = _pairs_of(_before(tokens, lengths), tokens, len(hashes))
        keys = bigram_keys(hashes[pairs // len(hashes)], hashes[pairs % len(hashes)])
        word_counts = [np.bincount(tokens[role == r], minlength=len(hashes)) for r in (_KEPT, _DELETED)]
        for counts, r in zip(word_counts, (_KEPT, _DELETED)):
            counts[0] = np.count_nonzero(roles == r)
        pair_counts = [np.bincount(place[role == r], minlength=len(pairs)) for r in (_KEPT, _DELETED)]
        del tokens, place, role
        of_words, of_pairs = np.argsort(hashes), np.argsort(keys)
        word_cuts = _range_cuts(hashes[of_words], bits)
        pair_cuts = _range_cuts(keys[of_pairs], bits)
        for part in range(1 << bits):
            w = of_words[word_cuts[part] : word_cuts[part + 1]]
            p = of_pairs[pair_cuts[part] : pair_cuts[part + 1]]
            if len(w) or len(p):
                yield (
                    part, number, _KEYS, None,
                    _narrow(hashes[w], 7), packed(np.concatenate([c[w] for c in word_counts])),
                    _narrow(keys[p] << np.uint64(bits), 5), packed(np.concatenate([c[p] for c in pair_counts])),
                )


def word_hash(word: bytes) -> int:
    """56 bits, the highest ones of 64."""
    return xxhash.xxh3_64_intdigest(word) & ~0xFF


def _narrow(keys: np.ndarray, size: int) -> bytes:
    """The highest bytes of every key."""
    return keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _wide(blob: bytes, size: int) -> np.ndarray:
    wide = np.zeros((len(blob) // size, 8), np.uint8)
    wide[:, :size] = np.frombuffer(blob, np.uint8).reshape(-1, size)
    return wide.view(">u8").ravel().astype(np.uint64)


def _range_cuts(ordered: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.array([0, len(ordered)])
    inner = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(ordered, inner), [len(ordered)]])


def _schema(id_type: T.DataType) -> T.StructType:
    kinds = [("route", T.LongType()), ("chunk", T.LongType()), ("kind", T.LongType()), ("ids", T.ArrayType(id_type))]
    return T.StructType([T.StructField(*k) for k in kinds + [(c, T.BinaryType()) for c in "abcd"]])


def _frame(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def chunked(docs: DataFrame, bits: int) -> DataFrame:
    """Chunk rows and key rows, see ``_Chunk.rows``. Needs doc_id, text (bytes), role."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, count, schema = _Chunk(), 0, None
        task = TaskContext.get().partitionId() << 32
        for batch in batches:
            schema = _arrow_schema(batch.schema.field("doc_id").type)
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                for id_, text, role in zip(*(some.column(c).to_pylist() for c in ("doc_id", "text", "role"))):
                    chunk.add(id_, text, role)
                    if chunk.size >= CHUNK_BYTES:
                        for row in chunk.rows(task + count, bits):
                            yield _frame([row], schema)
                        chunk, count = _Chunk(), count + 1
                        pa.default_memory_pool().release_unused()
        if chunk.ids:
            for row in chunk.rows(task + count, bits):
                yield _frame([row], schema)

    return docs.mapInArrow(run, _schema(docs.schema["doc_id"].dataType))


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    first = [("route", pa.int64()), ("chunk", pa.int64()), ("kind", pa.int64()), ("ids", pa.list_(id_type))]
    return pa.schema(first + [(c, pa.binary()) for c in "abcd"])


def _add_up(table: pa.Table) -> pa.Table:
    """One key range: totals of all its keys, for every chunk that asked."""
    schema = _arrow_schema(table.schema.field("ids").type.value_type)
    texts = table.filter(pc.equal(table.column("kind"), _TEXTS)).cast(schema)
    asked = table.filter(pc.equal(table.column("kind"), _KEYS)).to_pylist()
    if not asked:
        return texts
    words = [_wide(r["a"], 7) for r in asked]
    pairs = [_wide(r["c"], 5) for r in asked]
    word_totals, known = _totals(words, [unpacked(r["b"]) for r in asked])
    pair_totals, _ = _totals(pairs, [unpacked(r["d"]) for r in asked])
    start = np.uint64(word_hash(START))
    trained = known[0] != start
    sizes = np.array([known[1][trained].sum(), known[2][trained].sum(), np.count_nonzero((known[1] + known[2])[trained])])
    route = asked[0]["route"]
    pa.default_memory_pool().release_unused()
    rows = [(route, r["chunk"], _TOTALS, None, w, p, None, None) for r, w, p in zip(asked, word_totals, pair_totals)]
    rows.append((route, -1 - route % 1024, _SIZES, None, packed(sizes), None, None, None))
    return pa.concat_tables([texts, pa.Table.from_batches([_frame(rows, schema)])])


def _totals(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[bytes], tuple]:
    """Per asking chunk the packed totals of its keys; the distinct keys with both counts."""
    known, place = np.unique(np.concatenate(keys), return_inverse=True)
    halves = [np.concatenate([c.reshape(2, -1)[k] for c in counts]) for k in (0, 1)]
    sums = [np.bincount(place, h, len(known)).astype(np.int64) for h in halves]
    ends = np.cumsum([len(k) for k in keys])
    answers = [packed(np.concatenate([s[place[e - len(k) : e]] for s in sums])) for k, e in zip(keys, ends)]
    return answers, (known, *sums)


def _assemble(table: pa.Table) -> pa.Table:
    """One chunk: its tokens with the totals of their bigrams, and its part of the held-out histogram."""
    schema = _arrow_schema(table.schema.field("ids").type.value_type)
    rows = sorted(table.to_pylist(), key=lambda r: r["route"])
    text = next((r for r in rows if r["kind"] == _TEXTS), None)
    if text is None:
        return table.cast(schema)
    answers = [r for r in rows if r["kind"] == _TOTALS]
    tokens = unpacked(text["a"]).astype(np.int32)
    lengths, roles = unpacked(text["b"]).reshape(2, -1)
    hashes = _wide(text["c"], 7)
    before = _before(tokens, lengths)
    pairs, place = _pairs_of(before, tokens, len(hashes))
    place = place.astype(np.int32)
    order = np.argsort(bigram_keys(hashes[pairs // len(hashes)], hashes[pairs % len(hashes)]))
    word_totals = _in_order([r["a"] for r in answers], np.argsort(hashes))
    pair_totals = _in_order([r["b"] for r in answers], order)
    del pairs, order
    held = np.repeat(roles == _DELETED, lengths)
    codes = _codes(pair_totals[0][place[held]], word_totals[0][before[held]], word_totals[0][tokens[held]])
    code, times = np.unique(codes, return_counts=True)
    del codes, before, held
    pa.default_memory_pool().release_unused()
    number = text["chunk"]
    made = [
        (0, number, _SCORED, text["ids"], text["a"], packed(lengths), packed(pair_totals.sum(0)[place]), packed(word_totals.sum(0))),
        (0, number, _HISTOGRAM, None, packed(code), packed(times), None, None),
    ]
    return pa.Table.from_batches([_frame(made, schema)])


def _in_order(blobs: list[bytes], order: np.ndarray) -> np.ndarray:
    found = np.zeros((2, len(order)), np.int64)
    found[:, order] = np.concatenate([unpacked(b).reshape(2, -1) for b in blobs], 1)
    return found


def context_bucket(context: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(context + 1)).astype(np.int64)


def bounded(pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Bigram counts no larger than those of their words; a hash collision could exceed them."""
    return np.minimum(pair, np.minimum(context, word))


def _codes(pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Context bucket, bigram estimate and unigram count in quarter octaves; 0 stands for none."""
    pair = bounded(pair, context, word)
    estimate = np.where(pair > 0, 1 + np.rint(-4 * np.log2(np.maximum(pair, 1) / np.maximum(context, 1))), 0)
    count = np.where(word > 0, 1 + np.rint(4 * np.log2(np.maximum(word, 1))), 0)
    return (context_bucket(context) << 32) + (estimate.astype(np.int64) << 16) + count.astype(np.int64)


def learn_weights(histogram: dict[int, int], kept_tokens: int, vocabulary: int) -> np.ndarray:
    """Per context bucket the weights of bigram, unigram and uniform estimates, by EM.

    A bucket that no held-out token has takes the weights of the nearest one that has.
    """
    weights = np.full((65, 3), 1 / 3)
    if not histogram:
        return weights
    code = np.array(list(histogram), np.int64)
    times = np.array(list(histogram.values()), np.float64)
    bucket, estimate, count = code >> 32, (code >> 16) & 0xFFFF, code & 0xFFFF
    parts = np.stack(
        [
            np.where(estimate > 0, 2.0 ** (-(estimate - 1) / 4), 0),
            np.where(count > 0, 2.0 ** ((count - 1) / 4) / max(kept_tokens, 1), 0),
            np.full(len(code), 1 / (vocabulary + 1)),
        ],
        1,
    )
    for _ in range(ROUNDS):
        share = weights[bucket] * parts
        share *= (times / share.sum(1))[:, None]
        for k in range(3):
            weights[:, k] = np.bincount(bucket, share[:, k], len(weights)) + 1e-3
        weights /= weights.sum(1, keepdims=True)
    seen = np.unique(bucket)
    for empty in set(range(len(weights))) - set(seen.tolist()):
        weights[empty] = weights[seen[np.argmin(abs(seen - empty))]]
    return weights


class Model:
    """What scoring needs beside the counts: three numbers and a weight table of fixed size."""

    def __init__(self, stored: DataFrame) -> None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes, times = [], []
                for kind, a, b in zip(*(batch.column(c).to_pylist() for c in ("kind", "a", "b"))):
                    if kind == _SIZES:
                        codes.append(np.array([-1, -2, -3]))
                        times.append(unpacked(a))
                    else:
                        codes.append(unpacked(a))
                        times.append(unpacked(b))
                if codes:
                    arrays = [pa.array(np.concatenate(x)) for x in (codes, times)]
                    yield pa.RecordBatch.from_arrays(arrays, ["code", "times"])

        parts = stored.filter(F.col("kind").isin(_SIZES, _HISTOGRAM)).select("kind", "a", "b")
        rows = parts.mapInArrow(run, "code long, times long").groupBy("code").agg(F.sum("times").alias("n")).collect()
        found = {r["code"]: r["n"] for r in rows}
        kept, deleted, self.vocabulary = (found.pop(code, 0) for code in (-1, -2, -3))
        self.train_tokens = kept + deleted
        self.weights = learn_weights(found, kept, self.vocabulary)

    def token_logs(self, pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        w = self.weights[context_bucket(context)]
        mixed = w[:, 0] * (bounded(pair, context, word) / np.maximum(context, 1)) + w[:, 1] * (word / max(self.train_tokens, 1))
        return np.log10(mixed + w[:, 2] / (self.vocabulary + 1))


def score_texts(docs: DataFrame, training: Callable, deleted: Callable, key: str = "doc_id", column: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``training`` and ``deleted`` are conditions on the column ``key``: rows to
    learn from, and those of them to learn the weights from.
    """
    role = F.when(~training(key), _TESTED).when(deleted(key), _DELETED).otherwise(_KEPT)
    given = docs.select(F.col(key).alias("doc_id"), whole_text(column).cast("binary").alias("text"), role.alias("role"))
    total = docs.agg(F.sum(F.octet_length(whole_text(column)))).first()[0] or 0
    # About a key for nine bytes: a word and a space, seven keys for ten words.
    bits = power_of_two(total / 9 / KEYS_A_RANGE)
    schema = _schema(given.schema["doc_id"].dataType)
    answered = chunked(given, bits).groupBy("route").applyInArrow(_add_up, schema)
    stored = written(answered.groupBy("chunk").applyInArrow(_assemble, schema), "op8-chunks", compression="none")
    model = Model(stored)
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [T.LongType()] * 3 + [T.DoubleType()] * 2
    out = T.StructType([given.schema["doc_id"], *[T.StructField(n, k) for n, k in zip(names[1:], kinds)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for row_number in range(batch.num_rows):
                row = batch.slice(row_number, 1).to_pylist()[0]
                tokens = unpacked(row["a"]).astype(np.int32)
                lengths, pair, word = (unpacked(row[c]) for c in "bcd")
                ends = np.cumsum(lengths)
                # Whole texts, together about so many tokens at a time.
                cuts = np.searchsorted(ends, np.arange(0, len(tokens), TOKENS_AT_ONCE))
                for first, last in zip(cuts, [*cuts[1:], len(lengths)]):
                    if first == last:
                        continue
                    here = lengths[first:last]
                    start, end = ends[first] - here[0], ends[last - 1]
                    starts = np.cumsum(here) - here
                    own_tokens = tokens[start:end]
                    own = word[own_tokens]
                    base = np.log10((own + 1) / (model.train_tokens + model.vocabulary + 1))
                    logs = model.token_logs(pair[start:end], word[_before(own_tokens, here)], own)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(row["ids"][first:last], id_type),
                            pa.array(here),
                            pa.array(np.add.reduceat(own > 0, starts, dtype=np.int64)),
                            pa.array(np.full(len(here), model.train_tokens, np.int64)),
                            pa.array(np.add.reduceat(base, starts)),
                            pa.array(np.add.reduceat(logs, starts)),
                        ],
                        names,
                    )

    return stored.filter(F.col("kind") == _SCORED).select("ids", "a", "b", "c", "d").mapInArrow(run, out)


def deleted_fold(key: str):
    crc = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return F.floor(crc / FOLDS) % DELETED_FOLDS == 0


def scores(docs: DataFrame) -> DataFrame:
    scored = score_texts(docs, lambda key: crc_fold(key, FOLDS) != HELD_OUT, deleted_fold)
    return scored.withColumn("held_out", crc_fold("doc_id", FOLDS) == HELD_OUT)
