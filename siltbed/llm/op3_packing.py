"""Packing token ids into fixed-length sequences, shortest pack first over the length histogram.

1. One pass over the texts gives the pieces of every document: as many full
   sequences as it fills, and a rest. Each is stored with its ids, two bytes per id
   where the vocabulary allows, which go with it to its place; ``sequences`` puts
   them together.
2. The histogram of piece lengths has at most 4096 rows, whatever the input.
   Lengths are placed longest first, each in the pattern with the most room
   (the shortest pack); patterns carry counts, so a million equal pieces cost one
   step. The number of patterns is bounded by the lengths, not by the pieces.
3. Pieces are numbered within their length by distributed ranks; a pattern owns
   an interval of ranks of each of its lengths, which gives every piece its
   sequence and place there.

Defined results: NULL or empty text is one piece with the closing id; any
number of rows may share a doc_id; equal pieces are interchangeable; an empty
table gives no sequence. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.common import power_of_two, with_text_columns, written
from siltbed.llm.op11_bpe import byte_letters

SEQUENCE = 4096
#: Fixed values of the contract: the vocabulary and the id that closes a document.
VOCABULARY = "word_bpe_49k.json"
CLOSING_ID = 2
#: Bytes of words and their ids that a worker remembers, counting what Python needs for each.
MEMORY = 200_000_000
ENTRY = 150
#: Bytes of text whose words are looked up together, few enough to stay in a core's cache.
BUNDLE = 1 << 16
LETTER_OF = {byte: letter for letter, byte in byte_letters().items()}
#: Lower-cased words, one a line, whose ids are those of the letters, then those of the signs; other words give neither.
PLAIN = re.compile(r"^(?:([a-z\xdf-\xf6\xf8-\xff]*)([.,;:!?*#$%&|]*)|.+)$", re.MULTILINE)
#: Letters that are two bytes, as the vocabulary writes them.
LETTERS = {code: "".join(LETTER_OF[byte] for byte in chr(code).encode()) for code in range(0xDF, 0x100)}
#: ASCII separators that are white space to ``str.split`` but not to the tokenizer.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def id_type(size: int) -> np.dtype:
    """How ids of a vocabulary are stored while they travel."""
    return np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def encoder(path: str | None = None) -> Callable[[bytes], np.ndarray]:
    """Ids of one whole text."""
    encode = batch_encoder(path)
    return lambda text: encode([text])[0]


@cache
def batch_encoder(path: str | None = None, memory: int = MEMORY) -> Callable[[list[bytes]], list[np.ndarray]]:
    """Ids of whole texts; one encoder serves all tasks of a worker.

    The vocabulary's merges never cross white space, nor the border between
    letters and signs, and know no capitals. So ids are remembered by plain word,
    and a new one goes straight to the vocabulary's merges. ``tests/llm`` compares
    with encoding whole texts.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path or vocabulary_path())
    known: dict[str, bytes] = {}
    kind = id_type(tokenizer.get_vocab_size())
    stored = [number.to_bytes(kind.itemsize, "little") for number in range(tokenizer.get_vocab_size())]
    merge = tokenizer.model.tokenize
    used = 0

    def ids_of(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, kind).tobytes()

    def encoded(parts: list[str]) -> dict[str, bytes]:
        """Letters alone, or signs alone, are one unit that needs no normalising, so the merges are all that is left to do."""
        tokens = map(merge, "\n".join(parts).translate(LETTERS).split("\n")) if parts else ()
        return {part: b"".join([stored[token.id] for token in made]) for part, made in zip(parts, tokens)}

    def learn(words: list[str]) -> dict[str, bytes]:
        """The ids of new words, from their plain parts or from the tokenizer; the memory starts again when it is full."""
        nonlocal used
        if used > memory:
            known.clear()
            used = 0
        plain = PLAIN.findall("\n".join(words).lower())
        found = encoded([part for part in {part for parts in plain for part in parts} if part and part not in known])
        used += sum(map(len, found)) + len(found) * ENTRY
        known.update(found)
        for word, (letters, signs) in zip(words, plain):
            if letters:
                found[word] = known[letters] + known[signs] if signs else known[letters]
            elif signs:
                found[word] = known[signs]
            else:
                # Whatever a word may hold, alone it is encoded as in its text.
                found[word] = ids_of(word)
        used += sum(map(len, words)) + len(words) * ENTRY
        known.update(found)
        return found

    def encode(texts: list[bytes]) -> list[np.ndarray]:
        decoded = [raw.decode("utf-8", "replace") for raw in texts]
        odd = [any(c in text for c in SEPARATORS) for text in decoded]
        words, stops = [], [0]
        for text, whole in zip(decoded, odd):
            words += [] if whole else text.split()
            stops.append(len(words))
        found = list(map(known.get, words))
        if None in found:
            new = learn(list({w for w, ids in zip(words, found) if ids is None}))
            found = [new[w] if ids is None else ids for w, ids in zip(words, found)]
        return [
            np.frombuffer(ids_of(text) if whole else b"".join(found[a:b]), kind)
            for text, whole, a, b in zip(decoded, odd, stops, stops[1:])
        ]

    return encode


def bundles(texts: list[bytes], size: int = BUNDLE) -> Iterator[list[bytes]]:
    """The texts in order, several together up to about ``size`` bytes."""
    some, held = [], 0
    for text in texts:
        some.append(text)
        held += len(text)
        if held >= size:
            yield some
            some, held = [], 0
    if some:
        yield some


def pieces(docs: DataFrame, sequence: int = SEQUENCE, path: str | None = None, key: str = "doc_id", column: str = "text") -> DataFrame:
    """doc_id, start, length, doc_tokens and ids (2 bytes each, or 4) per piece; only the last piece of a document is shorter than ``sequence``."""

    def compute() -> Callable[[list[bytes]], list[list]]:
        encode = batch_encoder(path)

        def work(texts: list[bytes]) -> list[list]:
            cut, tokens = [], []
            for ids in (ids for some in bundles(texts) for ids in encode(some)):
                width = ids.itemsize
                whole = ids.tobytes() + CLOSING_ID.to_bytes(width, "little")
                cut.append([whole[at : at + width * sequence] for at in range(0, len(whole), width * sequence)])
                tokens.append(len(whole) // width)
            return [cut, tokens]

        return work

    fields = [T.StructField("ids", T.ArrayType(T.BinaryType())), T.StructField("doc_tokens", T.LongType())]
    found = with_text_columns(docs.select(F.col(key).alias("doc_id"), F.col(column).alias("text")), fields, compute)
    each = found.select("doc_id", "_found.doc_tokens", F.posexplode("_found.ids").alias("n", "ids"))
    start = (F.col("n") * sequence).cast("long")
    return each.select(
        "doc_id",
        start.alias("start"),
        F.least(F.lit(sequence).cast("long"), F.col("doc_tokens") - start).alias("length"),
        F.crc32("ids").alias("stored_crc32"),
        "doc_tokens",
        "ids",
    )


def pack_patterns(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as (count, [(length, times), ...]), shortest pack first.

    Lengths are placed longest first, each piece in the pack with the most room
    where it fits, else in a new pack. Packs that look alike are one pattern.
    """
    by_room: list[list[tuple[int, tuple]]] = [[] for _ in range(sequence + 1)]
    for length in sorted(histogram, reverse=True):
        left, room = histogram[length], sequence
        # Room only shrinks while one length is placed, so one way down is enough.
        while left and room >= length:
            if not by_room[room]:
                room -= 1
                continue
            count, items = by_room[room].pop()
            taken = min(count, left)
            if taken < count:
                by_room[room].append((count - taken, items))
            by_room[room - length].append((taken, (length, items)))
            left -= taken
        if left:
            fit = sequence // length
            full, rest = divmod(left, fit)
            for times, count in ((fit, full), (rest, 1)):
                if times and count:
                    by_room[sequence - times * length].append((count, _repeat(length, times)))
    return [(count, _times(items)) for packs in by_room for count, items in packs]


def _repeat(length: int, times: int) -> tuple:
    items: tuple = ()
    for _ in range(times):
        items = (length, items)
    return items


def _times(items: tuple) -> list[tuple[int, int]]:
    found: dict[int, int] = {}
    while items:
        length, items = items
        found[length] = found.get(length, 0) + 1
    return list(found.items())


def pattern_table(patterns: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Columns length, first rank, times, first sequence, first offset; by length and first rank."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence_id = [], 0
    for count, items in sorted(patterns):
        offset = 0
        for length, times in items:
            rows.append((length, used[length], times, sequence_id, offset))
            used[length] += count * times
            offset += length * times
        sequence_id += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(found: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Stored pieces with ids_crc32, sequence_id and offset."""
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = pattern_table(pack_patterns(histogram, sequence))
    bits = power_of_two(sum(histogram.values()) ** 0.5)
    dealt = found.withColumn(
        "range", F.shiftright(F.abs(F.xxhash64("doc_id", "start", "stored_crc32")), 63 - bits) if bits else F.lit(0).cast("long")
    )
    before = Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("length", "range")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("length", "range").orderBy("doc_id", "start", "stored_crc32", "doc_tokens")
    ranked = (
        dealt.join(starts, ["length", "range"])
        .withColumn("rank", F.col("base") + F.row_number().over(inside) - 1)
        .drop("range", "base")
    )
    made_here = [T.StructField(name, T.LongType()) for name in ("ids_crc32", "sequence_id", "offset")]
    schema = T.StructType([f for f in ranked.schema.fields if f.name not in ("rank", "stored_crc32")] + made_here)
    # Ranks of one length lie below 2 ** 50.
    keys = (table[:, 0] << 50) + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            row = table[np.searchsorted(keys, (length << 50) + rank, "right") - 1]
            pack, nth = np.divmod(rank - row[:, 1], row[:, 2])
            arrays = [batch.column(f.name) for f in schema.fields[:-3]]
            # The checksum of the ids that arrived here, four bytes each.
            ids = map(widened, batch.column("ids").to_pylist(), length.tolist())
            sums = pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())
            made = [sums, pa.array(row[:, 3] + pack), pa.array(row[:, 4] + nth * length)]
            yield pa.RecordBatch.from_arrays([*arrays, *made], schema.names)

    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, sequence: int = SEQUENCE, path: str | None = None, key: str = "doc_id", column: str = "text") -> DataFrame:
    """One row per piece with its ids, sequence and offset."""
    return place(written(pieces(docs, sequence, path, key, column), "op3-pieces"), sequence)


def widened(raw: bytes, count: int) -> np.ndarray:
    """Stored ids of a known number as 4-byte numbers."""
    return np.frombuffer(raw, f"<u{len(raw) // count}").astype("<u4") if count else np.empty(0, "<u4")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the ids of each sequence in the order of their offsets."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    # A sequence has at most ``sequence`` ids, so a row is bounded.
    whole = F.aggregate(parts, F.lit(b""), lambda left, part: F.concat(left, part["ids"]))
    made = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), whole.alias("ids"))
    return made.mapInArrow(_as_arrays, "sequence_id long, ids array<int>")


def _as_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = map(widened, batch.column("ids").to_pylist(), batch.column("length").to_pylist())
        ids = pa.array([x.view("<i4") for x in raw], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), ids], ["sequence_id", "ids"])


def piece_columns(packed: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
