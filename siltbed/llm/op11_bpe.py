"""BPE encoding and decoding by forced-boundary splitting.

Every token that merges can make is in the vocabulary. So two neighbouring bytes
that no token holds side by side can never come together: between them every
text may be cut for certain, its fragments encoded independently, and the ids
put one after the other. White space is in no token, so each run of it is such a
cut too, and what lies between two of them is a word.

The table of byte pairs is built from the vocabulary once per worker. A byte that
ends a word counts as another byte, since the vocabulary marks word ends. Ids are
remembered by word and by fragment, within a number of bytes; the fragments of all
new words of a slice are cut at once.

``encoded`` adds the ids, ``decoded`` turns ids into text, ``round_trip`` does both
in one pass. Decoding joins tokens with blanks, as the vocabulary has no decoder.

Defined results: NULL text counts as empty; empty and blank texts have no ids and
decode to the empty text; very long texts are read in slices between words, a
fragment of any length takes ``n log n`` steps; NULL ids decode to NULL; equal
texts have equal ids; rows pass through with all their columns, a result column
whose name is taken gets underscores; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import free_name, in_parts, quoted, whole_text, with_arrow_columns

#: Fixed value of the contract.
VOCABULARY = "word_bpe_49k.json"
#: What the operator expects of a vocabulary file besides tokens and merges.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words up to this letter need no composing, and their letters, digits and blanks are known without the library.
LAST_PLAIN = "ɏ"
#: Bytes of words and fragments that a worker remembers, counting what Python needs for each.
MEMORY = 220_000_000
ENTRY = 130
#: Longer words and fragments are not remembered.
LONGEST_KNOWN = 64
#: Bytes of text that are split into words at once.
SLICE = 1 << 20
#: Fragments longer than this are merged with a heap.
SHORT = 200
NEVER = 1 << 60


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary: printable bytes are themselves, others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges, and the byte pairs that occur inside tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model, split = given["model"], given["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in given["normalizer"]["normalizers"]]
        if kinds != NORMALIZERS or split["pattern"]["Regex"] != PATTERN or given["decoder"] or not model["end_of_word_suffix"]:
            raise ValueError(f"not a vocabulary of lower-cased words with marked ends: {path}")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in given["added_tokens"]):
            raise ValueError("added tokens must stand for themselves")
        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.pieces = library.pre_tokenizer.pre_tokenize_str
        self.added = {t["content"]: t["id"] for t in given["added_tokens"]}
        ids, end, letters = model["vocab"], model["end_of_word_suffix"], byte_letters()
        self.letters = letters
        self.tokens = [""] * (max([*ids.values(), *self.added.values()]) + 1)
        for token, number in [*ids.items(), *self.added.items()]:
            self.tokens[number] = token
        self.dtype = np.dtype("<u2") if len(self.tokens) <= 1 << 16 else np.dtype("<u4")
        self.first = [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.last = [ids[c + end] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.rank, self.made = {}, []
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.rank[ids[left] << 32 | ids[right]] = len(self.made)
            self.made.append(ids[left + right])
        #: inside[a, b]: some token holds byte a before byte b; b + 256 if b ends a word.
        self.inside = np.zeros((256, 512), bool)
        for token in ids:
            ends = token.endswith(end) and len(token) > len(end)
            raw = [letters[c] for c in (token[: -len(end)] if ends else token)]
            if ends:
                raw[-1] += 256
            self.inside[raw[:-1], raw[1:]] = True

    def fragment(self, raw: bytes, ends: bool) -> list[int]:
        """The ids of one fragment: of all neighbours that merge, the earliest merge goes first, then the leftmost."""
        ids = [self.first[b] for b in raw]
        if ends:
            ids[-1] = self.last[raw[-1]]
        return self._merged(ids) if len(ids) <= SHORT else self._merged_long(ids)

    def _merged(self, ids: list[int]) -> list[int]:
        rank = self.rank.get
        ranks = [rank(a << 32 | b, NEVER) for a, b in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            at = ranks.index(low)
            ids[at : at + 2] = [self.made[low]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank(ids[at] << 32 | ids[at + 1], NEVER)
            if at:
                ranks[at - 1] = rank(ids[at - 1] << 32 | ids[at], NEVER)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        count, rank = len(ids), self.rank.get
        after, before = [*range(1, count), -1], list(range(-1, count - 1))
        waiting = [(r, at) for at, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank(a << 32 | b)) is not None]
        heapq.heapify(waiting)

        def look(at: int) -> None:
            if at >= 0 and after[at] >= 0 and (r := rank(ids[at] << 32 | ids[after[at]])) is not None:
                heapq.heappush(waiting, (r, at))

        while waiting:
            r, at = heapq.heappop(waiting)
            right = after[at]
            if ids[at] < 0 or right < 0 or rank(ids[at] << 32 | ids[right]) != r:
                continue
            ids[at], ids[right] = self.made[r], -1
            after[at] = after[right]
            if after[at] >= 0:
                before[after[at]] = at
            look(before[at])
            look(at)
        return [i for i in ids if i >= 0]


class Memory(dict):
    """Remembers until its bytes are used up, then starts again."""

    def __init__(self, limit: int):
        self.limit, self.used = limit, 0

    def remember(self, key: bytes, ids: bytes) -> None:
        if len(key) <= LONGEST_KNOWN:
            self.used += ENTRY + len(key) + len(ids)
            self[key] = ids

    def forget(self) -> None:
        if self.used > self.limit:
            self.clear()
            self.used = 0


@cache
def codec(path: str | None = None, memory: int = MEMORY) -> tuple[Callable[[bytes], np.ndarray], Callable[[np.ndarray], str]]:
    """Encoder of a whole text and decoder of its ids; one of each serves all tasks of a worker."""
    import regex

    vocabulary = Vocabulary(path or vocabulary_path())
    plain = re.compile(f"[\0-{LAST_PLAIN}]*")
    plain_pieces = regex.compile(PATTERN.replace(r"\s", r"\x09-\x0d\x20\x85\xa0")).findall
    added = re.compile("|".join(f"({re.escape(t)})" for t in vocabulary.added) or "(?!)")
    marks = tuple(t.encode() for t in vocabulary.added)
    words, fragments = Memory(memory * 2 // 3), Memory(memory // 3)
    dtype, inside, tokens = vocabulary.dtype, vocabulary.inside, vocabulary.tokens

    def pieces_of(text: str) -> list[bytes]:
        """A word, or part of it, normalised and cut as the vocabulary says."""
        if plain.fullmatch(text):
            return [p.encode() for p in plain_pieces(text.lower())]
        found = vocabulary.pieces(vocabulary.normalize(text))
        return [bytes(map(vocabulary.letters.__getitem__, p)) for p, _ in found]

    def cut(pieces: list[bytes]) -> list[list[bytes]]:
        """The ids of each piece's fragments: cut wherever no token holds both bytes."""
        raw = b"".join(pieces)
        stops = np.cumsum([len(p) for p in pieces])
        second = np.frombuffer(raw, np.uint8).astype(np.int64)
        ends = np.zeros(len(raw), bool)
        ends[stops - 1] = True
        joins = inside[second[:-1], second[1:] + 256 * ends[1:]] & ~ends[:-1]
        cuts = [*(np.flatnonzero(~joins) + 1).tolist(), len(raw)]
        found: list[list[bytes]] = [[]]
        start = 0
        for stop, last in zip(cuts, ends[np.array(cuts) - 1].tolist()):
            fragment = raw[start:stop]
            key = fragment + b" " if last else fragment
            ids = fragments.get(key)
            if ids is None:
                ids = np.array(vocabulary.fragment(fragment, last), dtype).tobytes()
                fragments.remember(key, ids)
            found[-1].append(ids)
            if last:
                found.append([])
            start = stop
        return found[:-1]

    def learn(new: list[bytes], marked: bool) -> dict[bytes, bytes]:
        """The ids of new words; all their pieces are cut at once. ``marked``: a word may hold an added token."""
        parts: list[list[bytes | int]] = []
        for word in new:
            text = word.decode("utf-8", "replace")
            if marked and any(m in word for m in marks):
                of_word: list[bytes | int] = []
                for part in added.split(text):
                    of_word += [vocabulary.added[part]] if part in vocabulary.added else pieces_of(part) if part else []
                parts.append(of_word)
            else:
                parts.append(pieces_of(text))
        pieces = [p for of_word in parts for p in of_word if isinstance(p, bytes)]
        ids = iter(cut(pieces) if pieces else [])
        found = {}
        for word, of_word in zip(new, parts):
            made = b"".join(
                b"".join(next(ids)) if isinstance(p, bytes) else np.array([p], dtype).tobytes() for p in of_word
            )
            found[word] = made
            words.remember(word, made)
        fragments.forget()
        return found

    def encode(text: bytes) -> np.ndarray:
        made = []
        for part in slices(text):
            of_part = part.split()
            ids = list(map(words.get, of_part))
            if None in ids:
                marked = any(m in part for m in marks)
                new = learn(list({w for w, i in zip(of_part, ids) if i is None}), marked)
                ids = [new[w] if i is None else i for w, i in zip(of_part, ids)]
                words.forget()
            made.append(b"".join(ids))
        return np.frombuffer(b"".join(made), dtype)

    def decode(ids: np.ndarray) -> str:
        return " ".join(map(tokens.__getitem__, ids.tolist()))

    return encode, decode


def slices(text: bytes, size: int = SLICE) -> Iterator[bytes]:
    """The text in parts of about ``size`` bytes that end at white space."""
    blank = re.compile(rb"[\x20\x09-\x0D]")
    start = 0
    while start < len(text):
        found = blank.search(text, start + size) if len(text) - start > size else None
        stop = found.start() if found else len(text)
        yield text[start:stop]
        start = stop


def _in_parts(work: Callable[[], Callable[[pa.Array], list[pa.Array]]], size: int = SLICE) -> Callable[[], Callable]:
    """Work on a batch in parts of about ``size`` bytes, a large row alone."""

    def compute() -> Callable[[pa.Array], Iterator[tuple[slice, list[pa.Array]]]]:
        of_part = work()

        def parts(values: pa.Array) -> Iterator[tuple[slice, list[pa.Array]]]:
            for rows in in_parts(values, size):
                yield rows, of_part(values.slice(rows.start, rows.stop - rows.start))

        return parts

    return compute


IDS = T.ArrayType(T.IntegerType())


def _id_array(found: list[np.ndarray]) -> pa.Array:
    stops = np.cumsum([0, *map(len, found)]).astype(np.int32)
    flat = np.concatenate(found).astype(np.int32) if found else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(stops), pa.array(flat))


def encoded(docs: DataFrame, path: str | None = None, column: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with the ids of their whole texts (array of int)."""

    def work() -> Callable[[pa.Array], list[pa.Array]]:
        encode, _ = codec(path)
        return lambda texts: [_id_array([encode(t) for t in texts.to_pylist()])]

    given = whole_text(column).cast("binary")
    return with_arrow_columns(docs, given, [T.StructField(free_name(docs.columns, ids), IDS)], _in_parts(work))


def decoded(df: DataFrame, path: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text of their ids: tokens joined with blanks."""

    def work() -> Callable[[pa.Array], list[pa.Array]]:
        _, decode = codec(path)

        def texts(lists: pa.Array) -> list[pa.Array]:
            return [pa.array([None if x is None else decode(np.array(x, np.int64)) for x in lists.to_pylist()], pa.string())]

        return texts

    field = T.StructField(free_name(df.columns, text), T.StringType())
    return with_arrow_columns(df, quoted([ids])[0], [field], _in_parts(work))


def round_trip(docs: DataFrame, path: str | None = None, column: str = "text", ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the ids of their texts and the text of these ids."""

    def work() -> Callable[[pa.Array], list[pa.Array]]:
        encode, decode = codec(path)

        def both(texts: pa.Array) -> list[pa.Array]:
            found = [encode(t) for t in texts.to_pylist()]
            return [_id_array(found), pa.array(map(decode, found), pa.string())]

        return both

    ids = free_name(docs.columns, ids)
    fields = [T.StructField(ids, IDS), T.StructField(free_name([*docs.columns, ids], text), T.StringType())]
    return with_arrow_columns(docs, whole_text(column).cast("binary"), fields, _in_parts(work))


def digest_columns(tokenized: DataFrame, key: str = "doc_id") -> DataFrame:
    """The columns of the contract, from ids and decoded texts."""
    return tokenized.select(
        F.col(key).alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
