"""BPE, Merkle manifest and prefix trie against plain versions, on awkward rows and small blocks."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import brute
import pytest
from pyspark.sql import functions as F

from siltbed.llm import op11_bpe as op11
from siltbed.llm import op12_merkle as op12
from siltbed.llm import op13_prefix_trie as op13
from siltbed.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return brute.awkward(spark).cache()


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# op11


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(op11.vocabulary_path())


def expected_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_bpe_equals_the_library_on_documents(spark, library):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc_id, text in rows:
        ids = expected_ids(library, text)
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(decoded.encode()).hexdigest()))
    assert collected(QUERIES["op11_bpe"](spark, SF_DIR)) == sorted(expected, key=repr)


def test_bpe_on_awkward_rows(docs, library):
    found = op11.round_trip(docs).collect()
    assert len(found) == docs.count() and op11.round_trip(docs).columns == [*docs.columns, "ids", "decoded"]
    for r in found:
        ids = expected_ids(library, r["text"])
        assert r["ids"] == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)
    apart = op11.decoded(op11.encoded(docs))
    assert collected(apart) == collected(op11.round_trip(docs))
    assert op11.round_trip(docs.limit(0)).collect() == []


def test_bpe_keeps_taken_names_and_null_ids(spark):
    df = spark.createDataFrame([("x", None, "a.b")], "text string, ids array<int>, `a.b` string")
    found = op11.encoded(df)
    assert found.columns == ["text", "ids", "a.b", "ids_"] and found.collect()[0]["ids"] is None
    assert op11.decoded(df).collect()[0]["decoded"] is None


def test_bpe_on_random_texts(library):
    encode, decode = op11.codec()
    letters = ["a", "b", "é", "é", " ", "’", "'s", "t", "Σ", "ς", "İ", "\x85", "\x1c", "　", "²", "Ⅷ", "你", "한", ".", "!\n", "<|endoftext|>"]
    draw = random.Random(11)
    for _ in range(2000):
        text = "".join(draw.choices(letters, k=draw.randint(0, 40)))
        ids = expected_ids(library, text)
        assert encode(text.encode()).tolist() == ids
        assert decode(encode(text.encode())) == library.decode(ids, skip_special_tokens=False)


def test_bpe_on_every_plain_letter_and_some_others(library):
    encode, _ = op11.codec()
    for point in [*range(1, 0x300), *range(0x300, 0x11000, 37)]:
        if not 0xD800 <= point < 0xE000:
            text = f"a{chr(point)}b {chr(point)} 1{chr(point)}'s"
            assert encode(text.encode()).tolist() == expected_ids(library, text), hex(point)


def test_bpe_on_long_fragments_and_slices(library, monkeypatch):
    text = "abcé" * 3000 + "a" * 5000 + " " + "x1" * 2000
    encode, _ = op11.codec()
    assert encode(text.encode()).tolist() == expected_ids(library, text)
    words = "one two\n three\t" * 500
    assert b"".join(op11.slices(words.encode(), 100)) == words.encode()
    assert all(s[:1].isspace() for s in list(op11.slices(words.encode(), 100))[1:])


def test_bpe_forgets_and_still_agrees(library):
    encode, _ = op11.codec(None, 20_000)
    for n in range(60):
        text = " ".join(f"word{n * 100 + k}ing" for k in range(100))
        assert encode(text.encode()).tolist() == expected_ids(library, text)


def test_forced_cuts_are_certain():
    vocabulary = op11.Vocabulary(op11.vocabulary_path())
    # Merging a whole word with no cut at all gives the same as its fragments.
    encode, _ = op11.codec()
    for word in ["reauxelleê", "thontheéç", "zuverßung", "qzxjk", "ñíóúñ"]:
        raw = word.encode()
        assert encode(raw).tolist() == vocabulary.fragment(raw, True)
        assert vocabulary._merged_long([*[vocabulary.first[b] for b in raw[:-1]], vocabulary.last[raw[-1]]]) == vocabulary.fragment(raw, True)


# op12


def plain_hash(parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    def value(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    def levels(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            found.append([plain_hash(found[-1][k : k + 3]) for k in range(0, len(found[-1]), 3)])
        return found

    def up(node, found, at, siblings):
        for nodes in found[:-1]:
            run = nodes[at - at % 3 : at - at % 3 + 3]
            siblings += run[: at % 3] + run[at % 3 + 1 :]
            run[at % 3] = node
            node, at = plain_hash(run), at // 3
        return node

    by = defaultdict(list)
    for r in map(tuple, rows):
        by[r[1]].append((r[0] is not None, r[0] or 0, plain_hash(map(value, r)), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    found = []
    for k, s in enumerate(order):
        for at, (_, _, leaf, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            node = leaf
            if brute.fold(r[0], 2) == 0 and r[4] is not None:
                node = plain_hash(map(value, (*r[:4], r[4].replace("\n", ""))))
            siblings = []
            folded = up(up(node, trees[s], at, siblings), top, k, siblings)
            root = top[-1][0]
            found.append((r[0], leaf, trees[s][-1][0], root, plain_hash(siblings), folded, folded == root))
    return sorted(found, key=repr)


def manifest_of(df, **options):
    return collected(op12.manifest_columns(op12.manifest(df, op12.without_line_breaks(df), **options)))


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_a_plain_one(spark, levels):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.select(*op12.COLUMNS).collect()
    found = manifest_of(docs, levels=levels)
    assert found == plain_manifest(rows)
    assert {r[-1] for r in found} == {True, False}


def test_manifest_of_awkward_rows(spark, docs):
    rows = docs.select(*op12.COLUMNS).collect()
    assert manifest_of(docs, levels=1) == plain_manifest(rows)
    odd = [(None,) * 5, (2**62 + 1, "é", "en", 0, ""), (1, "", None, -3, "x\ny"), (1, "", None, -3, "x\ny"), (None, "", "", 1, "\n")]
    odd = spark.createDataFrame(odd, "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest_of(odd, levels=1) == plain_manifest(odd.collect())
    one = odd.filter("source = 'é'")
    assert manifest_of(one) == plain_manifest(one.collect())
    assert manifest_of(odd.limit(0)) == []


def test_manifest_with_many_sources(spark):
    rows = [(n, f"s{n % 40}", None, n, f"text {n}\n") for n in range(130)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest_of(df, levels=1) == plain_manifest(rows)


def test_proofs_lead_to_the_root(docs):
    found = op12.manifest(docs, proofs=True, levels=2).collect()
    for r in found:
        assert op12.folded(r["leaf"], r["siblings"], r["shape"]) == r["root"] == r["folded_root"]
        assert op12.folded(plain_hash(["other"]), r["siblings"], r["shape"]) != r["root"]


# op13


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in map(tuple, rows):
        role, text = role or "", text or ""
        tie = sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
        own[conv].append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        base = c if c is None else c - abs(c) % 20 * (1 if c > 0 else -1)
        built[c] = own.get(base, [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, of in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(of) - 1) * len(brute.words(p[-1][1])) if p else 0
            leaves[p[:d]] += p not in children

    def by_id(c):
        return c is None, c or 0

    found = []
    for p, of in members.items():
        ends = ",".join("" if c is None else str(c) for c in sorted((c for c in of if len(built[c]) == len(p)), key=by_id))
        above = min(members[p[:-1]], key=by_id) if p else None
        counts = (len(of), len(children[p]) if p in children else 0, leaves[p], saved[p])
        found.append((min(of, key=by_id), len(p), above, *counts, sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def trie_of(df, **options):
    return collected(op13.node_columns(op13.prefix_trie(df, **options)))


def awkward_turns():
    draw = random.Random(13)
    rows = [(0, 0, "u", "x")] * 3
    for conv in [None, *range(-30, 60), 2**40, 2**40 + 1]:
        for turn in range(draw.choice([0, 1, 2, 3, 5, 9])):
            texts = ["x", "y z", None, "", "tab\tand\x85odd"]
            rows.append((conv, draw.choice([turn, turn, turn, None, 1]), draw.choice(["u", "a", None]), draw.choice(texts)))
    return rows


@pytest.mark.parametrize("options", [{}, {"size": 1, "block": 4}, {"size": 2, "block": 7}])
def test_trie_equals_a_plain_one(spark, options):
    rows = awkward_turns()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("conv", "n", "digest", "words", "rank", "seg", "a.b"):
        df = df.withColumn(name, F.lit("clash"))
    assert trie_of(df, **options) == plain_trie(rows)


def test_trie_of_many_copies(spark):
    rows = [(c, t, "u", f"{t} of the same") for c in range(0, 400, 20) for t in range(5)]
    rows += [(c, t, "u", f"{t} of the same" if t < 3 else f"{c} {t}") for c in range(10, 400, 20) for t in range(5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert trie_of(df, block=3) == plain_trie(rows)


def test_trie_of_one_long_conversation(spark):
    rows = [(c, t, "u", f"turn {t % 7}") for c in (20, 21) for t in range(700 + c)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert trie_of(df) == plain_trie(rows)


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie_of(df) == []


def test_extents_equal_a_scan():
    import numpy as np

    draw = np.random.default_rng(3)
    for count in (1, 2, 7, 64, 100):
        values = draw.integers(-1, 4, count)
        table = op13.SparseTable(values)
        start = np.arange(count)
        for least in range(5):
            right, left = table.reach_right(start, np.full(count, least)), table.reach_left(start, np.full(count, least))
            for k in range(count):
                r = k
                while r + 1 < count and values[r + 1] >= least:
                    r += 1
                l = k
                while l >= 0 and values[l] >= least:
                    l -= 1
                assert (right[k], left[k]) == (r, l)
            first = draw.integers(0, count, 20)
            last = np.minimum(first + draw.integers(0, count, 20), count - 1)
            assert table.least(first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last)]
