"""Each operator against its plain version, on the given tables and on awkward rows."""

import math
import os
import re
import zlib
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.llm import op1_exact_dedup as op1
from siltbed.llm import op2_mixing as op2
from siltbed.llm import op3_packing as op3
from siltbed.llm import op4_pii as op4
from siltbed.llm import op5_sharding as op5
from siltbed.llm import op6_toxicity as op6
from siltbed.llm import op7_quality_rules as op7
from siltbed.llm import op8_lm_scoring as op8
from siltbed.llm import op9_near_dedup as op9
from siltbed.llm import op10_quality_classifier as op10
from siltbed.llm.common import written
from siltbed.llm.labelled import labelled_sample
from siltbed.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return brute.awkward(spark).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def pairs(df, columns=("doc_id", "text")):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def given(spark, name, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    ours, expected = QUERIES[name](spark, SF_DIR).toArrow(), connection.sql(SQL[name]).to_arrow_table()
    assert sorted(ours.column_names) == sorted(expected.column_names)
    rows = [sorted(zip(*[t[c].to_pylist() for c in sorted(t.column_names)]), key=repr) for t in (ours, expected)]
    assert rows[0] == rows[1] and rows[0]


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op2_mixing", "op5_sharding"])
def test_native_operators_run_no_python(spark, name, plan):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not [node for node in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop") if node in text]


# op1


def exact_expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    found = Counter()
    for t, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i))
        for n, i in enumerate(sorted(ids, key=lambda i: (i is not None, i))):
            found[(i, keep, len(ids), n == len(ids) - 1)] += 1
    return found


@pytest.mark.parametrize("support", [0.001, 0.1, 0.5])
def test_exact_groups(docs, support):
    groups = op1.exact_groups(docs, support)
    got = Counter(pairs(groups, ("doc_id", "keep_id", "group_size", "kept")))
    assert got == exact_expected(pairs(docs))


def test_exact_groups_with_a_hot_text(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', concat('t', id DIV 2)) AS text")
    heavy = op1.frequent_winners(
        df.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), F.col("doc_id").alias("row_no")), 0.01
    )
    assert [(r["group_size"], r["winner"]["doc_id"]) for r in heavy.collect()] == [(1000, 2997)]
    got = Counter(pairs(op1.exact_groups(df, 0.01), ("doc_id", "keep_id", "group_size", "kept")))
    assert got == exact_expected(pairs(df))


def test_drop_copies(docs):
    kept = op1.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [t or "" for _, t in pairs(kept)]
    assert sorted(texts) == sorted({t or "" for _, t in pairs(docs)})
    assert (5, brute.PROSE) in pairs(kept) and (None, brute.PROSE) not in pairs(kept)


# op2


def test_mix(docs):
    rows = pairs(docs, ("doc_id", "text", "source"))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(brute.words(t))
    wanted = brute.targets(sizes)
    mixed = op2.mix(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in mixed) == Counter((i, len(brute.words(t))) for i, t, _ in rows)
    taken = Counter()
    for r in mixed:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]])
        words = r["epochs"] * r["size"] + r["part"]
        assert 0 <= words <= 3 * r["size"]
        taken[r["source"]] += words
    assert {s: taken[s] for s in sizes} == {s: math.floor(wanted[s] + 1e-6) for s in sizes}
    again = op2.mix(docs.repartition(3)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, mixed))


def test_mixed_documents(docs):
    mixed = op2.mix(docs).groupBy("source").agg(F.sum(F.expr("epochs * size + part"))).collect()
    shown = op2.mixed_documents(docs)
    assert shown.columns == docs.columns
    taken = Counter()
    for _, t, s, n in pairs(shown, ("doc_id", "text", "source", "n_chars")):
        taken[s] += len(brute.words(t))
        assert n == len(t)
    assert {r[0]: r[1] for r in mixed if r[1]} == dict(taken)


@pytest.mark.parametrize(
    ("texts", "weights", "shown"),
    [
        (["a b", "c d"], [1, 3], [{"a b"}, {"c d"}]),
        (["a b", "a b"], [1, 3], [{"a b"}]),
        (["a b", "a b"], [1, 7], [{"a"}]),
        (["a b", "a b"], [3, 1], [{"a b"}]),
    ],
)
def test_rows_without_ids_are_cut_one_by_one(spark, texts, weights, shown):
    rows = [(None, t, "s") for t in texts] + [(1, "w x y z", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    budget = 8 * weights[0] // sum(weights)
    found = [r["text"] for r in op2.mixed_documents(df, weights=weights).filter("source = 's'").collect()]
    assert sum(len(t.split()) for t in found) == budget
    assert set(found) in shown


# op3


def test_encoder_equals_whole_texts(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(op3.vocabulary_path())
    odd = ["", "  ", " a\x1cb", "don't I'VE <|endoftext|> x<|endoftext|>y", "ﬁ İstanbul ΣΑΣ Σ", "é àb ́c", "日本語 тест", "a\xa0b c", "A!!b 'll", "…—,;", "x'S."]
    encode = op3.encoder()
    for text in odd + [t for _, t in pairs(given(spark, "documents"))]:
        assert encode(text.encode()).tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("sequence", [4096, 64])
def test_pack(docs, sequence):
    encode = op3.encoder()
    expected = Counter()
    for i, t in pairs(docs):
        ids = np.append(encode((t or "").encode()), 2).astype("<u4")
        for start in range(0, len(ids), sequence):
            piece = ids[start : start + sequence]
            expected[(i, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    packed = op3.pack(docs, sequence)
    got = packed.collect()
    assert Counter(tuple(r[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")) for r in got) == expected
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(by) == list(range(len(by)))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= sequence


@pytest.mark.parametrize("sequence", [4096, 64])
def test_sequences_hold_the_ids_of_every_document(docs, sequence):
    packed = written(op3.pack(docs, sequence), "test-packed")
    made = {r["sequence_id"]: r["ids"] for r in op3.sequences(packed).collect()}
    assert all(0 < len(ids) <= sequence for ids in made.values())
    encode = op3.encoder()
    back, total = defaultdict(list), 0
    for r in sorted(op3.piece_columns(packed).collect(), key=lambda r: r["start"]):
        ids = made[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
        total += len(ids)
        back[r["doc_id"]] += ids
    rows = pairs(docs)
    assert total == sum(map(len, made.values())) == sum(len(encode((t or "").encode())) + 1 for _, t in rows)
    repeated = Counter(i for i, _ in rows)
    for i, t in rows:
        if repeated[i] == 1:
            assert back[i] == [*encode((t or "").encode()).tolist(), 2]


def test_patterns_leave_little_padding():
    random = np.random.default_rng(1)
    for lengths in (random.integers(1, 4097, 50_000), np.minimum(4096, random.lognormal(6.5, 1, 50_000).astype(int) + 1), np.full(1000, 3)):
        histogram = dict(Counter(lengths.tolist()))
        patterns = op3.pack_patterns(histogram)
        used = Counter()
        for count, items in patterns:
            assert sum(length * times for length, times in items) <= 4096
            for length, times in items:
                used[length] += count * times
        assert used == histogram
        assert sum(count for count, _ in patterns) <= 1.005 * sum(lengths) / 4096 + 1


# op4


def test_pattern_spans():
    text = brute.awkward_rows()[12][1]
    found = [(k, text[s:e]) for k, s, e in op4.pattern_spans(text)]
    assert found == [
        ("email", "a.b@c.org"),
        ("ip", "10.0.0.1"),
        ("card", "4111 1111 1111 1111"),
        ("phone", "+1 (988) 555-2485"),
    ]
    assert op4.pattern_spans("a@b 1.2.3.256, 4111111111111112, +12 a@@b.c") == []


def test_emails_and_addresses_equal_the_plain_patterns():
    random = np.random.default_rng(2)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    address = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(2000):
        text = "".join(random.choice(list("a1.@- é2"), 25))
        spans = op4.pattern_spans(text)
        assert [s[1:] for s in spans if s[0] == "email"] == [m.span() for m in email.finditer(text)]
        small = [m.span() for m in address.finditer(text) if all(int(p) < 256 for p in m.group().split("."))]
        assert [s[1:] for s in spans if s[0] == "ip"] == small


def test_linear_time_on_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 100_000, "1 " * 150_000):
        op4.pattern_spans(text)


@pytest.fixture(scope="module")
def field():
    return op4.fit(op4.labelled_lines())


def test_field_labels_unseen_lines(field):
    lines = op4.labelled_lines(200, seed=77)
    runs = op4.decoder(field)([tokens for tokens, _ in lines])
    right = total = 0
    for (tokens, labels), found in zip(lines, runs):
        guess = ["O"] * len(tokens)
        for start, end, kind in found:
            guess[start:end] = [kind] * (end - start)
        right += sum(a == b for a, b in zip(guess, labels))
        total += len(tokens)
    assert right / total > 0.98


def test_viterbi_equals_all_paths():
    from itertools import product

    random = np.random.default_rng(3)
    scores, steps = random.normal(size=(3, 4, 3)), random.normal(size=(3, 3))
    lengths = np.array([4, 3, 1])
    path = op4.viterbi(scores, steps, lengths)
    for line, n in enumerate(lengths):
        def value(p):
            return sum(scores[line, t, p[t]] for t in range(n)) + sum(steps[p[t], p[t + 1]] for t in range(n - 1))

        assert tuple(path[line, :n]) == max(product(range(3), repeat=int(n)), key=value)


def test_find(docs, field):
    found = op4.find(docs.select("doc_id", "text"), field)
    rows = {r["doc_id"]: r["_found"] for r in found.collect()}
    assert [rows[11][f"n_{k}"] for k in op4.KINDS] == [1, 1, 1, 1]
    text = brute.awkward_rows()[12][1]
    spans = [s.split(":") for s in rows[11]["spans"].split(",")]
    assert ("phone", "988-555-2486") in [(k, text[int(s) : int(e)]) for k, s, e in spans]
    assert rows[1]["spans"] == "" and rows[4]["n_added"] == 0
    assert op4.masked("to a@b.c!", [("email", 3, 8)]) == "to <email>!"


# op5


def test_table_equals_permutations():
    shards = [f"s{n}" for n in range(7)]
    assert op5.filled_table(shards, 101) == brute.filled(shards, 101)
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            op5.filled_table(bad, 101)
    with pytest.raises(ValueError):
        op5.filled_table(["a"], 100)


def test_placement(spark, docs):
    table = op5.filled_table(op5.SHARDS)
    share = Counter(table)
    assert max(share.values()) - min(share.values()) <= 1
    fewer = op5.filled_table(op5.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(table, fewer) if a != len(op5.SHARDS) - 1)
    assert moved < 0.05 * op5.SLOTS
    weighted = Counter(op5.filled_table(["a", "b"], 101, {"b": 3}))
    assert 2.5 < weighted[1] / weighted[0] < 3.5
    placed = op5.place(docs)
    by_key = defaultdict(set)
    for r in placed.collect():
        assert r["shard"] == table[r["slot"]] and r["shard_name"] == op5.SHARDS[r["shard"]]
        by_key[r["doc_id"]].add(r["shard"])
    assert placed.count() == docs.count() and all(len(s) == 1 for s in by_key.values())


def test_write_shards(spark, docs, tmp_path):
    op5.write_shards(op5.place(docs.select("doc_id", "text"), shards=["a", "b"], slots=11), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()


# op6 and op10


def accuracy(spark, classify, label, folds, held):
    scored = classify(given(spark, "documents", LARGER), given(spark, "labels", LARGER))
    rows = scored.join(given(spark, "labels", LARGER), "doc_id").filter("held_out").collect()
    assert all(0 <= r["score"] <= 1 and brute.fold(r["doc_id"], folds) == held for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)
    return sum(r["predicted"] == r[label] for r in rows) / len(rows)


def test_toxicity_on_held_out_documents(spark):
    assert accuracy(spark, op6.classify, "toxic", 3, 1) > 0.9


def test_quality_on_held_out_documents(spark):
    assert accuracy(spark, op10.classify, "quality", 4, 2) > 0.9


def test_toxicity_finds_the_sentence(spark):
    good = [(b"The weather is fine today. We walk along the river %d." % n, 0) for n in range(40)]
    bad = [(b"The weather is fine today. You are a vile fool %d. We walk on." % n, 1) for n in range(40)]
    model = op6.fit(good + bad)
    df = spark.createDataFrame([(1, "Fine river. Étoile, vile fool! The end"), (2, "The weather."), (3, None)], "doc_id int, text string")
    rows = {r["doc_id"]: r for r in op6.offending_sentences(df, model).collect()}
    assert set(rows) == {1} and rows[1]["_found"]["sentence"] == " Étoile, vile fool"
    assert op6.score(df, model).filter("doc_id = 3").first()["_found"]["score"] == 0


def test_toxicity_finds_every_offending_sentence(spark):
    model = op6.Model({b"bad": 6.0, b"worse": 8.0}, -3.0)
    text = "Été bad. Fine. Worse é!" + " ok." * 500 + " Bad"
    df = spark.createDataFrame([(1, text), (2, "fine"), (3, None)], "doc_id int, text string")
    found = sorted((r["doc_id"], r["_found"]["start"], r["_found"]["end"], r["_found"]["sentence"]) for r in op6.offending_sentences(df, model).collect())
    assert [f[3] for f in found] == ["Été bad", " Worse é", " Bad"] and {f[0] for f in found} == {1}
    assert all(text[start:end] == sentence for _, start, end, sentence in found)


def test_noisy_or_adds_up_sentences():
    model = op6.Model({b"bad": 3.0}, -3.0)
    score = model.scorer()
    one, two = score(b"bad. good")[0], score(b"bad. bad")[0]
    p, q = 0.5, 1 / (1 + math.exp(3))
    assert one == pytest.approx(1 - (1 - p) * (1 - q)) and two == pytest.approx(1 - (1 - p) ** 2)


def test_classifiers_without_labels(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in op10.classify(docs, none).collect()} == {0.5}
    assert {r["score"] for r in op6.classify(docs, none).collect()} == {0.0}
    assert op6.classify(docs, none).count() == docs.count()


def test_sample_is_bounded_and_leaves_out_the_fold(spark):
    docs, labels = given(spark, "documents", LARGER), given(spark, "labels", LARGER)
    sample = labelled_sample(docs, labels, "quality", 4, 2, 20)
    assert Counter(y for _, y in sample) == {0: 20, 1: 20}
    twice = labelled_sample(docs.union(docs), labels.union(labels), "quality", 4, 2, 20)
    assert len(twice) <= 40
    allowed = {t for i, t in pairs(docs) if brute.fold(i, 4) != 2}
    assert all(t.decode() in allowed for t, _ in sample)


def test_chunks_cover_the_text():
    for n in (0, 1, 511, 512, 513, 5000):
        text = bytes(1 + k % 250 for k in range(n))
        cut = op10.chunks(text)
        step = op10.CHUNK - op10.OVERLAP
        back = b"".join(c[:step].tobytes() for c in cut[:-1]) + cut[-1].tobytes()
        assert back[:n] == text and not any(back[n:])


# op7


def test_measures(docs):
    judged = op7.ledger(docs)
    name = judged.columns[-1]
    for r in judged.collect():
        text, found = r["text"] or "", r[name]
        ws = brute.words(text)
        lines = [line for line in text.split("\n") if brute.words(line)]
        assert (found["n_words"], found["word_chars"]) == (len(ws), sum(map(len, ws)))
        assert found["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert found["n_dup_lines"] == len(lines) - len(set(lines))
        assert found["n_repeat_words"] == brute.repeated_words(ws)


def test_repeated_words():
    random = np.random.default_rng(5)
    for _ in range(300):
        ws = [b"%d" % n for n in random.integers(0, 4, random.integers(0, 30))]
        assert op7.repeated_words(ws) == brute.repeated_words(ws)


def test_policies_and_ablation(docs):
    kept = op7.apply_policy(docs, op7.POLICIES[0])
    assert kept.columns == docs.columns
    expected = [
        i for i, t in pairs(docs)
        if len(brute.words(t)) >= 50 and 100 * brute.repeated_words(brute.words(t)) <= 50 * len(brute.words(t))
    ]
    assert Counter(i for i, _ in pairs(kept)) == Counter(expected)
    judged = op7.ledger(docs)
    failed = judged.select(F.col(f"`{judged.columns[-1]}`.failed").alias("failed"))
    masks = [r[0] for r in failed.collect()]
    for r in op7.ablation(failed, op7.PRODUCTION).collect():
        bit = next(1 << x.bit for x in op7.RULES if x.name == r["rule"])
        assert r["fails"] == sum(bool(m & bit) for m in masks)
        assert r["fails_alone"] == sum(m == bit for m in masks)
        assert r["kept_without"] == sum(m & ~bit == 0 for m in masks)


# op8


@pytest.mark.parametrize("chunk_bytes,keys", [(16_000_000, 1_000_000), (20_000, 3_000)])
def test_counts_and_base_score(spark, docs, monkeypatch, chunk_bytes, keys):
    monkeypatch.setattr(op8, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(op8, "KEYS_A_RANGE", keys)
    both = given(spark, "documents").select("doc_id", "text").union(docs.select("doc_id", "text")).repartition(3)
    rows = pairs(both)
    tokens = [[w.encode().lower() for w in brute.words(t)] + [b" end"] for _, t in rows]
    train = [t for (i, _), t in zip(rows, tokens) if brute.fold(i, 7) != 2]
    count = Counter(w for t in train for w in t)
    total, distinct = sum(count.values()), len(count)
    expected = Counter()
    for (i, _), t in zip(rows, tokens):
        base = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in t)
        expected[(i, len(t), sum(count[w] > 0 for w in t), total, round(base, 3))] += 1
    got = op8.scores(both).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)) for r in got) == expected
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_bigram_totals_do_not_depend_on_chunks(spark, monkeypatch):
    documents = given(spark, "documents")
    whole = {r["doc_id"]: r["score"] for r in op8.scores(documents).collect()}
    monkeypatch.setattr(op8, "CHUNK_BYTES", 30_000)
    parts = {r["doc_id"]: r["score"] for r in op8.scores(documents.repartition(4)).collect()}
    assert parts == pytest.approx(whole)


def test_weights_sum_to_one_and_follow_the_data():
    trusted = op8.learn_weights({(5 << 32) + (1 << 16) + 1: 100}, 1000, 50)
    assert np.allclose(trusted.sum(1), 1) and trusted[5, 0] > 0.9
    unseen = op8.learn_weights({(5 << 32): 100}, 1000, 50)
    assert unseen[5, 2] > 0.9
    numbers = np.array([0, 1, 255, 2**40])
    assert op8.unpacked(op8.packed(numbers)).tolist() == numbers.tolist()


# op9


def compare_components(rows, groups):
    expected = brute.near_components(rows)
    wanted = Counter((row[0], *found[:2]) for row, found in zip(rows, expected))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in groups.collect()) == wanted


def test_near_groups_on_awkward_rows(docs):
    compare_components(pairs(docs), op9.near_groups(docs))


def test_near_groups_on_documents(spark):
    documents = given(spark, "documents", LARGER)
    compare_components(pairs(documents), op9.near_groups(documents))


def test_near_groups_in_a_large_dense_group(spark):
    """Hundreds of different texts around one, and pairs near one another only."""
    random = np.random.default_rng(8)
    base = [f"b{n}" for n in range(90)]
    rows = []
    for n in range(400):
        ws = list(base)
        for place in random.integers(0, 90, int(random.integers(1, 5))):
            ws[place] = f"x{n}_{place}"
        rows.append((n, " ".join(ws)))
    for n in range(400, 700):
        own = [f"o{n // 2}_{k}" for k in range(100)]
        own[int(random.integers(100))] = f"y{n}"
        rows.append((n, " ".join(base[:20] + own)))
    compare_components(rows, op9.near_groups(spark.createDataFrame(rows, "doc_id long, text string")))


def test_near_groups_in_a_family_of_unlinked_texts(spark, monkeypatch):
    """Thousands of texts that share a template, no two of them linked but planted pairs."""
    monkeypatch.setattr(op9, "BLOCK", 200)
    random = np.random.default_rng(9)
    template = [f"t{n}" for n in range(104)]
    rows = []
    for n in range(3000):
        own = [f"o{n}_{k}" for k in range(46)]
        rows.append((n, " ".join(template + own)))
        if n % 30 == 0:
            for place in random.choice(46, 2, replace=False):
                own[place] = f"y{n}_{place}"
            rows.append((10_000 + n, " ".join(template + own)))
    groups = op9.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # All share the template's 100 shingles of 146: 100 / 192 of what two have is less than the limit.
    linked = {r["doc_id"]: r["component_id"] for r in groups}
    sets = dict((i, brute.shingle_set(t)) for i, t in rows)
    for n in range(0, 3000, 30):
        a, b = sets[n], sets[10_000 + n]
        assert 100 * len(a & b) >= 75 * len(a | b)
    assert linked == {i: i % 10_000 for i, _ in rows}


def test_intersections_equal_sets():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 4000, int(n)).astype(np.uint64)) for n in draw.integers(0, 3000, 25)]
    found = op9.intersections(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert i == j or found[i, j] == len(set(a.tolist()) & set(b.tolist()))
    assert op9.intersections([]).tolist() == []


def test_members_sent_grow_with_a_family_not_with_its_square(spark):
    """Texts 0.6 to 0.74 alike and none linked: what leaves the tasks that compare them."""
    counts = []
    for size in (600, 1200):
        random = np.random.default_rng(size)
        rows = []
        for n in range(size):
            ws = [f"b{k}" for k in range(100)]
            for place in random.choice(100, 4, replace=False):
                ws[place] = f"x{n}_{place}"
            rows.append((n, " ".join(ws)))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        sets = written(op9.described(docs, "doc_id", "text"), "test-rows").selectExpr(
            "doc_id AS set_no", "doc_id AS component", "roots", "signature", "n_shingles"
        )
        nodes = op9.small_nodes(sets, (0, len(op9.ROOTS)), "test-nodes", all_pairs=True)
        counts.append(written(op9.similar_members(sets, nodes), "test-members").count())
    assert counts[1] <= 2.2 * counts[0]


def test_drop_near_copies(docs):
    kept = op9.drop_near_copies(docs)
    assert kept.columns == docs.columns
    rows = pairs(docs)
    groups = {row: number for row, (size, _, number) in zip(rows, brute.near_components(rows)) if size}
    left = [groups[p] for p in pairs(kept) if p in groups]
    assert sorted(left) == sorted(set(groups.values()))
    assert {i for i, t in pairs(kept) if not brute.words(t)} == {1, 2, 3}


def test_components_of_a_chain(spark):
    links = [(n, n + 1) for n in range(60)] + [(100, 101), (100, 102)]
    found = op9.components(spark.createDataFrame(links, "a long, b long"), "chain")
    assert {r["set_no"]: r["component"] for r in found.collect()} == {n: 0 for n in range(61)} | {100: 100, 101: 100, 102: 100}


def test_network_equals_plain_loops():
    """Every chunk, place, filter and pooling step one by one, for texts shorter and longer than a chunk."""
    draw = np.random.default_rng(10)
    net = op10.Network(
        draw.normal(0, 1, (op10.WIDTH, 256, op10.FILTERS)).astype(np.float32),
        draw.normal(0, 1, op10.FILTERS).astype(np.float32),
        draw.normal(0, 0.1, 2 * op10.FILTERS).astype(np.float32),
        0.25,
    )
    step = op10.CHUNK - op10.OVERLAP
    texts = [b"", b"short", bytes(draw.integers(1, 256, 3 * op10.CHUNK + 17).astype(np.uint8))]
    found = net.scores(texts)
    for text, score in zip(texts, found):
        pieces = [text[at : at + op10.CHUNK] for at in range(0, max(1, len(text) - op10.OVERLAP), step)]
        assert b"".join(p[:step] for p in pieces[:-1]) + pieces[-1] == text
        pooled = []
        for piece in pieces:
            padded = piece.ljust(op10.CHUNK, b"\0")
            sums = [
                sum(net.filters[k, padded[place + k]].astype(np.float64) for k in range(op10.WIDTH))
                for place in range(op10.CHUNK - op10.WIDTH + 1)
            ]
            pooled.append(np.maximum(np.max(sums, 0) + net.bias, 0))
        vector = np.concatenate([np.mean(pooled, 0), np.max(pooled, 0)])
        assert score == pytest.approx(1 / (1 + math.exp(-(vector @ net.head + net.offset))), rel=1e-4)


# all


def test_empty_tables(spark, empty, field):
    labels = given(spark, "labels")
    for df in (
        op1.exact_groups(empty), op1.drop_copies(empty), op2.mix(empty), op2.mixed_documents(empty), op3.pack(empty),
        op4.find(empty, field), op5.place(empty), op6.classify(empty, labels), op7.ledger(empty), op8.scores(empty),
        op9.near_groups(empty), op9.drop_near_copies(empty), op10.classify(empty, labels),
    ):
        assert df.collect() == []
