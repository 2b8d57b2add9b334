"""Quality rules as a bitmask ledger.

All rules are measured in one pass over the whole texts. The ledger keeps the
measurements and one bit per failed rule. A policy is a versioned set of rules:
applying one is a bitwise AND, so new policies and ablations never read a text
again.

Defined results: NULL text has no word; an empty text fails ``few_words``;
doc_id may be NULL or repeated, each row is judged by itself; very long texts are
measured whole, their words as numbers; an empty table
gives an empty ledger; all columns of the input pass through, the ledger's own
column gets underscores if its name is taken.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import quoted, with_text_columns

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_caps_words"]
#: Fixed value of the contract.
SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """How many words lie in windows of ``width`` words that occur twice or more."""
    count = len(words) - width + 1
    if count < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) == len(words):
        return 0
    windows = ids[:count]
    for shift in range(1, width):
        # Numbers stay below words squared, so nothing overflows.
        joined = windows * len(known) + ids[shift : shift + count]
        _, windows = np.unique(joined, return_inverse=True)
    twice = np.bincount(windows)[windows] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(twice), 1)
    np.add.at(covered, np.flatnonzero(twice) + width, -1)
    return int(np.count_nonzero(np.cumsum(covered)[: len(words)]))


def measure_text(text: bytes) -> list[int]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    joined = b"".join(words)
    return [
        len(words),
        len(joined.decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(w.isupper() and len(w) > 1 for w in words),
    ]


def measured(docs: DataFrame, column: str = "text") -> DataFrame:
    """The documents with a struct ``_found`` of all measurements."""

    def compute() -> Callable[[list[bytes]], list[list]]:
        return lambda texts: list(map(list, zip(*map(measure_text, texts)))) or [[] for _ in MEASURES]

    return with_text_columns(docs, [T.StructField(m, T.LongType()) for m in MEASURES], compute, column)


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; the bit is the rule's place in the ledger and never reused."""

    name: str
    bit: int
    fails: str


RULES = [
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "n_symbols > n_words"),
    Rule("long_words", 3, "word_chars > 25 * n_words"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("duplicate_lines", 5, "10 * n_dup_lines > 5 * n_lines AND n_dup_lines >= 3"),
    Rule("capitals", 6, "10 * n_caps_words > 8 * n_words"),
]


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: list[Rule]) -> int:
        known = {r.name: 1 << r.bit for r in rules}
        return sum(known[name] for name in self.rules)


#: Version 1 has the base rules, version 2 all that speak against running prose.
POLICIES = [
    Policy("base", 1, ("few_words", "repeated_windows")),
    Policy("prose", 2, tuple(rule.name for rule in RULES)),
]
PRODUCTION = POLICIES[1]


def ledger(docs: DataFrame, rules: list[Rule] = RULES, column: str = "text") -> DataFrame:
    """The documents with a struct: all measurements, ``failed`` bits."""
    found = measured(docs, column)
    name = found.columns[-1]

    def fails(rule: Rule) -> Column:
        condition = rule.fails
        for m in MEASURES:
            condition = condition.replace(m, f"`{name}`.{m}")
        return F.when(F.expr(condition), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long")

    bits = fails(rules[0])
    for rule in rules[1:]:
        bits = bits.bitwiseOR(fails(rule))
    return found.withColumn(name, F.col(name).withField("failed", bits))


def passes(failed: Column, policy: Policy, rules: list[Rule] = RULES) -> Column:
    return failed.bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def apply_policy(docs: DataFrame, policy: Policy = PRODUCTION, column: str = "text") -> DataFrame:
    """The documents that no rule of the policy rejects, with the input's columns."""
    judged = ledger(docs, column=column)
    return judged.filter(passes(F.col(f"{judged.columns[-1]}.failed"), policy)).select(*quoted(docs.columns))


def ablation(failed: DataFrame, policy: Policy = PRODUCTION, rules: list[Rule] = RULES) -> DataFrame:
    """Per rule of a policy: how many rows fail it, fail it alone, and pass if it goes. Needs a column ``failed``.

    One aggregate over the different bitmasks, of which there are at most 2 ** rules.
    """
    masks = failed.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    mask = policy.mask(rules)
    lines = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules if r.name in policy.rules]
    )
    each = masks.select("failed", "n", F.inline(lines))
    inside = F.col("failed").bitwiseAND(F.lit(mask).cast("long"))
    return each.groupBy("rule").agg(
        F.sum(F.when(inside.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(inside == F.col("bit"), F.col("n")).otherwise(0)).alias("fails_alone"),
        F.sum(F.when(inside.bitwiseAND(F.bitwise_not("bit")) == 0, F.col("n")).otherwise(0)).alias("kept_without"),
    )


def rule_columns(judged: DataFrame, policy: Policy = PRODUCTION, rules: list[Rule] = RULES) -> DataFrame:
    found = judged.columns[-1]
    failed = F.col(f"{found}.failed")
    base = POLICIES[0]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        "doc_id",
        *[F.col(f"{found}.{m}").alias(m) for m in names],
        (~passes(failed, base, rules)).alias("base_failed"),
        passes(failed, policy, rules).alias("kept"),
        failed.alias("failed_rules"),
        F.lit(policy.version).alias("policy_version"),
    )


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
placed AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
trios AS (
  SELECT r, i, word, lead(word) OVER p AS second, lead(word, 2) OVER p AS third
  FROM placed WINDOW p AS (PARTITION BY r ORDER BY i)),
twice AS (
  SELECT r, i FROM trios WHERE third IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY r, word, second, third) > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS s(k) GROUP BY r),
word_stats AS (
  SELECT r, sum(length(word))::BIGINT AS chars,
         count(*) FILTER (strlen(word) > 1 AND regexp_matches(word, '[A-Z]') AND NOT regexp_matches(word, '[a-z]')) AS caps
  FROM placed GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
line_stats AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(s.chars, 0) AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(l.dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         coalesce(l.n, 0) AS n_lines, coalesce(s.caps, 0) AS n_caps
  FROM w LEFT JOIN word_stats s USING (r) LEFT JOIN line_stats l USING (r) LEFT JOIN covered c USING (r)),
b AS (
  SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (n_symbols > n_words)::INT
    + 8 * (word_chars > 25 * n_words)::INT + 16 * (word_chars < 2 * n_words)::INT
    + 32 * (10 * n_dup_lines > 5 * n_lines AND n_dup_lines >= 3)::INT + 64 * (10 * n_caps > 8 * n_words)::INT)::BIGINT AS failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
       failed = 0 AS kept, failed AS failed_rules, 2 AS policy_version
FROM b
"""
