"""Plain versions of the operators, and a table with everything that is awkward."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{n % 977}é" for n in range(60_000))
PROSE = " ".join(f"w{n * n % 1009}" for n in range(120))


def awkward_rows():
    """(doc_id, text, lang, source, n_chars): NULLs, empty, blank and long texts, ties, repeated rows."""
    near = PROSE.split()
    near[60] = "changed"
    texts = [
        (None, PROSE),
        (1, None),
        (2, ""),
        (3, " \n\t\x0b "),
        (4, LONG),
        (5, PROSE),
        (5, PROSE),
        (6, PROSE.upper()),
        (7, " ".join(near)),
        (8, "one two three"),
        (9, "one two three"),
        (10, "x" * 50_000),
        (11, "mail a.b@c.org, call +1 (988) 555-2485 or 988-555-2486 at 10.0.0.1; 4111 1111 1111 1111"),
        (12, "tab\tnew\nline\x85odd\xa0space"),
        (12, "same id, other text"),
    ]
    return [(i, t, "en" if i != 7 else None, f"src{i % 3}" if i else None, len(t or "")) for i, t in texts]


def awkward(spark):
    """The rows with further columns whose names the operators use inside."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    df = spark.createDataFrame(awkward_rows(), schema)
    for name in ("digest", "_found", "size", "rand", "range", "node", "rank", "kept", "_text_bytes", "twins", "set_no", "a.b"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


def fold(doc_id, folds):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def words(text):
    return WORD.findall(text or "")


def repeated_words(ws):
    windows = Counter(zip(ws, ws[1:], ws[2:]))
    covered = set()
    for i in range(len(ws) - 2):
        if windows[tuple(ws[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return len(covered)


def shingle_set(text):
    ws = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words(text)]
    return frozenset(tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))) if ws else frozenset()


def near_components(rows):
    """Per row (set size, component id, number of the component) by comparing all sets that share a shingle.

    Groups may have the same id if rows of one id have different texts.
    """
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            by[x].append(n)
    pairs = {(a, b) for ns in by.values() for a in ns for b in ns if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(i, least.get(find(n), i))
    return [(len(sets[n]), least.get(find(n)) if sets[n] else rows[n][0], find(n)) for n in range(len(rows))]


def targets(sizes, weights=(5, 2, 1), most=3):
    """Target words per source: shares by weight, the excess above ``most`` times the size dealt again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    fixed, left = {}, float(sum(sizes.values()))
    while True:
        open_ = [s for s in order if s not in fixed]
        unit = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * unit > most * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * unit for s in open_}
        for s in over:
            fixed[s] = most * sizes[s]
            left -= fixed[s]


def filled(shards, slots):
    """The lookup table, claimed slot by slot from whole permutations."""

    def number(name, purpose):
        return int.from_bytes(hashlib.sha256(f"{purpose}:{name}".encode()).digest()[:8], "big")

    wishes = []
    for name in shards:
        start, step = number(name, "start") % slots, number(name, "step") % (slots - 1) + 1
        wishes.append([(start + k * step) % slots for k in range(slots)])
    table = {}
    while len(table) < slots:
        for shard, wish in enumerate(wishes):
            if len(table) < slots:
                table[next(s for s in wish if s not in table)] = shard
    return [table[s] for s in range(slots)]
