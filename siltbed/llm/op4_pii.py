"""Personal data by fixed patterns and a linear-chain conditional random field.

The field labels the tokens of every line with O or a kind. Its features are the
word shape of a token and of its neighbours. It is trained from a small labelled
table (``labelled_lines`` makes the default one, any other has the same form) by
gradient ascent on the likelihood, and decoded by Viterbi over many lines at
once. Runs of one kind become spans if they pass that kind's check and touch no
pattern span: the patterns find what is written by the book, the field what is
not, as a phone number without a plus or an address with "(at)".

Defined results: NULL counts as empty and has no span; repeated rows are each
searched; very long texts are searched whole, patterns in one pass and the rest
line by line; an empty table gives an empty result; only id and text are read. Spans
are (kind, start, end) in code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siltbed.llm.common import with_text_columns

Span = tuple[str, int, int]

#: Fixed values of the contract.
KINDS = ["email", "ip", "card", "phone"]
EMAIL_BEFORE = re.compile(r"[A-Za-z0-9._%+-]")
EMAIL_AFTER = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match takes whole runs of digits, so one can only begin where a run does.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LABELS = ["O", *KINDS]
#: White space to ``str.split`` that is no white space of the contract.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
REMEMBERED = 400_000
#: Lines that are decoded at once.
LINES = 512


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if place % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """As the pattern's leftmost matches, but found from the at sign, in linear time."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and EMAIL_BEFORE.match(text[start - 1]):
            start -= 1
        after = EMAIL_AFTER.match(text, at + 1) if start < at else None
        if after:
            found.append(("email", start, after.end()))
        free = after.end() if after else at + 1
        at = text.find("@", free)
    return found


def pattern_spans(text: str) -> list[Span]:
    found = emails(text)
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        number = digits(m.group())
        if 13 <= len(number) <= 19 and luhn(number):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(digits(m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def labelled_lines(lines: int = 900, seed: int = 4) -> list[tuple[list[str], list[str]]]:
    """The small labelled table: tokens and labels of made-up lines, a third of them without personal data."""
    r = np.random.default_rng(seed)

    def pick(options):
        return options[int(r.integers(len(options)))]

    def number(n: int) -> str:
        return "".join(str(d) for d in r.integers(0, 10, n))

    def letters(least: int = 1, most: int = 9) -> str:
        return "".join(chr(97 + c) for c in r.integers(0, 26, int(r.integers(least, most + 1))))

    def ip() -> str:
        return ".".join(str(x) for x in r.integers(0, 256, 4))

    def name() -> str:
        return pick([letters(3, 8), f"{letters(2, 6)}.{letters(3, 7)}", letters(2, 5) + number(2), f"{letters(3, 6)}_{number(1)}"])

    def host() -> str:
        return f"{letters(3, 8)}.{pick(['com', 'org', 'net', 'de', 'fr', 'es', 'example.com'])}"

    three, four = (lambda: number(3)), (lambda: number(4))
    private = {
        "email": [
            lambda: f"{name()}@{host()}",
            lambda: f"{name()} (at) {host()}",
            lambda: f"{name()} [at] {host()}",
            lambda: f"{name()}(at){host()}",
            lambda: f"{name()}[at]{host()}",
        ],
        "ip": [ip, lambda: f"2001:db8:{letters(1, 3)}{number(1)}::{number(2)}", lambda: f"fe80::{number(4)}:{number(3)}:{number(4)}"],
        "card": [
            lambda: number(16),
            lambda: " ".join(four() for _ in range(4)),
            lambda: "-".join(four() for _ in range(4)),
            lambda: ".".join(four() for _ in range(4)),
        ],
        "phone": [
            lambda: f"+{number(1)} ({three()}) {three()}-{four()}",
            lambda: f"({three()}) {three()}-{four()}",
            lambda: f"{three()}-{three()}-{four()}",
            lambda: f"{three()}.{three()}.{four()}",
            lambda: f"+{number(2)} {number(2)} {number(7)}",
            lambda: f"{pick(['tel.', 'call', 'phone', 'tel:', 'fax'])} 0{number(3)} {number(7)}",
        ],
    }
    other = [
        lambda: f"20{number(2)}-0{1 + int(r.integers(9))}-1{number(1)}",
        lambda: f"{number(2)}:{number(2)}",
        lambda: f"{number(1)}.{number(1)}",
        lambda: f"{number(1)}.{number(2)}.{number(1)}",
        lambda: f"{number(1)},{three()}.{number(2)}",
        lambda: f"({letters(2, 6)})",
        lambda: f"({number(1)})",
        lambda: f"{letters(2, 6)}.",
        lambda: f"{letters(2, 6)}{pick('.,')}{pick(['***', '$$$', '%%%', '###', '&&&', '!!'])}".title(),
        lambda: letters(2, 9).upper() + pick(["!!", ".!!", ",!!"]),
        lambda: f"{letters(2, 6)},",
        lambda: letters(1, 6) + pick(["***", "$$$", "%%%", "###", "&&&", "!!", ".***", ",%%%", ".&&&"]),
        lambda: f"password={letters(1, 3)}{number(4)}{letters(1, 3)}{number(5)}",
        lambda: f'token = "{number(5)}{letters(2, 4)}{number(6)}{letters(1, 3)}{number(4)}"',
        lambda: "AKIA" + letters(6, 8).upper() + number(4) + letters(2, 4).upper(),
        lambda: f"978-{number(1)}-{number(2)}-{number(6)}-{number(1)}",
        lambda: f"#{number(7)}",
        lambda: number(int(r.integers(1, 10))),
        lambda: pick(["|", "-", "=", "at", "call", "phone", "CC BY-NC 4.0.", "Version 2.0."]),
    ]
    table = []
    for _ in range(lines):
        tokens: list[str] = []
        labels: list[str] = []

        def add(text: str, label: str) -> None:
            for token in text.split():
                tokens.append(token)
                labels.append("O" if token in ("tel.", "call", "phone", "tel:", "fax") else label)

        for _ in range(int(r.integers(1, 5))):
            for _ in range(int(r.integers(0, 6))):
                add(letters(1, 9) if r.random() < 0.7 else letters(1, 9).title(), "O")
            if r.random() < 0.5:
                kind = pick(KINDS)
                add(pick(private[kind])() + pick(["", "", ",", "."]), kind)
            else:
                add(pick(other)(), "O")
        table.append((tokens, labels)) if tokens else None
    return table


class _Shape(dict):
    """Maps digits to 9, capital letters to A, other letters to a."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = found = "9" if "0" <= c <= "9" else c if not c.isalpha() else "A" if c.isupper() else "a"
        return found


_SHAPE = _Shape()
_RUNS = re.compile(r"(a)a+|(A)A+|(9999)9+")


def token_features(token: str) -> tuple[str, ...]:
    """The word shape (runs of letters count as one, runs of digits as four at most) and a few coarse marks."""
    core = token.rstrip(".,;:!?")
    if core.isalpha():
        return (f"word={core.lower()}", "letters")
    shape = _RUNS.sub(lambda m: m.group(1) or m.group(2) or m.group(3) + "+", core[:80].translate(_SHAPE))
    count = len(digits(core))
    size = "0" if not count else "1" if count < 4 else "4" if count < 7 else "7" if count < 9 else "9" if count < 13 else "13" if count < 20 else "20"
    marks = [f"shape={shape}", f"digits={size}"]
    marks += [f"has={c}" for c in "@.:-()[]+=\"#" if c in core]
    if any(c.isalpha() for c in core):
        marks.append("mixed" if count else "no digit")
    return tuple(marks)


class Field:
    """Scores of a feature at a token, before it and after it, by label; transitions between labels."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, steps: np.ndarray) -> None:
        self.index, self.weights, self.steps = index, weights, steps

    def scores(self, features: tuple[str, ...]) -> np.ndarray:
        return self.weights[[self.index[f] for f in features]].sum(0) if features else np.zeros(self.weights.shape[1:])


def line_scores(parts: np.ndarray) -> np.ndarray:
    """Lines x tokens x (self, next to the left, next to the right) x labels -> lines x tokens x labels."""
    total = parts[:, :, 0].copy()
    total[:, 1:] += parts[:, :-1, 1]
    total[:, :-1] += parts[:, 1:, 2]
    return total


def viterbi(scores: np.ndarray, steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The best labels of every line; lines are padded to one length, longest first."""
    lines, longest, labels = scores.shape
    back = np.zeros((lines, longest, labels), np.int8)
    best = scores[:, 0].copy()
    for at in range(1, longest):
        here = int(np.searchsorted(-lengths, -at, "left"))
        reach = best[:here, :, None] + steps
        back[:here, at] = reach.argmax(1)
        best[:here] = reach.max(1) + scores[:here, at]
    path = np.zeros((lines, longest), np.int8)
    label = best.argmax(1)
    for at in range(longest - 1, -1, -1):
        here = int(np.searchsorted(-lengths, -at, "left"))
        path[:here, at] = label[:here]
        label[:here] = back[np.arange(here), at, label[:here]]
    return path


def fit(table: list[tuple[list[str], list[str]]], turns: int = 120, rate: float = 0.1, ridge: float = 1e-3) -> Field:
    """Gradient ascent (Adam) on the conditional likelihood, by forward and backward sums over padded lines."""
    table = [row for row in table if row[0]]
    index: dict[str, int] = {}
    for tokens, _ in table:
        for token in tokens:
            for f in token_features(token):
                # A rare word stands for any word.
                if not f.startswith("word=") or f[5:] in ("at", "call", "phone", "tel", "fax"):
                    index.setdefault(f, len(index))
    labels, longest = len(LABELS), max((len(t) for t, _ in table), default=1)
    # Tokens with the same features are one class; the last class is padding.
    classes: dict[tuple[int, ...], int] = {}
    number = np.full((len(table), longest), -1)
    gold = np.zeros((len(table), longest, labels))
    for n, (tokens, names) in enumerate(table):
        for t, (token, name) in enumerate(zip(tokens, names)):
            own = tuple(sorted({index[f] for f in token_features(token) if f in index}))
            number[n, t] = classes.setdefault(own, len(classes))
            gold[n, t, LABELS.index(name)] = 1
    mask = number >= 0
    has = np.zeros((len(classes) + 1, len(index)))
    for own, row in classes.items():
        has[row, list(own)] = 1
    gold_steps = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
    weights, steps = np.zeros((len(index), 3, labels)), np.zeros((labels, labels))
    moments = [[np.zeros(p.shape), np.zeros(p.shape)] for p in (weights, steps)]
    ends = mask.sum(1) - 1
    for turn in range(1, turns + 1):
        scores = line_scores(np.tensordot(has, weights, 1)[number])
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for t in range(1, longest):
            ahead[:, t] = _log_sum(ahead[:, t - 1][:, :, None] + steps, 1) + scores[:, t]
        for t in range(longest - 2, -1, -1):
            later = _log_sum(steps + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where((t < ends)[:, None], later, 0)
        total = _log_sum(ahead[np.arange(len(table)), ends], 1)
        share = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
        error = gold - share
        grad = np.empty_like(weights)
        for place, (near, far) in enumerate(
            ((number, error), (number[:, :-1], error[:, 1:]), (number[:, 1:], error[:, :-1]))
        ):
            of_class = [np.bincount(near[near >= 0], far[near >= 0][:, k], len(has)) for k in range(labels)]
            grad[:, place] = has.T @ np.stack(of_class, 1)
        joint = ahead[:, :-1, :, None] + steps + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        step_grad = gold_steps - (np.exp(joint) * mask[:, 1:, None, None]).sum((0, 1))
        for p, g, (m, v) in zip((weights, steps), (grad - ridge * weights, step_grad - ridge * steps), moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return Field(index, weights, steps)


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    most = values.max(axis, keepdims=True)
    return (most + np.log(np.exp(values - most).sum(axis, keepdims=True))).squeeze(axis)


def decoder(field: Field) -> Callable[[list[str]], list[list[tuple[int, int, str]]]]:
    """For each line of white-space tokens, the runs (first token, last token + 1, kind) that the field finds."""
    known: dict[str, int] = {}
    classes: dict[tuple[str, ...], int] = {}
    scores: list[np.ndarray] = []

    def learn(token: str) -> int:
        if len(known) > REMEMBERED:
            known.clear()
        # Tokens with the same known features score alike.
        own = tuple(f for f in token_features(token) if f in field.index)
        number = classes.get(own)
        if number is None:
            number = classes[own] = len(scores)
            scores.append(field.scores(own))
        known[token] = number
        return number

    def decode(lines: list[list[str]]) -> list[list[tuple[int, int, str]]]:
        found: list[list[tuple[int, int, str]]] = [[] for _ in lines]
        order = sorted((n for n, tokens in enumerate(lines) if tokens), key=lambda n: -len(lines[n]))
        at = 0
        while at < len(order):
            # As many lines as fit a bounded number of padded tokens.
            count = max(1, min(LINES, 200_000 // len(lines[order[at]])))
            batch = order[at : at + count]
            at += count
            lengths = np.array([len(lines[n]) for n in batch])
            number = np.zeros((len(batch), lengths[0]), np.int64)
            for row, n in enumerate(batch):
                number[row, : lengths[row]] = [known[t] if t in known else learn(t) for t in lines[n]]
            table = np.array(scores)
            parts = table[number]
            parts[np.arange(lengths[0]) >= lengths[:, None]] = 0
            path = viterbi(line_scores(parts), field.steps, lengths)
            for row in np.flatnonzero(path.any(1)):
                labels = path[row, : lengths[row]]
                cuts = np.flatnonzero(np.diff(labels, prepend=-1, append=-1))
                for start, end in zip(cuts[:-1], cuts[1:]):
                    if labels[start]:
                        found[batch[row]].append((int(start), int(end), LABELS[labels[start]]))
        return found

    return decode


def _passes(kind: str, text: str) -> bool:
    """What a run of labelled tokens must look like to become a span."""
    number = digits(text)
    if kind == "card":
        return 13 <= len(number) <= 19 and luhn(number)
    if kind == "phone":
        return 9 <= len(number) <= 15 and not any(c.isalpha() for c in text) and len(set(text) - set("0123456789")) > 0
    if kind == "ip":
        return text.count(":") >= 2 and all(c in "0123456789abcdefABCDEF:." for c in text)
    return bool(re.search(r"[(\[]at[)\]]|@", text, re.I)) and "." in text


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while end > start and text[end - 1] in ".,;:!?\"'<>":
        end -= 1
    while end > start and text[start] in ".,;:!?\"'<>":
        start += 1
    return start, end


def find_all(texts: list[str], decode: Callable) -> list[tuple[list[Span], list[Span]]]:
    """Per text the pattern spans and the spans that the field adds."""
    lines, places = [], []
    for n, text in enumerate(texts):
        start, odd = 0, ODD_SPACE.search(text)
        for line in text.split("\n"):
            tokens = WORD.findall(line) if odd else line.split()
            if tokens:
                lines.append(tokens)
                places.append((n, start, line))
            start += len(line) + 1
    base = [pattern_spans(text) for text in texts]
    added: list[list[Span]] = [[] for _ in texts]
    for (n, offset, line), runs in zip(places, decode(lines)):
        if not runs:
            continue
        tokens = [m.span() for m in WORD.finditer(line)]
        for first, last, kind in runs:
            start, end = _trimmed(line, tokens[first][0], tokens[last - 1][1])
            if start < end and _passes(kind, line[start:end]):
                start, end = start + offset, end + offset
                if all(end <= s or e <= start for _, s, e in base[n] + added[n]):
                    added[n].append((kind, start, end))
    return list(zip(base, added))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))


FIELDS = [
    *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
    T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()),
    T.StructField("n_added", T.LongType()),
]


def find(docs: DataFrame, field: Field, column: str = "text") -> DataFrame:
    """The documents with a struct: pattern spans per kind, their digest, all spans, number of added ones."""

    def compute() -> Callable[[list[bytes]], list[list]]:
        decode = decoder(field)

        def work(texts: list[bytes]) -> list[list]:
            found: list[list] = [[] for _ in FIELDS]
            for at in range(0, len(texts), 200):
                for base, added in find_all([t.decode("utf-8", "replace") for t in texts[at : at + 200]], decode):
                    counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                    digest = hashlib.sha256(listed(base).encode()).hexdigest()
                    for values, value in zip(found, (*counts, digest, listed(base + added), len(added))):
                        values.append(value)
            return found

        return work

    return with_text_columns(docs, FIELDS, compute, column)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets."""
    for kind, start, end in sorted(spans, key=lambda x: -x[1]):
        text = f"{text[:start]}<{kind}>{text[end:]}"
    return text


def search(docs: DataFrame) -> DataFrame:
    return find(docs.select("doc_id", "text"), fit(labelled_lines())).select("doc_id", "_found.*")
