"""Scanning JSON text piece by piece, as column expressions.

A piece may begin anywhere, also inside a string, so what it does is found for
each state it may begin in. Patterns never go back: one pass, no stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPEN = r'"[^"\\]*+(?:\\[\s\S][^"\\]*+)*+'
_STRING = _OPEN + '"'
#: States between two letters, each with a text that leads to it: outside strings, inside one, after its backslash.
STATES = {"outside": "", "string": '"', "escape": '"\\'}
#: Strings, open ones at the end too, signs, and what lies between: together the whole text.
_TOKEN = rf'{_OPEN}(?:"|\\?+\z)|[\[\]{{}},]|[^"\[\]{{}},]++'


def _flat(inside: str) -> str:
    return rf'[\[{{](?:[^"\[\]{{}}]++|{_STRING}|{inside})*+[\]}}]'


#: Values of keys that may stand before an array: scalars and containers nested twice.
_VALUE = rf'(?:{_STRING}|[^\s"\[\]{{}},]++|{_flat(_flat(r"(?!)"))})'


def array_start(text: Column, key: str) -> Column:
    """Number of letters up to and with the opening bracket of a top-level array; 0 if it is not found in a plain scan."""
    name = "".join(c if c.isalnum() or c == "_" else f"\\{c}" for c in key)
    header = rf'\A\s*+\{{(?:\s*+(?!"{name}"\s*+:){_STRING}\s*+:\s*+{_VALUE}\s*+,)*+\s*+"{name}"\s*+:\s*+\['
    return F.length(F.regexp_extract(text, header, 0))


def scan(text: Column, start: str) -> Column:
    """What a piece does if it begins in a state: the state after it (``state``) and how much deeper it ends (``deeper``)."""
    whole = F.concat(F.lit(STATES[start]), text)
    done = F.regexp_extract(whole, rf'\A(?:[^"]++|{_STRING})*+', 0)
    rest = F.substring(whole, F.length(done) + 1, F.length(whole))
    opened = F.regexp_extract(rest, rf"\A{_OPEN}", 0)
    brackets = F.regexp_replace(done, rf"{_STRING}|[^\[\]{{}}\"]++", "")
    opens = F.length(F.regexp_replace(brackets, r"[\]}]++", ""))
    state = (
        F.when(rest == "", F.lit("outside")).when(F.length(opened) == F.length(rest), F.lit("string")).otherwise(F.lit("escape"))
    )
    return F.struct(state.alias("state"), (2 * opens - F.length(brackets)).cast("long").alias("deeper"))


def borders(text: Column, start: Column, depth: Column) -> Column:
    """Of a piece that begins in a state, ``depth`` levels inside an array's elements: letters before the first comma
    between elements (``comma``) and before the array's closing bracket (``end``); NULL where there is none."""
    lead = F.element_at(F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair]), start)
    tokens = F.regexp_extract_all(F.concat(lead, text), F.lit(_TOKEN), F.lit(0))
    nothing = F.lit(None).cast("int")
    begin = F.struct(
        (-F.length(lead)).alias("at"), depth.cast("long").alias("depth"), nothing.alias("comma"), nothing.alias("end")
    )

    def step(seen: Column, token: Column) -> Column:
        opens, closes = token.isin("[", "{"), token.isin("]", "}")
        is_open = seen["end"].isNull()
        return F.struct(
            (seen["at"] + F.length(token)).alias("at"),
            F.when(opens, seen["depth"] + 1).when(closes, seen["depth"] - 1).otherwise(seen["depth"]).alias("depth"),
            F.coalesce(seen["comma"], F.when((token == ",") & (seen["depth"] == 0) & is_open, seen["at"])).alias("comma"),
            F.coalesce(seen["end"], F.when(closes & (seen["depth"] == 0), seen["at"])).alias("end"),
        )

    return F.aggregate(tokens, begin, step)
