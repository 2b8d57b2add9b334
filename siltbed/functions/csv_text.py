"""Records and cells of CSV text, as column expressions.

A quote opens a cell only at the cell's start; inside, two quotes are one; after
the closing quote and in plain cells quotes are letters. A line break ends a record
unless a quoted cell is open. Patterns never go back, so they take one pass and no
stack, however long a text is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A quoted cell up to its closing quote, which may be missing at the end of a text.
_OPEN = r'"[^"]*+(?:""[^"]*+)*+'
#: Any cell of a text with several records.
CELL = rf'(?:{_OPEN}(?:"[^,\n]*+)?+|[^",\n][^,\n]*+)?+'
_RECORD = rf"({CELL}(?:,{CELL})*+)(?:\n|\z)"
_CELL_OF_RECORD = rf',((?:{_OPEN}(?:"[^,]*+)?+|[^",][^,]*+)?+)'


def csv_records(text: Column) -> Column:
    """The records of a text without their line breaks; a break at the end starts no further record."""
    plain = F.split(text, "\n")
    # After its last record, a pattern search always meets the empty end of the text once more.
    found = F.regexp_extract_all(text, F.lit(_RECORD), F.lit(1))
    last_is_empty = F.when(F.element_at(plain, -1) == "", F.size(plain) - 1).otherwise(F.size(plain))
    return F.when(F.contains(text, F.lit('"')), F.slice(found, F.lit(1), F.size(found) - 1)).otherwise(
        F.slice(plain, F.lit(1), last_is_empty)
    )


def csv_cells(record: Column) -> Column:
    """The cells of one record, without the quotes around them."""

    def bare(cell: Column) -> Column:
        inside = F.regexp_extract(cell, rf"\A{_OPEN}", 0)
        rest = F.substring(cell, F.length(inside) + 2, F.length(cell))
        return F.when(
            F.startswith(cell, F.lit('"')),
            F.concat(F.replace(F.substring(inside, F.lit(2), F.length(inside)), F.lit('""'), F.lit('"')), rest),
        ).otherwise(cell)

    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_CELL_OF_RECORD), F.lit(1))
    return F.when(F.contains(record, F.lit('"')), F.transform(found, bare)).otherwise(F.split(record, ","))


#: States between two letters of a CSV text, each with a text that leads to it: a record starts, a cell starts, inside
#: a plain cell, inside a quoted cell, after a quote in a quoted cell.
STATES = {"record": "", "cell": ",", "plain": "x", "quoted": '"', "quote": '""'}
_COMPLETE = rf"\A(?:(?:{_OPEN}\"[^,\n]*+|[^\",\n][^,\n]*+)?+[,\n])*+"


def csv_state_after(text: Column, start: str) -> Column:
    """The state at the end of a text that begins in a given state."""
    whole = F.concat(F.lit(STATES[start]), text)
    done = F.regexp_extract(whole, _COMPLETE, 0)
    rest = F.substring(whole, F.length(done) + 1, F.length(whole))
    opened = F.regexp_extract(rest, rf"\A{_OPEN}", 0)
    return (
        F.when(rest == "", F.when((done == "") | F.endswith(done, F.lit("\n")), F.lit("record")).otherwise(F.lit("cell")))
        .when(~F.startswith(rest, F.lit('"')), F.lit("plain"))
        .when(F.length(opened) == F.length(rest), F.lit("quoted"))
        .when(F.length(opened) + 1 == F.length(rest), F.lit("quote"))
        .otherwise(F.lit("plain"))
    )


def csv_head(text: Column, start: Column) -> Column:
    """How many letters at the start of a text belong to the record that was open there, its line break included; the
    whole text if that record does not end."""
    lead = F.element_at(F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair]), start)
    first = F.regexp_extract(F.concat(lead, text), rf"\A{_RECORD}", 0)
    return F.when(start == "record", F.lit(0)).otherwise(F.length(first) - F.length(lead))
