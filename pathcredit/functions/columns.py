"""Small column-expression helpers (all JVM-side, codegen friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five marketing channels, in the reference's list order.
CHANNELS = (
    "Social Network",
    "Search Engine Marketing",
    "Google Display Network",
    "Affiliates",
    "Email",
)

# Markov chain states that are not channels.
START = "Start"
CONVERSION = "Conversion"
NULL_STATE = "Null"

# Fixed value: separator of the rendered journey path.
PATH_SEP = " > "


def pick(values: Sequence[str], index: Column) -> Column:
    """``values[index]`` (0-based) as a literal-array lookup; NULL if out of range."""
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def ratio(numer: Column, denom: Column) -> Column:
    """Division that yields NULL instead of an ANSI divide-by-zero error."""
    return F.try_divide(numer.cast("double"), denom.cast("double"))


def terminal_state(conversion: Column) -> Column:
    return F.when(conversion == 1, F.lit(CONVERSION)).otherwise(F.lit(NULL_STATE))


def transition_label(start: Column, end: Column) -> Column:
    return F.concat(start, F.lit(PATH_SEP), end)


def transition_array(path: Column | str) -> Column:
    """Native form of the reference's path UDF: split a rendered path on ``>``,
    strip each state and pair it with the next as ``"A > B"``.  JVM-side
    (``transform`` over the state indices), no Python worker.  A one-state
    path has no transition (empty array)."""
    states = F.transform(F.split(F.col(path) if isinstance(path, str) else path, ">"), lambda s: F.trim(s))
    pairs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(states) - 1, F.lit(1))),
        lambda i: F.concat(F.get(states, i - 1), F.lit(PATH_SEP), F.get(states, i)),
    )
    return F.filter(pairs, lambda x: x.isNotNull())
