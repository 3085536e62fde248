"""Small helpers for composing SQL expression text.

The geometry functions of this package take SQL text and return SQL text, used with ``F.expr`` or
``selectExpr``.  One parsed expression is built in milliseconds, where the same tree assembled
from Column objects takes thousands of calls into the JVM.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable

_names = itertools.count()


def fresh(prefix: str) -> str:
    """A lambda variable name not used anywhere else."""
    return f"{prefix}_{next(_names)}"


def num(value: float) -> str:
    return f"{float(value)!r}D"


def text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def struct(**fields: str) -> str:
    inside = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return f"named_struct({inside})"


def each(function: str, array: str, body: Callable[[str], str], prefix: str = "v") -> str:
    """``transform``, ``filter`` or ``exists`` with a one-argument lambda."""
    v = fresh(prefix)
    return f"{function}({array}, {v} -> {body(v)})"


def each_with_index(function: str, array: str, body: Callable[[str, str], str]) -> str:
    v, i = fresh("v"), fresh("i")
    return f"{function}({array}, ({v}, {i}) -> {body(v, i)})"


def let(value: str, body: Callable[[str], str]) -> str:
    """Bind ``value`` once and use it several times inside ``body``."""
    return f"get({each('transform', f'array({value})', body, 'x')}, 0)"


def stages(steps: list[dict[str, str]], value: str) -> str:
    """``value`` after steps that each bind names for the later ones, in one expression that is only worked out where it is reached."""
    for fields in reversed(steps):
        v = fresh("s")
        names = "|".join(re.escape(n) for n in fields)
        # names that are fields of a struct, or its quoted field names, stay
        bound = re.sub(rf"(?<![\w.'])({names})\b", rf"{v}.\1", value)
        value = f"get(transform(array({struct(**fields)}), {v} -> {bound}), 0)"
    return value


def case(*branches: tuple[str, str], default: str = "null") -> str:
    return "case " + " ".join(f"when {c} then {v}" for c, v in branches) + f" else {default} end"


def total(values: str) -> str:
    a, v = fresh("a"), fresh("v")
    return f"aggregate({values}, 0.0D, ({a}, {v}) -> {a} + {v})"
