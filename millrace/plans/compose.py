"""Functions over streams and tables, and how they are put together.

A function takes one or more DataFrames and returns a DataFrame, a tuple of them, or None (a
consumer)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

Function = Callable[..., object]


@dataclass(frozen=True)
class Binding:
    """A function's input or output tied to a destination."""

    destination: str
    group: str | None = None
    content_type: str = "application/json"
    properties: Mapping[str, object] = field(default_factory=dict)


def apply(function: Function, *inputs: DataFrame) -> object:
    """Call a function on its inputs; a function of several inputs may also take them one by one
    (`a -> b -> c -> result`)."""
    result = function(*inputs[:1]) if _curried(function) else function(*inputs)
    if _curried(function):
        for frame in inputs[1:]:
            result = result(frame)
    return result


def _curried(function: Function) -> bool:
    return getattr(function, "curried", False)


def curried(function: Function) -> Function:
    """Mark a function that takes its inputs one at a time."""
    function.curried = True
    return function


def compose(*functions: Function) -> Function:
    """`a|b|c`: the first may take many inputs, the others take the one result before them; a
    consumer ends the chain."""
    if not functions:
        raise ValueError("nothing to compose")

    def composed(*inputs: DataFrame) -> object:
        result = apply(functions[0], *inputs)
        for function in functions[1:]:
            if not isinstance(result, DataFrame):
                raise TypeError("only a function with a single DataFrame result can be followed by another")
            result = function(result)
        return result

    return composed


def from_definition(definition: str, catalog: Mapping[str, Function]) -> dict[str, Function]:
    """Functions named by a definition: `|` composes, `;` separates independent functions."""
    found = {}
    for part in filter(None, (p.strip() for p in definition.split(";"))):
        members = [m.strip() for m in part.split("|")]
        missing = [m for m in members if m not in catalog]
        if missing:
            raise LookupError(f"no function named {', '.join(missing)}")
        found["".join([members[0], *[m[:1].upper() + m[1:] for m in members[1:]]])] = compose(*[catalog[m] for m in members])
    return found


def apply_tuple(function: Function, inputs: tuple[DataFrame, ...]) -> tuple[DataFrame, ...]:
    """Many inputs and outputs as tuples; lists and tuples of anything but DataFrames are refused."""
    if not isinstance(inputs, tuple) or not all(isinstance(f, DataFrame) for f in inputs):
        raise TypeError("inputs must be a tuple of DataFrames")
    outputs = function(inputs)
    if isinstance(outputs, DataFrame):
        return (outputs,)
    if not isinstance(outputs, tuple) or not all(isinstance(f, DataFrame) for f in outputs):
        raise TypeError("outputs must be a DataFrame or a tuple of DataFrames")
    return outputs


def binding_names(function: str, inputs: int, outputs: int) -> tuple[list[str], list[str]]:
    """Names of a function's bindings: `<function>-in-<n>` and `<function>-out-<n>`."""
    return [f"{function}-in-{i}" for i in range(inputs)], [f"{function}-out-{i}" for i in range(outputs)]
