"""Functions that are found by name, and pipelines of steps: how an engine's users add their own."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Extractors by the name of the table that they are for; ``register`` adds to them.
EXTRACTORS: dict[str, Callable[[Column], Column]] = {}


def register(name: str) -> Callable:
    """Make a column function known under ``name``; the last one registered holds."""

    def add(f: Callable[[Column], Column]) -> Callable[[Column], Column]:
        EXTRACTORS[name] = f
        return f

    return add


@register("digest")
def _digest(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, "([0-9a-fA-F]{40})", 1), F.lit(""))


@register("number")
def _number(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"(?:/|=)([0-9]+)(?:[,/?&]|$)", 1), F.lit(""))


def extract(name: Column, url: Column, extractors: Mapping[str, Callable[[Column], Column]] | None = None) -> Column:
    """What the extractor called ``name`` makes of an address, all inside the engine.

    Addresses of no web page, names without an extractor and those whose extractor finds
    nothing give the address itself.
    """
    out = url
    for key, f in (EXTRACTORS if extractors is None else extractors).items():
        out = F.when((name == key) & url.rlike("^https?://"), F.coalesce(f(url), url)).otherwise(out)
    return out


def pipeline(df: DataFrame, steps: list[Callable[[DataFrame], DataFrame]], on_error: Callable[[Exception], None] | None = None) -> DataFrame:
    """``df`` through all steps in order.

    An error in building a step's plan is passed to ``on_error``, and the step is left out;
    without a handler it is raised.
    """
    for step in steps:
        try:
            df = df.transform(step)
        except Exception as e:
            if on_error is None:
                raise
            on_error(e)
    return df
