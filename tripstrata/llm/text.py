"""Column expressions on text that several operators share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lower_az(text: Column) -> Column:
    """``text`` with A-Z in lower case; every other character stays, NULL becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def split_words(text: Column, between: str) -> Column:
    """The pieces of ``text`` between runs of the character class ``between``, none of them empty."""
    return F.array_remove(F.split(text, f"{between}+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once, even where ``body`` uses it for each element of an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many ``_`` behind it as it takes to differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}

    def free(name: str) -> str:
        return free(f"{name}_") if name.lower() in taken else name

    return [free(n) for n in names]
