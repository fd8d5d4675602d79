"""Small helpers the operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What parts words is the space and the controls 9 to 13.
BLANKS = "\t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each application, so
    that operators with Python stages run wherever only the driver has it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def replaced(text: Column, characters: str, by: str) -> Column:
    """``text`` with each of ``characters`` replaced (a byte search each)."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def words_of(text: Column) -> Column:
    """The words of a text in order (built-in functions only)."""
    return F.array_remove(F.split(replaced(text, BLANKS, " "), " "), "")


def only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Just these columns: other columns cannot clash with what is added."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def settled(df: DataFrame) -> DataFrame:
    """``df``, with all its columns computed before any later filter.

    A filter on chained array expressions is otherwise moved below them, and
    repeats in itself every expression it reads, each as often as it is read:
    that grows without bound.  Filters stay above a projection that is not
    deterministic; the one here numbers the rows and drops none.
    """
    pin = fresh(df, "pin")
    return df.withColumn(pin, F.monotonically_increasing_id()).where(F.col(pin) >= 0).drop(pin)
