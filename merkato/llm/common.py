"""What the text operators share: word patterns, null-safe input, step tables, Python shipping."""

from __future__ import annotations

import gc
import sys
import types

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merkato.session import store as _store

#: The white space of all contracts, as the inside of a character class: space and U+0009 to U+000D.
BLANK = "\\x20\\x09-\\x0D"
#: The same characters one by one.
BLANKS = " \t\n\x0b\x0c\r"


def ship(module_name: str) -> None:
    """Send a module's functions to Python workers by value, so that workers need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def worker_memory() -> dict:
    """A dict that outlives a task: Python workers are reused, but shipped functions get new globals each time."""
    return vars(sys.modules.setdefault("merkato_worker_memory", types.ModuleType("merkato_worker_memory")))


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it in any case."""
    taken, made = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        made.append(name)
    return made


def whole_text(column: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def without_blanks(text: Column) -> Column:
    """The text without any white space: plain replacements, one quick scan each."""
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` as an array, without a lambda over them."""
    for blank in BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a step's rows to the shared folder and go on from the files.

    The shuffle files of the step are dropped as soon as the driver collects the plan
    that made them, which is asked for here: a long chain of steps then needs the disk
    of its largest step, not of all of them.
    """
    stored = _store(df, label)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return stored


ship(__name__)
