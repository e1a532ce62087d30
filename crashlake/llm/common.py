"""Helpers that several corpus operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import crashlake

from crashlake.session import checkpoint_dir

#: A word: a run of anything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
#: Words of 64 bits in the table that tells which rows are surely not asked for.
WORDS = 1 << 18


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the one all executors share; a repeat never meets an earlier run's files."""
    return f"{checkpoint_dir(spark)}/corpus/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read more than once to the shared folder, and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once a session, and texts in small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    context = spark.sparkContext
    if not getattr(context, "_crashlake_shipped", False):
        home = os.path.dirname(os.path.abspath(crashlake.__file__))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "crashlake"), "zip",
                                      os.path.dirname(home), os.path.basename(home))
        context.addPyFile(archive)
        context._crashlake_shipped = True


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with more underscores before it while a column of ``df`` has it."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        out.append(name)
    return out


def text_of(col: str | Column = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words, as a long."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def maybe_asked(rows: DataFrame, keys: DataFrame, own: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose columns ``own`` the keys may hold, and those whose they surely do not.

    The keys have a column for each of ``own``, in this order and of the same types. A bit is set for
    the hash of each key. The table of bits has at most ``WORDS`` rows, so it is sent to the rows
    however many keys there are, and rows that nobody asks for are not moved to be joined. An
    exact join on the first part has to follow.
    """
    place = lambda names: "xxhash64(" + ", ".join(f"`{n}`" for n in names) + ")"
    word = lambda h: F.expr(f"pmod(shiftrightunsigned({h}, 6), {WORDS})")
    bit = lambda h: f"CAST({h} & 63 AS INT)"
    mine, asked = place(own), place(keys.columns)
    w, bits = unused(rows, "_word", "_bits")
    table = store(keys.groupBy(word(asked).alias(w)).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit(asked)})")).alias(bits)), "bits")
    marked = rows.join(F.broadcast(table), word(mine) == F.col(w), "left")
    held = F.expr(f"coalesce(shiftright({bits}, {bit(mine)}) & 1, 0L)") == 1
    return marked.where(held).drop(w, bits), marked.where(~held).drop(w, bits)
