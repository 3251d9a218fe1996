"""Small helpers the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Code points handled together by the array code; a longer text is handled on its own.
SLICE_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(texts: Sequence[str | None], most: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Cut a list of texts into runs of about ``most`` code points: (first index, texts); NULL becomes empty."""
    first, run, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if run and size + len(text) > most:
            yield first, run
            first, run, size = i, [], 0
        run.append(text)
        size += len(text)
    if run:
        yield first, run


def map_texts(
    docs: DataFrame, text: str, fields: Sequence[tuple[str, str]], work: Callable[[list[str]], Sequence[list]], keep: Sequence[str]
) -> DataFrame:
    """Add columns that a function computes from texts, in Arrow batches, without a shuffle.

    ``work`` gets a list of texts (NULL as empty) and returns one list per field. The columns
    ``keep`` pass through; new columns that are named like a kept one replace it.
    """
    names = [n for n, _ in fields]
    source = docs.select(*[_quoted(c).alias(f"k{i}") for i, c in enumerate(keep)], _quoted(text).cast("string").alias("t"))
    kept = [(i, c) for i, c in enumerate(keep) if c not in names]
    schema = T.StructType(
        [T.StructField(c, docs.schema[c].dataType) for _, c in kept] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields]
    )
    arrow = to_arrow_schema(schema)
    new = [arrow.field(n).type for n in names]
    places = [i for i, _ in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for first, part in slices(texts):
                made = work(part)
                old = [batch.column(i).slice(first, len(part)) for i in places]
                yield pa.RecordBatch.from_arrays([*old, *[pa.array(v, t) for v, t in zip(made, new)]], names=arrow.names)

    return source.mapInArrow(run, schema)


def shielded(docs: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """``docs`` under plain column names, the plain name of each column, and the way back.

    Whatever the given columns are called, they cannot clash with those an operator adds.
    """
    names = docs.columns
    plain = [f"c{i}" for i in range(len(names))]
    back = lambda df: df.select(*[F.col(p).alias(n) for p, n in zip(plain, names)])
    return docs.toDF(*plain), dict(zip(names, plain)), back


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def held_out(key: Column, parts: int) -> Column:
    """True for rows whose CRC-32 of the key as text leaves 2 when divided by ``parts``; NULL keys are not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % F.lit(parts) == 2, F.lit(False))
