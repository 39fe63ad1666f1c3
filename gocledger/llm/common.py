"""Helpers shared by the corpus operators: private projections, Arrow maps, scratch tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gocledger.session import cut_lineage, cut_lineage_counted, remove_path

#: Words of the corpus contracts, on UTF-8 bytes after lower-casing A-Z: runs of
#: digits, ASCII letters and any non-ASCII character.
ALNUM_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")

#: Bytes of text tokenised at once; a longer text is cut at a byte that is no word byte.
CHUNK_BYTES = 1 << 20

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without columns that an operator is about to add: the operator's
    columns win over input columns of the same name (any case)."""
    taken = {n.lower() for n in names}
    clash = [c for c in df.columns if c.lower() in taken]
    return df.drop(*clash) if clash else df


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text with A-Z lower-cased and nothing else changed."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").lower()


def pieces(data: bytes, is_break: re.Pattern[bytes]) -> Iterator[bytes]:
    """``data`` in pieces of about CHUNK_BYTES, cut only where ``is_break`` matches,
    so that no word is cut.  A run without any break stays whole."""
    at = 0
    while len(data) - at > CHUNK_BYTES:
        m = is_break.search(data, at + CHUNK_BYTES)
        if m is None:
            break
        yield data[at:m.end()]
        at = m.end()
    yield data[at:] if at else data


_NOT_ALNUM = re.compile(rb"[^0-9a-z\x80-\xff]")


def alnum_words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a whole text, as lists of bounded size."""
    for piece in pieces(utf8(text), _NOT_ALNUM):
        yield ALNUM_WORDS.findall(piece)


def arrow_map(df: DataFrame, rows: Callable[[pa.RecordBatch], dict | None], add: T.StructType,
              keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with columns computed batch by batch in Python.

    ``rows`` gets an Arrow batch and returns {column: values} for ``add``; the
    input columns named in ``keep`` (default: all but clashing ones) pass
    through untouched as Arrow arrays.  A narrow map: no shuffle, recomputable
    from the input partition after an executor loss.
    """
    base = without(df, add.names)
    keep = [c for c in base.columns if keep is None or c in keep]
    schema = T.StructType([base.schema[c] for c in keep] + list(add))
    kinds = {f.name: pa_type(f.dataType) for f in add}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = rows(batch)
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            arrays += [v if isinstance(v := new[n], pa.Array) else pa.array(v, type=kinds[n]) for n in kinds]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *kinds])

    return base.mapInArrow(run, schema)


def pa_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


class Scratch:
    """Tables written into the shared folder (``spark.checkpoint.dir``) by one operator run.

    ``cut`` writes a DataFrame and reads it back: its rows survive the loss of
    any executor and later stages do not recompute what made them.  ``drop``
    deletes tables that nothing reads any more; ``release`` deletes all, once the
    caller has stored the result.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        return cut_lineage(df, f"llm-{name}", self.paths)

    def cut_counted(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        return cut_lineage_counted(df, f"llm-{name}", self.paths)

    def mark(self) -> int:
        return len(self.paths)

    def drop(self, since: int, until: int) -> None:
        for path in self.paths[since:until]:
            remove_path(self.spark, path)
        del self.paths[since:until]

    def release(self) -> None:
        self.drop(0, len(self.paths))


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where null equals null; keeps the left columns' names.
    Inner and left joins add the right side's other columns."""
    r = right.select([F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__r_{k}" for k in keys])


def shield(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns that clash with ``names`` renamed, and the renaming back.
    For operators that return their input's own columns unchanged."""
    taken = {n.lower() for n in names}
    away = {c: f"__in_{c}" for c in df.columns if c.lower() in taken}
    return (df.withColumnsRenamed(away) if away else df), {v: k for k, v in away.items()}
