"""What the operators share: tables, words, the shared work folder, texts in tasks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import work_dir

#: A word is a run of anything but these blanks, in Java and in Python expressions.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

#: What str.split() cuts at beside the blanks above.
_ODD_BLANKS = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WORDS = re.compile(WORD)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting, as in tests, has a temporary folder instead.
    """
    return f"{work_dir(spark).rstrip('/')}/cadenza-llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder: computed once, safe from lost executors.

    ``rows``, if known to be about so many, keeps a small table from being written by many tasks.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(row_groups(rows, 100_000))
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made, once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/cadenza-llm/" in f}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo a divisor; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % divisor


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


LOWER_ASCII = {i: i + 32 for i in range(65, 91)}


def words_of(text: str) -> list[str]:
    """The words of a text, as ``WORD`` has them."""
    return _WORDS.findall(text) if _ODD_BLANKS.search(text) else text.split()


def row_groups(rows: int, per_group: int) -> int:
    """So many groups that each has about ``per_group`` rows; 1 at least."""
    return max(1, -(-rows // per_group))


def column_of(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each has about ``max_bytes`` of text, or one row if that is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(batch.schema.get_field_index(text))]
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)
