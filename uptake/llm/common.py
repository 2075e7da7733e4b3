"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: one word: a run of anything but ASCII white space (fixed by the operators' contracts)
WORD = r"[^\x20\x09-\x0D]+"

#: rows of one Arrow batch that a Python step takes in one go, and bytes after which it hands a batch back
BLOCK_ROWS = 2000
BLOCK_BYTES = 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Map blocks of rows: ``fn`` takes columns as Python lists and returns columns as lists, of any length."""
    out = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                block = batch.slice(at, BLOCK_ROWS)
                cols = fn({n: block.column(i).to_pylist() for i, n in enumerate(block.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def pa_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a DDL string, for functions that run on executors."""
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(StructType.fromDDL(ddl))


def text_of(col: str) -> Column:
    """The text as a string, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def unit(*cols: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the given columns and the seed only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double") * F.lit(2.0 ** -53)


def discard(table: DataFrame) -> None:
    """Deletes the folder of a table that ``materialize`` wrote and nobody will read any more.

    What was derived from it must have been written before."""
    files = table.inputFiles()
    if files:
        path = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pow2_at_least(n: int) -> int:
    return 1 << max(0, (n - 1).bit_length())
