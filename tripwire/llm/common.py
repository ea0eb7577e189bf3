"""Helpers shared by the text operators: tables, scratch space, checked broadcasts."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.session import checkpoint_root

# A side of a join is hinted for broadcast only up to this many bytes of plain data.
BROADCAST_BYTES = 32 * 2 ** 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder of this application. All of an
    application's intermediate tables lie in one folder (`clear_scratch`)."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/llm-{spark.sparkContext.applicationId}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete one intermediate table of this application."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table of this application. Call it when no
    DataFrame that reads them is needed any more."""
    drop_path(spark, _scratch_root(spark))


def stored(df: DataFrame, name: str, below: str | None = None) -> DataFrame:
    """Write `df` to the shared folder, or `below` a path of it, and read it back: cuts the lineage with
    files that outlive any executor."""
    spark = df.sparkSession
    path = f"{below}/{name}" if below else scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many _ before it as it takes to be none of `df`'s columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def beside(df: DataFrame, name: str, kind: T.DataType,
           make: Callable[[], Callable[[pa.RecordBatch], pa.Array]]) -> DataFrame:
    """Every row of `df` as it is, with a further column: nothing is shuffled or written. make() gives
    each task its function from a batch of rows to the column's values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = make()
        for b in batches:
            column = values(b)
            yield pa.RecordBatch.from_arrays([*b.columns, column], schema=b.schema.append(pa.field(name, column.type)))
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, kind)]))


def position(df: DataFrame, column: str) -> int:
    """Where a column of `df` stands."""
    return [c.lower() for c in df.columns].index(column)


def broadcast_if_small(df: DataFrame, bytes_per_row: int) -> DataFrame:
    """Hint a broadcast when the row count proves that the data is at most
    BROADCAST_BYTES; otherwise leave the join to the planner (sort-merge, AQE
    splits skewed partitions)."""
    bound = BROADCAST_BYTES // bytes_per_row
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def batches_of(rows: Iterable[tuple], schema: pa.Schema, max_rows: int = 2000,
               max_bytes: int = 8 * 2 ** 20) -> Iterator[pa.RecordBatch]:
    """Row tuples as Arrow batches, bounded by rows and by text bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (str, bytes)))
        if len(held) >= max_rows or size >= max_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)],
                           schema=schema)
