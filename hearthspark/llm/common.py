"""What the operators share: reading tables, cutting text into words, and adding columns by Arrow batches.

Conventions of the whole subpackage
* An operator selects the columns it reads first, so other columns, also ones named like a result, never disturb it.
  Where an operator keeps the input's columns, a result replaces an input column of its name.
* A null text counts as an empty one unless the operator says otherwise.
* A row is a document of its own even if its id occurs twice or is null, unless the operator says otherwise.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from hearthspark.session import tune

# Text handled at once in a Python worker; a longer single text is handled alone.
SLICE_BYTES = 4 << 20

# Rows of an Arrow batch on their way to a worker.
BATCH_ROWS = 1000

# A-Z to a-z; everything in ASCII that is no letter or digit to a blank. Bytes above 127 belong to words.
WORD_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

Compute = Callable[..., Sequence[pa.Array]]

# What an operator's tasks leave in a worker for its next tasks; see ``task_state``.
_kept: dict[object, object] = {}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings the operators rely on."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def ascii_words(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased."""
    return text.translate(WORD_TABLE).split()


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def parts(batch: pa.RecordBatch, measure: int | None, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose column ``measure`` has at most ``limit`` bytes, one row at least."""
    if measure is None or batch.num_rows < 2:
        yield batch
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(measure).cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        floor = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, floor + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def task_state(key: object, make: Callable[[], object]) -> object:
    """State of an operator that a reused worker keeps from task to task, as long as no other operator runs in it."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def begin_task(state: object = None) -> None:
    """Drop what tasks of other operators left in this worker."""
    if state not in _kept:
        _kept.clear()


def end_task() -> None:
    """Give free memory back to the system: workers outlive tasks, and would go on holding the most any task needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], state: object = None
         ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as a task that leaves no more in its worker than ``state``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(state)
        yield from run(batches)
        end_task()

    return task


def append(df: DataFrame, make: Callable[[], Compute], fields: Sequence[StructField], reads: Sequence[str],
           keep: Sequence[str] | None = None, measure: str | None = None, limit: int = SLICE_BYTES,
           state: object = None) -> DataFrame:
    """``df`` with columns computed from ``reads`` by Arrow batches, without a shuffle.

    ``make`` is called once per task and gives the function from the read
    columns to the new ones. ``keep`` names the input columns that stay (all
    by default). ``measure`` is the column of which at most ``limit`` bytes
    are handled at once, ``state`` the key of the operator's ``task_state``.
    """
    new = {field.name.lower() for field in fields}
    kept = [name for name in (df.columns if keep is None else keep) if name.lower() not in new]
    extra = [name for name in reads if name not in kept]
    source = df.select(*[F.col(f"`{name}`") for name in kept],
                       *[F.col(f"`{name}`").alias(f"read {i}") for i, name in enumerate(extra)])
    places = [kept.index(name) if name in kept else len(kept) + extra.index(name) for name in reads]
    sized = None if measure is None else places[list(reads).index(measure)]
    names = [*kept, *[field.name for field in fields]]
    schema = StructType([*source.schema.fields[:len(kept)], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part in parts(batch, sized, limit):
                made = compute(*[part.column(i) for i in places])
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(kept))], *made], names=names)

    return source.mapInArrow(tidy(run, state), schema)


def hashed_sample(df: DataFrame, most: int, rows: int, *key: str) -> DataFrame:
    """``most`` of the ``rows`` rows, chosen by a hash of ``key``: the same rows on any cluster.

    A bound on the hash first leaves about twice as many, so that however many
    partitions there are, few rows meet in the task that takes the smallest.
    """
    share = min(1.0, 2 * most / max(1, rows) + 1e-6)
    draw = F.xxhash64(F.lit(17), *key)
    near = df.where(F.pmod(draw, F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    return near.orderBy(F.pmod(draw, F.lit(1 << 30)), *key).limit(most)
