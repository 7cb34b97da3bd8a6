"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule ``[^\x20\x09-\x0D]+``; ``bytes.split()`` without
#: arguments parts UTF-8 at the same six characters.
BLANK = r"[\x20\x09-\x0D]"


def ship(spark: SparkSession) -> SparkSession:
    """Give the workers this package, unless the session has already done so.

    Tasks import it; a cluster that has it installed doesn't need this.
    """
    context = spark.sparkContext
    name = f"tidemark-{context.applicationId}.zip"
    if not any(path.endswith(name) for path in context.listFiles):
        package = Path(__file__).resolve().parent.parent
        made = Path(tempfile.mkdtemp()) / name  # on the driver, which serves it to the workers
        with zipfile.ZipFile(made, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        context.addPyFile(str(made))
    return spark


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, whatever the optimizer inlines."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have (upper and lower case are one)."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


_kept: dict[tuple, Any] = {}


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """What ``make`` returned for ``key``; a worker process keeps one such object at a time.

    The stages of a run share the workers: without this, memories of words that a stage
    before has filled would stay beside those of the next.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns every text operator needs; a null text is empty."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def map_rows(df: DataFrame, make: Callable, schema: str, rows: int = 2000) -> DataFrame:
    """Run ``make()``'s row function over ``df`` in Arrow batches.

    ``make`` is called once in each Python worker task and returns a function
    that takes a row's values and yields result tuples, so that a task's set-up
    (an automaton, a model) is paid once. Results leave in batches of ``rows``:
    memory doesn't grow with the partition.
    """
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        out: list[tuple] = []
        for batch in batches:
            for values in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                out.extend(one(*values))
                if len(out) >= rows:
                    yield _batch(out, arrow)
                    out = []
        if out:
            yield _batch(out, arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(schema: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "boolean": pa.bool_(),
        "binary": pa.binary(),
        "array<int>": pa.list_(pa.int32()),
        "array<long>": pa.list_(pa.int64()),
        "array<double>": pa.list_(pa.float64()),
        "array<string>": pa.list_(pa.string()),
    }
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, schema.types)], schema=schema
    )


def map_arrays(df: DataFrame, make: Callable, schema: str, rows: int = 50_000) -> DataFrame:
    """As ``map_rows``, for functions that return a tuple of equally long numpy arrays."""
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        out: list[tuple] = []
        n = 0
        for batch in batches:
            for values in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                out.append(one(*values))
                n += len(out[-1][0])
                if n >= rows:
                    yield _joined(out, arrow)
                    out, n = [], 0
        if out:
            yield _joined(out, arrow)

    return df.mapInArrow(run, schema)


def _joined(parts: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*parts)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c.astype(kind.to_pandas_dtype(), copy=False)) for c, kind in zip(columns, schema.types)],
        schema=schema,
    )


def filter_rows(docs: DataFrame, make: Callable, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose text passes ``make()``'s predicate.

    Rows stay in their partitions with all their columns; a null text is empty.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = make()
        for batch in batches:
            kept = [passes(text or "") for text in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


# ── hashing of words, the same in every process ──────────────────────────────

_ODD = np.random.default_rng(20).integers(1, 1 << 63, size=4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each value's bits over all of it."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def run_hashes(hashes: np.ndarray, length: int, family: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` values; families are independent."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(length):
        total += hashes[k : k + n] * _ODD[64 * family + k]
    return mix(total)


_ROLL = _ODD[4001:4003]
_ROLL_BACK = np.array([pow(int(x), -1, 1 << 64) for x in _ROLL], np.uint64)


def rolling_hashes(hashes: np.ndarray, length: int, family: int = 0) -> np.ndarray:
    """As ``run_hashes``, in a few passes whatever the length: differences of prefix sums.

    The values must be hashes themselves. Families 0 and 1 are independent.
    """
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = np.full(len(hashes), _ROLL[family])
    power[0] = 1
    sums = np.cumsum(hashes * np.cumprod(power))
    runs = sums[length - 1 :].copy()
    runs[1:] -= sums[: n - 1]
    back = np.full(n, _ROLL_BACK[family])
    back[0] = 1
    return mix(runs * np.cumprod(back))


def least_of_runs(values: np.ndarray, length: int) -> np.ndarray:
    """The least of each run of ``length`` values, by doubling."""
    n = len(values) - length + 1
    if n <= 0:
        return values[:0]
    reach = 1
    while 2 * reach <= length:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[:n], values[length - reach : length - reach + n])
