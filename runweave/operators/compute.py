"""User functions over tables: wrap, map in parallel, chain, infer, fold per key."""

from __future__ import annotations

import functools
import traceback
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

Transform = Callable[[DataFrame], DataFrame]


class Operator:
    """One calling form for functions and classes: a step from DataFrame to DataFrame.

    Subclasses write ``forward(df)``; plain functions come in through :func:`operator`.
    """

    def forward(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError("an operator must implement forward()")

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.forward(df)


def arrow_type(kind: T.DataType | str) -> pa.DataType:
    """The Arrow type of a Spark type, given as such or as DDL."""
    return to_arrow_type(kind if isinstance(kind, T.DataType) else T.DataType.fromDDL(kind))


class ColumnOperator(Operator):
    """A function of one column's values, run on Arrow batches into a new column.

    The function gets plain Python values: whole numbers stay whole and a null is ``None``, whatever
    else the batch holds.

    ``target`` is a function of one value, or a class with ``forward(value)``, which is built
    once per task and not once per row.
    """

    def __init__(self, target: Any, input: str, output: str, returns: T.DataType | str):
        self.target, self.input, self.output, self.returns = target, input, output, returns

    def forward(self, df: DataFrame) -> DataFrame:
        target, kind = self.target, arrow_type(self.returns)

        @F.arrow_udf(self.returns)
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            one = target().forward if isinstance(target, type) else target
            for batch in batches:
                yield pa.array([one(v) for v in batch.to_pylist()], kind)

        return df.withColumn(self.output, run(self.input))


def operator(
    input: str, output: str, returns: T.DataType | str
) -> Callable[[Any], ColumnOperator]:
    """Decorator form of :class:`ColumnOperator`."""

    def wrap(target: Any) -> ColumnOperator:
        out = ColumnOperator(target, input, output, returns)
        functools.update_wrapper(out, target, updated=())
        return out

    return wrap


def init_once_udf(
    build: Callable[[], Callable[[pd.Series], pd.Series]], returns: T.DataType | str
) -> Callable[[str | Column], Column]:
    """A column function whose heavy set-up, ``build``, runs once per task before its batches.

    The built function gets Series as pandas makes them: where a batch has nulls, whole numbers are
    floats there. :class:`ColumnOperator` hands over plain values instead.
    """

    @F.pandas_udf(returns)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = build()
        for batch in batches:
            yield ready(batch)

    return run


def parallel_map(
    inputs: DataFrame,
    fn: Callable[[Any], Any],
    input: str,
    returns: str,
    index: str = "idx",
    workers: int = -1,
) -> DataFrame:
    """``fn`` of every input, in input order: (index, value, error).

    A failing input reports its error and stops no other. ``workers`` is the number of parallel
    parts, by default the larger of the cores and the shuffle partitions. There is no limit on
    inputs. The inputs are sorted, not the results: a sort samples what it sorts first, and ``fn``
    would run twice.
    """
    if workers == 0 or workers < -1:
        raise ValueError("`workers` must be positive, or -1")
    spark = inputs.sparkSession
    if workers == -1:
        shuffle_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        workers = max(spark.sparkContext.defaultParallelism, shuffle_partitions)
    rows = (
        inputs.select(index, input)
        .repartitionByRange(workers, index)
        .sortWithinPartitions(index)
    )

    def attempt(value: Any) -> tuple[Any, str | None]:
        try:
            return fn(value), None
        except Exception as error:  # noqa: BLE001
            return None, traceback.format_exception_only(error)[-1].strip()

    out = arrow_type(returns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [attempt(v) for v in batch.column(input).to_pylist()]
            values = pa.array([d[0] for d in done], out)
            errors = pa.array([d[1] for d in done], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(index), values, errors], names=[index, "value", "error"]
            )

    kind = rows.schema[index].dataType.simpleString()
    return rows.mapInArrow(run, f"{index} {kind}, value {returns}, error string")


def sequential(
    *steps: Transform, capture_output: bool = False
) -> Callable[[DataFrame], DataFrame | tuple[DataFrame, list[DataFrame]]]:
    """Chain steps; with ``capture_output`` also return the outcome of each."""
    for step in steps:
        if not callable(step):
            raise TypeError(f"step {step!r} is not callable")

    def run(df: DataFrame) -> DataFrame | tuple[DataFrame, list[DataFrame]]:
        outputs = []
        for step in steps:
            df = df.transform(step)
            outputs.append(df)
        return (df, outputs) if capture_output else df

    return run


def check_arguments(
    given: Sequence[str], required: Sequence[str], optional: Sequence[str] = ()
) -> None:
    """Unknown or missing argument names are errors, before any job runs."""
    unknown = set(given) - set(required) - set(optional)
    if unknown:
        raise ValueError(f"unknown arguments: {sorted(unknown)}")
    missing = set(required) - set(given)
    if missing:
        raise ValueError(f"missing required arguments: {sorted(missing)}")


def batch_infer(
    df: DataFrame,
    make_model: Callable[[], Callable[..., np.ndarray]],
    arguments: dict[str, str],
    required: Sequence[str],
    returns: T.DataType,
    output: str = "prediction",
    batch_size: int = 1024,
    input_tensor_shapes: list[list[int] | None] | None = None,
) -> DataFrame:
    """Score rows with a model that each worker builds once.

    ``arguments`` names the column of each model argument, in the model's order.
    """
    check_arguments(list(arguments), required)
    predict = predict_batch_udf(
        make_model,
        return_type=returns,
        batch_size=batch_size,
        input_tensor_shapes=input_tensor_shapes,
    )
    return df.withColumn(output, predict(*[F.col(arguments[a]) for a in required]))


class Actor:
    """State kept per key. ``update`` folds rows in (column name to array), ``state`` and ``merge``
    carry the state between tasks, ``result`` gives the output row.

    Columns of numbers and booleans arrive as masked arrays of their own type, masked where they are
    null; all others as arrays of plain values with ``None``. No type depends on what a batch holds.
    """

    def update(self, rows: Mapping[str, np.ndarray]) -> None:
        raise NotImplementedError

    def state(self) -> dict[str, Any]:
        raise NotImplementedError

    def merge(self, state: dict[str, Any]) -> None:
        raise NotImplementedError

    def result(self) -> dict[str, Any]:
        raise NotImplementedError


class _Rows(Mapping):
    """The arrays of one key, cut out of a batch's columns when they are asked for."""

    def __init__(self, columns: dict[str, np.ndarray], where: slice):
        self.columns, self.where = columns, where

    def __getitem__(self, name: str) -> np.ndarray:
        return self.columns[name][self.where]

    def __iter__(self) -> Iterator[str]:
        return iter(self.columns)

    def __len__(self) -> int:
        return len(self.columns)


def _to_array(column: pa.Array) -> np.ndarray:
    kind = column.type
    if pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_boolean(kind):
        missing = column.is_null().to_numpy(zero_copy_only=False)
        filled = column.fill_null(False if pa.types.is_boolean(kind) else 0)
        return np.ma.MaskedArray(filled.to_numpy(zero_copy_only=False), missing)
    out = np.empty(len(column), object)
    out[:] = column.to_pylist()
    return out


def _rows_by_key(batch: pa.RecordBatch, key: str) -> Iterator[tuple[Any, Mapping[str, np.ndarray]]]:
    """Arrays of each key of a batch; a sort and slices, since a frame per key would cost more
    than most updates. Null keys form one group."""
    coded = batch.column(key).dictionary_encode("encode")
    codes, values = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    order = np.argsort(codes, kind="stable")
    columns = {c: _to_array(batch.column(c))[order] for c in batch.schema.names}
    edges = np.searchsorted(codes[order], np.arange(len(values) + 1))
    for i, value in enumerate(values):
        yield value, _Rows(columns, slice(edges[i], edges[i + 1]))


def group_apply(
    df: DataFrame,
    key: str,
    actor: type[Actor],
    state_schema: str,
    result_schema: str,
    max_live_actors: int = 10_000,
) -> DataFrame:
    """One actor per key over all rows of the key.

    Each task folds its own rows first, batch by batch, and sends one state row per key; the
    states of a key, not its rows, are then merged. At ``max_live_actors`` keys a task sends its
    states early and goes on, so memory is bounded and no row is lost.
    """
    kind = df.schema[key].dataType.simpleString()
    state_rows, result_rows = (
        pa.schema([(f.name, arrow_type(f.dataType)) for f in T.StructType.fromDDL(f"{key} {kind}, {s}")])
        for s in (state_schema, result_schema)
    )

    def states(live: dict[Any, Actor]) -> pa.RecordBatch:
        rows = [{key: k, **a.state()} for k, a in live.items()]
        return pa.RecordBatch.from_pylist(rows, schema=state_rows)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live: dict[Any, Actor] = {}
        for batch in batches:
            for value, rows in _rows_by_key(batch, key):
                if value not in live:
                    live[value] = actor()
                live[value].update(rows)
            if len(live) >= max_live_actors:
                yield states(live)
                live = {}
        if live:
            yield states(live)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # States arrive sorted by key, so one actor lives at a time.
        current, merged = None, None
        for batch in batches:
            done = []
            for state in batch.to_pylist():
                value = state.pop(key)
                if merged is None or value != current:
                    if merged is not None:
                        done.append({key: current, **merged.result()})
                    current, merged = value, actor()
                merged.merge(state)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=result_rows)
        if merged is not None:
            last = [{key: current, **merged.result()}]
            yield pa.RecordBatch.from_pylist(last, schema=result_rows)

    partial = df.mapInArrow(fold, f"{key} {kind}, {state_schema}")
    sorted_states = partial.repartition(F.col(key)).sortWithinPartitions(key)
    return sorted_states.mapInArrow(merge, f"{key} {kind}, {result_schema}")
