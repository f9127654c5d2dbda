"""Batch completion of prompts through a user's function."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of the retry rule: three attempts, waits of 2 and 4 seconds, and
# half a second between calls.
ATTEMPTS = 3
BACKOFF = 2.0
PAUSE = 0.5
FLUSH_SECONDS = 1.0
FLUSH_ROWS = 1024


def _attempt(call: Callable[[], Sequence[str]], attempts: int, backoff: float):
    for i in range(attempts):
        try:
            return call(), None
        except Exception as problem:  # noqa: BLE001 - the user's function may raise anything
            if i + 1 == attempts:
                return None, f"{type(problem).__name__}: {problem}"
            if backoff:
                time.sleep(backoff ** (i + 1))


def complete(df: DataFrame, prompt: str, fn: Callable[[list[str]], list[str]], *,
             answer: str = "answer", error: str = "error", attempts: int = ATTEMPTS,
             backoff: float = BACKOFF, pause: float = PAUSE, batch_size: int = 1,
             concurrency: int | None = None, in_flight: int = 1) -> DataFrame:
    """Adds the function's answer per row, or the error after the last attempt.

    ``fn`` gets ``batch_size`` prompts at a time and a failure fails that batch.
    ``concurrency`` spreads the rows evenly over that many tasks.  A task has up to
    ``in_flight`` calls open at once; a call that waits for its next attempt holds up no
    other.  Rows leave the task in their order, at most ``FLUSH_SECONDS`` after their
    call and those before it are done, and no more than two rounds of calls wait.  Prompts
    become Python strings call by call and the other columns stay in Arrow's memory, so a
    task holds Spark's batch, about ``FLUSH_ROWS`` answers and the open calls.  Spark may run
    a task again, so calls happen at least once: write the result before using it twice.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(answer, T.StringType()),
                           T.StructField(error, T.StringType())])

    def ask(batch: list[str]) -> tuple[list[str | None], list[str | None]]:
        got, problem = _attempt(lambda: list(fn(batch)), attempts, backoff)
        if got is not None and len(got) != len(batch):
            got, problem = None, f"{len(got)} answers to {len(batch)} prompts"
        if pause and problem is None:
            time.sleep(pause)
        return (got if got is not None else [None] * len(batch)), [problem] * len(batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                yield from answered(batch, batch.column(prompt), pool)

    def answered(batch: pa.RecordBatch, prompts: pa.Array, pool: ThreadPoolExecutor
                 ) -> Iterator[pa.RecordBatch]:
        waiting: deque[Future] = deque()
        answers, errors, shown, last = [], [], 0, time.monotonic()

        def done() -> pa.RecordBatch:
            added = [pa.array(x, pa.string(), from_pandas=True) for x in (answers, errors)]
            return pa.RecordBatch.from_arrays(
                [*batch.slice(shown, len(answers)).columns, *added], schema.names)
        for at in range(0, len(prompts) + 2 * in_flight * batch_size, batch_size):
            if at < len(prompts):
                waiting.append(pool.submit(ask, prompts.slice(at, batch_size).to_pylist()))
            while waiting and (len(waiting) >= 2 * in_flight or at >= len(prompts)
                               or waiting[0].done()):
                got, problems = waiting.popleft().result()
                answers += got
                errors += problems
                if len(answers) >= FLUSH_ROWS or time.monotonic() - last >= FLUSH_SECONDS:
                    yield done()
                    shown, last = shown + len(answers), time.monotonic()
                    answers, errors = [], []
        if answers:
            yield done()

    spread = df if concurrency is None else df.repartition(concurrency)
    return spread.mapInArrow(run, schema)
