"""What Python workers keep between tasks.

Spark reuses its workers, and freed memory stays with a process until it is asked for: a
worker that once held a large block would keep that size next to every later stage.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa


def hand_back() -> None:
    """Gives unused memory of this process to the operating system, where it can be asked to."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # not every C library has it
        pass


def handing_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; memory is handed back behind the last one."""
    try:
        yield from batches
    finally:
        hand_back()


def handing_back_each(function: Callable) -> Callable:
    """The function of Arrow columns, with its type hints; memory is handed back behind each call."""
    @functools.wraps(function)
    def run(*columns):
        try:
            return function(*columns)
        finally:
            hand_back()
    return run
