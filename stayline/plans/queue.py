"""One queue of fits of different models, run from driver threads.

Each unit of work is a distributed job or a chain of them. Units of different
models take turns in the queue and run in fair scheduler pools named after their
model (with ``spark.scheduler.mode`` FAIR the pools share the executors evenly, without
it jobs are served in order of arrival), so a slow model does not hold up the others.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from itertools import zip_longest
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

_POOL = "spark.scheduler.pool"


@dataclass(frozen=True)
class Unit:
    """``run`` does the work; ``pool`` names the model it belongs to."""

    pool: str
    run: Callable[[], Any]


def interleaved(groups: Sequence[Sequence[Unit]]) -> list[Unit]:
    """The units of several groups in turn: first of each, second of each, …"""
    return [unit for turn in zip_longest(*groups) for unit in turn if unit is not None]


def run_units(spark: SparkSession, units: Sequence[Unit], parallelism: int) -> list[Any]:
    """Results in the order of ``units``; at most ``parallelism`` run at a time. The first failure is raised."""
    context = spark.sparkContext

    def targeted(unit: Unit) -> Callable[[], Any]:
        def work():
            context.setLocalProperty(_POOL, unit.pool)
            return unit.run()

        # Wrapped one by one: each unit gets its own copy of the caller's properties.
        return inheritable_thread_target(spark)(work)

    if not units:
        return []
    targets = [targeted(unit) for unit in units]
    with ThreadPool(min(parallelism, len(units))) as pool:
        return pool.map(lambda target: target(), targets, chunksize=1)


@dataclass
class Shared:
    """A value that several units need: made by the first, released after the last."""

    make: Callable[[], Any]
    release: Callable[[Any], None]
    uses: int
    _lock: threading.Lock = field(default_factory=threading.Lock)
    _value: Any = None
    _made: bool = False

    def get(self) -> Any:
        with self._lock:
            if not self._made:
                self._value, self._made = self.make(), True
            return self._value

    def done(self) -> None:
        with self._lock:
            self.uses -= 1
            if not self.uses and self._made:
                self.release(self._value)
                self._value = None
