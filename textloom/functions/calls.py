"""Model calls: tried again, slowed down, and reached from Columns in Arrow batches."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def steady(call: Callable, tries: int = 3, wait: float = 1.0, per_second: float | None = None, errors: tuple[type[BaseException], ...] = (Exception,), sleep: Callable = time.sleep, clock: Callable = time.monotonic) -> Callable:
    """call, tried again after one of the errors with waits that double; the last try's error goes out.
    No more than per_second calls a second start, within one process."""
    free = [clock()]

    def run(*args):
        for i in range(tries):
            if per_second:
                at = max(clock(), free[0])
                free[0] = at + 1 / per_second
                if at > clock():
                    sleep(at - clock())
            try:
                return call(*args)
            except errors:
                if i + 1 == tries:
                    raise
                sleep(wait * 2**i)

    if tries < 1:
        raise ValueError("tries is 1 or more")
    return run


def by_model(make: Callable[[], Callable[[list[str]], list[str]]], prompt: Callable[..., Column], batch: int = 32, **how) -> Callable[..., Column]:
    """A hook for whatever takes Columns to an answer: prompt(*columns) is what the model reads (null: empty).
    make() runs once in each worker's task and gives a function from prompts to as many texts; how goes to steady()."""

    @F.pandas_udf("string")
    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = steady(make(), **how)
        for texts in batches:
            asked = texts.fillna("").tolist()
            out = []
            for i in range(0, len(asked), batch):
                some = list(call(asked[i : i + batch]))
                if len(some) != len(asked[i : i + batch]):
                    raise ValueError(f"the model gave {len(some)} texts for {len(asked[i : i + batch])} prompts")
                out += some
            yield pd.Series(out, dtype=object)

    return lambda *columns: answers(prompt(*columns))
