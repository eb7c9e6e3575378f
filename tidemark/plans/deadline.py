"""A limit on how long a step at the source may take, whatever the source is."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tidemark.errors import SourceUnavailableError

# How often jobs are asked to stop once the time is up: a step may start another after the first has gone.
ASK_AGAIN_SEC = 0.5


@contextmanager
def within(spark: SparkSession, seconds: float | None, step: str) -> Iterator[None]:
    """Ends the block's Spark jobs after ``seconds`` and names the step; None sets no limit.

    The jobs carry a tag of their own, so those of other tables go on, in whatever pool or thread they run. What
    they have written by then belongs to no version of a target. A block that ends in time is left alone.
    """
    if seconds is None:
        yield
        return
    context, tag = spark.sparkContext, f"tidemark-{uuid.uuid4().hex}"
    ended, late = threading.Event(), threading.Event()

    def watch() -> None:
        if ended.wait(seconds):
            return
        late.set()
        while True:
            context.cancelJobsWithTag(tag)
            if ended.wait(ASK_AGAIN_SEC):
                return

    watcher = threading.Thread(target=watch, name=tag, daemon=True)
    context.addJobTag(tag)
    watcher.start()
    try:
        yield
    except Exception:
        if late.is_set():
            raise SourceUnavailableError(f"the source took more than {seconds:g} s while {step}") from None
        raise
    finally:
        ended.set()
        watcher.join()
        context.removeJobTag(tag)
