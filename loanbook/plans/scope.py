"""Owner of what a run keeps between its steps, and joint publication of several outputs."""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from loanbook.sources import files

Write = Callable[[str], None]  # writes one output to the folder or file it is given


class Scope:
    """Frames that several steps read, kept on the executors' disks until the scope is closed.

    Nothing runs when a frame is shared: it is kept from its first use on. What
    is kept is known by its plan, so other dates or parameters never find it,
    and what a lost executor held is computed again.
    """

    def __init__(self) -> None:
        self._kept: list[DataFrame] = []

    def share(self, df: DataFrame) -> DataFrame:
        kept = df.persist(StorageLevel.DISK_ONLY)
        self._kept.append(kept)
        return kept

    def close(self) -> None:
        """Let go of all shared frames; a frame still in use is only computed again."""
        while self._kept:
            self._kept.pop().unpersist()

    def __enter__(self) -> Scope:
        return self

    def __exit__(self, *failure) -> None:
        self.close()

    def close_with(self, df: DataFrame) -> DataFrame:
        """Close when the caller lets go of `df`, the lazy result that reads the shared frames."""
        weakref.finalize(df, self._close_quietly)
        return df

    def _close_quietly(self) -> None:
        try:
            self.close()
        except Exception:  # the session may be stopped by then, and its storage with it
            self._kept.clear()


def publish(spark: SparkSession, outputs: dict[str, Write]) -> None:
    """Write several outputs at the same time and put them in place together.

    Every output is written beside its place. When all of them are written, the
    old ones are set aside and the new ones moved in; then the old ones go. If a
    write or a move fails, every old output is as before, what was written is
    deleted, and all failures are raised together.
    """
    run = uuid.uuid4().hex
    fresh = {place: f"{place}.new-{run}" for place in outputs}
    old = {place: f"{place}.old-{run}" for place in outputs}
    failures = []
    with ThreadPoolExecutor(max_workers=max(1, len(outputs))) as pool:
        writes = {pool.submit(write, fresh[place]): place for place, write in outputs.items()}
    for done, place in writes.items():
        if done.exception() is not None:
            done.exception().add_note(f"while writing {place}")
            failures.append(done.exception())
    try:
        if not failures:
            _swap(spark, fresh, old, failures)
    finally:
        for name in fresh.values():
            files.delete(spark, name)
    if failures:
        raise ExceptionGroup("nothing was published", failures)
    for name in old.values():
        files.delete(spark, name)


def _swap(spark: SparkSession, fresh: dict[str, str], old: dict[str, str], failures: list) -> None:
    undo: list[tuple[str, str]] = []
    try:
        for place in fresh:
            if files.exists(spark, place):
                files.move(spark, place, old[place])
                undo.append((old[place], place))
            files.move(spark, fresh[place], place)
            undo.append((place, fresh[place]))
    except Exception as failure:
        failures.append(failure)
        for now, before in reversed(undo):
            files.move(spark, now, before)
