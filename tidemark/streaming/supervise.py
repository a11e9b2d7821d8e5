"""Running jobs: a registry, one runner per checkpoint, and a watch over the started queries."""

from __future__ import annotations

import argparse
import errno
import logging
import os
import signal
import sys
import time
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)
Job = Callable[[SparkSession], Sequence[StreamingQuery]]


class Registry:
    """Jobs by name. Jobs of one ``group`` write the same tables and exclude each other."""

    def __init__(self) -> None:
        self.jobs: dict[str, Job] = {}
        self.groups: dict[str, str] = {}

    def add(self, name: str, job: Job, group: str | None = None) -> None:
        self.jobs[name] = job
        if group:
            self.groups[name] = group

    def chosen(self, names: Sequence[str]) -> list[str]:
        """The names, or all for ``all``; unknown names and two jobs of one group raise ValueError."""
        wanted = list(self.jobs) if list(names) == ["all"] else list(dict.fromkeys(names))
        unknown = [n for n in wanted if n not in self.jobs]
        if unknown:
            raise ValueError(f"unknown jobs: {', '.join(unknown)}; known: {', '.join(self.jobs)}")
        taken: dict[str, str] = {}
        for n in wanted:
            g = self.groups.get(n)
            if g and g in taken:
                if list(names) == ["all"]:
                    continue
                raise ValueError(f"{taken[g]} and {n} write the same tables")
            if g:
                taken[g] = n
        return [n for n in wanted if n not in self.groups or taken[self.groups[n]] == n]


class Lock:
    """A file that one live process holds; one whose process is gone is taken over."""

    def __init__(self, path: str):
        self.path = path

    def _alive(self) -> bool:
        try:
            with open(self.path) as f:
                pid = int(f.read().strip() or 0)
            os.kill(pid, 0)
        except (ValueError, FileNotFoundError):
            return False
        except OSError as e:
            return e.errno == errno.EPERM
        return pid > 0

    def __enter__(self) -> Lock:
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        for _ in range(2):
            try:
                handle = os.open(self.path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                if self._alive():
                    raise RuntimeError(f"{self.path} is held by a running process") from None
                os.unlink(self.path)
                continue
            with os.fdopen(handle, "w") as f:
                f.write(str(os.getpid()))
            return self
        raise RuntimeError(f"{self.path} can't be locked")

    def __exit__(self, *_: object) -> None:
        os.unlink(self.path)


def alive(spark: SparkSession | None) -> bool:
    """Whether the session's context still runs; it may have been stopped by the cluster without a query failing."""
    return spark is None or not spark.sparkContext._jsc.sc().isStopped()


def watch(queries: Sequence[StreamingQuery], stop_all: bool = True, every: float = 2.0, spark: SparkSession | None = None) -> None:
    """Returns when all queries have ended. A failed one raises, and stops the others first if ``stop_all``; SIGINT and SIGTERM stop all. With ``spark``, a context that is gone raises too."""
    asked = []
    before = {s: signal.signal(s, lambda *_: asked.append(1)) for s in (signal.SIGINT, signal.SIGTERM)}
    failed = None
    try:
        while alive(spark) and any(q.isActive for q in queries) and not asked:
            failed = next((q for q in queries if q.exception() is not None), None)
            if failed is not None and stop_all:
                break
            time.sleep(every)
        failed = failed or (next((q for q in queries if q.exception() is not None), None) if alive(spark) else None)
    finally:
        for s, handler in before.items():
            signal.signal(s, handler)
        for q in queries if alive(spark) else ():
            if q.isActive:
                q.stop()
    if not alive(spark):
        raise RuntimeError("the Spark context has stopped")
    if failed is not None:
        raise failed.exception()


def main(registry: Registry, spark: Callable[[], SparkSession], argv: Sequence[str] | None = None, locks: str = "locks") -> int:
    """``--jobs name...`` or ``--jobs all``: starts the jobs and watches them. 1 for bad names."""
    parser = argparse.ArgumentParser()
    parser.add_argument("--jobs", nargs="+", default=["all"])
    parser.add_argument("--keep-going", action="store_true", help="a failed query doesn't stop the others")
    args, _ = parser.parse_known_args(argv)
    try:
        names = registry.chosen(args.jobs)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 1
    held: list[Lock] = []
    try:
        for n in names:
            held.append(Lock(os.path.join(locks, f"{n}.lock")).__enter__())
        session = spark()
        watch([q for n in names for q in registry.jobs[n](session)], stop_all=not args.keep_going, spark=session)
    finally:
        for lock in held:
            lock.__exit__()
    return 0
