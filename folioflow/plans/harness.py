"""Timing and memory of jobs, by the kernel's marks and Spark's own settings."""

from __future__ import annotations

import os
import platform
import statistics
import time
from collections.abc import Callable
from contextlib import suppress
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def _family(root: int) -> list[int]:
    """A process and all below it."""
    found, at = [root], 0
    while at < len(found):
        with suppress(OSError):
            for children in Path(f"/proc/{found[at]}/task").glob("*/children"):
                found += map(int, children.read_text().split())
        at += 1
    return found


def _kilobytes(pid: int, mark: str) -> int:
    with suppress(OSError):
        for line in Path(f"/proc/{pid}/status").read_text().splitlines():
            if line.startswith(mark):
                return int(line.split()[1])
    return 0


def resident_mb() -> dict[str, float]:
    """What this process, all processes below it (the JVM, its Python workers), and both together hold now."""
    own, below = _kilobytes(os.getpid(), "VmRSS:"), sum(_kilobytes(p, "VmRSS:") for p in _family(os.getpid())[1:])
    return {"own": own / 1024, "children": below / 1024, "total": (own + below) / 1024}


class PeakMemory:
    """The highest resident memory of this machine's processes over a block.

    The kernel keeps the mark of each process; it is put back when the block begins and read when it ends, so nothing
    is sampled.  The processes' marks are added up, which is no less than what they held at one time.
    """

    peak_mb = 0.0

    def __enter__(self) -> PeakMemory:
        for pid in _family(os.getpid()):
            with suppress(OSError):
                Path(f"/proc/{pid}/clear_refs").write_text("5")
        return self

    def __exit__(self, *_: object) -> None:
        self.peak_mb = sum(_kilobytes(pid, "VmHWM:") for pid in _family(os.getpid())) / 1024


def timed(job: Callable[[], DataFrame], warm_up: int = 1, runs: int = 3) -> dict:
    """Seconds of each run and their median; every run is carried out in full, into no sink."""
    seconds = []
    with PeakMemory() as memory:
        for i in range(warm_up + runs):
            began = time.monotonic()
            job().write.format("noop").mode("overwrite").save()
            if i >= warm_up:
                seconds.append(round(time.monotonic() - began, 4))
    return {"seconds": seconds, "median": round(statistics.median(seconds), 4), "peak_ram_mb": round(memory.peak_mb, 1)}


def grid(spark: SparkSession, job: Callable[[], DataFrame], partitions: tuple[int, ...], sizes: tuple[str, ...] = ("128m",)) -> list[dict]:
    """One run for each pair of settings: shuffle partitions, and bytes a scan task reads."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(n) for n in names]
    rows = []
    try:
        for p in partitions:
            for size in sizes:
                for name, value in zip(names, (str(p), size)):
                    spark.conf.set(name, value)
                rows.append({"partitions": p, "scan_bytes": size, **timed(job, 0, 1)})
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
    return rows


def environment(spark: SparkSession | None = None) -> dict:
    """Where a job ran, as its Spark context tells; the versions are those of the driver."""
    import numpy
    import pandas
    import pyarrow
    import pyspark

    found = {"python": platform.python_version(), "packages": {m.__name__: m.__version__ for m in (pyspark, pyarrow, pandas, numpy)}}
    if spark := spark or SparkSession.getActiveSession():
        jvm, context = spark._jvm.System, spark.sparkContext
        found |= {"java": jvm.getProperty("java.version"), "os": f"{jvm.getProperty('os.name')} {jvm.getProperty('os.version')} {jvm.getProperty('os.arch')}"}
        found |= {"spark": spark.version, "master": context.master, "cores": context.defaultParallelism, "executors": spark._jsc.sc().getExecutorMemoryStatus().size()}
    return found
