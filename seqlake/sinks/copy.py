"""Distributed copy of planned transfers (SNK2, SNK15).

The plan is a DataFrame of ``(origin, dest)``; copying runs inside the
tasks (``mapInPandas``), one Arrow batch at a time, and returns one status
row per file.  Each copy goes to a temporary name next to the
destination and is renamed into place, so a retried task (lost executor)
either finds the finished file and skips it or redoes a partial one.
"""

from __future__ import annotations

import os
import shutil
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUS_SCHEMA = "origin string, dest string, ok boolean, bytes long, error string"

# Tasks that share the slots of a paced plan when the caller names no number.
PACED_TASKS = 4

Copier = Callable[[str, str], int]


def _local(p: str) -> str:
    if p.startswith("file://"):
        return p[len("file://"):]
    if p.startswith("file:"):
        return p[len("file:"):]
    return p


def local_copy(origin: str, dest: str) -> int:
    """Copy between paths of a shared POSIX file system; returns bytes.

    Skips the copy when ``dest`` already has the origin's size (a rerun).
    """
    src, dst = _local(origin), _local(dest)
    size = os.path.getsize(src)
    if os.path.exists(dst) and os.path.getsize(dst) == size:
        return size
    os.makedirs(os.path.dirname(dst) or ".", exist_ok=True)
    tmp = f"{dst}.part-{uuid.uuid4().hex[:8]}"
    shutil.copyfile(src, tmp)
    os.replace(tmp, dst)
    return size


def arrow_copy(origin: str, dest: str) -> int:
    """Copy between any two ``pyarrow.fs`` file systems named by URI
    (``s3://``, ``gs://``, ``hdfs://``, local paths); returns bytes.

    Credentials come from each store's usual environment.  A destination
    that already has the origin's size is kept (a rerun).  Object stores
    publish an object only when its upload completes, so they are written
    in place; local file systems get a temporary name and a rename.
    """
    from pyarrow import fs

    sfs, spath = fs.FileSystem.from_uri(origin)
    dfs, dpath = fs.FileSystem.from_uri(dest)
    size = sfs.get_file_info(spath).size
    have = dfs.get_file_info(dpath)
    if have.type == fs.FileType.File and have.size == size:
        return size
    parent = dpath.rsplit("/", 1)[0]
    if parent:
        dfs.create_dir(parent, recursive=True)
    if isinstance(dfs, fs.LocalFileSystem):
        tmp = f"{dpath}.part-{uuid.uuid4().hex[:8]}"
        fs.copy_files(spath, tmp, source_filesystem=sfs, destination_filesystem=dfs)
        dfs.move(tmp, dpath)
    else:
        fs.copy_files(spath, dpath, source_filesystem=sfs, destination_filesystem=dfs)
    return size


def copy_files(plan: DataFrame, copier: Copier = local_copy, origin: str = "origin", dest: str = "dest",
               parallelism: int | None = None, slot: str | None = None, interval: float = 0.0) -> DataFrame:
    """Status of copying every ``origin`` to ``dest`` (lazy; act on it once
    and keep the result, e.g. by writing it).

    ``parallelism`` spreads the plan over that many tasks, which is how many
    copies run at once (a store's request budget decides it); by default the
    plan's own partitions are used.

    ``slot`` names a column of batch numbers from 0 (STR5).  Time is cut in
    slots of ``interval`` seconds, which belong to the tasks in turn; a task
    releases one batch in each slot of its own and none in another's.  So
    no slot sees two releases, also when tasks start late, lag or are repeated
    after the loss of their executor (clocks must agree within a part of a
    slot).  A task without a core leaves its slots unused: ask for no more
    tasks than run at once.
    """
    lanes = parallelism or PACED_TASKS
    if slot:
        plan = (plan.withColumn("_lane", F.pmod(F.col(slot), F.lit(lanes)).cast("int"))
                .repartition(lanes, "_lane").sortWithinPartitions(slot, dest))
    elif parallelism:
        plan = plan.repartition(parallelism)

    def own_slot(lane: int, after: int) -> int:
        """Wait for the next slot of a lane; its number."""
        first = max(int(time.time() // interval) + 1, after + 1)
        turn = first + (lane - first) % lanes
        time.sleep(max(0.0, turn * interval - time.time()))
        return turn

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, used = None, -1
        for b in batches:
            out = []
            for i, (o, d) in enumerate(zip(b[origin], b[dest])):
                if slot and interval > 0 and b[slot].iat[i] != last:
                    last = b[slot].iat[i]
                    used = own_slot(int(b["_lane"].iat[i]), used)
                try:
                    out.append((o, d, True, int(copier(o, d)), None))
                except Exception as e:  # reported per file, never fails the job
                    out.append((o, d, False, 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["origin", "dest", "ok", "bytes", "error"])

    return plan.select(origin, dest, *([slot, "_lane"] if slot else [])).mapInPandas(run, STATUS_SCHEMA)
