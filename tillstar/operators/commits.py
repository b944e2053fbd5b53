"""The commit log of a warehouse: one small JSON file a load, created only if its number is still free.

A commit names the folder of its rows, the last run it replaces, and how far it has read each source. What a reader sees
are the commits that no later one replaces. A whole load replaces the runs that were there when it began, so of two loads
at the same time neither is lost: the later one does not know the other and leaves it in force.

The log needs a file system whose rename refuses an existing target (HDFS and its like) or has hard links (local). That
is what Spark's own streaming checkpoints ask for.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tillstar.session import file_system

_LOG = "run bigint, folder string, dimensions string, replaces bigint, sources map<string,bigint>, rejects string"
FOLDER = "commits"


class Commit(NamedTuple):
    run: int
    folder: str  # of the fact
    dimensions: str  # folder of the dimension rows that came with it
    replaces: int  # this run and all before it are history
    sources: Mapping[str, int]  # the last batch of each source that it holds
    rejects: str | None  # the schema of its rejects


def history(spark: SparkSession, root: str) -> list[Commit]:
    """All commits, oldest first; one row a load, so the log stays small, and ``expire`` shortens it."""
    try:
        rows = spark.read.schema(_LOG).json(f"{root}/{FOLDER}").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(Commit(**row.asDict()) for row in rows)


def visible(commits: Iterable[Commit], run: int | None = None) -> list[Commit]:
    """The commits that make up the warehouse, or that made it up after an earlier run."""
    commits = [c for c in commits if run is None or c.run <= run]
    replaced = max((c.replaces for c in commits), default=0)
    return [c for c in commits if c.run > replaced]


def offset(commits: Iterable[Commit], source: str) -> int | None:
    """The last batch of a source in these commits."""
    return max((c.sources[source] for c in commits if source in (c.sources or {})), default=None)


def path(root: str, run: int) -> str:
    return f"{root}/{FOLDER}/{run:012d}.json"


def claim(spark: SparkSession, root: str, commit: Commit) -> bool:
    """Write a commit under its number, whole or not at all; False when another load has taken the number."""
    fs, target = file_system(spark, path(root, commit.run))
    _, draft = file_system(spark, f"{root}/{FOLDER}/.{uuid.uuid4().hex}")  # hidden from Spark's readers
    fs.mkdirs(target.getParent())
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(commit._asdict()).encode()))
    out.close()
    try:
        if fs.getUri().getScheme() != "file":
            return fs.rename(draft, target)
        os.link(draft.toUri().getPath(), target.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        fs.delete(draft, False)
