"""Stages of a long job that are stored once and found again after a restart.

A stage is a folder ``<name>-<digest of its key>`` with the rows and a ledger
entry (rows, tokens). It is written under another name and appears by one
rename, rows and entry together, so a stage either is there whole or isn't. The
key holds what the rows depend on: parameters, and a fingerprint of the source's
files. A job that starts again asks for the same stages in the same order, finds
those that are done, without reading their sources, and goes on with the next.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..runtime import filesystem_of, rename_new

ENTRY = "stage string, key string, rows bigint, tokens bigint"


@dataclass(frozen=True)
class Stage:
    """Stored rows with their totals."""

    rows: DataFrame
    count: int
    tokens: int
    key: str


def fingerprint(spark: SparkSession, path: str, glob: str = "*") -> str:
    """Changes when a file below ``path`` is added, removed or rewritten; files are listed, not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    facts = files.select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h"))
    row = facts.agg(F.count(F.lit(1)), F.sum("h")).first()
    return f"{row[0]}:{row[1]}"


class StageStore:
    """The stages of one job below the folder ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str, key: object) -> tuple[str, str]:
        digest = hashlib.sha256(json.dumps(key, sort_keys=True, default=str).encode()).hexdigest()[:32]
        plain = re.sub(r"[^0-9A-Za-z]+", "-", name).strip("-")
        return f"{self.root}/{plain}-{digest}", digest

    def has(self, name: str, key: object) -> bool:
        filesystem, path = filesystem_of(self.spark, self._path(name, key)[0])
        return filesystem.exists(path)

    def run(self, name: str, key: object, build: Callable[[], DataFrame], tokens: str | None = None) -> Stage:
        """The stage ``name`` for ``key``: the stored one, or what ``build`` returns, stored now.

        ``tokens`` names a column to total. Of two runs that build one stage the
        first to finish counts, and both go on with its rows.
        """
        path, digest = self._path(name, key)
        if not self.has(name, key):
            staged = f"{self.root}/staged-{uuid.uuid4().hex}"
            build().write.parquet(f"{staged}/rows")
            stored = self.spark.read.parquet(f"{staged}/rows")
            total = F.coalesce(F.sum(tokens), F.lit(0)) if tokens else F.lit(None)
            entry = stored.agg(F.count(F.lit(1)).alias("rows"), total.cast("bigint").alias("tokens"))
            named = entry.select(F.lit(name).alias("stage"), F.lit(digest).alias("key"), "rows", "tokens")
            named.coalesce(1).write.parquet(f"{staged}/entry")
            if not rename_new(self.spark, staged, path):
                filesystem, leftover = filesystem_of(self.spark, staged)
                filesystem.delete(leftover, True)
        facts = self.spark.read.schema(ENTRY).parquet(f"{path}/entry").first()
        return Stage(self.spark.read.parquet(f"{path}/rows"), facts.rows, facts.tokens or 0, digest)

    def entries(self) -> DataFrame:
        """stage, key, rows, tokens of every stage that is done."""
        filesystem, path = filesystem_of(self.spark, self.root)
        names = [s.getPath().getName() for s in filesystem.listStatus(path)] if filesystem.exists(path) else []
        done = [f"{self.root}/{n}/entry" for n in names if not n.startswith("staged-")]
        if not done:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(*done)
