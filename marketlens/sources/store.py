"""Folders of rows under one manifest: what a reader sees changes in one step, or not at all.

A writer first writes new folders nobody reads yet, then creates the next numbered manifest, which names all live folders. A manifest
counts once it is closed and whole; a writer that dies before that changes nothing, and its folders are swept by ``compact`` of the owner.
Two writers cannot create the same number, so the second one's commit fails instead of hiding the first one's.
"""
from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession


class CommitConflict(RuntimeError):
    """Another writer committed since this one read the manifest."""


class Store:
    """``path`` is a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        root = self._at(f"{self.path}/manifests")
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(root)) if self._fs.exists(root) else []

    def _read(self, number: int) -> dict[str, Any] | None:
        stream = self._fs.open(self._at(f"{self.path}/manifests/{number}"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None  # its writer died

    def manifest(self) -> tuple[int, dict[str, Any]]:
        """(number, content) of the newest whole manifest; the next number to write is one above the newest of any kind."""
        numbers = self._numbers()
        for number in reversed(numbers):
            content = self._read(number)
            if content is not None:
                return numbers[-1], content
        return (numbers[-1] if numbers else 0), {}

    def write(self, rows: DataFrame, kind: str, files: int | None = None) -> str:
        """Write ``rows`` to a new folder and return its name; nobody reads it before a manifest names it."""
        name = f"{kind}-{uuid.uuid4().hex}"
        (rows if files is None else rows.coalesce(files)).write.parquet(f"{self.path}/folders/{name}")
        return name

    def read(self, names: list[str]) -> DataFrame | None:
        """The rows of several folders of one kind."""
        if not names:
            return None
        paths = [f"{self.path}/folders/{n}" for n in names]
        return self.spark.read.schema(self.spark.read.parquet(paths[-1]).schema).parquet(*paths)

    def commit(self, after: int, content: dict[str, Any]) -> None:
        """Make ``content`` the manifest that follows number ``after``."""
        try:
            out = self._fs.create(self._at(f"{self.path}/manifests/{after + 1}"), False)
        except Exception as error:
            raise CommitConflict(f"manifest {after + 1} of {self.path} exists") from error
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
