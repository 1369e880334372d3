"""Stages of a run that are written once, and skipped when the run is started again.

A stage writes its tables under the run's folder and is then committed by a small
file that appears at once.  The file holds a key of the stage's settings and of the
keys of the stages it reads, so a change of settings repeats a stage and all after it.
What a stage needs on the way lies in a work folder of its own and goes with it.

One driver at a time may work in a folder.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from jobsift.session import file_system, scratch_folder


@dataclass(frozen=True)
class Stage:
    """``write(path)`` writes under the path given; ``inputs`` are the stages it reads."""

    write: Callable[[str], None]
    inputs: tuple[str, ...] = ()
    settings: tuple[Any, ...] = ()


def frame_key(df: DataFrame | None) -> str:
    """What a table is made of: its columns and the files behind it, not their content."""
    if df is None:
        return ""
    return digest([df.schema.simpleString(), sorted(df.inputFiles())])


def digest(value: Any) -> str:
    return hashlib.sha256(json.dumps(value, default=str).encode()).hexdigest()


class Run:
    """The stages of one folder."""

    def __init__(self, spark: SparkSession, folder: str, stages: Mapping[str, Stage]) -> None:
        self.spark, self.folder, self.stages = spark, folder.rstrip("/"), stages
        self._keys: dict[str, str] = {}
        self.done: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def key(self, name: str) -> str:
        if name not in self._keys:
            stage = self.stages[name]
            self._keys[name] = digest([name, stage.settings, [self.key(i) for i in stage.inputs]])
        return self._keys[name]

    def _commit_path(self, name: str) -> str:
        return f"{self.folder}/_stages/{name}.json"

    def committed(self, name: str) -> bool:
        """Whether the stage was finished with the present settings."""
        fs, path = file_system(self.spark, self._commit_path(name))
        if not fs.exists(path):
            return False
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text).get("key") == self.key(name)

    def _commit(self, name: str) -> None:
        fs, path = file_system(self.spark, self._commit_path(name))
        _, new = file_system(self.spark, f"{self.folder}/_stages/.{name}-{uuid.uuid4().hex}")
        stream = fs.create(new, True)
        stream.write(bytearray(json.dumps({"stage": name, "key": self.key(name)}), "utf-8"))
        stream.close()
        fs.rename(new, path)

    def ensure(self, name: str) -> None:
        """Bring a stage and all it reads up to date."""
        stage = self.stages[name]
        for read in stage.inputs:
            self.ensure(read)
        if self.committed(name):
            return
        fs, committed = file_system(self.spark, self._commit_path(name))
        fs.delete(committed, False)
        with scratch_folder(self.spark, f"{self.folder}/_work/{name}"):
            stage.write(self.path(name))
        self._commit(name)
        self.done.append(name)
