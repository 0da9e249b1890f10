"""The commit manifest: which written folders of a warehouse count, and the last surrogate keys.

Every version is one small file. A writer lays its rows into folders of their own and
then publishes the next version by a rename that fails where that version
exists, so readers see all of a commit or nothing, and of two writers one is refused.
The file system must have an atomic rename, as HDFS and local disks do.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_KEPT = 20  # versions


class CommitRefused(RuntimeError):
    """Another writer has published since this one began."""


@dataclass
class State:
    """What a version says: the commits of every table in order, and the tables' last keys."""

    version: int = 0
    commits: dict[str, list[str]] = field(default_factory=dict)
    last_keys: dict[str, int] = field(default_factory=dict)

    def copy(self) -> State:
        return State(self.version, {t: list(c) for t, c in self.commits.items()}, dict(self.last_keys))


class Manifest:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._folder = f"{root}/_manifest"
        # The versions for Spark's readers; their names ascend.
        self.files = f"{self._folder}/*.json"

    def newest(self) -> State:
        """The state of the last version; an empty one where nothing was published."""
        versions = self._versions()
        if not versions:
            return State()
        path = self._path(versions[-1])
        stream = path.getFileSystem(self._conf).open(path)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        held = json.loads(text)
        return State(versions[-1], held["commits"], held["last_keys"])

    def publish(self, state: State) -> None:
        """Make ``state`` the version after its own, or raise ``CommitRefused``."""
        fs = self._jvm.org.apache.hadoop.fs
        draft = fs.Path(f"{self._folder}/.{uuid.uuid4().hex}")
        files = draft.getFileSystem(self._conf)
        stream = files.create(draft, True)
        stream.write(json.dumps({"commits": state.commits, "last_keys": state.last_keys}).encode())
        stream.close()
        context = fs.FileContext.getFileContext(draft.toUri(), self._conf)
        modes = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            context.rename(files.makeQualified(draft), files.makeQualified(self._path(state.version + 1)), modes)
        except Py4JJavaError as error:
            files.delete(draft, False)
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            raise CommitRefused(f"version {state.version + 1} of {self._folder} was published by another writer") from error
        for old in self._versions()[:-_KEPT]:
            files.delete(self._path(old), False)

    def _versions(self) -> list[int]:
        folder = self._jvm.org.apache.hadoop.fs.Path(self._folder)
        files = folder.getFileSystem(self._conf)
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _path(self, version: int):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{version:012d}.json")
