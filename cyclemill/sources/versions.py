"""Tables that are published in one step: readers see the old rows or the new, never a mixture."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from cyclemill.session import delete_table

MANIFEST = "manifest-"
DATA = "data-"
KEPT = 2


class Versions:
    """Directories below ``path`` and the manifests that name them, by phase.

    A writer fills a ``fresh`` directory, which no manifest names, and publishes it: the manifest is one small file,
    written beside the others and renamed into place. The last one counts. What a job that died
    has left is in no manifest; ``collect`` deletes it, and versions before the last ``KEPT``, which leaves
    readers of the version before the time to finish. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def fresh(self) -> str:
        """A directory for new rows."""
        return f"{self.path}/{DATA}{uuid.uuid4().hex}"

    def current(self) -> dict[str, str]:
        """The directory of every published phase; empty if nothing is published."""
        found = self._manifests()
        return self._read(found[-1]) if found else {}

    def publish(self, places: dict[str, str]) -> None:
        """From now on these phases are read from these directories, below ``path``; other phases stay."""
        found = self._manifests()
        number = int(found[-1].removeprefix(MANIFEST)) + 1 if found else 1
        held = {phase: place.rsplit("/", 1)[-1] for phase, place in {**self.current(), **places}.items()}
        pending, target = (self._at(f"{self.path}/{n}") for n in (f".pending-{uuid.uuid4().hex}", f"{MANIFEST}{number:010d}"))
        out = self._fs().create(pending, False)
        try:
            out.write(bytearray(json.dumps(held).encode()))
        finally:
            out.close()
        if not self._fs().rename(pending, target):
            raise OSError(f"could not publish {target}")

    def collect(self, keep: int = KEPT) -> None:
        """Delete all but the last ``keep`` manifests and the directories that these name."""
        found = self._manifests()
        old, named = found[:-keep], {p for m in found[-keep:] for p in self._read(m).values()}
        stale = [n for n in self._names() if n.startswith(DATA) and f"{self.path}/{n}" not in named]
        stale += [n for n in self._names() if n.startswith(".pending-")]
        # manifests first: one that is there names directories that are there
        for name in [*old, *stale]:
            delete_table(self.spark, f"{self.path}/{name}")

    def _read(self, manifest: str) -> dict[str, str]:
        stream = self._fs().open(self._at(f"{self.path}/{manifest}"))
        try:
            held = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        return {phase: f"{self.path}/{name}" for phase, name in held.items()}

    def _names(self) -> list[str]:
        fs, at = self._fs(), self._at(self.path)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def _manifests(self) -> list[str]:
        return sorted(n for n in self._names() if n.startswith(MANIFEST))

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._at(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
