"""Versions of a store: a manifest lists the windows of every variable, where their files are and how many rows they have.

A version is one JSON file, `_manifests/v00000001.json` and so on, written under another name first and then renamed: what isn't in
the newest manifest isn't in the store, so readers see all of a commit or nothing, and files of a failed commit are never read.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

NAME = re.compile(r"v(\d{8})\.json")


@dataclass(frozen=True)
class Manifest:
    """entries: variable -> (year, widx) -> (commit whose folder holds the files, rows); sizes: "variable/commit" -> windows in that folder,
    live or not; states: variable -> commit of its climatology sums."""

    version: int = 0
    commit: str = ""
    entries: dict[str, dict[tuple[int, int], tuple[str, int]]] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)
    states: dict[str, str] = field(default_factory=dict)

    def windows(self, variable: str) -> list[tuple[int, int]]:
        return sorted(self.entries.get(variable, {}))

    def following(self, commit: str, added: dict, dropped_years: dict[str, int] | None = None, states: dict[str, str] | None = None) -> Manifest:
        """The next version: some variables' years dropped, windows added, in one step."""
        entries = {v: dict(w) for v, w in self.entries.items()}
        for v, year in (dropped_years or {}).items():
            entries[v] = {k: x for k, x in entries.get(v, {}).items() if k[0] != year}
        for v, windows in added.items():
            entries.setdefault(v, {}).update(windows)
        used = {f"{v}/{c}" for v, windows in entries.items() for c, _ in windows.values()}
        sizes = self.sizes | {f"{v}/{commit}": len(windows) for v, windows in added.items()}
        return Manifest(self.version + 1, commit, entries, {k: n for k, n in sizes.items() if k in used}, self.states if states is None else states)

    def text(self) -> str:
        rows = [[v, y, w, c, n] for v, windows in sorted(self.entries.items()) for (y, w), (c, n) in sorted(windows.items())]
        return json.dumps({"version": self.version, "commit": self.commit, "entries": rows, "sizes": self.sizes, "states": self.states})

    @staticmethod
    def parsed(text: str) -> Manifest:
        found = json.loads(text)
        entries: dict[str, dict] = {}
        for v, y, w, c, n in found["entries"]:
            entries.setdefault(v, {})[y, w] = (c, n)
        return Manifest(found["version"], found["commit"], entries, found["sizes"], found["states"])


class Folder:
    """Small files and renames in a folder of whatever file system Spark reads; used by the driver alone."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root
        self.fs = self.path().getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        return [x.getPath().getName() for x in self.fs.listStatus(self.path(name))] if self.fs.exists(self.path(name)) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def rename(self, name: str, to: str) -> bool:
        return not self.fs.exists(self.path(to)) and self.fs.rename(self.path(name), self.path(to))


def versions(folder: Folder) -> list[int]:
    return sorted(int(m[1]) for n in folder.names("_manifests") if (m := NAME.fullmatch(n)))


def load(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The newest version, or one of before; an empty manifest where there is none yet."""
    folder = Folder(spark, root)
    known = versions(folder)
    if version is not None and version not in known:
        raise FileNotFoundError(f"{root} has no version {version}")
    if not known:
        return Manifest()
    return Manifest.parsed(folder.read(f"_manifests/v{version if version is not None else known[-1]:08d}.json"))


def publish(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Make a version the newest in one rename. Of two writers that began at the same version the second gets an error, and may try again."""
    folder = Folder(spark, root)
    beside, name = f"_manifests/.{uuid.uuid4().hex}", f"_manifests/v{manifest.version:08d}.json"
    folder.write(beside, manifest.text())
    if not folder.rename(beside, name) or Manifest.parsed(folder.read(name)).commit != manifest.commit:
        folder.delete(beside)
        raise RuntimeError(f"{root}: another writer has published version {manifest.version}")


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete all manifests but the newest `keep`, and the files of commits that none of these names; returns those commits' folders.

    Not while a commit is being written, whose files no manifest names yet.
    """
    folder = Folder(spark, root)
    known = versions(folder)
    live = [load(spark, root, v) for v in known[-keep:]]
    used = {c for m in live for windows in m.entries.values() for c, _ in windows.values()} | {c for m in live for c in m.states.values()}
    for v in known[:-keep]:
        folder.delete(f"_manifests/v{v:08d}.json")
    gone = []
    for top in folder.names(""):
        if not top.startswith("_manifests"):
            gone += [f"{top}/{n}" for n in folder.names(top) if n.startswith("commit=") and n[7:] not in used]
    for name in gone:
        folder.delete(name)
    return gone
