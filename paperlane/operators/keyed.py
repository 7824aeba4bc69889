"""A keyed table with versions (B1): last write wins per key.

Layout of its folder: ``segments/<name>`` are Parquet folders, ``commits/vN.json``
the versions, each a small file that names its segments and schema. A run writes
one segment (reduced to the last write of each key) and then commits a version
that adds it; a run that is repeated replaces its own segment. Readers take the
segments of the last version, so they never see half a run, and a crash before
the commit leaves the old state.

Commits are optimistic: the file of version N+1 is created only if it isn't
there; who comes second reads the new version and tries again. A commit file
that was cut off has no end mark and counts for nothing.

:meth:`KeyedTable.compact` folds the segments of a version into one that holds
the live rows alone; a write does so when there are more than ``most_segments``.
Reads then cost the live rows and a bounded number of runs; a table of one
segment is a plain scan, without a shuffle. :meth:`KeyedTable.vacuum` deletes
what the last versions don't name.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from paperlane.operators.listing import latest_write_per_blob
from paperlane.sources.files import Folder


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys=("container", "name"), order=("written_at", "tiebreak"),
                 most_segments: int = 8):
        self.spark, self.path, self.most_segments = spark, path.rstrip("/"), most_segments
        self.keys, self.order = tuple(keys), tuple(order)
        self.files = Folder(spark, self.path)

    # --- versions ---------------------------------------------------------------------------
    def _version_names(self) -> list[str]:
        return [n for n in self.files.names("commits") if n.startswith("v") and n.endswith(".json")]

    def _parse(self, name: str) -> dict | None:
        try:
            made = json.loads(self.files.read(f"commits/{name}"))
        except ValueError:
            return None
        return made if made.get("end") else None

    def snapshot(self, version: int | None = None) -> dict | None:
        """The last committed version (or the named one)."""
        for name in reversed(self._version_names()):
            made = self._parse(name)
            if made and version in (None, made["version"]):
                return made
        return None

    def _commit(self, segments: list[dict], schema: StructType) -> bool:
        names = self._version_names()
        version = 1 + (int(names[-1][1:-5]) if names else 0)
        text = json.dumps({"version": version, "segments": segments, "schema": json.loads(schema.json()), "end": True})
        return self.files.create(f"commits/v{version:010d}.json", text)

    def _new_segment(self, rows: DataFrame, tag: str) -> dict:
        name = f"{tag}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/segments/{name}")
        return {"folder": name}

    # --- reading ----------------------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """The last write of each key as of a version."""
        snap = self.snapshot(version)
        if snap is None:
            raise ValueError(f"no committed version {'' if version is None else version} of {self.path}")
        return self._rows(snap)

    def _rows(self, snap: dict) -> DataFrame:
        schema = StructType.fromJson(snap["schema"])
        rows = self.spark.read.schema(schema).parquet(*(f"{self.path}/segments/{s['folder']}" for s in snap["segments"]))
        return rows if len(snap["segments"]) == 1 else latest_write_per_blob(rows, self.keys, self.order).select(*schema.names)

    # --- writing ----------------------------------------------------------------------------
    def write(self, writes: DataFrame, run_id: str) -> DataFrame:
        """Add a run's writes; returns the new state."""
        reduced = latest_write_per_blob(writes, self.keys, self.order)
        segment = self._new_segment(reduced, "run") | {"run_id": run_id}
        while True:
            snap = self.snapshot() or {"segments": [], "schema": StructType().jsonValue()}
            schema = StructType.fromJson(snap["schema"])
            for field in reduced.schema:  # columns that earlier runs had stay, new ones come after
                if field.name not in schema.names:
                    schema.add(field)
            kept = [s for s in snap["segments"] if s.get("run_id") != run_id]
            if self._commit([*kept, segment], schema):
                break
        if len(kept) + 1 > self.most_segments:
            self.compact()
        return self.read()

    def compact(self) -> bool:
        """Fold the present segments into one. False where there is nothing to
        fold, or a run was replaced meanwhile (the next write tries again)."""
        snap = self.snapshot()
        if snap is None or len(snap["segments"]) < 2:
            return False
        base = self._new_segment(self._rows(snap), "base")
        while True:
            now = self.snapshot()
            folded = [s["folder"] for s in snap["segments"]]
            since = [s for s in now["segments"] if s["folder"] not in folded]
            if len(now["segments"]) - len(since) < len(folded):
                return False
            if self._commit([base, *since], StructType.fromJson(now["schema"])):
                return True

    def vacuum(self, versions: int = 2) -> list[str]:
        """Delete commits before the last ``versions`` and the segments that no
        kept one names. Not while a writer is between segment and commit."""
        names = self._version_names()
        made = {n: m for n in names if (m := self._parse(n))}
        kept = list(made)[-versions:]
        live = {s["folder"] for n in kept for s in made[n]["segments"]}
        gone = [f"segments/{s}" for s in self.files.names("segments") if s not in live]
        gone += [f"commits/{n}" for n in names if kept and n < kept[0]]
        for name in gone:
            self.files.delete(name)
        return gone
