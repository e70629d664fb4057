"""The packed bundle as files in a client's form, written so that readers see the old one or the new one whole.

A folder has manifest.json and grid.json, the cells' order (cells.bin.br, 32 bits a cell), a blob a world, threshold and
stretch of years (WORLD/THRESHOLD/FIRST-LAST.bin.br, a byte a cell and month), and a world's daily extents with their day
offsets (extent/WORLD.bin.br, extent/WORLD_days.bin.br). Blobs are compressed with brotli.

Writing is a Spark data source. Tasks put their files, under names that no other attempt has, into a folder of the
write's own; the commit moves what the successful tasks report into place, the manifest last and in one step. If a task
fails, the abort removes the write's folder, and the manifest and all it names are as they were. Files that a manifest
names are never written over: a changed blob gets a new name, and what no manifest names any more is removed after the commit.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..functions.grid import COLUMNS, ROWS, STEP
from ..operators.listing import file_system
from ..operators.packing import expand
from .gridded import opened

#: A row of what is written: file is a path in the bundle, its digest goes into the name; place says where the manifest names it.
FILES = "file string, place string, data binary"
STAGING = ".writing-"


@dataclass
class Written(WriterCommitMessage):
    """(file, place, staged, bytes) of a task's files."""

    files: list[tuple[str, str, str, int]]


def named(file: str, data: bytes) -> str:
    """The file's name with a digest of what is in it, before its endings."""
    head, dot, ends = file.partition(".")
    return f"{head}-{hashlib.sha256(data).hexdigest()[:12]}{dot}{ends}"


class BundleWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.manifest = json.loads(options["manifest"])
        self.staging = f"{self.root}/{STAGING}{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Written:
        system, root = file_system(self.root)
        staging, out = f"{root}{self.staging[len(self.root) :]}", []
        system.create_dir(staging, recursive=True)
        for r in rows:
            data = bytes(r.data)
            at = f"{staging}/{uuid.uuid4().hex}"
            with system.open_output_stream(at) as f:
                f.write(data)
            out.append((named(r.file, data), r.place, at, len(data)))
        return Written(out)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = file_system(self.root)
        files = [f for m in messages if m for f in m.files]
        for file, _, staged, _ in files:
            system.create_dir(f"{root}/{file}".rsplit("/", 1)[0], recursive=True)
            system.move(staged, f"{root}/{file}")
        old = read_manifest(self.root)
        new = _placed(self.manifest, {place: (file, size) for file, place, _, size in files}, old)
        with system.open_output_stream(f"{root}/{STAGING}manifest") as f:
            f.write(json.dumps(new, indent=1, sort_keys=True).encode())
        system.move(f"{root}/{STAGING}manifest", f"{root}/manifest.json")
        for file in named_files(old) - named_files(new):
            system.delete_file(f"{root}/{file}")
        self._remove()

    def abort(self, messages: list[Written | None]) -> None:
        self._remove()

    def _remove(self) -> None:
        system, root = file_system(self.root)
        staging = f"{root}{self.staging[len(self.root) :]}"
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)


def _placed(manifest: dict, files: dict[str, tuple[str, int]], old: dict) -> dict:
    """The manifest with the names of its files, and the worlds of the old one that it does not have."""

    def fill(x):
        if isinstance(x, dict):
            out = {k: fill(v) for k, v in x.items()}
            for key in ("file", "days_file"):
                if key in out:
                    out[key], size = files[out[key]]
                    out["bytes" if key == "file" else "days_bytes"] = size
            return out
        return [fill(v) for v in x] if isinstance(x, list) else x

    new = fill(manifest)
    kept = old.get("worlds", {}) if old.get("cells", {}).get("digest") == new.get("cells", {}).get("digest") else {}
    return old | new | {"worlds": kept | new["worlds"]}


def named_files(manifest: dict) -> set[str]:
    """Every file that a manifest names."""
    if isinstance(manifest, list):
        return set().union(*map(named_files, manifest)) if manifest else set()
    if not isinstance(manifest, dict):
        return set()
    own = {v for k, v in manifest.items() if k in ("file", "days_file")}
    return own.union(*(named_files(v) for v in manifest.values()))


def read_manifest(root: str) -> dict:
    """A bundle's manifest; without worlds if there is none."""
    system, inner = file_system(f"{root.rstrip('/')}/manifest.json")
    if system.get_file_info(inner).type == fs.FileType.NotFound:
        return {"worlds": {}}
    with system.open_input_stream(inner) as f:
        return json.loads(f.read())


class Blob(InputPartition):
    def __init__(self, world: str, threshold: str, entry: dict, cells: str):
        self.world, self.threshold, self.entry, self.cells = world, threshold, entry, cells


class BundleReader(DataSourceReader):
    """(world, threshold, year, month, cell_id, days): a partition a blob, a batch a month."""

    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")

    def _bytes(self, file: str, size: int) -> bytes:
        with opened(f"{self.root}/{file}") as f:
            return expand(f.read(), size)

    def partitions(self) -> list[Blob]:
        m = read_manifest(self.root)
        return [Blob(w, t, e, m["cells"]) for w, own in m["worlds"].items() for t, entries in own["thresholds"].items() for e in entries]

    def read(self, blob: Blob) -> Iterator[pa.RecordBatch]:
        n = blob.cells["n_cells"]
        cells = np.frombuffer(self._bytes(blob.cells["file"], 4 * n), "<i4").astype(np.int64)
        frames = np.frombuffer(self._bytes(blob.entry["file"], n * blob.entry["n_months"]), np.uint8).reshape(-1, n)
        for k, frame in enumerate(frames):
            year, month = blob.entry["first_year"] + k // 12, k % 12 + 1
            same = lambda x, kind: pa.array([x] * n, kind)
            yield pa.RecordBatch.from_arrays([same(blob.world, pa.string()), same(blob.threshold, pa.string()), same(year, pa.int32()), same(month, pa.int32()), pa.array(cells), pa.array(frame.astype(np.int64))], ["world", "threshold", "year", "month", "cell_id", "days"])


class Bundle(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bundle"

    def schema(self) -> str:
        return "world string, threshold string, year int, month int, cell_id bigint, days bigint"

    def reader(self, schema) -> BundleReader:
        return BundleReader(self.options)

    def writer(self, schema, overwrite: bool) -> BundleWriter:
        return BundleWriter(self.options)


GRID = {"nlat": ROWS, "nlon": COLUMNS, "lat0": 90.0, "lon0": -180.0, "step": STEP, "cells_dtype": "int32"}


def write(files: DataFrame, root: str, manifest: dict) -> None:
    """Writes files (file, place, data) as a bundle; the manifest has places where names of files belong."""
    files.sparkSession.dataSource.register(Bundle)
    files.select("file", "place", "data").write.format("bundle").mode("append").option("manifest", json.dumps(manifest)).save(root)
    system, inner = file_system(root)
    text = json.dumps(GRID | {"n_cells": manifest["cells"]["n_cells"]}, indent=1).encode()
    with system.open_output_stream(f"{inner}/grid.json") as f:
        f.write(text)


def frames(spark: SparkSession, root: str) -> DataFrame:
    spark.dataSource.register(Bundle)
    return spark.read.format("bundle").load(root)
