"""Published tables that a failed write can't harm: versioned folders, switched by a manifest.

A root folder holds tables, each in a folder of its own (or in the root itself, under the name
``""``). A publication writes what is new into fresh ``version=…`` folders and touches nothing
that is published. Only when everything is written does one small file appear, the next
manifest in ``_manifest/``: it says for every table and partition which version holds it, so all
tables of the root change in one step, and months that stay are kept by naming their folder again,
without being read or copied. A publication that fails, at whatever point, leaves the tables as they were.

Folders that neither the new manifest nor the one before names are deleted after the switch: a reader
that opened a table keeps its files through one later publication.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_manifest"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name for a NULL


class PublishConflict(RuntimeError):
    """Another publication of the same root was switched to in the meantime."""


@dataclass
class Table:
    """Where a table's partitions are: folder (``""`` for a table without partitions) -> version."""

    fmt: str
    partition_by: list
    folders: dict = field(default_factory=dict)
    written: dict = field(default_factory=dict)  # version -> folders it wrote, live or not

    def partial(self) -> set:
        live = Counter(self.folders.values())
        return {v for v in live if live[v] < self.written[v]}


@dataclass
class Manifest:
    number: int
    tables: dict

    def versions(self) -> set:
        return {v for t in self.tables.values() for v in t.folders.values()}


class _Files:
    """The few file operations that publishing needs, on the file system of ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        path = self._at(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def folders(self, folder: str, depth: int) -> list[str]:
        """Partition folders below ``folder``, ``depth`` levels of ``column=value``."""
        if not depth:
            return [""]
        out = []
        for name in self.names(folder):
            if "=" in name:
                out += [f"{name}/{rest}".rstrip("/") for rest in self.folders(f"{folder}/{name}", depth - 1)]
        return out

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def appear(self, name: str, text: str) -> bool:
        """Let a file appear whole; False if it is there already."""
        folder, _, last = name.rpartition("/")
        draft = self._at(f"{folder}/.{last}.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        done = not self._fs.exists(self._at(name)) and self._fs.rename(draft, self._at(name))
        if not done:
            self._fs.delete(draft, False)
        return done

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def _manifest(files: _Files, number: int) -> Manifest:
    kept = json.loads(files.read(f"{MANIFESTS}/{number:08d}.json"))
    return Manifest(number, {name: Table(**t) for name, t in kept["tables"].items()})


def _numbers(files: _Files) -> list[int]:
    return [int(n[:8]) for n in files.names(MANIFESTS) if re.fullmatch(r"\d{8}\.json", n)]


def current(spark: SparkSession, root: str) -> Manifest | None:
    """The manifest that holds now, None if nothing was published under ``root`` yet."""
    files = _Files(spark, root)
    numbers = _numbers(files)
    return _manifest(files, max(numbers)) if numbers else None


#: A table's folder lies at most so many levels below its root.
DEPTH = 4


def find(spark: SparkSession, path: str) -> tuple[str, str, Table] | None:
    """Root, name and manifest entry of the published table whose folder is ``path``."""
    root, name = path.rstrip("/"), ""
    for _ in range(DEPTH):
        manifest = current(spark, root)
        if manifest and name in manifest.tables:
            return root, name, manifest.tables[name]
        root, _, last = root.rpartition("/")
        if not root or root.endswith(":/"):
            return None
        name = f"{last}/{name}".rstrip("/")
    return None


def _folder(root: str, name: str) -> str:
    return f"{root}/{name}".rstrip("/")


def _values(folder: str) -> dict:
    return dict((unquote(c), unquote(v)) for c, _, v in (part.partition("=") for part in folder.split("/")))


def _open(spark: SparkSession, folder: str, table: Table, schema: T.StructType | None) -> DataFrame:
    versions = sorted(set(table.folders.values()))
    if not versions:
        return spark.createDataFrame([], schema or T.StructType([]))
    reader = spark.read.option("basePath", folder)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("version", T.StringType())]))
    if table.fmt == "csv":
        reader = reader.option("header", True)
    df = reader.format(table.fmt).load([f"{folder}/version={v}" for v in versions])
    partial = table.partial()
    if partial:  # filters on folders alone: what is no longer live isn't read
        place = F.concat_ws("\x01", "version", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_FOLDER)) for c in table.partition_by])
        live = ["\x01".join([v, *_values(f).values()]) for f, v in table.folders.items() if v in partial]
        df = df.where(F.col("version").isin(sorted(set(versions) - partial)) | place.isin(sorted(live)))
    return df.drop("version")


def read_published(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The published table in the folder ``path`` as it is now; None if there is none.

    ``schema`` names all columns, those of the folders included; without one Spark infers it."""
    found = find(spark, path)
    return found and _open(spark, path.rstrip("/"), found[2], schema)


def published_folder(spark: SparkSession, path: str) -> str:
    """The folder of plain files of a published table without partitions, for readers other than this one."""
    found = find(spark, path)
    if found is None or found[2].partition_by:
        raise ValueError(f"no table without partitions is published in {path}")
    return f"{path.rstrip('/')}/version={found[2].folders['']}"


def laid_out(df: DataFrame, partition_by: list, sort_within=None, spread: int | None = None) -> DataFrame:
    """The rows as they are written. By default published tables are aggregates that take one writing task (one
    file) a partition, sorted. ``spread`` deals them to so many tasks by ranges of the partition columns and
    sort keys instead: a large partition is several files, whose names follow the order of the rows
    (finding the ranges computes ``df`` once more)."""
    if not partition_by:
        return df
    # partition columns first, as the writer wants them: else it sorts again
    order = [*partition_by, *(sort_within or ())]
    data = df.repartitionByRange(spread, *order) if spread else df.repartition(*partition_by)
    return data.sortWithinPartitions(*order) if sort_within else data


class Publication:
    """Tables of one root, written together and switched to in one step at the end of the ``with`` block.

    An exception inside the block, or in the switch, leaves everything published as it was."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._files = spark, _Files(spark, root)
        self.root = self._files.root
        self.before = current(spark, root)
        self.number = (self.before.number if self.before else 0) + 1
        # never the name of what another run, dead or alive, has written
        self.version = f"v{self.number:06d}-{uuid.uuid4().hex[:8]}"
        self.tables = dict(self.before.tables) if self.before else {}
        self._written: list[str] = []

    def write(self, name: str, df: DataFrame, partition_by=(), fmt: str = "parquet", sort_within=None,
              keep: Callable[[dict], bool] | None = None, spread: int | None = None) -> None:
        """Write ``df`` as the next state of table ``name``. ``keep`` says by its column values which
        published partition stays, if ``df`` has no rows for it; without ``keep`` none does.
        ``spread``: see :func:`laid_out`."""
        columns = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        target = _folder(name, f"version={self.version}").lstrip("/")
        if name.count("/") > DEPTH - 2:
            raise ValueError(f"{name} is too deep below its root")
        self._written.append(target)
        writer = laid_out(df, columns, sort_within, spread).write.mode("error").partitionBy(*columns)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(f"{self.root}/{target}")
        new = self._files.folders(target, len(columns))
        table = Table(fmt, columns, written={self.version: len(new)})
        old = self.before and self.before.tables.get(name)
        if keep is not None and old:
            if (old.fmt, old.partition_by) != (fmt, columns):
                raise ValueError(f"{name or self.root} is published as {old.fmt} by {old.partition_by}")
            table.folders = {f: v for f, v in old.folders.items() if keep(_values(f))}
            table.written.update(old.written)
        table.folders.update(dict.fromkeys(new, self.version))
        table.written = {v: n for v, n in table.written.items() if v in set(table.folders.values())}
        self.tables[name] = table

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """Table ``name`` as it will be, what is kept included."""
        return _open(self._spark, _folder(self.root, name), self.tables[name], schema)

    def published(self, name: str) -> bool:
        return bool(self.before) and name in self.before.tables

    def switch(self) -> None:
        told = json.dumps({"tables": {n: asdict(t) for n, t in self.tables.items()}}, indent=1)
        if not self._files.appear(f"{MANIFESTS}/{self.number:08d}.json", told):
            raise PublishConflict(f"version {self.number} of {self.root} was published by another run")

    def clean(self) -> None:
        """Delete what neither this manifest nor the one before names, up to this version."""
        now = Manifest(self.number, self.tables)
        for name in self.tables:
            live: dict = {}
            for m in (now, self.before):
                for f, v in (m.tables[name].folders if m and name in m.tables else {}).items():
                    live.setdefault(v, set()).add(f)
            for found in self._files.names(name):
                v = found.removeprefix("version=")
                if v == found or int(v[1:7]) > self.number:
                    continue
                if v not in live:
                    self._files.delete(_folder(name, found).lstrip("/"))
                elif self.tables[name].partition_by:
                    at = _folder(name, found).lstrip("/")
                    for f in self._files.folders(at, len(self.tables[name].partition_by)):
                        if f not in live[v]:
                            self._files.delete(f"{at}/{f}")
        for number in _numbers(self._files):
            if number < self.number - 1:
                self._files.delete(f"{MANIFESTS}/{number:08d}.json")

    def abandon(self) -> None:
        for target in self._written:
            self._files.delete(target)

    def __enter__(self) -> "Publication":
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            try:
                self.switch()
            except PublishConflict:
                self.abandon()
                raise
            # after any other error of the switch the manifest may be there: nothing is deleted
            self.clean()
        else:
            self.abandon()
