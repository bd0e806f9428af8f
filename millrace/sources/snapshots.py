"""Tables whose partitions are replaced all together or not at all.

Every commit writes its partitions beside the old ones, under a version of its own,
and then names the live version of each partition in a manifest. The manifest
appears by one rename, so readers see the table before a commit or after it, and a
job that stops in between leaves a folder that nobody reads (the next commit
overwrites it). Readers of an older snapshot keep their files until :meth:`vacuum`.

    data/__snapshot=<version>/<column>=<value>/*.parquet
    manifests/<version>.json

The manifest holds one entry per partition and passes through the driver: thousands
of days or buckets, not millions. The rename must not replace an existing file
(HDFS, local disks); on object stores use one whose rename has this property. Of two
concurrent commits the later one raises and may run again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators import merge

BUCKET = "bucket"
VERSION = "__snapshot"  # a folder name that no column of a table has


class Folder:
    """The few file operations a manifest needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """The file with all its text, or an error if it is there already."""
        if self._fs.exists(self._at(name)):
            raise FileExistsError(f"{self.path}/{name}")
        folder, _, base = name.rpartition("/")
        draft = self._at(f"{folder}/.{base}.{self._jvm.java.util.UUID.randomUUID().toString()}")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._fs.rename(draft, self._at(name)):
            self._fs.delete(draft, False)
            raise FileExistsError(f"{self.path}/{name}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class SnapshotTable:
    """A table partitioned by ``column`` under ``path``, read and replaced by snapshots."""

    def __init__(self, spark: SparkSession, path: str, column: str):
        self.spark, self.column, self.folder = spark, column, Folder(spark, path)
        self.path = self.folder.path

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.folder.names("manifests") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """``version, parts`` (partition folder to version), ``schema`` and ``applied`` of a
        snapshot, by default the latest; an empty one before the first commit."""
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "parts": {}, "schema": None, "applied": {}}
        return json.loads(self.folder.read(f"manifests/{(known[-1] if version is None else version):012d}.json"))

    def values(self, version: int | None = None) -> list[str]:
        """The partition values of a snapshot, as text, in order; no file is listed."""
        return sorted(p.split("=", 1)[1] for p in self.manifest(version)["parts"])

    def read(self, version: int | None = None, *, only: Iterable[str] | None = None, schema: StructType | None = None) -> DataFrame:
        """The rows of a snapshot, or of some of its partitions (``only``: values as text)."""
        now = self.manifest(version)
        schema = StructType.fromJson(now["schema"]) if now["schema"] else schema
        if schema is None:
            raise ValueError(f"{self.path} has no snapshot yet; give a schema")
        wanted = None if only is None else {f"{self.column}={v}" for v in only}
        paths = [f"{self.path}/data/{VERSION}={v}/{part}" for part, v in sorted(now["parts"].items()) if wanted is None or part in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths).select(schema.names)

    def commit(self, rows: DataFrame, *, replaces: Iterable[str], applied: dict[str, int] | None = None) -> int:
        """Replace the partitions ``replaces`` (values as text) by the partitions of ``rows`` in one
        step: those that ``rows`` lacks become empty, all others stay. ``applied`` notes what
        was done (a source and its last batch), so that a repeated step can be told."""
        before = self.manifest()
        version = before["version"] + 1
        self.write(rows, version)
        written = {n: version for n in self.folder.names(f"data/{VERSION}={version}") if n.startswith(f"{self.column}=")}
        gone = {f"{self.column}={v}" for v in replaces}
        if stray := set(written) - gone:
            raise ValueError(f"rows lie in partitions that are not replaced: {sorted(stray)[:3]}")
        parts = {p: v for p, v in before["parts"].items() if p not in gone} | written
        self.publish({"version": version, "parts": parts, "schema": rows.schema.jsonValue(), "applied": before["applied"] | (applied or {})})
        return version

    def write(self, rows: DataFrame, version: int) -> None:
        """The files of a version that no manifest names yet. AQE sizes the write tasks, so a
        hot partition is written by several."""
        rows.hint("rebalance", self.column).write.mode("overwrite").partitionBy(self.column).parquet(f"{self.path}/data/{VERSION}={version}")

    def publish(self, manifest: dict) -> None:
        try:
            self.folder.write_new(f"manifests/{manifest['version']:012d}.json", json.dumps(manifest))
        except FileExistsError:
            raise RuntimeError(f"another commit made version {manifest['version']} of {self.path}; run this one again") from None

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete what the last ``keep`` snapshots do not name; the deleted folders."""
        known = self.versions()
        live = {(v, p) for n in known[-keep:] for p, v in self.manifest(n)["parts"].items()}
        for n in known[:-keep]:
            self.folder.delete(f"manifests/{n:012d}.json")
        out = []
        for name in self.folder.names("data"):
            version = int(name.split("=")[1])
            if known and version > known[-1]:
                continue  # a commit that is under way
            for part in self.folder.names(f"data/{name}"):
                if part.startswith(f"{self.column}=") and (version, part) not in live:
                    self.folder.delete(f"data/{name}/{part}")
                    out.append(f"{name}/{part}")
        return out


class KeyedTable(SnapshotTable):
    """One row per key, dealt to ``buckets`` by a hash of the key. A merge rewrites the buckets
    that its delta touches and no others; reading needs no merge."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: str | Sequence[str], *, buckets: int = 64):
        super().__init__(spark, path, BUCKET)
        self.schema, self.keys, self.buckets = schema, [keys] if isinstance(keys, str) else list(keys), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def rows(self, version: int | None = None) -> DataFrame:
        return self.read(version, schema=self._stored()).drop(BUCKET)

    def _stored(self) -> StructType:
        return StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])

    def done(self, source: str) -> int:
        """The last batch of ``source`` that a commit holds, -1 for none."""
        return self.manifest()["applied"].get(source, -1)

    def merge(self, delta: DataFrame, rule: str, *, source: str | None = None, batch: int = -1) -> int | None:
        """Merge ``delta`` (one row per key, null keys left out) by ``coalesce`` or ``update``
        (see :mod:`millrace.operators.merge`). A batch that a commit holds already is not
        merged again. Returns the new version, None if there was nothing to do."""
        if rule not in ("coalesce", "update"):
            raise ValueError(f"unknown merge rule {rule!r}")
        if source is not None and batch <= self.done(source):
            return None
        applied = {source: batch} if source is not None else None
        for k in self.keys:
            delta = delta.where(F.col(k).isNotNull())
        touched = [str(r[0]) for r in delta.select(self.bucket()).distinct().collect()]  # at most one per bucket
        if not touched and applied is None:
            return None
        current = self.read(only=touched, schema=self._stored()).drop(BUCKET)
        upsert = merge.upsert_coalesce if rule == "coalesce" else merge.upsert_update
        return self.commit(upsert(current, delta, self.keys).withColumn(BUCKET, self.bucket()), replaces=touched, applied=applied)
