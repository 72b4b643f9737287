"""A table of bucketed files behind a manifest: snapshots, merges, and replacement by its own query.

A table is a folder. ``data/`` holds write-once Parquet folders, one per commit and bucket of
the key; ``manifests/`` holds one small JSON file per version that names the folders of every
bucket. A commit writes its data first and then puts the next manifest in place in one rename,
which fails if another writer has been there: readers see the version they opened, whole, and a
failure between the two steps leaves only data that no manifest names.

A merge rewrites the buckets that its rows fall into and no others, so a small batch on a large
table reads and writes a small share of it. A commit may carry the name and number of the batch
it comes from; the manifest keeps the last number of each name, and a replayed batch is skipped.

Only the manifest passes through the driver: one short entry per bucket and folder in it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from wardlight.session import file_system, list_folder, remove_path, settled

BUCKETS = 64
# A commit is tried so often when other writers come first.
ATTEMPTS = 5
_BUCKET = "__bucket"


class Conflict(RuntimeError):
    """Another writer has put the next version in place."""


@dataclass
class Manifest:
    """What one version consists of."""

    version: int
    key: str
    buckets: int
    schema: dict
    folders: dict[int, list[str]]
    batches: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({**self.__dict__, "folders": {str(b): f for b, f in self.folders.items()}})

    @staticmethod
    def of(text: str) -> "Manifest":
        values = json.loads(text)
        return Manifest(**{**values, "folders": {int(b): f for b, f in values["folders"].items()}})


class VersionedTable:
    """A keyed table at ``path`` on any storage that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- reading ---------------------------------------------------------

    @staticmethod
    def create(frame: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> "VersionedTable":
        """A new table with the rows of ``frame``; the key need not be unique before the first merge."""
        table = VersionedTable(frame.sparkSession, path)
        if table.versions():
            raise ValueError(f"{path} holds a table already")
        first = Manifest(0, key, buckets, json.loads(frame.schema.json()), {})
        table._publish(Manifest(0, key, buckets, first.schema, table._written(frame, first)))
        return table

    def versions(self) -> list[int]:
        return sorted(int(name[:-5]) for name in list_folder(self.spark, f"{self.path}/manifests")
                      if name.endswith(".json") and not name.startswith("."))

    def manifest(self, version: int | None = None) -> Manifest:
        known = self.versions()
        if not known:
            raise ValueError(f"no table at {self.path}")
        where, files = file_system(self.spark, self._manifest_path(known[-1] if version is None else version))
        stream = files.open(where)
        try:
            return Manifest.of(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """One version, the newest by default; of it only some buckets if they are named."""
        return self._rows(self.manifest(version), buckets)

    def bucket(self, key: Column, buckets: int | None = None) -> Column:
        """The bucket of a key. It depends on the key's value, not on its numeric width."""
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets or self.manifest().buckets)).cast("int")

    def buckets_of(self, rows: DataFrame, column: str | None = None) -> list[int]:
        """Buckets that rows fall into: at most as many numbers as the table has buckets."""
        found = self.manifest()
        where = self.bucket(F.col(column or found.key), found.buckets)
        return sorted(r[0] for r in rows.select(where).distinct().collect())

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """The newest rows of some keys: files of other buckets are not opened."""
        found = self.manifest()
        own = self._rows(found, self.buckets_of(keys, found.key))
        return own.join(keys.select(found.key).distinct(), found.key, "left_semi")

    # ---- writing ---------------------------------------------------------

    def merge(self, updates: DataFrame, matched: Mapping[str, Column] | None = None,
              inserted: Mapping[str, Column] | None = None, delete: Column | None = None,
              batch: tuple[str, int] | None = None) -> int:
        """Bring ``updates`` (one row per key) into the table; the version it gives.

        Columns of the stored row are ``old.<name>`` and of the update ``new.<name>`` in the
        expressions. A row of a known key becomes ``matched`` (columns not named: the update's
        if it has them, else the stored ones), or goes where ``delete`` holds; a row of a new key
        becomes ``inserted`` likewise, and columns that neither names are null. Null keys and
        repeated keys in ``updates`` are refused.
        """
        for _ in range(ATTEMPTS):
            base = self.manifest()
            if batch and base.batches.get(batch[0], -1) >= batch[1]:
                return base.version
            held = settled(updates, "merge")
            self._check_keys(held, base.key)
            touched = self.buckets_of(held)
            rows = self._merged(self._rows(base, touched), held, base, matched or {}, inserted or {}, delete)
            new = self._written(rows, base)
            folders = {**base.folders, **{b: new.get(b, []) for b in touched}}
            if self._committed(base, folders, base.schema, batch):
                return base.version + 1
        raise Conflict(f"{self.path}: other writers came first {ATTEMPTS} times")

    def append(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Add rows beside those that are there; nothing is rewritten."""
        for _ in range(ATTEMPTS):
            base = self.manifest()
            if batch and base.batches.get(batch[0], -1) >= batch[1]:
                return base.version
            new = self._written(rows.select(*(f["name"] for f in base.schema["fields"])), base)
            folders = {b: base.folders.get(b, []) + new.get(b, []) for b in {*base.folders, *new}}
            if self._committed(base, folders, base.schema, batch):
                return base.version + 1
        raise Conflict(f"{self.path}: other writers came first {ATTEMPTS} times")

    def replace(self, query: Callable[[DataFrame], DataFrame], batch: tuple[str, int] | None = None) -> int:
        """Replace the table by a query over itself, in one plan; columns may change, the key stays."""
        for _ in range(ATTEMPTS):
            base = self.manifest()
            if batch and base.batches.get(batch[0], -1) >= batch[1]:
                return base.version
            rows = query(self._rows(base, None))
            if base.key not in rows.columns:
                raise ValueError(f"the query drops the key {base.key}")
            if self._committed(base, self._written(rows, base), json.loads(rows.schema.json()), batch):
                return base.version + 1
        raise Conflict(f"{self.path}: other writers came first {ATTEMPTS} times")

    def compact(self, most_folders: int = 1) -> int:
        """Rewrite the buckets that are spread over more folders than this."""
        base = self.manifest()
        spread = [b for b, folders in base.folders.items() if len(folders) > most_folders]
        if not spread:
            return base.version
        new = self._written(self._rows(base, spread), base)
        if not self._committed(base, {**base.folders, **{b: new.get(b, []) for b in spread}}, base.schema, None):
            raise Conflict(f"{self.path}: changed while it was compacted")
        return base.version + 1

    def vacuum(self, keep: int = 2) -> int:
        """Remove all but the last ``keep`` versions and the data only they name; how many folders.

        Run it when no commit is under way: data that is not yet named looks like data left behind.
        """
        known = self.versions()
        for version in known[:-keep]:
            remove_path(self.spark, self._manifest_path(version))
        named = {f.split("/")[1] for v in known[-keep:] for some in self.manifest(v).folders.values() for f in some}
        loose = [n for n in list_folder(self.spark, f"{self.path}/data") if n not in named]
        return sum(remove_path(self.spark, f"{self.path}/data/{name}") for name in loose)

    # ---- steps -----------------------------------------------------------

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifests/{version:012d}.json"

    def _rows(self, found: Manifest, buckets: Iterable[int] | None) -> DataFrame:
        wanted = found.folders if buckets is None else [b for b in buckets if b in found.folders]
        folders = [f"{self.path}/{f}" for b in wanted for f in found.folders[b]]
        schema = StructType.fromJson(found.schema)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def _written(self, rows: DataFrame, base: Manifest) -> dict[int, list[str]]:
        """Write rows to a new folder; the folders of each bucket in it.

        Ranges of (bucket, row hash) spread a bucket that a hot key fills over several tasks.
        """
        name = f"data/{uuid.uuid4().hex}"
        spread = F.xxhash64(*(F.col(c) for c, kind in rows.dtypes if not kind.startswith("map")))
        (rows.withColumn(_BUCKET, self.bucket(F.col(base.key), base.buckets))
         .repartitionByRange(F.col(_BUCKET), spread)
         .write.partitionBy(_BUCKET).parquet(f"{self.path}/{name}"))
        found = [n for n in list_folder(self.spark, f"{self.path}/{name}") if n.startswith(f"{_BUCKET}=")]
        return {int(n.split("=")[1]): [f"{name}/{n}"] for n in found}

    def _check_keys(self, updates: DataFrame, key: str) -> None:
        wrong = updates.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()).limit(1)
        if not wrong.isEmpty():
            raise ValueError(f"updates repeat a {key} or leave it null")

    def _merged(self, stored: DataFrame, updates: DataFrame, base: Manifest, matched: Mapping[str, Column],
                inserted: Mapping[str, Column], delete: Column | None) -> DataFrame:
        key, names = base.key, [f["name"] for f in base.schema["fields"]]
        old = stored.select(F.col(key).alias("__key"), F.struct(*names).alias("old"))
        new = updates.select(F.col(key).alias("__key"), F.struct(*updates.columns).alias("new"))
        both = old.join(new, "__key", "full_outer")
        if delete is not None:
            gone = F.col("old").isNotNull() & F.col("new").isNotNull() & F.coalesce(delete, F.lit(False))
            both = both.where(~gone)

        def value(name: str, kind) -> Column:
            offered = F.col(f"new.{name}") if name in updates.columns else None
            kept = matched.get(name, offered if offered is not None else F.col(f"old.{name}"))
            begun = inserted.get(name, offered if offered is not None else F.lit(None))
            if name == key:
                return F.col("__key").cast(kind).alias(name)
            return (F.when(F.col("new").isNull(), F.col(f"old.{name}"))
                    .when(F.col("old").isNull(), begun).otherwise(kept).cast(kind).alias(name))

        return both.select(*(value(f.name, f.dataType) for f in stored.schema))

    def _committed(self, base: Manifest, folders: dict[int, list[str]], schema: dict,
                   batch: tuple[str, int] | None) -> bool:
        batches = {**base.batches, **({batch[0]: batch[1]} if batch else {})}
        try:
            self._publish(Manifest(base.version + 1, base.key, base.buckets, schema,
                                   {b: f for b, f in folders.items() if f}, batches))
        except Conflict:
            return False
        return True

    def _publish(self, manifest: Manifest) -> None:
        """Put a manifest in place in one step, or raise ``Conflict`` if its version is taken."""
        target = self._manifest_path(manifest.version)
        draft, files = file_system(self.spark, f"{self.path}/manifests/.{uuid.uuid4().hex}.draft")
        stream = files.create(draft)
        stream.write(bytearray(manifest.text().encode()))
        stream.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            draft.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(files.makeQualified(draft), files.makeQualified(
                jvm.org.apache.hadoop.fs.Path(target)), options)
        except Exception as error:
            files.delete(draft, False)
            if "AlreadyExists" in str(error):
                raise Conflict(target) from None
            raise
