"""Keyed tables in versions, written by streams exactly once.

A table is kept in hash buckets of its key as Parquet. A commit rewrites only the
buckets its changes touch and then creates the next manifest, which names every
bucket's files and, for each streaming query, the last batch that is in them. The
manifest is one file made whole or not at all, so the tables of a commit and the
ledger change together; a batch that is replayed after a crash is recognised by its
query and number and skipped. The ledger has one entry a query, however many batches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


class Conflict(RuntimeError):
    """Another writer has made the next version meanwhile."""


class Store:
    """folder: any path Hadoop's file systems can reach from all executors.

    buckets: how many a table starts with. When its files hold more than ``bucket_bytes`` a bucket, the commit
    that finds it so writes all of it in twice as many, or as often twice as it takes; each
    table's own number is in the manifest.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64, keep_versions: int = 10, bucket_bytes: int = 128 << 20):
        self.spark, self.folder, self.buckets, self.keep, self.bucket_bytes = spark, folder.rstrip("/"), buckets, keep_versions, bucket_bytes
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    # Manifests.

    def _versions(self) -> list[int]:
        at = self._fs_path(f"{self.folder}/manifests")
        if not self._fs.exists(at):
            return []
        return sorted(int(n.split(".")[0]) for f in self._fs.listStatus(at) if (n := f.getPath().getName()).endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        versions = self._versions()
        if not versions:
            return {"version": 0, "tables": {}, "ledger": {}}
        stream = self._fs.open(self._fs_path(f"{self.folder}/manifests/{version or versions[-1]}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        """Writes the manifest aside and renames it to its number, which fails if that exists."""
        end = self._fs_path(f"{self.folder}/manifests/{manifest['version']}.json")
        aside = self._fs_path(f"{self.folder}/manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(manifest), "utf-8"))
        out.close()
        if self._fs.exists(end) or not self._fs.rename(aside, end):
            self._fs.delete(aside, False)
            raise Conflict(f"version {manifest['version']} exists")

    # Tables.

    def seen(self, query: str, batch: int) -> bool:
        """Whether the batch is in the tables already. A query's batches come in order, so its last one tells."""
        return self.manifest()["ledger"].get(query, -1) >= batch

    def read(self, name: str, buckets: Sequence[int] | None = None, version: int | None = None) -> DataFrame | None:
        """The table, or only some of its buckets; None if it was never written."""
        table = self.manifest(version)["tables"].get(name)
        if table is None:
            return None
        schema = T.StructType.fromJson(table["schema"])
        paths = [p for b, p in table["paths"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def buckets_of(self, name: str, manifest: dict | None = None) -> int:
        """How many buckets the table has now; as many as it will start with, if it isn't there."""
        return ((manifest or self.manifest())["tables"].get(name) or {}).get("buckets", self.buckets)

    def bucket(self, key: Sequence[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(buckets).cast("bigint")).cast("int")

    def commit(self, query: str, batch: int, merges: dict[str, tuple[DataFrame, Sequence[str], Callable[[DataFrame, DataFrame], DataFrame] | None]]) -> bool:
        """Merges changes into tables, all in one version; False if the batch is in them already.

        merges: for each table its changes, key, and the merge of (table, changes), or None
        if the changes are the whole new table. The changes of a table not yet
        there are merged into an empty one of their columns.
        """
        base = self.manifest()
        if base["ledger"].get(query, -1) >= batch:
            return False
        tables = dict(base["tables"])
        for name, (changes, key, merge) in merges.items():
            now = self.buckets_of(name, base)
            # At most `now` numbers.
            touched = [r.b for r in changes.select(self.bucket(key, now).alias("b")).distinct().collect()]
            if merge is None:
                tables.pop(name, None)
                merge = lambda old, new: new
            elif not touched:
                continue
            before, buckets = tables.get(name), now
            while before and sum(before["bytes"].values()) > buckets * self.bucket_bytes:
                buckets *= 2
            old = self.read(name, touched if buckets == now else None, base["version"] or None)
            if old is None:
                old = self.spark.createDataFrame([], changes.schema)
            new = merge(old, changes)
            at = f"{self.folder}/data/{name}/{base['version'] + 1}-{uuid.uuid4().hex}"
            parts = max(1, len(touched) if buckets == now else buckets)
            new.withColumn("__bucket", self.bucket(key, buckets)).repartition(parts, "__bucket").write.partitionBy("__bucket").parquet(at)
            written = {f.getPath().getName().split("=")[1]: f.getPath() for f in self._fs.listStatus(self._fs_path(at)) if "=" in f.getPath().getName()}
            kept = {} if before is None or buckets != now else {b: p for b, p in before["paths"].items() if int(b) not in touched}
            tables[name] = {
                "schema": json.loads(new.schema.json()), "buckets": buckets, "paths": kept | {b: p.toString() for b, p in written.items()},
                "bytes": {b: before["bytes"][b] for b in kept} | {b: self._fs.getContentSummary(p).getLength() for b, p in written.items()},
            }
        self._publish({"version": base["version"] + 1, "tables": tables, "ledger": base["ledger"] | {query: batch}})
        self._forget()
        return True

    def _forget(self) -> None:
        """Deletes manifests beyond the last few, and folders no kept manifest names."""
        versions = self._versions()
        old, kept = versions[: -self.keep], versions[-self.keep :]
        if not old:
            return
        needed = {p.rsplit("/", 1)[0] for v in kept for t in self.manifest(v)["tables"].values() for p in t["paths"].values()}
        for v in old:
            for t in self.manifest(v)["tables"].values():
                for folder in {p.rsplit("/", 1)[0] for p in t["paths"].values()} - needed:
                    self._fs.delete(self._fs_path(folder), True)
            self._fs.delete(self._fs_path(f"{self.folder}/manifests/{v}.json"), False)
