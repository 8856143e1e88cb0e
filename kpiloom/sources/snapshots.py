"""A table of snapshots: deltas, a manifest per version, merge on read, compaction.

Every commit writes its rows to a folder of its own and then names it in a new
manifest.  The manifest's file appears under its name by one rename that fails if
the name is taken, so a reader sees the version before or the version after, and of two
writers one starts over.  A writer or an executor that is lost leaves files
that no manifest names.

A manifest lists entries ``(folder, seq, days)``.  A day that several entries hold is
merged when it is read: the latest entry wins for each key.  Compaction writes such days once and
takes them from the older entries.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions.timegrid import utc_date
from kpiloom.schema import KEY
from kpiloom.session import cut
from kpiloom.sources.tables import dated, first_per_key, rows_by_day

MOST_ENTRIES = 16  # entries of a day beyond which a commit compacts


@dataclass
class Manifest:
    version: int = 0
    entries: list[dict] = field(default_factory=list)  # {"folder", "seq", "days"}
    done: dict[str, int] = field(default_factory=dict)  # last batch of each stream

    def holders(self) -> dict[str, list[dict]]:
        """Entries of each day, oldest first."""
        out: dict[str, list[dict]] = {}
        for e in sorted(self.entries, key=lambda e: e["seq"]):
            for day in e["days"]:
                out.setdefault(day, []).append(e)
        return out


class SnapshotTable:
    """Rows with unique keys below ``path``; keys hold ``ts``, so a key lies in one day."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str] = KEY, most_entries: int = MOST_ENTRIES):
        self.spark, self.path, self.schema, self.keys, self.most_entries = spark, path.rstrip("/"), schema, list(keys), most_entries

    # -- manifests

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def versions(self) -> list[int]:
        files, folder = self._fs(f"{self.path}/_manifests")
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        if version is None:
            known = self.versions()
            if not known:
                return Manifest()
            version = known[-1]
        rows = self.spark.read.text(self._file(version), wholetext=True).collect()  # one small file
        return Manifest(**json.loads(rows[0]["value"]))

    def _file(self, version: int) -> str:
        return f"{self.path}/_manifests/v{version:09d}.json"

    def _publish(self, manifest: Manifest) -> bool:
        """Write the manifest under its version; False if another writer took that version."""
        draft = f"{self.path}/_manifests/.draft-{uuid.uuid4().hex}"
        files, target = self._fs(draft)
        out = files.create(target)
        try:
            out.write(bytearray(json.dumps(vars(manifest)).encode()))
        finally:
            out.close()
        jvm = self.spark._jvm
        none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = none
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(target, jvm.org.apache.hadoop.fs.Path(self._file(manifest.version)), options)
        except Exception as error:  # noqa: BLE001
            files.delete(target, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    # -- writing

    def _write(self, rows: DataFrame) -> dict:
        folder = f"data/{uuid.uuid4().hex}"
        rows_by_day(rows.select(*self.schema.fieldNames())).write.partitionBy("date").parquet(f"{self.path}/{folder}")
        stored = self.spark.read.schema(dated(self.schema)).parquet(f"{self.path}/{folder}")
        days = [str(r["date"]) for r in stored.select("date").distinct().collect()]  # the days of one batch
        return {"folder": folder, "seq": 0, "days": sorted(days)}

    def commit(self, rows: DataFrame, stream: str | None = None, batch: int | None = None) -> int:
        """Insert or replace rows by key; the version that holds them.

        A batch of a stream that was committed before is left out, so a replay changes nothing.
        """
        known = self.manifest()
        if stream is not None and known.done.get(stream, -1) >= batch:
            return known.version
        entry = self._write(first_per_key(rows, self.keys))
        while True:
            after = Manifest(known.version + 1, [*known.entries], dict(known.done))
            if entry["days"]:
                after.entries.append({**entry, "seq": after.version})
            if stream is not None:
                after.done[stream] = batch
            if self._publish(after):
                break
            known = self.manifest()
            if stream is not None and known.done.get(stream, -1) >= batch:
                return known.version
        if any(len(e) > self.most_entries for e in after.holders().values()):
            self.compact()
        return after.version

    def compact(self) -> int:
        """Write every day that several entries hold once; gives up if another writer was faster, as nothing is lost then."""
        known = self.manifest()
        days = sorted(day for day, held in known.holders().items() if len(held) > 1)
        if not days:
            return known.version
        merged = self._rows(known, days)
        entry = self._write(merged)
        gone = set(days)
        kept = [{**e, "days": [d for d in e["days"] if d not in gone]} for e in known.entries]
        newest = max(e["seq"] for e in known.entries)
        after = Manifest(known.version + 1, [*[e for e in kept if e["days"]], {**entry, "seq": newest}], known.done)
        return after.version if self._publish(after) else known.version

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete manifests but the last ``keep`` and the folders that none of these names; run it while no commit is under way."""
        versions = self.versions()
        named = {e["folder"] for v in versions[-keep:] for e in self.manifest(v).entries}
        for v in versions[:-keep]:
            files, target = self._fs(self._file(v))
            files.delete(target, False)
        files, folder = self._fs(f"{self.path}/data")
        gone = [s.getPath() for s in files.listStatus(folder) if f"data/{s.getPath().getName()}" not in named] if files.exists(folder) else []
        for target in gone:
            files.delete(target, True)
        return [t.getName() for t in gone]

    # -- reading

    def _entry(self, entry: dict, days: list[str]) -> DataFrame:
        rows = self.spark.read.schema(dated(self.schema)).parquet(f"{self.path}/{entry['folder']}")
        return rows.where(F.col("date").isin([F.lit(d).cast("date") for d in days]))

    def _rows(self, manifest: Manifest, days: list[str] | None = None) -> DataFrame:
        """Rows of a version, of all days or of some: days of one entry as they are, the others merged by key."""
        holders = {d: held for d, held in manifest.holders().items() if days is None or d in set(days)}
        alone: dict[str, list[str]] = {}
        shared: dict[str, list[str]] = {}
        for day, held in holders.items():
            for e in held:
                (alone if len(held) == 1 else shared).setdefault(e["folder"], []).append(day)
        by_folder = {e["folder"]: e for e in manifest.entries}
        names = self.schema.fieldNames()
        out = self.spark.createDataFrame([], self.schema)
        for folder, of in alone.items():
            out = out.union(self._entry(by_folder[folder], of).select(*names))
        parts = [self._entry(by_folder[f], of).withColumn("_seq", F.lit(by_folder[f]["seq"])) for f, of in shared.items()]
        if parts:
            both = parts[0]
            for p in parts[1:]:
                both = both.union(p)
            newest = Window.partitionBy("date", *self.keys).orderBy(F.col("_seq").desc())
            out = out.union(both.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").select(*names))
        return out

    def read(self, version: int | None = None, start=None, end=None) -> DataFrame:
        """The rows of a version, by default the latest, from ``start`` to ``end`` (days outside are not opened)."""
        manifest = self.manifest(version)
        days = None
        if start is not None or end is not None:
            low, high = str(start or "")[:10], str(end or "9999-12-31")[:10]
            days = [d for d in manifest.holders() if low <= d <= high]
        rows = self._rows(manifest, days)
        if start is not None:
            rows = rows.where(F.col("ts") >= F.lit(str(start)).cast("timestamp"))
        return rows if end is None else rows.where(F.col("ts") <= F.lit(str(end)).cast("timestamp"))

    def stream_into(self, stream: DataFrame, checkpoint: str, name: str = "ingest"):
        """Commit every micro-batch; file counts stay bounded by compaction, and a restart commits no batch twice."""
        return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(
            lambda batch, number: self.commit(cut(batch), name, number) and None
        )
