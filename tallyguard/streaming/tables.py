"""Tables that a stream extends batch by batch, with a log that says which batches count.

A batch owns one folder per table, ``<name>/batch_id=<n>``, and overwrites it, so a batch
that is repeated after a failure leaves one copy. It counts once its folder in ``commits``
exists, which is written last. Compaction folds the committed batches of every table into
one folder, which counts from the moment its entry in ``compactions`` exists; readers take
the newest compaction and the committed batches behind it. The owner removes what no
reader needs any more.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

BATCH = "batch_id"


@dataclass(frozen=True)
class TableSpec:
    """Columns of a table. With ``keys``, a row replaces the one of an earlier batch with the same keys.

    A ``whole`` table is given anew by every batch, and replaces what the one before gave.
    """

    schema: StructType
    keys: tuple[str, ...] = ()
    whole: bool = False


class BatchTables:
    def __init__(self, spark: SparkSession, base: str, specs: Mapping[str, TableSpec]):
        self.spark, self.base, self.specs = spark, base.rstrip("/"), dict(specs)

    # --- writing ---------------------------------------------------------

    def write(self, batch_id: int, rows: Mapping[str, DataFrame], n_records: int | None = None) -> None:
        """All tables of one batch, and then its commit."""
        for name, frame in rows.items():
            self.put(name, batch_id, frame)
        self.commit(batch_id, n_records)

    def put(self, name: str, batch_id: int, rows: DataFrame) -> DataFrame:
        """One table of a batch; gives back what was written, so that it is computed once."""
        schema, folder = self.specs[name].schema, self._folder(name, batch_id)
        rows.select(*schema.fieldNames()).write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(schema).parquet(folder)

    def commit(self, batch_id: int, n_records: int | None = None) -> None:
        note = self.spark.range(1).select(F.lit(n_records).cast("long").alias("n_records"))
        note.write.mode("overwrite").parquet(f"{self.base}/commits/{BATCH}={batch_id}")

    def compact(self) -> int | None:
        """Fold all committed batches into one folder per table; the last batch in it, None if there is none.

        A compaction that fails half-way counts for nothing and is written again by the next one.
        """
        upto, since = self._state()
        if not since:
            return upto
        last = max(since)
        for name in self.specs:
            self.read(name).write.mode("overwrite").parquet(f"{self.base}/{name}-compacted/upto={last}")
        note = self.spark.range(1).select(F.lit(len(since)).cast("long").alias("n_batches"))
        note.write.mode("overwrite").parquet(f"{self.base}/compactions/upto={last}")
        return last

    def remove_folded(self) -> int:
        """Delete the folders that the newest compaction replaces; only when no reader uses older state.

        Commits go last, so an interrupted removal goes on the next time.
        """
        upto = self._newest("compactions", "upto")
        if upto is None:
            return 0
        old = [n for n in self._entries("commits", BATCH) if n <= upto]
        stale = [n for n in self._entries("compactions", "upto") if n < upto]
        paths = [self._folder(name, n) for n in old for name in self.specs]
        paths += [f"{self.base}/{name}-compacted/upto={n}" for n in stale for name in self.specs]
        paths += [f"{self.base}/compactions/upto={n}" for n in stale]
        paths += [f"{self.base}/commits/{BATCH}={n}" for n in old]
        return sum(self._delete(path) for path in paths)

    # --- reading ---------------------------------------------------------

    def read(self, name: str, before: int | None = None) -> DataFrame:
        """The committed rows with their ``batch_id``; with keys, the newest row of each.

        ``before`` leaves out that batch and later ones: what a batch finds, also when it is repeated.
        """
        spec = self.specs[name]
        upto, since = self._state()
        if before is not None:
            since = [n for n in since if n < before]
        if spec.whole and since:
            upto, since = None, since[-1:]
        schema = StructType([*spec.schema.fields]).add(BATCH, LongType())
        parts = []
        if upto is not None:
            parts.append(self.spark.read.schema(schema).parquet(f"{self.base}/{name}-compacted/upto={upto}"))
        if since:
            # As many folders as there were batches since the last compaction.
            folders = [self._folder(name, n) for n in since]
            found = self.spark.read.schema(schema).option("basePath", f"{self.base}/{name}").parquet(*folders)
            parts.append(found.select(*schema.fieldNames()))
        if not parts:
            # Known to be empty when it is planned, so that joins with it fall away.
            nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
            return self.spark.range(1).where(F.lit(False)).select(*nulls)
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        if before is not None:
            rows = rows.where(F.col(BATCH) < before)
        if not spec.keys:
            return rows
        whole = F.struct(*schema.fieldNames())
        newest = rows.groupBy(*spec.keys).agg(F.max_by(whole, F.col(BATCH)).alias("newest"))
        return newest.select("newest.*")

    def committed(self) -> list[int]:
        """Batches behind the newest compaction."""
        return self._state()[1]

    # --- the log ---------------------------------------------------------

    def _folder(self, name: str, batch_id: int) -> str:
        return f"{self.base}/{name}/{BATCH}={batch_id}"

    def _state(self) -> tuple[int | None, list[int]]:
        upto = self._newest("compactions", "upto")
        found = self._entries("commits", BATCH)
        return upto, sorted(n for n in found if upto is None or n > upto)

    def _newest(self, log: str, column: str) -> int | None:
        return max(self._entries(log, column), default=None)

    def _entries(self, log: str, column: str) -> Iterable[int]:
        """Numbers in a log: one for each batch or compaction that was not removed yet."""
        try:
            rows = self.spark.read.parquet(f"{self.base}/{log}")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return []
        return [row[0] for row in rows.select(F.col(column).cast("long")).distinct().collect()]

    def _delete(self, path: str) -> bool:
        """Through the file system that the path names, local or not."""
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        system = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return bool(system.delete(target, True))
