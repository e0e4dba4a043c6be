"""Keyed tables on plain files: every batch is a version, readers see the last version of a key.

A batch is one folder, `runs/version=N`, N from `files.version_of`: a replayed batch replaces its own folder and nothing
else, and a batch of a new owner comes after all before. A compaction writes the last versions of all keys
once, to `whole/version=N`, which stands for every batch up to N.
"""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.storage.descriptor import describe
from eventmart.storage.files import Files, version_of

FIXED_WIDTH = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType, T.BooleanType)


def latest_per_key(rows, key, order, one_row_per_order=False):
    """The last row per key by the `order` columns; equal order is settled by the other columns.

    An aggregate rather than a window: copies of a hot key shrink to one row per task before the
    shuffle. `one_row_per_order` promises that no two rows of a key tie, which allows a hash
    aggregate over fixed-width columns.
    """
    payload = [f for f in rows.schema if f.name not in key and f.name not in order]
    if one_row_per_order and len(order) == 1 and all(isinstance(f.dataType, FIXED_WIDTH) for f in payload):
        last = [F.max_by(f.name, order[0]).alias(f.name) for f in payload]
        return rows.groupBy(*key).agg(*last, F.max(order[0]).alias(order[0])).select(*rows.columns)
    ranked = F.struct(*order, *[f.name for f in payload])
    last = rows.groupBy(*key).agg(F.max(ranked).alias("_last"))
    return last.select(*[F.col(c) if c in key else F.col(f"_last.{c}").alias(c) for c in rows.columns])


class KeyedTable:
    """Upsert by key. `order` names columns that rank rows of one batch (for example an offset)."""

    def __init__(self, spark, path, schema, key, order=(), one_row_per_batch=False):
        self.spark, self.path, self.key = spark, path.rstrip("/"), list(key)
        self.schema, self.order = schema, list(order)
        self.one_row_per_batch = one_row_per_batch
        self._files = Files(spark, path)

    def _folder(self, kind, version):
        return f"{self.path}/{kind}/version={version}"

    def _finished(self, kind):
        """Versions of the finished folders of a kind."""
        found = [int(name.split("=")[1]) for name, _ in self._files.list(f"{self.path}/{kind}")]
        return sorted(v for v in found if self._files.exists(f"{self._folder(kind, v)}/_SUCCESS"))

    def versions(self):
        """(version that stands for all up to it, or None; the versions after it)."""
        whole = max(self._finished("whole"), default=None)
        return whole, [v for v in self._finished("runs") if whole is None or v > whole]

    def _save(self, rows, folder):
        # readers tell a finished folder by its marker, so it is asked for whatever the cluster's default
        marked = rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        marked.mode("overwrite").parquet(folder)

    def write(self, rows, batch_id, owner="batch"):
        """Store a batch. The same batch of the same owner replaces what it stored. A key without a value
        is an error, and so is a replay of a batch that has been compacted.
        """
        version = version_of(self._files, self.path, owner, batch_id)
        if version <= max(self._finished("whole"), default=-1):
            raise ValueError(f"batch {batch_id} of {owner} is already folded into {self.path}")
        describe(self._files, self.path, kind="keyed", schema=self.schema.jsonValue(), key=self.key, order=self.order,
                 one_row_per_batch=self.one_row_per_batch)
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.key])
        no_value = F.raise_error(F.lit(f"null in key {self.key}")).cast("boolean")
        checked = rows.select(*self.schema.names).where(F.when(complete, F.lit(True)).otherwise(no_value))
        self._save(checked.hint("rebalance"), self._folder("runs", version))

    def rows(self, whole, runs):
        """Every stored row of these versions, with its `version`."""
        schema = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        parts = [("whole", [whole] if whole is not None else []), ("runs", runs)]
        frames = [self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(*[self._folder(kind, v) for v in versions])
                  for kind, versions in parts if versions]
        return reduce(lambda a, b: a.unionByName(b), frames) if frames else self.spark.createDataFrame([], schema)

    def _last(self, whole, runs):
        unique = self.one_row_per_batch and not self.order
        return latest_per_key(self.rows(whole, runs), self.key, ["version", *self.order], unique).select(*self.schema.names)

    def latest(self):
        """The last version of every key."""
        whole, runs = self.versions()
        return self._last(whole, runs) if runs or whole is None else self.rows(whole, []).select(*self.schema.names)

    def compact_finished(self):
        """`compact` without the newest batch, which may still be replayed; for a job beside the stream."""
        _, runs = self.versions()
        if len(runs) > 1:
            self.compact(runs[-2])

    def compact(self, upto=None):
        """Write the last versions of all keys up to a version (default: all) as one.

        The result is range-partitioned by the key, so that a file holds a narrow range of keys and a hot key prefix
        spreads over files. What the compaction before replaced is removed now, so readers that started earlier keep
        their files.
        """
        whole, runs = self.versions()
        for kind, version in [*(("whole", v) for v in self._finished("whole")), *(("runs", v) for v in self._finished("runs"))]:
            if whole is not None and (version < whole or kind == "runs" and version == whole):
                self._files.delete(self._folder(kind, version))
        taken = [v for v in runs if upto is None or v <= upto]
        if taken:
            last = self._last(whole, taken).repartitionByRange(*self.key).sortWithinPartitions(*self.key)
            self._save(last, self._folder("whole", taken[-1]))
