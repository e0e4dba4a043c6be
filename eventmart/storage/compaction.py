"""Parquet sink for micro-batches that publishes only files of a minimum size."""

from eventmart.storage.descriptor import describe
from eventmart.storage.files import Files, version_of


class CompactingTable:
    """`table/` holds published files, `pending/v=N` the rows that still wait after batch N, `done/v=N` says that N counts.

    A batch is written once, in parallel, and its files of the minimum size are published as they are. The others are
    joined with what was pending, which is less than a file for each of a batch's tasks, and what then is large enough
    is published too; `flush` publishes the rest. Readers here take published files up to the last batch that is
    done, and its pending rows, so they see every row once while a batch is under way. A reader of `table/` itself may
    meet a part of the batch under way. Batches are numbered by owner and number (`files.version_of`), and their files carry
    the number, so a batch that runs again first takes back what it left.
    """

    def __init__(self, spark, path, schema, min_size, target_size=None):
        self.spark, self.path, self.schema, self.min_size = spark, path.rstrip("/"), schema, min_size
        self.target_size = max(target_size or 0, min_size * 3 // 2, 1)
        self.table = f"{self.path}/table"
        self._files = Files(spark, path)

    def _versions(self):
        return sorted(int(name.split("=")[1]) for name, _ in self._files.list(f"{self.path}/done"))

    def last_version(self):
        return max(self._versions(), default=None)

    def _sized(self, folder):
        return [(f"{folder}/{name}", size) for name, size in self._files.list(folder)]

    def _published(self, version):
        return [f"{self.table}/{n}" for n, _ in self._files.list(self.table) if int(n.split("-")[1]) == version]

    def _pending(self, version):
        return f"{self.path}/pending/v={version}"

    def _read(self, paths):
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def add(self, rows, batch_id, owner="batch"):
        """Take in a batch. Running a batch of an owner again gives the same rows."""
        self._take(rows, version_of(self._files, self.path, owner, batch_id))

    def flush(self):
        """Publish all that is pending, whatever its size: for the end of a run, or a reader that waits."""
        last = self.last_version()
        if last is not None and self._sized(self._pending(last)):
            self._take(None, version_of(self._files, self.path, "flush", last), everything=True)

    def _take(self, rows, version, everything=False):
        for path in (f"{self.path}/done/v={version}", self._pending(version), *self._published(version)):
            self._files.delete(path)
        self._files.mkdirs(self.table)
        describe(self._files, self.path, kind="files", schema=self.schema.jsonValue(), min_size=self.min_size)
        before = [v for v in self._versions() if v < version]
        arrived = f"{self.path}/scratch/v={version}"
        if rows is not None:
            rows.select(*self.schema.names).write.mode("overwrite").parquet(arrived)
        found = self._sized(arrived)
        small = [f for f in found if f[1] < self.min_size] + (self._sized(self._pending(before[-1])) if before else [])
        if small:
            parts = max(1, sum(size for _, size in small) // self.target_size)
            self._read([p for p, _ in small]).coalesce(parts).write.mode("overwrite").parquet(self._pending(version))
        ready = [p for p, size in found if size >= self.min_size]
        ready += [p for p, size in self._sized(self._pending(version)) if everything or size >= self.min_size]
        for i, path in enumerate(ready):
            self._files.rename(path, f"{self.table}/part-{version}-{i}.parquet")
        self._files.mkdirs(f"{self.path}/done/v={version}")
        self._files.delete(arrived)
        for old in before[:-1]:  # the batch before is kept, from which this one could run again
            self._files.delete(self._pending(old))
            self._files.delete(f"{self.path}/done/v={old}")

    def published(self):
        """Rows of the published files."""
        last = self.last_version()
        names = [] if last is None else [n for n, _ in self._files.list(self.table) if int(n.split("-")[1]) <= last]
        return self._read([f"{self.table}/{name}" for name in names])

    def pending(self):
        """Rows still waiting after the last batch."""
        last = self.last_version()
        return self._read([] if last is None else [p for p, _ in self._sized(self._pending(last))])

    def rows(self):
        """Everything taken in so far: published and pending."""
        return self.published().unionByName(self.pending())
