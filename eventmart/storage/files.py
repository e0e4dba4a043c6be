"""File-system calls through the Hadoop client Spark already uses; metadata only, never contents."""


class Files:
    """The file system of one path."""

    def __init__(self, spark, root):
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path):
        return self._fs.exists(self._path(path))

    def list(self, path):
        """(name, length) of each visible child; names starting with `_` or `.` are hidden."""
        if not self.exists(path):
            return []
        found = [(s.getPath().getName(), s.getLen()) for s in self._fs.listStatus(self._path(path))]
        return sorted((n, size) for n, size in found if not n.startswith(("_", ".")))

    def size(self, path):
        """Bytes of all files below a folder."""
        return self._fs.getContentSummary(self._path(path)).getLength()

    def delete(self, path):
        self._fs.delete(self._path(path), True)

    def delete_on_exit(self, path):
        """Delete a folder when the driver's JVM ends."""
        self._fs.deleteOnExit(self._path(path))

    def mkdirs(self, path):
        self._fs.mkdirs(self._path(path))

    def rename(self, source, target):
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def write_text(self, path, text, overwrite=True):
        """Write a small file; without `overwrite`, an error where it exists."""
        out = self._fs.create(self._path(path), overwrite)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def read_text(self, path):
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


KEPT_VERSIONS = 100  # a replay is of an owner's last batch, so older ones need not be known


def version_of(files, path, owner, batch_id):
    """A number for a batch of a table, in order of arrival; a replay gives the number it had.

    An owner is a streaming query's stable id, so that a new checkpoint, which counts its batches from 0
    again, cannot touch what an older one has stored. A number is taken by creating its file.
    """
    folder, text = f"{path}/versions", f"{owner} {batch_id}"
    while True:
        taken = sorted((int(name) for name, _ in files.list(folder)), reverse=True)
        for version in taken:
            if files.read_text(f"{folder}/{version}") == text:
                return version
        version = taken[0] + 1 if taken else 0
        try:
            files.write_text(f"{folder}/{version}", text, overwrite=False)
        except Exception:
            if not files.exists(f"{folder}/{version}"):
                raise
            continue  # another owner took it
        for old in taken[KEPT_VERSIONS:]:
            files.delete(f"{folder}/{old}")
        return version
