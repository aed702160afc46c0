"""A user-defined streaming source written with the Python Data Source API:
new text files in a folder, read line by line by executor tasks.

Which files were handed out is kept in a log, not derived from times or
names: each batch of newly seen files is one entry, a numbered list of names, written
whole under ``_seen`` in the folder (or under the option ``log``), and the offset is the
number of the last entry.  So a file that lands late, or keeps an older modification time
because it was renamed into place, is read once like any other, and a restarted
query finds the same files behind the same offsets.  The log belongs to one query.

A file counts from when it is listed, so files should land whole (written
elsewhere or under a name beginning with "." or "_", then renamed).  Each new file becomes one input partition, read where
the task runs; the driver only lists file names.
"""

from __future__ import annotations

import io
import json
import os

import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


class _FilePartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _fs(uri: str):
    """(filesystem, path) for a local path or a URI (file://, hdfs://, s3://)."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    return pafs.FileSystem.from_uri(uri)


class LineFilesStreamReader(DataSourceStreamReader):
    def __init__(self, folder: str, log: str | None = None):
        self.folder, self.log = folder, log or os.path.join(folder, "_seen")
        self.entry, self.seen = 0, set()            # entries read so far, and the names in them

    def _listed(self) -> list[str]:
        fs, root = _fs(self.folder)
        infos = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        return sorted(i.base_name for i in infos
                      if i.type == pafs.FileType.File and not i.base_name.startswith((".", "_")))

    def _path(self, entry: int) -> str:
        return f"{_fs(self.log)[1]}/{entry:012d}.json"

    def _names(self, entry: int) -> list[str] | None:
        """Names of an entry, None if it was never written."""
        fs, path = _fs(self.log)[0], self._path(entry)
        if fs.get_file_info(path).type != pafs.FileType.File:
            return None
        with fs.open_input_stream(path) as f:
            return json.loads(f.read())

    def _catch_up(self) -> None:
        """Read the entries written since the last call (all of them after a restart)."""
        while (names := self._names(self.entry + 1)) is not None:
            self.seen.update(names)
            self.entry += 1

    def _append(self, names: list[str]) -> None:
        """Write the next entry whole: under another name first, then renamed."""
        fs, root = _fs(self.log)
        fs.create_dir(root, recursive=True)
        path = self._path(self.entry + 1)
        with fs.open_output_stream(f"{path}.tmp") as f:
            f.write(json.dumps(names).encode())
        fs.move(f"{path}.tmp", path)
        self.seen.update(names)
        self.entry += 1

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        self._catch_up()
        new = [n for n in self._listed() if n not in self.seen]
        if new:
            self._append(new)
        return {"entry": self.entry}

    def partitions(self, start: dict, end: dict):
        return [_FilePartition(os.path.join(self.folder, n))
                for e in range(start["entry"] + 1, end["entry"] + 1) for n in self._names(e) or []]

    def read(self, partition: _FilePartition):
        fs, path = _fs(partition.path)
        with fs.open_input_stream(path) as raw, io.TextIOWrapper(io.BufferedReader(raw, 1 << 20), "utf-8",
                                                                 newline="\n") as lines:
            for line in lines:               # never more than a buffer in memory
                yield (line.removesuffix("\n"),)

    def commit(self, end: dict) -> None:
        pass


class LineFilesSource(DataSource):
    """``spark.readStream.format("linefiles").option("path", folder).load()``"""

    @classmethod
    def name(cls) -> str:
        return "linefiles"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema):
        return LineFilesStreamReader(self.options["path"], self.options.get("log"))
