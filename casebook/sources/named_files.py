"""Text files under names that the rows give: a data source to write to.

    spark.dataSource.register(NamedFiles)
    rows.write.format("named_files").mode("overwrite").option("path", folder).save()

Rows have ``file``, a name or relative path, and ``value``, its text. A task writes its
files into a folder of its own attempt; when all tasks are done, the files of those that
succeeded are moved to their names, and with overwrite files of earlier runs whose names
are not among them go. A run that fails leaves the files of the run before. Names must be
distinct; the last of two equal ones would stay.

Files reach the store through pyarrow's file systems, which know local paths, HDFS, S3
and Google Cloud Storage by their URI.
"""

from __future__ import annotations

import posixpath
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from casebook import session

STAGING = "_staging"


def _store(path: str):
    """(file system, path on it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    folder: str
    names: list[str]


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.staging = f"{STAGING}-{uuid.uuid4().hex}"

    def write(self, iterator) -> Written:
        store, root = _store(self.path)
        folder, names = f"{root}/{self.staging}/{uuid.uuid4().hex}", []
        for row in iterator:
            target = f"{folder}/{row['file']}"
            store.create_dir(posixpath.dirname(target))
            with store.open_output_stream(target) as out:
                out.write(row["value"].encode())
            names.append(row["file"])
        return Written(folder, names)

    def commit(self, messages) -> None:
        from pyarrow import fs

        store, root = _store(self.path)
        done = [m for m in messages if m is not None]
        for message in done:
            for name in message.names:
                store.create_dir(posixpath.dirname(f"{root}/{name}"))
                store.move(f"{message.folder}/{name}", f"{root}/{name}")
        if self.overwrite:
            new = {f"{root}/{name}" for message in done for name in message.names}
            for old in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
                if old.is_file and old.path not in new and f"/{self.staging}/" not in old.path:
                    store.delete_file(old.path)
        self.abort(messages)

    def abort(self, messages) -> None:
        from pyarrow import fs

        store, root = _store(self.path)
        folder = f"{root}/{self.staging}"
        if store.get_file_info([folder])[0].type != fs.FileType.NotFound:
            store.delete_dir(folder)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "file string, value string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return NamedFilesWriter(self.options["path"], overwrite)


def write(files: DataFrame, path: str) -> None:
    """Replace the files below path by those of (file, value)."""
    spark = files.sparkSession
    session.workers_import(spark)
    spark.dataSource.register(NamedFiles)
    files.select("file", "value").write.format("named_files").mode("overwrite").option("path", path).save()
