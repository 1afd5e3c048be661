"""Binary files in the shared folder, written and read by tasks."""

from __future__ import annotations

from uuid import uuid4

from pyarrow import fs


#: Schemes of Hadoop's connectors, and what the store is called here.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "wasb": "abfs", "wasbs": "abfss"}


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of ``uri``, on whatever store its scheme names."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:")
    scheme, mark, rest = uri.partition("://")
    return fs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + mark + rest) if mark else (fs.LocalFileSystem(), uri)


class Replacing:
    """A file that appears under its name when it is complete: a task that is lost or runs
    twice leaves no half-written file under that name."""

    def __init__(self, uri: str) -> None:
        self.fs, self.path = locate(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.draft = f"{self.path}.{uuid4().hex}.tmp"

    def __enter__(self):
        self.out = self.fs.open_output_stream(self.draft, compression=None)
        return self.out

    def __exit__(self, kind, value, trace) -> None:
        self.out.close()
        if kind is None:
            self.fs.move(self.draft, self.path)
        else:
            self.fs.delete_file(self.draft)
