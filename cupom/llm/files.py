"""Files that tasks write and read themselves, on any store that Arrow's file systems reach."""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file given as URI or plain path."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


class Publisher:
    """Writes a file under a name of its own and moves it into place when it is whole.

    Every attempt of a task uses another name, so a lost or repeated task leaves at worst a file
    that no manifest lists.
    """

    def __init__(self, folder: str, stem: str, suffix: str):
        self.fs, base = open_store(folder)
        self.fs.create_dir(base, recursive=True)
        name = f"{stem}-{uuid.uuid4().hex}{suffix}"
        self.uri, self._final, self._partial = f"{folder.rstrip('/')}/{name}", f"{base}/{name}", f"{base}/_{name}.partial"
        self._out = self.fs.open_output_stream(self._partial, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def publish(self) -> str:
        self._out.close()
        self.fs.move(self._partial, self._final)
        return self.uri
