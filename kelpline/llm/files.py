"""Files written and read by tasks, in a folder all executors share."""

from __future__ import annotations

import os

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it: a mounted path or a URI that Arrow knows."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    for hadoop, arrow in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if uri.startswith(hadoop):
            uri = arrow + uri[len(hadoop) :]
    return fs.FileSystem.from_uri(uri)


class NewFile:
    """A file that gets its name when it is complete.

    Every attempt of a task writes a file of its own; the name holds the attempt, so a second
    attempt never touches what a first one left.
    """

    def __init__(self, system: fs.FileSystem, folder: str, name: str):
        self.system, self.path = system, f"{folder}/{name}"
        self.part = f"{self.path}.part"
        system.create_dir(folder, recursive=True)
        self.stream = system.open_output_stream(self.part)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        if isinstance(self.system, fs.LocalFileSystem):
            os.replace(self.part, self.path)
        else:
            self.system.move(self.part, self.path)
