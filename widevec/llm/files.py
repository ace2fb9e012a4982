"""Files of a shared store as tasks write and read them.

Paths are those that Spark uses (``file:``, ``hdfs:``, ``s3a:``, or no scheme). A file is
written under a temporary name of its own attempt and renamed when complete, so a task that
runs twice leaves one whole file, with the same content, under the final name.
"""

import contextlib
import os
import uuid

import pyarrow as pa
from pyarrow import fs


def located(path):
    """The file system of a path and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(path)
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1))


@contextlib.contextmanager
def committed(path):
    """A stream to a file that appears under ``path`` only when all of it is written."""
    system, place = located(path)
    temporary = f"{place}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(temporary) as stream:
        yield stream
    system.move(temporary, place)


def make_folder(path):
    system, place = located(path)
    system.create_dir(place, recursive=True)


def opened(path):
    """A file to read at random: mapped into memory where it is on a disk of this machine."""
    system, place = located(path)
    if isinstance(system, fs.LocalFileSystem):
        return pa.memory_map(place)
    return system.open_input_file(place)


def read_all(path):
    with opened(path) as source:
        return source.read()
