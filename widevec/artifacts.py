"""Getting model files, tokenizer files and the package itself to the tasks.

A file of any size is staged under the digest of its content and registered with the Spark
context, so every executor fetches it once to disk and its Python workers open that one
copy. Bytes that the driver already holds travel as a broadcast and are refused over a limit.
"""

import hashlib
import os
import shutil
import uuid
from dataclasses import dataclass
from typing import Any

from pyspark import SparkFiles
from pyspark.sql import functions as F

from widevec.sources.scratch import scratch_path

BROADCAST_LIMIT = 32 * 1024 * 1024
# Files of a folder artifact.
FOLDER_FILES = 1000

_shipped = set()


@dataclass(frozen=True)
class Artifact:
    """A file's content as a task sees it. ``digest`` identifies the content."""

    digest: str
    payload: Any = None
    file_name: str = ""
    # Of a folder: the names in it and the distributed files behind them.
    parts: tuple = ()
    main: str = ""

    def content(self):
        """Bytes for a broadcast artifact, a local path for a distributed file, or for the main
        file of a folder, beside which the others lie."""
        if self.payload is not None:
            return self.payload.value
        if self.parts:
            return os.path.join(self._assembled(), self.main)
        return SparkFiles.get(self.file_name)

    def _assembled(self):
        """The folder on this machine: made under a name of this process, then renamed, so a
        worker sees all of it or none."""
        whole = os.path.join(SparkFiles.getRootDirectory(), f"widevec-folder-{self.digest}")
        if not os.path.isdir(whole):
            making = f"{whole}.{uuid.uuid4().hex}"
            for name, file_name in self.parts:
                place = os.path.join(making, name)
                os.makedirs(os.path.dirname(place), exist_ok=True)
                source = os.path.realpath(SparkFiles.get(file_name))
                try:
                    os.link(source, place)
                except OSError:
                    shutil.copyfile(source, place)
            try:
                os.rename(making, whole)
            except OSError:
                # Another worker of this machine was first.
                shutil.rmtree(making, ignore_errors=True)
        return whole

    def read(self):
        found = self.content()
        if isinstance(found, bytes):
            return found
        with open(found, "rb") as handle:
            return handle.read()


def ship_folder(spark, path, main=None):
    """Ship all files of the folder at ``path``, such as a model with weights beside its graph.

    Every file is an artifact of its own, of at most 2 GB, so files that two folders share
    travel once. The digest is that of the whole tree: names and contents. ``main`` is the
    file to open, by default the only ``.onnx`` file there is.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # A row per file of a model folder.
    listed = sorted(tuple(row) for row in files.select("path", F.sha2("content", 256)).take(FOLDER_FILES + 1))
    if not listed or len(listed) > FOLDER_FILES:
        raise ValueError(f"expected 1 to {FOLDER_FILES} files at {path}, found {len(listed)}")
    root = _status(spark, path).getPath().toUri().getPath().rstrip("/") + "/"
    parts = []
    for location, _ in listed:
        place = spark._jvm.org.apache.hadoop.fs.Path(location).toUri().getPath()
        parts.append((place.removeprefix(root), ship_file(spark, location)))
    graphs = [name for name, _ in parts if name == main or main is None and name.endswith(".onnx")]
    if len(graphs) != 1:
        raise ValueError(f"name the main file of {path}: {graphs or [name for name, _ in parts]}")
    tree = repr([(name, part.digest) for name, part in parts] + graphs)
    names = tuple((name, part.file_name) for name, part in parts)
    return Artifact(hashlib.sha256(tree.encode()).hexdigest(), parts=names, main=graphs[0])


def is_folder(spark, path):
    return _status(spark, path).isDirectory()


def _status(spark, path):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(found)


def ship_bytes(spark, content):
    if len(content) > BROADCAST_LIMIT:
        raise ValueError(
            f"{len(content)} bytes is over the broadcast limit {BROADCAST_LIMIT}: give a path instead"
        )
    return Artifact(hashlib.sha256(content).hexdigest(), spark.sparkContext.broadcast(content))


def ship_file(spark, path):
    """Ship the file at ``path``, on any file system Spark can read.

    One task reads its digest. A copy named after the digest is staged once in the shared
    folder (``spark.checkpoint.dir``), and every executor fetches that copy once to disk.
    Names and sizes decide nothing: files of one name, or one replaced in place, are
    artifacts of their own, and equal files are one.
    """
    context = spark.sparkContext
    files = spark.read.format("binaryFile").load(path)
    found = files.select("path", F.sha2("content", 256).alias("digest")).take(2)
    if len(found) != 1:
        raise ValueError(f"expected one file at {path}, found {len(found) or 'none'}")
    location, digest = found[0]["path"], found[0]["digest"]
    name = f"widevec-{digest}"
    if (context.applicationId, digest) not in _shipped:
        staged = scratch_path(spark, name)
        _copy(spark, location, staged)
        context.addFile(staged)
        _shipped.add((context.applicationId, digest))
    return Artifact(digest, file_name=name)


def _copy(spark, source, target):
    """From one file system to another, in pieces."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(name) for name in (source, target)]
    stores = [path.getFileSystem(conf) for path in paths]
    if not jvm.org.apache.hadoop.fs.FileUtil.copy(stores[0], paths[0], stores[1], paths[1], False, conf):
        raise OSError(f"could not copy {source} to {target}")


def ship_package(spark):
    """Make this package importable in the tasks of a session that was started without it.

    A cluster job installs the wheel or passes ``--py-files`` and has no need of this.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    name = f"widevec-{context.applicationId}.zip"
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(SparkFiles.getRootDirectory(), name)
    shutil.make_archive(archive[: -len(".zip")], "zip", os.path.dirname(here), os.path.basename(here))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
