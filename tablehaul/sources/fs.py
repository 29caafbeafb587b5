"""Small helpers over the Hadoop FileSystem of a path (works for file:, hdfs:, s3a:)."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Name of the file ``write_note`` leaves in a folder; the underscore hides it from readers.
NOTE = "_tablehaul.json"
# Files that are renamed side by side.
RENAME_THREADS = 32


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs_and_path(spark, path)
    return bool(fs.exists(jpath))


def committed(spark: SparkSession, path: str) -> bool:
    """True when a Spark write to ``path`` finished (its ``_SUCCESS`` marker exists)."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def is_file(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs_and_path(spark, path)
    return bool(fs.exists(jpath)) and not fs.getFileStatus(jpath).isDirectory()


def complete(spark: SparkSession, path: str) -> bool:
    """True for a plain file, or a folder whose Spark write finished."""
    return is_file(spark, path) or committed(spark, path)


def write_note(spark: SparkSession, folder: str, note: dict) -> None:
    """Record how a written folder was made, in a file that Spark's readers pass over."""
    fs, jpath = _fs_and_path(spark, folder.rstrip("/") + "/" + NOTE)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(json.dumps(note, sort_keys=True).encode()))
    finally:
        out.close()


def read_note(spark: SparkSession, folder: str) -> dict | None:
    path = folder.rstrip("/") + "/" + NOTE
    if not path_exists(spark, path):
        return None
    fs, jpath = _fs_and_path(spark, path)
    stream = fs.open(jpath)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs_and_path(spark, path)
    return bool(fs.delete(jpath, True))


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _fs_and_path(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, sorted; none where there is no such folder."""
    fs, jpath = _fs_and_path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def file_sizes(spark: SparkSession, folder: str) -> list[int] | None:
    """Bytes of each file that readers see in a folder; None where one of them is a folder."""
    fs, jpath = _fs_and_path(spark, folder)
    seen = [s for s in fs.listStatus(jpath) if not s.getPath().getName().startswith(("_", "."))]
    return None if any(s.isDirectory() for s in seen) else [s.getLen() for s in seen]


def within(spark: SparkSession, path: str, folder: str) -> bool:
    """True where ``path`` is ``folder`` or lies in it."""
    inner, outer = [str(fs.makeQualified(p).toString()).rstrip("/") + "/" for fs, p in (_fs_and_path(spark, x) for x in (path, folder))]
    return inner.startswith(outer)


def take_over(spark: SparkSession, staged: str, folder: str, suffix: str, extension: str) -> None:
    """Move the files of a finished Spark write in ``staged`` to ``folder``, where their names have ``extension`` instead of
    ``suffix`` (before that of a codec, where there is one). The ``_SUCCESS`` marker comes last, so until then the folder doesn't
    count as written. Files are renamed; no bytes pass through the driver."""
    jvm = spark.sparkContext._jvm
    fs, top = _fs_and_path(spark, folder)
    names = [n for n in list_names(spark, staged) if not n.startswith(("_", "."))]

    def move(name: str) -> None:
        stem, _, codec = name.rpartition(suffix)
        to = jvm.org.apache.hadoop.fs.Path(top, stem + extension + codec)
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(staged, name), to):
            raise OSError(f"{staged}/{name} could not be renamed to {to}")

    with ThreadPoolExecutor(RENAME_THREADS) as pool:
        list(pool.map(move, names))
    fs.create(jvm.org.apache.hadoop.fs.Path(top, "_SUCCESS"), True).close()
    delete_path(spark, staged)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless one of that name is there: of several writers one succeeds.

    The text goes to a file of its own first. On a local disk a hard link then gives it its name, elsewhere a rename that
    doesn't overwrite; either fails where the name is taken, and a reader sees all of the text or none. (Both are atomic on local
    disks and HDFS. An object store whose rename is a copy gives no such promise.)
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs, target = _fs_and_path(spark, path)
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            jvm.java.nio.file.Files.createLink(*[jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath() for p in (target, draft)])
        else:
            once = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            once[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(draft), fs.makeQualified(target), once)
        return True
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    finally:
        fs.delete(draft, False)
