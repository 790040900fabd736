"""Small files that the driver, and stream readers beside it, read, list and publish.

Paths are those of Spark. ``qualified`` names their file system, so that Python code
outside the session opens the same file: local ones directly, others through pyarrow.
"""

import os
import uuid
from pathlib import Path
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark resolves it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def local_path(path: str) -> str | None:
    """The plain path of a file on a local (or mounted) file system, else None."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        return None
    return unquote(parts.path) if parts.scheme else path


def filesystem(path: str):
    """A pyarrow file system and the path in it."""
    from pyarrow import fs

    local = local_path(path)
    if local is not None:
        return fs.LocalFileSystem(), local
    # S3 has other schemes in Spark
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def read(path: str, most: int | None = None) -> bytes | None:
    """The bytes of a file (the first ``most``), None if there is none."""
    system, inside = filesystem(path)
    try:
        with system.open_input_stream(inside) as stream:
            return stream.read(most) if most else stream.readall()
    except FileNotFoundError:
        return None


def exists(path: str) -> bool:
    from pyarrow import fs

    system, inside = filesystem(path)
    return system.get_file_info(inside).type != fs.FileType.NotFound


def names(folder: str) -> list[str]:
    """The names in a folder, sorted; none if it is missing. Hidden ones are left out."""
    from pyarrow import fs

    system, inside = filesystem(folder)
    found = system.get_file_info(fs.FileSelector(inside, allow_not_found=True))
    return sorted(x.base_name for x in found if not x.base_name.startswith((".", "_")))


def data_files(folder: str) -> list[tuple[str, int]]:
    """Paths, relative to the folder and sorted, and sizes of all parquet files below it."""
    from pyarrow import fs

    system, inside = filesystem(folder)
    found = system.get_file_info(fs.FileSelector(inside, allow_not_found=True, recursive=True))
    inside = inside.rstrip("/") + "/"
    return sorted((x.path[len(inside) :], x.size) for x in found if x.path.endswith(".parquet"))


def _publish_locally(path: str, data: bytes, replace: bool) -> bool:
    folder = Path(path).parent
    folder.mkdir(parents=True, exist_ok=True)
    draft = folder / f".{uuid.uuid4().hex}.tmp"
    draft.write_bytes(data)
    try:
        if replace:
            os.replace(draft, path)
        else:
            # unlike a rename, a link fails if the name is taken
            os.link(draft, path)
    except FileExistsError:
        return False
    finally:
        draft.unlink(missing_ok=True)
    return True


def _publish(spark: SparkSession, path: str, data: bytes, replace: bool) -> bool:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    draft = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    system = target.getFileSystem(conf)
    out = system.create(draft, True)
    out.write(bytearray(data))
    out.close()
    how = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.OVERWRITE if replace else hadoop.Options.Rename.NONE
    try:
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, how)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True


def put_if_absent(spark: SparkSession, path: str, data: bytes) -> bool:
    """Publish a whole file under a name that is not taken yet; False if it is.

    The file appears by one link or rename, so nobody sees a part of it and of several
    writers one succeeds. Object stores without a rename that fails on an existing name
    do not give that promise.
    """
    local = local_path(path)
    return _publish(spark, path, data, False) if local is None else _publish_locally(local, data, False)


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """Publish a file, in place of an older one."""
    local = local_path(path)
    if local is None:
        _publish(spark, path, data, True)
    else:
        _publish_locally(local, data, True)


def note(path: str, data: bytes) -> None:
    """Write a file outside the session; for notes that one process keeps for itself."""
    system, inside = filesystem(path)
    system.create_dir(inside.rsplit("/", 1)[0], recursive=True)
    draft = f"{inside}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(draft) as stream:
        stream.write(data)
    system.move(draft, inside)


def remove(spark: SparkSession, folder: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
