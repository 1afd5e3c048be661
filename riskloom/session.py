"""Session helpers: where to pin intermediate results, and how to find paths."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_KEY = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; where it names none, one in its warehouse."""
    shared = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    return shared or join_path(spark.conf.get("spark.sql.warehouse.dir"), "_pinned")


#: Paths pinned in the innermost open scope of this thread (or task of an event loop).
_scope: ContextVar[list[str] | None] = ContextVar("pinned", default=None)


def pin(df: DataFrame, by: Sequence[str] = (), schema: StructType | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read that instead.

    This cuts the lineage like a checkpoint. Being Parquet, later steps read only
    the columns they use, and Spark knows the size when it picks a join. Filters
    on the columns in ``by`` read only the matching folders. ``schema``, where it differs
    from that of ``df``, gives another name to types of the same layout.
    """
    spark = df.sparkSession
    path = join_path(ensure_checkpoint_dir(spark), f"pinned-{uuid4().hex}")
    if (own := _scope.get()) is not None:
        own.append(path)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


@contextmanager
def pinned_scope(spark: SparkSession):
    """Drop the tables that this thread pins inside the block when it ends.

    Scopes belong to the thread that opened them, so a job beside a stream keeps its
    tables while a micro-batch of the stream drops its own."""
    own: list[str] = []
    before = _scope.set(own)
    try:
        yield
    finally:
        _scope.reset(before)
        for path in own:
            jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever file system its scheme names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(jvm_path))


def join_path(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *[p.strip("/") for p in parts]])


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names in a folder, and when each was last changed (seconds)."""
    fs, jvm_path = _file_system(spark, path)
    return [(f.getPath().getName(), f.getModificationTime() / 1000) for f in fs.listStatus(jvm_path)]


def remove_path(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _file_system(spark, path)
    fs.delete(jvm_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, read by the driver."""
    fs, jvm_path = _file_system(spark, path)
    stream = fs.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


#: Stores where a file appears when it is closed and that check the name at that moment.
OBJECT_STORES = ("s3a", "abfs", "abfss", "gs")


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Whether a small file was created whole; False if there was one of that name already.

    Of writers at the same time exactly one succeeds: by a hard link on a local disk, by a
    conditional write on an object store, elsewhere by a rename that does not replace.
    """
    fs, target = _file_system(spark, path)
    jvm, scheme = spark._jvm, fs.getScheme()
    fs.mkdirs(target.getParent())
    if scheme in OBJECT_STORES:
        builder = fs.createFile(target).overwrite(False).opt("fs.option.create.conditional.overwrite", True)
        return _unless_there(lambda: _write(builder.build(), text))
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid4().hex}.tmp")
    _write(fs.create(draft, True), text)
    try:
        if scheme == "file":
            old, new = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (draft, target))
            return _unless_there(lambda: jvm.java.nio.file.Files.createLink(new, old))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        return _unless_there(lambda: context.rename(draft, target, options))
    finally:
        fs.delete(draft, False)


def _write(stream, text: str) -> None:
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def _unless_there(act) -> bool:
    try:
        act()
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True
