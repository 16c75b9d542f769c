"""Session helpers: a local session for tests and benches, and the shared
scratch folder every job writes intermediate tables and checkpoints to."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8,
                  app: str = "tickflow", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench.  On a cluster, build your own session;
    the library only reads settings from it."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session.  Where nothing is configured, a ``local[...]``
    session gets a fresh folder of this machine; on any other master that
    folder would not be seen by the executors, so it is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        master = sc.master or ""
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        root = tempfile.mkdtemp(prefix="tickflow-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared folder (never reused)."""
    return f"{shared_root(spark)}/tickflow/{name}-{uuid.uuid4().hex[:12]}"


_TEMPORARY: dict[str, tuple[SparkSession, list[str]]] = {}


def temporary_scratch(spark: SparkSession, name: str) -> str:
    """A scratch location whose frames are read lazily by results of this
    application: :func:`release_scratch` removes it, at the application's end
    at the latest."""
    app = spark.sparkContext.applicationId
    if app not in _TEMPORARY:
        _TEMPORARY[app] = (spark, [])
        atexit.register(_release, app)
    path = scratch_path(spark, name)
    _TEMPORARY[app][1].append(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Removes the temporary locations of this application; frames that still
    read them fail afterwards."""
    _release(spark.sparkContext.applicationId)


def _release(app: str) -> None:
    spark, paths = _TEMPORARY.pop(app, (None, []))
    if spark is None or spark.sparkContext._jsc is None:
        return  # the application has been stopped: its folder is its owner's to remove
    for path in paths:
        drop_scratch(spark, path)


def drop_scratch(spark: SparkSession, path: str | None = None) -> None:
    """Removes a location made by :func:`scratch_path`, or without ``path``
    all of this application's, once their queries are finished.  Frames that
    still read them fail afterwards."""
    base = f"{shared_root(spark)}/tickflow"
    target = path or base
    if target != base and not target.startswith(f"{base}/"):
        raise ValueError(f"not a scratch location of this session: {target}")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(target)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Moves the data files of the written folder ``source`` into ``target``
    (made if missing): renames inside one file system, no data is copied.  A
    missing ``source`` (a part without rows) moves nothing."""
    here, fs = _file_system(spark, source)
    there, _ = _file_system(spark, target)
    fs.mkdirs(there)
    if not fs.exists(here):
        return
    # partitions of one write hold files of equal names: the folder's name sets them apart
    folder = here.getName().replace("=", "-")
    for f in fs.listStatus(here):
        name = f.getPath().getName()
        if f.isFile() and not name.startswith(("_", ".")) and not fs.rename(
                f.getPath(), there.suffix(f"/{folder}-{name}")):
            raise OSError(f"could not move {f.getPath()} to {target}")


def table_version(spark: SparkSession, path: str) -> str:
    """A text that changes when the files of a table change: number, bytes and
    latest modification of all of them."""
    here, fs = _file_system(spark, path)
    if not fs.exists(here):
        return "none"
    files, count, size, latest = fs.listFiles(here, True), 0, 0, 0
    while files.hasNext():
        f = files.next()
        count, size, latest = count + 1, size + f.getLen(), max(latest, f.getModificationTime())
    return f"{count}-{size}-{latest}"
