"""Session set-up (A9) and the shared checkpoint folder.

The session is built once per job. Object-store credentials are never
defaulted: they come from the caller's ``extra`` config (e.g. the
``spark.hadoop.fs.s3a.*`` keys) or from the cluster's own defaults.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

# Settings every railyard job relies on. Timestamps are pinned to UTC so that
# hour buckets and date keys do not depend on the machine running the job.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Checkpoint files of DataFrames that are gone are removed by the cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    app_name: str = "railyard",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) the session with railyard's base settings.

    ``master`` is only set when given; on a cluster ``spark-submit`` supplies
    it. ``shuffle_partitions`` should be sized so one partition holds roughly
    100-200 MB of shuffle data at the target scale; AQE coalesces downwards.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    prepare_session(spark)
    return spark


def prepare_session(spark: SparkSession) -> SparkSession:
    """Make an existing session (e.g. one handed over by a driver) safe to use.

    Pins the session time zone and makes sure a reliable checkpoint folder
    is known to the SparkContext.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    _bound_listing(spark)
    return spark


def _bound_listing(spark: SparkSession) -> None:
    """List the folders of a table in a few tasks a core, not in one task each:
    facts have a folder for every date, and by default each is a task of its
    own. A session that has set the number itself keeps it."""
    name, default = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "10000"
    if _has_context(spark) and spark.conf.get(name, default) == default:
        spark.conf.set(name, str(4 * spark.sparkContext.defaultParallelism))


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def _has_context(spark: SparkSession) -> bool:
    """False for a Spark Connect session (no driver-side SparkContext): there
    the server's own ``spark.checkpoint.dir`` is used as configured."""
    try:
        spark.sparkContext  # noqa: B018
    except Exception:  # noqa: BLE001 - Connect raises on access
        return False
    return True


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    The cluster names it in ``spark.checkpoint.dir``; that value always wins.
    Only a local-mode session (tests) without the setting gets a private
    temporary folder: on a cluster a machine-local folder would not survive
    the loss of an executor, so there it is an error.
    """
    if not _has_context(spark):
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return configured
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder"
            )
        configured = tempfile.mkdtemp(prefix="railyard-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables.

    Used to cut lineage with a written table, and by round-trip queries.
    """
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/railyard/{name}-{uuid.uuid4().hex[:12]}"


class Scratch:
    """The tables that :func:`written` makes inside ``with scratch.taken():``,
    also in steps that run at once there; ``drop`` deletes them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    @contextmanager
    def taken(self) -> Iterator[Scratch]:
        token = _TAKEN.set(self)
        try:
            yield self
        finally:
            _TAKEN.reset(token)

    def drop(self) -> None:
        """Whoever calls this has no more use for a frame that reads them."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        while self.paths:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(conf).delete(path, True)


_TAKEN: ContextVar[Scratch | None] = ContextVar("railyard_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Tables written inside the block go when it ends: for steps that leave
    their results elsewhere, and no frame that still reads what is in between."""
    own = Scratch(spark)
    try:
        with own.taken():
            yield own
    finally:
        own.drop()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once: written as Parquet into the shared checkpoint
    folder and read back, so lineage is cut and Catalyst knows its size. It is
    the caller's to clear, or goes with the :func:`scratch` it is made in."""
    path, taken = scratch_path(df.sparkSession, name), _TAKEN.get()
    if taken is not None:
        taken.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What independent steps return, in their order. Each is a thread of the
    driver that submits jobs of its own, so the last tasks of one leave no cores
    idle, nor does its planning. All end before the first failure is raised."""
    if len(steps) < 2:
        return [step() for step in steps]
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(copy_context().run, inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]


__all__ = [
    "BASE_CONF",
    "get_session",
    "prepare_session",
    "checkpoint_dir",
    "scratch_path",
    "Scratch",
    "scratch",
    "written",
    "together",
]
