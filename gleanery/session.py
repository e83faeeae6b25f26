"""Session helpers: the shared work folder and a local session for tests."""

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL = {}


def work_dir(spark: SparkSession) -> str:
    """A fresh folder below the shared folder named by spark.checkpoint.dir.

    Where the setting is absent a temporary folder is used, but only by a
    local-mode session: executors of a cluster could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="gleanery-")
        base = _LOCAL[app]
    return f"{base.rstrip('/')}/gleanery-{uuid.uuid4().hex}"


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
