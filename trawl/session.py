"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

#: Bytes of a batch that a Python worker is handed. Spark's own limit is 10,000 rows, of whatever length.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "trawl", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew-join handling on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or a checkpoint dir already set on
    the context). Only with a local master (tests), where the driver's disk is
    the executors' disk, is a scratch folder made when neither is set;
    elsewhere that would lose data, so it is an error.
    """
    sc = spark.sparkContext
    jdir = sc._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="trawl-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared folder for a written intermediate table."""
    import uuid

    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Cut lineage by writing a parquet table to the shared folder and reading it back.

    Unlike an eager ``checkpoint()`` (which evaluates the plan once for the
    count and again for the checkpoint write) the plan runs once; the table
    survives executor loss and later stages read it with column pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out.table_path = path
    return out


def drop_table(df) -> None:
    """Delete a table that ``materialize`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.table_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_JAVA: dict[tuple[str, str], object] = {}


def java_function(spark: SparkSession, package: str, cls: str, returns: str) -> str | None:
    """Register the Java UDF ``trawl.<cls>``, whose source lies in ``package``, and return its name in SQL.

    Janino, which Spark brings along for its own generated code, compiles it once an application; executors
    get the class as a jar. None without Janino.
    """
    import zipfile
    from importlib import resources

    sc = spark.sparkContext
    key = (sc.applicationId, cls)
    if key not in _JAVA:
        maker = sc._jvm.org.codehaus.janino.SimpleCompiler
        if not callable(maker):  # py4j gives a package where there is no such class
            return None
        compiler = maker()
        compiler.cook(resources.files(package).joinpath(cls + ".java").read_text())
        out = os.path.join(tempfile.mkdtemp(prefix="trawl-code-"), f"trawl-{cls}.jar")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, code in compiler.getBytecodes().items():
                z.writestr(name.replace(".", "/") + ".class", bytes(code))
        sc._jsc.addJar(out)
        _JAVA[key] = compiler.getClassLoader().loadClass("trawl." + cls).newInstance()
    name = "trawl_" + cls.lower()
    session = spark._jsparkSession
    session.udf().register(name, _JAVA[key], session.sessionState().sqlParser().parseDataType(returns))
    return name


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``trawl`` importable in the executors' Python workers (UDFs are
    pickled by reference): zip the package once and ``addPyFile`` it. The session's
    batches for these workers get their limit in bytes, unless it has a smaller one."""
    import zipfile

    sc = spark.sparkContext
    jconf = spark._jsparkSession.sessionState().conf()
    if jconf.arrowMaxBytesPerBatch() > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="trawl-code-"), "trawl.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("trawl", os.path.relpath(full, pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
