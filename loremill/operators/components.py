"""Connected components of an undirected graph, by joins and aggregations alone."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``. Only a local session, which is one machine, may leave it unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def job_dir(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_dir(spark)}/jobs/{spark.conf.get('spark.app.id', 'local')}"


def clear(spark: SparkSession) -> None:
    """Removes what this application has written to its part of the shared folder. For the end of a job: results that are still lazy need these tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(job_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Whether Spark removes an execution's shuffle files when it ends, rather than when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, small: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    ``small`` is for rows of a few numbers: they are dealt evenly to two files for each core of the cluster, so that
    a table that is made over and over does not become as many files as there are shuffle partitions.

    The result no longer depends on the executors that computed it, is computed once however often
    it is read, and joins on it get their own exchange, which adaptive execution can split when a
    key is hot.
    """
    spark = df.sparkSession
    path = f"{job_dir(spark)}/tables/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # the table is all that is read of them again
    try:
        (df.repartition(2 * spark.sparkContext.defaultParallelism) if small else df).write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Removes a table that ``cut`` wrote, when all that reads it has been written too."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link each node's greater neighbours to the least node around it. Small star: the same for its lesser ones."""
    if large:
        around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = cut(around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), small=True)
    moved = around.join(least, "a")
    if large:
        moved = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select("a", F.col("m").alias("b")).union(moved.select(F.col("b").alias("a"), F.col("m").alias("b")))
    return cut(moved.filter("a <> b").distinct(), small=True)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: every node that an edge names, with the least node it is connected to.

    Self-loops count (a node alone), repeated edges and directions do not matter, edges with a null end
    are ignored. Large and small stars alternate until every node hangs on its least node: a number of
    rounds that grows with the logarithm of the graph. Each round writes its edges to the shared folder;
    only a count reaches the driver. A hub's rows meet in aggregations with map-side combining, or in a
    join of written tables, which adaptive execution splits.
    """
    own = cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL"), small=True)
    work = cut(own.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), small=True)
    mark = None
    while True:
        work = _star(_star(work, large=True), large=False)
        now = work.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    hung = work.select(F.col("a").alias("node"), F.col("b").alias("component"))
    nodes = own.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return nodes.join(hung, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
