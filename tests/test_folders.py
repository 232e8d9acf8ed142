"""Tables with many date folders: what listing and writing them costs."""

from pyspark.sql import functions as F

from railyard.session import prepare_session
from railyard.sources.parquet import write_clustered


def _days(spark, n):
    day = F.expr("date_add(date'2020-01-01', cast(id % 60 as int))")
    return spark.range(n).select("id", F.concat(F.lit("some text "), "id").alias("text"), day.alias("day"))


def _tasks(spark, group, what):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = what()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds]
    return out, [s.numTasks for s in stages if s is not None]


def test_folders_are_listed_in_a_few_tasks(spark, workdir):
    prepare_session(spark)
    write_clustered(_days(spark, 600), f"{workdir}/t", "day", ["id"])
    read, tasks = _tasks(spark, "list", lambda: spark.read.parquet(f"{workdir}/t"))
    assert read.count() == 600 and max(tasks) <= 4 * spark.sparkContext.defaultParallelism < 60


def test_sparse_dates_are_written_by_all_cores(spark, workdir):
    name = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(name)
    write_clustered(_days(spark, 12_000).drop("text"), f"{workdir}/t", "day", ["id"])
    assert spark.conf.get(name) == before
    files = spark.read.parquet(f"{workdir}/t").inputFiles()
    writers = {f.rsplit("/part-", 1)[1][:5] for f in files}
    # several tasks, but no date is dealt to two of them
    assert len(writers) > 1 and len(files) == 60
