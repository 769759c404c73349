import pytest
from tables import day, one

from pyspark.sql import functions as F

from subsight.session import shared_folder
from subsight.sinks import tables as sinks


def test_failed_job_keeps_the_old_table(spark, tmp_path):
    path = sinks.replace_table(spark.range(5), f"{tmp_path}/t")
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.replace_table(broken, path)
    assert spark.read.parquet(path).count() == 5
    # a table may be replaced by something computed from itself
    sinks.replace_table(spark.read.parquet(path).where("id < 2"), path)
    assert spark.read.parquet(path).count() == 2


def test_run_that_stopped_between_renames_is_put_right(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.replace_table(spark.range(5), path)
    (tmp_path / "t").rename(tmp_path / "t.old")
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.replace_table(broken, path)
    assert spark.read.parquet(path).count() == 5


def test_wide_snapshot_has_many_writers(spark, build, tmp_path):
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor")
    before = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], "20k")
    try:
        one_account = build.accounts(dict(account_id="A")).first()
        columns = [F.lit(v).cast(t).alias(c) for (c, t), v in zip(build.accounts().dtypes, one_account) if c != "account_id"]
        rows = spark.range(0, 200_000, 1, 12).select(F.md5(F.col("id").cast("string")).alias("account_id"), *columns)
        sinks.write_snapshot("accounts", rows, "2024-06-01", str(tmp_path))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    files = list((tmp_path / "accounts/date=2024-06-01").glob("*.parquet"))
    assert len(files) > 3
    got = one(spark.read.parquet(f"{tmp_path}/accounts").agg(F.count("*").alias("n"), F.max("snapshot_date").alias("d")))
    assert got == dict(n=200_000, d=day("2024-06-01"))


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())
