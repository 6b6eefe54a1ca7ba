import pytest

from ferrolex import session


def test_only_local_sessions_get_a_temporary_folder():
    assert session.is_local("local") and session.is_local("local[*]") and session.is_local("local[4, 2]")
    assert not any(map(session.is_local, ("local-cluster[3,4,1024]", "yarn", "spark://x:7077", None, "")))


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf(dict):
        set = dict.__setitem__

    class Spark:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Spark())
    Spark.conf["spark.checkpoint.dir"] = "hdfs://x/y"
    assert session.shared_folder(Spark()) == "hdfs://x/y"


def test_cut_keeps_rows_and_lineage_is_short(spark):
    df = session.cut(spark.range(5).selectExpr("id * 2 as x"))
    assert sorted(r.x for r in df.collect()) == [0, 2, 4, 6, 8] and "Scan ExistingRDD" in df._jdf.queryExecution().toString()


def test_written_tables_keep_rows_types_and_empty_tables(spark):
    df = spark.createDataFrame([(1, [("a", None)]), (None, None)], "x bigint, y array<struct<k:string,v:tinyint>>")
    for t in (df, df.where("false")):
        back = session.written(t)
        assert back.schema == df.schema and sorted(map(str, back.collect())) == sorted(map(str, t.collect()))


def test_small_tables_are_spread_over_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    one, many = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, cores + 3)
    assert session.spread(one).rdd.getNumPartitions() == cores and session.spread(many).rdd.getNumPartitions() == cores + 3
    assert sorted(r.id for r in session.spread(one).collect()) == list(range(100)) and session.spread(one.limit(0)).count() == 0
