import threading

from betaloom.sources import scratch


def there(spark, df):
    at, files = scratch.target(spark, df._betaloom_path)
    return files.exists(at)


def test_tables_go_at_the_end_of_their_block_and_thread(spark):
    with scratch.temporary(spark) as keep:
        a = scratch.materialize(spark.range(3), "gone")
        b = keep(a.selectExpr("id + 1 as id"), "kept")
        other = []
        t = threading.Thread(target=lambda: other.append(scratch.materialize(spark.range(4), "elsewhere")))  # no part of this block
        t.start()
        t.join()
        with scratch.temporary(spark):
            inner = scratch.materialize(spark.range(2), "inner")
        assert there(spark, a) and not there(spark, inner)
    assert not there(spark, a) and there(spark, b) and b.count() == 3
    assert there(spark, other[0]) and other[0].count() == 4
    scratch.release(b)
    scratch.release(b)
    assert not there(spark, b)


def test_the_checkpoint_folder_of_the_session_is_left_alone(spark):
    before = spark.sparkContext._jsc.sc().getCheckpointDir().isDefined()
    assert scratch.shared_dir(spark)
    assert spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() == before
