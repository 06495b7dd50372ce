import random
import time

from pyspark.sql import functions as F

from starloom.llm import frames


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_saved_table_leaves_no_shuffle_files(spark):
    setting = spark.conf.getAll.get(frames._SHUFFLES_GO)
    before = _shuffle_files(spark)
    table = frames.saved(spark.range(10_000).groupBy((F.col("id") % 777).alias("k")).count())
    for _ in range(50):  # they go in the background
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert table.agg(F.sum("count")).first()[0] == 10_000
    assert spark.conf.getAll.get(frames._SHUFFLES_GO) == setting


def test_rows_among_others_by_bits_and_by_shuffle(spark):
    draw = random.Random(2)
    rows = [*range(200), 2**40 + 3, 2**40 + 63, 2**40 + 64, 2**50]
    chosen = {0, 63, 64, 2**40 + 63, 2**50, 5_000, *draw.sample(range(200), 40)}
    large = spark.createDataFrame([(row, f"t{row}") for row in rows + rows[:5]], "row long, `_word` string")
    ids = spark.createDataFrame([(row,) for row in chosen], "row long")
    for limit in (100, 2):
        for keep in (True, False):
            found = frames.among(large, ids, "row", keep, limit)
            assert found.columns == large.columns
            assert sorted(r.row for r in found.collect()) == sorted(
                row for row in rows + rows[:5] if (row in chosen) == keep
            )
