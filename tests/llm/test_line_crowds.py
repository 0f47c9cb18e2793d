"""What goes with the fine pieces of lines under crowded keys."""

from keyloom.llm import line_dedup
from pyspark.sql import functions as F


def test_pieces_carry_no_more_than_their_lines_name(spark):
    line = "a common phrase, then some other words that follow it"
    rows = spark.createDataFrame([(1, 2, line, len(line), list(range(23)))], "h bigint, g bigint, line string, chars int, counts array<int>")
    pieces = line_dedup._exploded(rows.withColumn("first", F.lit(0)), [line_dedup._fine_keys("chars", 2, 32, move) for move in (0, 1)])
    assert pieces.columns == ["h", "g", "key"]
    assert pieces.count() == pieces.distinct().count() == 2 * (len(line) // 4)


def test_few_rows_are_kept_in_few_parts(spark):
    few = line_dedup._kept(spark.range(100).repartition(32))
    many = line_dedup._kept(spark.range(3 * line_dedup.PART_ROWS).repartition(5))
    assert few.rdd.getNumPartitions() == 1 and sorted(r.id for r in few.collect()) == list(range(100))
    assert many.rdd.getNumPartitions() == 5 and many.distinct().count() == 3 * line_dedup.PART_ROWS
    assert line_dedup._kept(spark.range(0)).count() == 0
