"""Quotes and clauses come out as they were said."""

from pyspark.sql import functions as F

from scenewright.operators import packages


def test_quotes_keep_their_digits(spark):
    scenes = spark.createDataFrame([(1, '"0 men came home 0" and "1 more is here 1 "')], "doc_id int, text string")
    got = packages.dialogue(scenes, "ordered", keys=["doc_id"]).orderBy("rank").select("line").collect()
    assert [r.line for r in got] == ["0 men came home 0", "1 more is here 1"]


def test_spoken_sentences_keep_their_digits(spark):
    scenes = spark.createDataFrame([(1, "0 of us said so. My house is number 1")], "doc_id int, text string")
    got = packages.dialogue(scenes, "ordered", keys=["doc_id"]).orderBy("rank").select(F.col("line")).collect()
    assert [r.line for r in got] == ["0 of us said so.", "My house is number 1"]
