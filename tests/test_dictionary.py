from contestlab.sources.dictionary import described, dictionary


def test_comments_travel_with_the_schema_and_counts_are_of_all_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 2.0), (2, "x", None), (None, "y", None)], "a long, `b.c` string, n double")
    noted = described(df, {"a": "first", "b.c": "name with a dot", "absent": "not there"})
    path = str(tmp_path / "t")
    noted.write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.schema["a"].metadata["comment"] == "first"
    assert [tuple(r) for r in dictionary(stored).orderBy("position").collect()] == [
        ("a", 1, "bigint", "first", 2, 1), ("b.c", 2, "string", "name with a dot", 2, 1), ("n", 3, "double", None, 1, 2),
    ]


def test_empty_table(spark):
    got = dictionary(described(spark.createDataFrame([], "a long"), {"a": "first"})).collect()
    assert [tuple(r) for r in got] == [("a", 1, "bigint", "first", 0, 0)]
