from tripmill.llm import scoring


def test_weighed_joins_every_key_once_in_slices(spark, monkeypatch):
    """op8's join of text keys with table weights runs in slices by key, each written apart, with the sums of one join."""
    walked = spark.createDataFrame(
        [(0, [5, -3, 5, 8]), (1, [-7, 9, 2]), (2, []), (3, [11])], "row long, keys array<long>"
    )
    weights = spark.createDataFrame(
        [(5, 0.5), (-3, -1.25), (-7, 2.0), (9, 4.0), (2, 0.125), (8, 1.0), (100, 9.0)], "key long, weight double"
    )
    made = []
    original = scoring.written
    monkeypatch.setattr(scoring, "written", lambda df, name: made.append(name) or original(df, name))
    found = scoring._weighed(walked, weights).groupBy("row").sum("weight").collect()
    assert made == ["weighed"] * scoring.KEY_SLICES
    assert {r[0]: r[1] for r in found} == {0: 0.5 - 1.25 + 0.5 + 1.0, 1: 2.0 + 4.0 + 0.125}
