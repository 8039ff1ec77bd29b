from quayside.operators.encoding import label_encode


def test_codes_follow_sorted_values(spark):
    words = [f"w{i:04d}" for i in range(500)]
    rows = [(w, w[-1]) for w in reversed(words)] * 2
    df = spark.createDataFrame(rows, "a string, b string")
    coded = label_encode(df, {"a": "a_code", "b": "b_code"}).collect()
    assert len(coded) == 1000
    assert all(r.a_code == words.index(r.a) and r.b_code == int(r.b) for r in coded)


def test_null_is_coded_last(spark):
    df = spark.createDataFrame([("x",), (None,), ("a",)], "a string")
    coded = {r.a: r.code for r in label_encode(df, {"a": "code"}).collect()}
    assert coded == {"a": 0, "x": 1, None: 2}
