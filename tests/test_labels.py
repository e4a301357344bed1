from lodestone.operators import labels as L


def test_codes_sorted_and_null_is_minus_one(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "s string")
    out = sorted(L.category_codes(df, "s", out="code").collect(), key=lambda r: (r["s"] is None, r["s"] or ""))
    assert [(r["s"], r["code"]) for r in out] == [("a", 0), ("a", 0), ("b", 1), ("c", 2), (None, -1)]


def test_codes_of_many_labels(spark):
    df = spark.range(3000).selectExpr("id", "cast(id % 1500 as string) as s")
    names = sorted(str(i) for i in range(1500))
    place = {n: i for i, n in enumerate(names)}
    for coded in (L.category_codes(df, "s", out="code"), L.encode_with_list(df, "s", names, out="code")):
        got = coded.collect()
        assert len(got) == 3000 and all(r["code"] == place[r["s"]] for r in got)


def test_preprocess_iris_shape(spark):
    from lodestone.operators.training import preprocess
    rows = [(i, 5.0 + i / 100, 3.0, 1.0, 0.2, sp) for i, sp in
            enumerate(["Iris-setosa"] * 3 + ["Iris-versicolor"] * 3 + ["Iris-virginica"] * 3, start=1)]
    df = spark.createDataFrame(rows, "Id int, SepalLengthCm double, SepalWidthCm double, "
                                     "PetalLengthCm double, PetalWidthCm double, Species string")
    out = preprocess(df)
    assert "Id" not in out.columns
    assert sorted({r["Species"] for r in out.collect()}) == [0, 1, 2]


def test_codes_of_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "s string")
    assert [r["code"] for r in L.category_codes(df, "s", out="code").collect()] == [-1, -1]
    assert L.category_codes(df.limit(0), "s", out="code").count() == 0
