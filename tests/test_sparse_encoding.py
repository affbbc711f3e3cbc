"""Sparse rows from a dictionary against the wide form, and a column with a million categories."""

from pyspark.sql import functions as F

from foldwise.operators.encode import as_sparse_vectors, dictionary, encode_sparse, encode_wide, fit_encoder, one_hot_union


def test_sparse_equals_wide(spark):
    rows = [(i, float(i % 7), i % 3 - 1, f"c{i % 4}" if i % 5 else None, i % 11) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, m double, n int, c string, k int")
    p = fit_encoder(df.where("id < 40"), ["m"], ["n"], ["c", "k"])
    batch = df.unionByName(spark.createDataFrame([(100, None, None, "new", 99), (101, 2.0, 0, "c1", 10)], df.schema))
    names = ["m", "n", *[f"{c}_{v}" for c, v in one_hot_union(p)]]
    ids = dictionary(p)
    assert [r["id"] for r in ids.orderBy("id").collect()] == list(range(len(names)))
    assert [r["name"] for r in ids.orderBy("id").select(F.concat_ws("_", "feature", "category").alias("name")).collect()] == names
    want = {r["id"]: [r[n] or 0.0 for n in names] for r in encode_wide(batch, p, keep=["id"]).collect()}
    found = encode_sparse(batch, p, ids, keep=["id"])
    for r in found.collect():
        assert r["size"] == len(names) and r["indices"] == sorted(r["indices"]) and 0.0 not in r["values"]
        dense = [0.0] * len(names)
        for i, v in zip(r["indices"], r["values"]):
            dense[i] = v
        assert dense == want[r["id"]]
    vectors = {r["id"]: r["features"].toArray().tolist() for r in as_sparse_vectors(found, ["id"]).collect()}
    assert vectors == want


def test_a_model_fits_on_the_vectors(spark):
    from pyspark.ml.classification import LogisticRegression
    df = spark.range(200).select("id", (F.col("id") % 2).cast("int").alias("label"), F.concat(F.lit("c"), F.col("id") % 10).alias("c"))
    p = fit_encoder(df, [], [], ["c"])
    data = as_sparse_vectors(encode_sparse(df, p, dictionary(p), keep=["label"]), ["label"])
    model = LogisticRegression(regParam=0.01).fit(data)
    assert model.transform(data).where("prediction = label").count() == 200


def test_a_million_categories(spark):
    n = 1_000_000
    df = spark.range(n).select("id", F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("c"), (F.col("id") % 2).cast("int").alias("b"))
    p = fit_encoder(df, [], ["b"], ["c"])
    found = encode_sparse(df, p, dictionary(p), keep=["id"])
    # category i has place i behind the numeric column; one more entry where b is 1
    last = F.element_at("indices", -1)
    got = found.agg(F.count("*").alias("n"), F.min("size").alias("size"), F.count_if(last == F.col("id") + 1).alias("right"), F.sum(F.size("indices")).alias("entries")).first()
    assert tuple(got) == (n, n + 1, n, n + n // 2)
