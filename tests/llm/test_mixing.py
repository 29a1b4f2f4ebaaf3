import random

import duckdb
from pyspark.sql import functions as F

from cairnflow.llm import mixing


def test_same_as_sql(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for d in range(600):
        text = rng.choice([" ".join(["w"] * rng.randrange(1, 80)), "", None, " \t one  two\n"])
        rows.append((d, text, rng.choice(["en", "en", "de", "fr", "xx", None]), rng.choice(["src0"] * 6 + ["src1", "src2", "src13", "blog", None]), d))
    rows += [(None, "a b", "en", "src1", 1), (5, rows[5][1], rows[5][2], rows[5][3], 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, copies long")
    path = str(tmp_path / "d")
    df.coalesce(1).write.parquet(path)
    got = sorted((tuple(r) for r in mixing.mix_documents(df.repartition(5)).collect()), key=repr)
    want = sorted(duckdb.sql(mixing.oracle(f"(SELECT * FROM '{path}/*.parquet')")).fetchall(), key=repr)
    assert got == want and len(got) > 100


def test_budgets_keep_to_weights_and_capacity(spark):
    tokens = spark.createDataFrame([("a", "x", 1000), ("a", "y", 10), ("b", "x", 5000), ("c", "x", 3)], "domain string, source string, n_tokens long")
    weights = [F.when(F.col("domain") == "a", 3).otherwise(1), F.lit(1)]
    out = {(r.domain, r.source): r.share for r in mixing.leaf_budgets(tokens, ["domain", "source"], weights, (1, 2), 1).collect()}
    # 3006 tokens: c gives its 3, a its 1010 (less than three quarters), b the rest; inside a, y's shortage goes to x
    assert out == {("a", "x"): 1000, ("a", "y"): 10, ("b", "x"): 1993, ("c", "x"): 3}
    small = {(r.domain, r.source): r.share for r in mixing.leaf_budgets(tokens, ["domain", "source"], weights, (1, 100), 1).collect()}
    assert small[("c", "x")] == 3 and small[("a", "y")] == 10 and small[("b", "x")] == 14 and sum(small.values()) in (59, 60)


def test_epochs_and_empty(spark):
    docs = spark.createDataFrame([(i, "a b c d", "en", "src3") for i in range(10)], "doc_id long, text string, lang string, source string")
    levels = {"source": F.col("source")}
    rows = mixing.mix(docs, levels, [F.lit(1)], (5, 2), max_epochs=3).collect()
    assert sum(r.copies * r.n_tokens for r in rows) == 100 and {r.copies for r in rows} == {2, 3}
    assert all(r.copies == 3 for r in mixing.mix(docs, levels, [F.lit(1)], (9, 1), max_epochs=3).collect())
    assert mixing.mix_documents(docs.limit(0)).count() == 0
    assert mixing.mix(docs, levels, [F.lit(0)], (1, 2)).count() == 0
