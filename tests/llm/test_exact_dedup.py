import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tabulon.llm import exact_dedup


def brute(rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    best = {t: (max if keep == "largest" else min)((i for i in ids if i is not None), default=None)
            for t, ids in groups.items()}
    return sorted(((i, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                   for i, t in rows), key=repr)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups_as_by_brute_force(spark, corpus, rows, keep):
    data = corpus(5, n=200) + [(i, "hot text " * 20) for i in range(500, 700)] + [(900, ""), (901, None), (900, "")]
    data += [(None, "hot text " * 20), (None, "alone"), (5_000, "é" * 200_000), (5_001, "é" * 200_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    found = exact_dedup.exact_copies(docs, keep=keep)
    assert rows(found, "doc_id", "keep_id", "group_size", "text_sha256") == brute(data, keep)
    # one row of each group stays, also where ids repeat or are missing
    stays = found.filter("kept").collect()
    assert sorted(r["text_sha256"] for r in stays) == sorted({r[3] for r in brute(data, keep)})
    assert all(r["doc_id"] == r["keep_id"] for r in stays)


def test_the_order_of_partitions_does_not_matter(spark, corpus, rows):
    docs = spark.createDataFrame(corpus(6, n=150), "doc_id long, text string")
    assert rows(exact_dedup.exact_copies(docs.coalesce(1))) == rows(exact_dedup.exact_copies(docs.repartition(7)))


def test_normalised_texts_and_clashing_columns(spark, rows):
    data = [(1, "A b", "x"), (2, "a b ", "y"), (3, None, "z"), (4, "c", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, keep_id string").withColumn("_hash", F.lit(1)).withColumn(
        "kept", F.lit(False))
    left = exact_dedup.drop_copies(docs, normalise=lambda c: F.trim(F.lower(c)))
    assert left.columns == docs.columns
    assert rows(left, "doc_id", "text", "keep_id") == [(1, "A b", "x"), (3, None, "z"), (4, "c", None)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_copies(docs).count() == 0
    assert exact_dedup.drop_copies(docs).count() == 0


def test_no_python_and_no_second_shuffle_of_the_texts(spark, corpus):
    docs = spark.createDataFrame(corpus(7), "doc_id long, text string")
    with pytest.raises(ValueError):
        exact_dedup.exact_copies(docs, keep="first")
    rows = exact_dedup._with_parts(docs.select(
        F.col("doc_id").alias("_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("_bytes")).select(
        "*", F.xxhash64("_bytes").alias("_hash"), F.substring("_bytes", 1, 48).alias("_head")))
    from pyspark.sql import Window as W

    same = W.partitionBy(*exact_dedup._KEY, "_bytes")
    plan = rows.repartitionByRange(*exact_dedup._KEY).select(F.count("*").over(same))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning(_bytes" not in plan
    assert "Python" not in plan
