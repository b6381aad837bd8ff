import zlib

import numpy as np
from pyspark.sql import functions as F

from daybook.llm import toxicity


def test_train_finds_the_marking_features():
    rng = np.random.default_rng(0)
    rows, positive = [], []
    for i in range(3000):
        toxic = i < 300 or rng.random() < 0.1  # 300 confirmed, a tenth of the unlabelled
        rows.append(sorted(set(rng.integers(5, 60, 12).tolist()) | (set(rng.choice(5, 2).tolist()) if toxic else set())))
        positive.append(i < 300)
    truth = np.array([min(r) < 5 for r in rows])
    w, b = toxicity.train(rows, np.array(positive), 60, 0.1)
    scores = np.array([w[r].sum() + b for r in rows])
    assert ((scores >= 0) == truth).mean() > 0.97


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(docs, labels)
    held = labels.where(toxicity.fold(F.col("doc_id")) == 0).join(toxicity.score(docs, model), F.col("id") == F.col("doc_id")).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    toxic = [r["score"] for r in held if r["toxic"] == 1]
    clean = [r["score"] for r in held if r["toxic"] == 0]
    assert np.mean([s >= 0.5 for s in toxic]) > 0.9 and np.mean([s >= 0.5 for s in clean]) < 0.02
    # labels of the held-out fold do not matter
    turned = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(docs, turned)
    assert again.features == model.features and np.array_equal(again.weights, model.weights) and again.bias == model.bias


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (7, 0), (1, 1)], "doc_id long, toxic int")
    for given in (labels, labels.limit(0), labels.where("toxic = 0")):
        rows = toxicity.score(odd_documents, toxicity.fit(odd_documents, given)).collect()
        assert len(rows) == 11 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(no_documents, toxicity.fit(no_documents, labels)).collect() == []
    clean = toxicity.keep_clean(odd_documents, toxicity.Model())
    assert clean.columns == odd_documents.columns and clean.count() == 11
