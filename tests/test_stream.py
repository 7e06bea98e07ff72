from pyspark.sql import functions as F

from cardwatch.plans.predict import predict, requests_from
from cardwatch.streaming import predict_stream as ps


def test_key_follows_its_input(spark, scratch, sf_small):
    """A second run on other tables under the same path scores those, not what an earlier run left."""
    import os
    import shutil

    from cardwatch.plans import keys as K
    from cardwatch.plans.keys_io import q_predict_stream

    path = scratch + "/tables"
    os.makedirs(path)
    for name in os.listdir(sf_small):  # contents only: the tables and their folder may be read-only
        shutil.copyfile(f"{sf_small}/{name}", f"{path}/{name}")
    first = q_predict_stream(spark, path).count()
    spark.read.parquet(sf_small + "/orders.parquet").limit(100).coalesce(1).write.mode("overwrite").parquet(path + "/fewer")
    spark.catalog.clearCache()
    os.replace(path + "/orders.parquet", path + "/orders.old")
    os.rename(path + "/fewer", path + "/orders.parquet")
    second = q_predict_stream(spark, path).select("id", "prediction")
    batch = K.q_predict_batch(spark, path).select("id", "prediction")
    assert second.count() == batch.count() < first
    assert second.exceptAll(batch).count() == 0


def test_stream_equals_batch(spark, scratch, sf_small):
    from cardwatch.plans import keys as K

    req = requests_from(K.silver(spark, sf_small))
    req.write.parquet(scratch + "/inbox")
    out = ps.run_to_completion(spark, scratch + "/inbox", scratch + "/outbox", scratch + "/ckpt")
    batch = predict(req)
    cols = ["id", "prediction", "fraude_probabilite", F.array_join("explication", "|").alias("e")]
    assert sorted(map(tuple, out.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    # a restart with nothing new adds nothing (exactly-once file sink)
    again = ps.run_to_completion(spark, scratch + "/inbox", scratch + "/outbox", scratch + "/ckpt")
    assert again.count() == out.count()
