"""The forest of op3 in a session that has observed a query before."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from farelane.llm import secrets_rf


def test_forest_goes_to_tasks_after_an_observed_query(spark):
    """Before, the model took its summary and with it the session along, and an observed session cannot be serialized."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = [(str(i), i, 0, float(i), float(i % 2)) for i in range(12)]
    labelled = spark.createDataFrame(rows, "token string, rid long, at int, f_x double, label double")
    model = secrets_rf.train(labelled)
    assert model.transform(labelled).select("probability").count() == 12
    assert len(model.transform(labelled).select("probability").collect()) == 12
