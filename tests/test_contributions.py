"""The features behind contributions are computed once."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from ladle.operators import models as M


def counted(df):
    """``df`` and an accumulator of the rows that were computed of it."""
    acc = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            acc.add(b.num_rows)
            yield b
    return df.mapInArrow(run, df.schema), acc


def test_contributions_read_features_once(spark):
    df = spark.createDataFrame([(i, float(i), float(i * i % 7), 2.0 * i) for i in range(20)], "id long, a double, b double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), LinearRegression()]).fit(df)
    rows, n = counted(df)
    got = M.linear_contributions(model, rows, "id").collect()
    assert n.value == 20 and len(got) == 40
    assert sum(r["contribution"] for r in got) == pytest.approx(0, abs=1e-6)
