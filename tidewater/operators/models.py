"""A baseline model and rule votes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def baseline(df: DataFrame, key: str, features: Sequence[str], label: str, holdout_percent: int = 20) -> DataFrame:
    """Fit on the rows outside the hashed holdout and report counts, accuracy and area under the curve."""
    held = F.pmod(F.xxhash64(key), F.lit(100)) < holdout_percent
    rows = VectorAssembler(inputCols=list(features), outputCol="raw").transform(df)
    train, test = rows.where(~held), rows.where(held)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(train)
    model = LogisticRegression(labelCol=label, maxIter=20, regParam=0.01).fit(scaler.transform(train))
    predicted = model.transform(scaler.transform(test))
    auc = BinaryClassificationEvaluator(labelCol=label).evaluate(predicted)
    base = F.greatest(F.avg(label), 1 - F.avg(label))
    return predicted.agg(
        F.count(F.lit(1)).alias("n_holdout"),
        F.round(F.count_if(F.col("prediction") == F.col(label)) / F.count(F.lit(1)), 4).alias("accuracy"),
        F.round(base, 4).alias("majority_share"),
    ).withColumn("auc", F.round(F.lit(auc), 4))


def majority(df: DataFrame, key: str, rules: Sequence[Column]) -> DataFrame:
    """Label by majority: each rule votes +1 or -1."""
    votes = sum((F.when(r, 1).otherwise(-1) for r in rules), F.lit(0))
    return df.select(key, votes.cast("bigint").alias("votes"), F.when(votes > 0, 1).otherwise(0).alias("label"))
