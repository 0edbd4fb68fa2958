"""Balanced samples, train/test splits and the four classifiers."""

from __future__ import annotations

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.functions.chance import draw

MODELS = ("LR", "DT", "RF", "NB")


def balance(rows: DataFrame, *keys: str, label: str = "sanctioned", seed: int = 1) -> DataFrame:
    """All positive rows and a share of the negative ones, positives / negatives, without replacement.

    Whether a row is drawn depends on its ``keys`` and the seed, so it is drawn again in
    the same way when a lost task is repeated. Both numbers come from one small aggregate.
    """
    counts = rows.agg(
        F.try_divide(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).alias("share")
    ).scalar()
    drawn = draw(seed, *[F.col(k) for k in keys]) < counts
    return rows.where((F.col(label) == 1) | ((F.col(label) == 0) & drawn))


def split(rows: DataFrame, *keys: str, share: float = 0.8, seed: int = 2) -> tuple[DataFrame, DataFrame]:
    """Rows for training and for testing, told apart by their ``keys`` and the seed."""
    number = draw(seed, *[F.col(k) for k in keys])
    return rows.where(number < share), rows.where(number >= share)


def classifier(name: str, features: str = "featureVector", label: str = "sanctioned", seed: int = 1):
    """One of the classifiers: LR logistic regression, DT decision tree, RF random forest, NB naive Bayes."""
    columns = {"featuresCol": features, "labelCol": label}
    if name == "LR":
        return LogisticRegression(maxIter=100, regParam=0.1, elasticNetParam=0.2, **columns)
    if name == "DT":
        return DecisionTreeClassifier(seed=seed, **columns)
    if name == "RF":
        return RandomForestClassifier(numTrees=10, seed=seed, **columns)
    if name == "NB":
        return NaiveBayes(**columns)
    raise ValueError(f"unknown classifier {name}")


def predict(name: str, train: DataFrame, test: DataFrame, label: str = "sanctioned", seed: int = 1) -> DataFrame:
    """(label, prediction) of the test rows by a classifier fitted on the training rows."""
    return classifier(name, label=label, seed=seed).fit(train).transform(test).select(label, "prediction")
