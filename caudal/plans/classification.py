"""Flat tables to the predictions of the four classifiers."""

from __future__ import annotations

from pyspark.sql import SparkSession

from caudal.operators import classify as C
from caudal.operators import features as X
from caudal.plans.corpus import flat_tables
from caudal.session import materialise
from caudal.sources.writers import write_csv


def run_classification(
    spark: SparkSession, base: str, out: str, seed: int = 1, per_id: bool = False, fit_on: str = "all"
) -> None:
    """Write ``{LR,DT,RF,NB}results.csv``: label and prediction of the test rows, without header.

    ``fit_on`` "all" weighs words over all laws before they are split, "train" over the
    training rows only.
    """
    t = flat_tables(spark, base)
    assembled = X.assemble(
        t["laws"], t["results"], t["signers"], t["deputyCommissions"], t["senateCommissions"], per_id=per_id
    )
    keys = ("id", "outcome")
    if fit_on == "train":
        train_rows, test_rows = C.split(materialise(C.balance(assembled, *keys, seed=seed)), *keys, seed=seed + 1)
        train = materialise(X.feature_vectors(train_rows))
        test = materialise(X.feature_vectors(test_rows, fit_on=train_rows))
    else:
        vectors = materialise(C.balance(X.feature_vectors(assembled), *keys, seed=seed))
        train, test = C.split(vectors, *keys, seed=seed + 1)
    for name in C.MODELS:
        write_csv(C.predict(name, train, test, seed=seed), f"{out}/{name}results.csv")
