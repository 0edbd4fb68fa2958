"""caudal: analytics jobs over logs, documents and keyed data, written as Spark DataFrame plans.

Every job is a plain function from DataFrames to a DataFrame. Nothing runs
until the caller writes or collects the result; only the functions in
``caudal.plans`` and the model fits start Spark jobs themselves.
"""
