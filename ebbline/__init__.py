"""Customer-churn analytics as Spark jobs.

``sources``    readers and writers
``functions``  column expressions
``operators``  DataFrame in, DataFrame out
``streaming``  the prediction-log metrics as a running query
``plans``      jobs built from operators, and the registered queries
"""
