"""Subscription-churn analytics written as Spark jobs.

Sub-packages:

``functions``  column expressions and the two-level running sum
``sources``    scans, sinks and message encoding
``operators``  DataFrame-in, DataFrame-out building blocks
``streaming``  day-ordered replay and the Structured Streaming feature job
``plans``      whole jobs (batch, training, scoring) and the query registry
"""
