"""Retail price setting on Spark: sales preparation, pair correlations, demand
models with competitor effects, cost assembly and price simulation.

Every public function takes and returns DataFrames, so nothing runs until the
caller writes or collects a result.
"""
