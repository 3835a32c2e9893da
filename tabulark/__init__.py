"""tabulark: data preparation, profiling, statistics, modelling and evaluation
operators for learning-activity style tables, expressed as Spark DataFrame plans.

Every operator takes and returns DataFrames. Fitted operators come as a
``fit_*`` function that runs a small number of fused aggregate jobs and returns
plain Python parameters, and an ``apply_*`` function that turns those
parameters into native column expressions (no Python runs per row).
"""

__version__ = "0.1.0"
