"""Operators for preparing training data: text in, decisions and training rows out."""

from pyspark import cloudpickle as _cloudpickle

import cohortkit.llm as _self

# Functions that run in Python workers travel with the job, so executors need not have
# this package installed.
_cloudpickle.register_pickle_by_value(_self)
