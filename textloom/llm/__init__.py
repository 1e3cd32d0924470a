"""Operators of a training-data pipeline, one module per operator.

Nothing outside this folder imports it.  ``queries.py`` registers one query per
operator (``opN_<name>``) and the pipeline.
"""
