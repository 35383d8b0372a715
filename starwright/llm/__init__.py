"""Operators for preparing language-model training data.

Each module is one operator with a general interface over DataFrames;
``queries.py`` applies them to the driver tables.  Nothing else in the library
imports this package.

Common rules: an operator reads only the columns it is told to read and returns
its key columns plus its own results, so further columns (also ones whose names
clash with a result) never matter.  A null text counts as an empty text.  Rows
are never dropped, capped or sampled unless that is the operator's purpose.
"""
