"""Operators for preparing large language-model training data.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; :mod:`tidewater.llm.queries` registers
the thin ``opN_*`` queries that apply them to whole tables.
"""
