"""bugtide: a Spark-native engine for issue-tracker data.

Scalars are ``Column -> Column`` functions (``bugtide.functions``), table steps
are ``DataFrame -> DataFrame`` functions (``bugtide.operators``) that compose
with ``df.transform``; readers and writers live in ``bugtide.sources`` and whole
jobs in ``bugtide.plans``.
"""
