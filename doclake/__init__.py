"""doclake: document collections as Spark tables.

Every operator is a ``DataFrame -> DataFrame`` function (or a ``Column``
expression), so Catalyst sees the whole plan and nothing is collected.
"""
