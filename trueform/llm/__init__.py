"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage. Each module holds one
operator built by one stated method; ``queries`` registers them over the driver
tables. Shared helpers: ``common`` (saved tables, Arrow batches), ``textbytes``
(vectorised hashing of words and byte windows), ``components`` (connected
components).
"""
