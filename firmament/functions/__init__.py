"""Column functions: built-in expressions only, no Python UDF."""

from firmament.functions import contacts, html, normalize, registry, urls  # noqa: F401
