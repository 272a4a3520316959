"""Column expressions shared by the operators (all JVM-side built-ins)."""

from reclab.functions.hashing import bucket, hash32
from reclab.functions.vectors import dot, norm

__all__ = ["bucket", "hash32", "dot", "norm"]
