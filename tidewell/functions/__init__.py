"""Column-expression helpers (built-in Spark functions only, codegen friendly)."""

from .columns import clamp_index  # noqa: F401
