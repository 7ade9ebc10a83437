"""Column-expression helpers (JVM built-ins only; no Python UDFs)."""

from stratum.functions.scalar import *  # noqa: F401,F403
