"""Registered queries, one module per operator family."""

from stratum.plans.catalog import aggregates, baseline, blending, matching, models, profile, publish, relational, sequence, sources, splits, tabular  # noqa: F401
