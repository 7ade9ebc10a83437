from stratum.sources.tables import load, TABLES  # noqa: F401
