"""Sources (S1-S15): JDBC/warehouse scans, delimited files, sheet envelopes,
file unions with provenance, latest-file pick, inline tables."""

from carelake.sources.readers import *  # noqa: F401,F403
