"""Registered queries: each pairs a Spark call with plain SQL that must give the same rows."""
