"""Reusable operators over raw, staging, unified and mart frames."""
