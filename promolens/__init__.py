"""Promotion and funnel analytics on Spark."""

from promolens.config import RunConfig

__all__ = ["RunConfig"]
