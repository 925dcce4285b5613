"""Event logs and entity metadata in, a queryable star schema out — on Spark."""

from loomstar.session import build_session, clear_scratch, scratch_path, sizing

__all__ = ["build_session", "clear_scratch", "scratch_path", "sizing"]
