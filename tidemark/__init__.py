"""Keep wide tables in step with feeds of semi-structured records, on Spark."""

from tidemark.meta import MetaColumns
from tidemark.session import build_session, configure, scratch_dir

__all__ = ["MetaColumns", "build_session", "configure", "scratch_dir"]
