"""dimsmith: Spark-native dimension and star-schema toolkit.

Type-2 and Type-2+1 histories from change feeds (full rebuild, incremental
streaming refresh, versioned MERGE), constraint audits, and wide reporting
marts whose unused joins disappear when declared keys are trusted.
"""

from dimsmith.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
