"""Social-post analytics on Spark: ingest, enrichment, ad labelling, place matching, label checks."""

from postsieve.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
