"""cinerank: recommender analytics as Spark DataFrame jobs.

Every public operator takes DataFrames and returns a DataFrame. The heavy
steps (pair similarity, top-k neighbours, profile products, TF-IDF,
factorisation, evaluation) are joins, windows and aggregations planned by
Catalyst; Python only runs inside Arrow-batched pandas UDFs where no
built-in expression exists (stemming, block SGD).
"""

from cinerank.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
