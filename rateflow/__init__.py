"""rateflow: rating-data analytics and recommendation on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame; nothing is
collected to the driver except bounded scalars (a fitted model, a
handful of grid results).  Column conventions:

* ratings: ``user_id LONG, item_id LONG, rating DOUBLE[, rated_at]``
* items:   ``item_id LONG, title STRING[, genres ARRAY<STRING>]``
"""

from rateflow.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
