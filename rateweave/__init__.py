"""rateweave: ratings analytics and user-based neighbour recommendation on Spark.

Every public function takes and returns DataFrames (plus plain parameters);
nothing is collected to the driver except single scalars where Spark needs a
Python value (for example the length of an id list).

Sub-packages
------------
sources    table readers, the derived ratings/items views, text scans, sinks
functions  reusable column expressions (Pearson from moments, shrinkage, ...)
operators  relational building blocks (stats, similarity, neighbours, ...)
plans      composite jobs and the query registry used by ``__spark_entry__``

The most used entry points are re-exported here.
"""

from .operators.predict import recommend, recommend_for_users
from .operators.serving import recommendation_pages, users_page, users_rated_all
from .operators.stats import normalize_ratings, user_stats
from .plans.train import recommend_all, train_neighbors, train_neighbors_for
from .sources.versioned import latest_version, materialize, release, write_versioned
from .sources.views import load_items, load_ratings

__all__ = [
    "load_ratings", "load_items", "user_stats", "normalize_ratings",
    "train_neighbors", "train_neighbors_for", "recommend_all", "recommend",
    "recommend_for_users", "recommendation_pages", "users_page", "users_rated_all",
    "write_versioned", "latest_version", "materialize", "release",
]
