"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the ratings / items views) in
full.  Doubles are rounded to ``OUT_DIGITS`` (correlations keep their
``CORR_DIGITS`` rounding) so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..constants import DENSE_ITEMS, OUT_DIGITS
from ..sources.versioned import materialize
from ..sources.views import load_items, load_ratings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# exact decimal quantities (9-digit correlations and their exact sums) are
# left unrounded: both engines produce the same double for them.
EXACT = ("corr", "score", "corr_sum")


def rounded(df: DataFrame, keep: tuple[str, ...] = EXACT) -> DataFrame:
    """Round double columns for cross-engine comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in keep:
            cols.append(F.round(F.col(f.name), OUT_DIGITS).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


class Ctx:
    """Inputs of one query call.

    ``materialize=True``: the ratings view is written once as parquet in the
    shared checkpoint folder and every branch of the plan (training, scoring,
    titles, totals) reads that table instead of recomputing the
    lineitem x orders join.  Queries that touch only a few users keep the
    lazy view, so their filter reaches the parquet scan.

    ``dense=True``: parts are mapped onto DENSE_ITEMS items, the fixture of
    the queries that need users who share items.  All others keep the part
    keys, so their catalogue grows with the tables.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = False, dense: bool = False):
        self.spark, self.sf_dir, self.materialize = spark, sf_dir, materialize
        self.n_items = DENSE_ITEMS if dense else None
        self._ratings = None
        self._items = None

    @property
    def ratings(self) -> DataFrame:
        if self._ratings is None:
            view = load_ratings(self.spark, self.sf_dir, self.n_items)
            self._ratings = materialize(view, "ratings") if self.materialize else view
        return self._ratings

    @property
    def items(self) -> DataFrame:
        if self._items is None:
            self._items = load_items(self.spark, self.sf_dir, self.ratings, self.n_items)
        return self._items


def all_queries() -> dict[str, Query]:
    # importing the query modules fills QUERIES
    from . import queries_core, queries_serving, queries_io  # noqa: F401
    return dict(QUERIES)
