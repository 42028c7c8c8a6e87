"""Parameters shared by the Spark queries and their SQL oracles.

Fixed values that must equal the reference's defaults for equal results:
    neighbours kept per user (k)            = 50
    minimum co-rated items (batch, >=)      = 10
    minimum correlation (exclusive, >)      = 0.3
    smoothing factor (shrinkage lambda)     = 5
    rating clip                             = 1 .. 5
    page size                               = default 20, at most 100
    similarity blocks                       = 1000
    notebook form: k = 50, support > 10 (strict), C = 5
"""

from __future__ import annotations

# --- fixed values (reference defaults) -------------------------------------
K_NEIGHBORS = 50
N_BLOCKS = 1000
MIN_SUPPORT = 10
MIN_CORR = 0.3
SMOOTHING = 5
RATING_MIN = 1
RATING_MAX = 5
PAGE_SIZE = 20
MAX_PAGE_SIZE = 100
NOTEBOOK_K = 50
NOTEBOOK_MIN_SUPPORT = 10
NOTEBOOK_C = 5

# --- our own choices ---------------------------------------------------------
# Similarity blocks of the registered queries, whatever the table's size; a
# caller passes the count that suits the table (see N_BLOCKS).
QUERY_BLOCKS = 8
# Users of one side of a training tile pair, and users and neighbours of one
# scoring task: the sizes that bound a task, without influence on any result.
TRAIN_TILE = 1024
STRIP_TILES = 32
# Tiles and ratings of a strip where a task keeps the k best of its users, and
# the tasks that fewer strips should still give.
TOP_STRIP_TILES = 128
STRIP_RATINGS = 6_000_000
TRAIN_TASKS = 32
SCORE_TILE = 32768
NEAR_TILE = 1 << 20
# Candidate rows of one scoring task, the ratings that it holds, and the tasks that fewer strips should still give.
STRIP_ROWS = 512_000_000
NEAR_ROWS = 32_000_000
SCORE_TASKS = 16
# Block mixing hash ((user mod P) * A + B) mod P, then mod n_blocks.  Plain
# 64-bit integer arithmetic ((P-1) * A + B < 2^63), so Spark and the SQL
# oracle compute identical blocks, and any id pattern is spread evenly.
BLOCK_PRIME = 2147483647
BLOCK_MULT = 1000000007
BLOCK_ADD = 12345
# Correlations are rounded before threshold and ranking so that engines agree.
CORR_DIGITS = 9
# Doubles in registered query outputs are rounded to this many digits.
OUT_DIGITS = 6
# The similarity queries map parts onto this many items, so that users share
# items as they do in rating data; all other queries keep the part keys.
DENSE_ITEMS = 100

# Pieces that an item's block of lines is rendered in, whatever the table's size.
BLOCK_PIECES = 8

# Default subjects / parameters of the registered single-user style queries.
DEFAULT_SUBJECT_USERS = (1, 2, 3)
DEFAULT_PAIR = (1, 2)
DEFAULT_FILTER_ITEMS = (1, 2)
DEFAULT_VERSION_OLD = "1998-01-01"
DEFAULT_VERSION_NEW = "2002-01-01"
