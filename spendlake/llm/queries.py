"""All queries of the subpackage, in order."""

from spendlake.llm import (  # noqa: F401
    bpe_sql,
    centroids,
    grid_order,
    language,
    licenses,
    markov,
    mixing,
    quality,
    repair,
    secret_scan,
    shingles,
    token_counts,
    token_files,
)
from spendlake.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
