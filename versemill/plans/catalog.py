"""All registered queries."""

from versemill.plans import (  # noqa: F401  (importing a module registers its queries)
    cleaning,
    comparing,
    evaluation,
    features,
    files,
    modelling,
    sampling,
    similarity,
    texts,
)
from versemill.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
