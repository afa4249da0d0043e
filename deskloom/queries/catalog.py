"""All registered queries."""

from deskloom.queries import cases, corpora, evaluation, scalars, streams  # noqa: F401
from deskloom.queries.registry import ORACLE, QUERIES  # noqa: F401
