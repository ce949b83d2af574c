"""All registered queries; importing a module registers its queries."""

from gleaner.plans import documents, evaluation, graphs, retrieval, streams  # noqa: F401
from gleaner.plans.registry import ORACLES, QUERIES  # noqa: F401
