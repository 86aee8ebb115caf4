"""All registered queries: importing this module registers every query and twin."""

from . import registry
from . import operator_queries  # noqa: F401  (registers operator-level queries)
from . import quality_queries  # noqa: F401  (registers load, quality and report queries)
from . import rule_queries  # noqa: F401  (registers load rules, many-run log reports, long series)
from . import suite_queries  # noqa: F401  (registers the check suite)

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
