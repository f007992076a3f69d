"""Named conformance queries, one module per operator family.

Importing this package registers every query in ``registry``.
"""

from lakeshard.plans import (  # noqa: F401
    core,
    maintenance,
    relational,
    joins,
    aggregates,
    windows,
    ordering,
    setops,
    scalars,
    generators,
    storage,
)
