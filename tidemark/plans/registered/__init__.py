"""The queries registered on the test tables, by subject."""

from tidemark.plans.registered import (  # noqa: F401
    aggregates,
    arrays,
    census,
    files,
    flights,
    history,
    joins,
    rental,
    reviews,
    rooms,
    scalars,
    windows,
)
