"""Work that must not be repeated per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fields_once(struct: Column) -> Column:
    """Fields of a struct as columns, computed once per row whatever is filtered on them later.

    The optimizer pushes a filter on a projected column below the projection,
    and with it a copy of the column's expression per mention: costly when
    that parses text or walks a forest. It pushes none below a generator.
    """
    return F.inline(F.array(struct))
