"""Operations of change records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"


def operation(code: Column) -> Column:
    """r and c insert, u updates, d deletes; any other code is null."""
    return F.when(code.isin("r", "c"), INSERT).when(code == "u", UPDATE).when(code == "d", DELETE)


def flat_operation(header: Column, deleted: Column, field: Column) -> Column:
    """Operation of a flattened record: its header, then the deletion mark, then its field, else an insert.

    An unknown code in the header or the field inserts, as no code does.
    """
    insert = F.lit(INSERT)
    return F.when(header.isNotNull(), F.coalesce(operation(header), insert)).when(F.lower(deleted.cast("string")) == "true", DELETE).otherwise(F.coalesce(operation(field), insert))


def payload(op: Column, before: Column, after: Column) -> Column:
    """The row image that counts: the one before a deletion, else the one after."""
    return F.when(op == DELETE, before).otherwise(after)
