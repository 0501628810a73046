"""What a JSON field is: absent, null, of another type, or as expected."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OK, ABSENT, NULL, MISTYPED = "OK", "ABSENT", "NULL", "MISTYPED"

#: Types that a JSON value may have where a field has this type.
_TYPES = {"bigint": "^BIGINT$", "double": r"^(BIGINT|DOUBLE|DECIMAL\(.*\))$", "string": "^STRING$", "boolean": "^BOOLEAN$"}


def field_status(value: Column, name: str, kind: str) -> Column:
    """Status of the field ``name`` of a VARIANT object; NULL for a NULL value.
    A value that is no object has no fields."""
    field = F.try_variant_get(value, f"$.{name}", "variant")
    status = (
        F.when(field.isNull(), F.lit(ABSENT))
        .when(F.is_variant_null(field), F.lit(NULL))
        .when(~F.schema_of_variant(field).rlike(_TYPES[kind]), F.lit(MISTYPED))
        .otherwise(F.lit(OK))
    )
    return F.when(value.isNotNull(), status)
