"""JSON of any shape as VARIANT."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_json(text: Column) -> Column:
    """The VARIANT of a text that is exactly one JSON value; NULL for any other text.

    The parser takes a value and ignores what follows it. What follows must be blank to be a whole list's
    only item and a whole object's only field at once.
    """
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    field = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    # One expression from the list to its item: named twice, the list would be parsed twice.
    only = F.transform(F.array(listed), lambda items: F.when((F.size(items) == 1) & field.isNotNull(), F.get(items, F.lit(0))))
    return F.get(only, F.lit(0))


def step(c: Column) -> Column:
    """c as a generator of one row, to select under a name: later filters on it cannot move below it and compute it again.

    As a plain column it would be written out wherever a filter uses it, and run where the table is scanned.
    """
    return F.explode_outer(F.array(c))


def fields_of(value: Column) -> Column:
    """An object's fields as a map to VARIANT; NULL for anything but an object."""
    return F.try_variant_get(value, "$", "map<string,variant>")
