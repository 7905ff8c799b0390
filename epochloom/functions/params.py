"""Reading message parameters, which are JSON text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: an address entry that names the storage-market actor.
MARKET_ADDRESS = r'"Address"\s*:\s*"f05"'


def array_length(params: Column, field: str) -> Column:
    """Elements of the named top-level array: 0 if empty; NULL if missing or not an array."""
    return F.json_array_length(F.get_json_object(params, f"$.{field}")).cast("bigint")


def array_elements(params: Column, field: str) -> Column:
    """The named array with each element kept as its own JSON text."""
    return F.from_json(F.get_json_object(params, f"$.{field}"), "array<string>")


def parsed_arrays(params: Column, names: Iterable[str]) -> Column:
    """The named top-level arrays in a struct, each element as its own JSON text, in one parse.

    A name that is missing or not an array is NULL; text that is no JSON object has no arrays.
    """
    fields = ", ".join(f"`{name}`: ARRAY<STRING>" for name in sorted(set(names)))
    return F.from_json(params, f"STRUCT<{fields}>")


#: The column that holds parameters parsed when they were stored.
VARIANT = "params_variant"


def with_variant(messages: DataFrame) -> DataFrame:
    """The messages with their parameters also as VARIANT, for storing; parsed once and for all.

    NULL where the text is no JSON, or names one field twice in an object.
    """
    return messages.withColumn(VARIANT, F.try_parse_json("params"))


def message_arrays(messages: DataFrame, names: Iterable[str]) -> Column:
    """`parsed_arrays` of the messages' parameters, from the VARIANT column where there is one."""
    if VARIANT not in messages.columns:
        return parsed_arrays(F.col("params"), names)
    return F.struct(
        *[
            F.try_variant_get(VARIANT, f"$.{name}", "array<string>").alias(name)
            for name in sorted(set(names))
        ]
    )


def array_names(fields: Mapping[str, Sequence[str]]) -> list[str]:
    return sorted({name for names in fields.values() for name in names})


def param_count(
    method: Column, arrays: Column, fields: Mapping[str, Sequence[str]]
) -> Column:
    """Sector count of a message from the parsed arrays: the first of its method's that is there."""
    branches = F
    for name, keys in fields.items():
        sizes = [F.array_size(arrays[key]).cast("bigint") for key in keys]
        branches = branches.when(method == name, F.coalesce(*sizes))
    return branches.otherwise(F.lit(1).cast("bigint"))


def notifies_market(activation: Column) -> Column:
    """Whether any address under the activation's pieces is the market actor.

    Missing or null pieces make no call.
    """
    pieces = F.get_json_object(activation, "$.Pieces")
    return F.coalesce(pieces.rlike(MARKET_ADDRESS), F.lit(False))


def notifies_market_strict(activation: Column) -> Column:
    """As above, but only addresses under a piece's Notify list count."""
    notify = F.get_json_object(activation, "$.Pieces[*].Notify")
    return F.coalesce(notify.rlike(MARKET_ADDRESS), F.lit(False))
