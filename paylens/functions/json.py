"""Semi-structured helpers that accept JSON text, typed columns or VARIANT.

The source tables keep several attributes as JSON documents; typed
ingestion (arrays, maps) and VARIANT, which is parsed once when it is
written, are preferred and supported by the same calls. All three give the
same results on the same documents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def array_len(col: Column, dtype: T.DataType) -> Column:
    """Element count of a JSON array text or an array column; NULL -> 0.

    A JSON value that is not an array counts as NULL (ignored by sums).
    """
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.json_array_length(F.coalesce(col, F.lit("[]"))),
                          F.when(col.isNull(), F.lit(0)))
    if isinstance(dtype, T.VariantType):
        col, absent = F.try_variant_get(col, "$", "array<variant>"), col.isNull()
        return F.when(absent, F.lit(0)).when(col.isNotNull(), F.size(col))
    return F.when(col.isNull(), F.lit(0)).otherwise(F.size(col))


def key_count(col: Column, dtype: T.DataType) -> Column:
    """Key count of a JSON object text or a map column; NULL -> 0."""
    if isinstance(dtype, T.StringType):
        keys = F.json_object_keys(F.coalesce(col, F.lit("{}")))
        return F.when(keys.isNotNull(), F.size(keys))
    if isinstance(dtype, T.VariantType):
        col, absent = F.try_variant_get(col, "$", "map<string,variant>"), col.isNull()
        return F.when(absent, F.lit(0)).when(col.isNotNull(), F.size(col))
    return F.when(col.isNull(), F.lit(0)).otherwise(F.size(col))


def participant_ids(col: Column, dtype: T.DataType, key: str = "playerId") -> Column:
    """Participant id texts of a session as ``array<string>``.

    JSON text: only a top-level array is unnested (a bare object or broken
    text yields no participants; ``from_json`` alone would wrap an object
    into a one-element array). Each element is read on its own, so an
    element that is not an object (a number, a string, null) gives a NULL
    id without discarding its siblings -- parsing the array as
    ``array<map<...>>`` would null the whole array on one odd element.
    Typed input: an array of ids or of structs with ``key``.
    """
    if isinstance(dtype, T.StringType):
        elems = F.from_json(col, T.ArrayType(T.StringType()))
        ids = F.transform(elems, lambda e: F.get_json_object(e, f"$.{key}"))
        return F.when(F.json_array_length(col).isNotNull(), ids)
    if isinstance(dtype, T.VariantType):
        return F.transform(F.try_variant_get(col, "$", "array<variant>"), lambda e: F.try_variant_get(e, f"$.{key}", "string"))
    elem = dtype.elementType if isinstance(dtype, T.ArrayType) else None
    if isinstance(elem, T.StructType):
        return F.transform(col, lambda s: s[key].cast("string"))
    return F.transform(col, lambda x: x.cast("string"))


def id_texts(col: Column, dtype: T.DataType) -> Column:
    """Winner ids (``text[]`` / ``array<long>``) as ``array<string>``."""
    if isinstance(dtype, T.StringType):
        return F.from_json(col, T.ArrayType(T.StringType()))
    if isinstance(dtype, T.VariantType):
        return F.try_variant_get(col, "$", "array<string>")
    return F.transform(col, lambda x: x.cast("string"))


def object_fields(col: Column, dtype: T.DataType, fields: tuple[str, ...]) -> Column:
    """The named fields of a JSON object as a struct of texts, the document parsed once.

    Texts are given plainly, arrays and objects as JSON text; a missing field,
    a JSON null and a value that is no object are NULL."""
    if not isinstance(dtype, T.VariantType):
        return F.from_json(col, T.StructType([T.StructField(f, T.StringType()) for f in fields]))

    def text(f: str) -> Column:
        value = F.try_variant_get(col, f"$.{f}", "variant")
        nested = F.schema_of_variant(value).rlike("^(ARRAY|OBJECT)")
        plain = F.try_variant_get(col, f"$.{f}", "string")
        return F.when(F.coalesce(F.is_variant_null(value), F.lit(True)), F.lit(None)).when(nested, F.to_json(value)).otherwise(plain)
    return F.struct(*[text(f).alias(f) for f in fields])
