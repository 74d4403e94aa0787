"""Scans of the input tables.

Scans are plain ``spark.read.parquet``; column pruning and filter pushdown
happen in Catalyst because every operator names only the columns it uses.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


@dataclass
class Tables:
    """Lazy parquet scans of a directory holding ``<name>.parquet`` tables."""
    spark: SparkSession
    root: str
    _cache: dict = field(default_factory=dict)

    def __call__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(os.path.join(self.root, f"{name}.parquet"))
        return self._cache[name]


def key_ranges(key: str, bounds: list) -> list[str]:
    """Predicates that deal the rows of a table by ranges of ``key``: every row, also
    with a null key, satisfies exactly one. ``bounds``: split values, e.g. quantiles."""
    def text(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    cuts = [text(b) for b in sorted({b for b in bounds if b is not None})]
    if not cuts:
        return ["1 = 1"]
    middle = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"({key} < {cuts[0]} OR {key} IS NULL)", *middle, f"{key} >= {cuts[-1]}"]


def quantile_bounds_query(role: str, key: str, parts: int) -> str:
    """Subquery (for ``dbtable``) whose one row holds the split values of ``parts`` ranges of about equal size."""
    picks = ", ".join(f"percentile_disc({i / parts!r}) WITHIN GROUP (ORDER BY {key}) AS b{i}" for i in range(1, parts))
    return f"(SELECT {picks} FROM {role}) AS bounds"


def read_key_bounds(spark: SparkSession, url: str, role: str, key: str, parts: int, options: dict[str, str] | None = None) -> list:
    """Split values of a database table, taken by the database itself (one row comes back)."""
    reader = spark.read.format("jdbc").options(**(options or {})).option("url", url)
    return list(reader.option("dbtable", quantile_bounds_query(role, key, parts)).load().first())


TEXT_FORMATS = ("csv", "json", "text", "xml")


def as_role(df: DataFrame, role: T.StructType) -> DataFrame:
    """``df`` with the role's columns: nested columns and JSON text keep their type, scalars are cast."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    own = {f.name.lower(): f for f in df.schema}

    def column(f: T.StructField):
        have = own.get(f.name.lower())
        if have is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f"`{have.name}`")
        keep = isinstance(have.dataType, nested) or (isinstance(have.dataType, T.StringType) and isinstance(f.dataType, nested))
        return (c if keep else c.cast(f.dataType)).alias(f.name)
    return df.select(*[column(f) for f in role])


def read_role_tables(spark: SparkSession, root: str, fmt: str = "parquet", roles=None,
                     options: dict[str, str] | None = None, schemas: dict[str, str] | None = None,
                     jdbc_bounds: dict[str, tuple[str, list]] | None = None):
    """Production entry: the role tables under ``root``.

    Formats that state their own types (Parquet, ORC, JDBC, catalog formats)
    are read with them: scalars are cast to the role's type, nested columns
    (arrays, maps, structs) and JSON text stay as they are, a column that the
    files lack is null. Text formats are read with the role's schema;
    ``schemas`` overrides single ones.

    One folder per role; with ``fmt="jdbc"`` ``root`` is the database URL and
    each role is a table; ``jdbc_bounds`` (role -> key and split values) reads
    a role's table by several tasks. Roles left out of ``roles`` are empty tables.
    """
    from paylens.sources.bindings import ROLES, RoleTables
    from paylens.sources.schemas import ROLE_SCHEMAS
    wanted, schemas = set(roles or ROLES), {**ROLE_SCHEMAS, **(schemas or {})}
    if wanted - set(ROLES):
        raise ValueError(f"unknown roles: {sorted(wanted - set(ROLES))}")

    def read(role):
        if role not in wanted:
            return spark.createDataFrame([], schemas[role])
        reader = spark.read.format(fmt).options(**(options or {}))
        if fmt in TEXT_FORMATS:
            return reader.schema(schemas[role]).load(os.path.join(root, role))
        if fmt != "jdbc":
            df = reader.load(os.path.join(root, role))
        elif role in (jdbc_bounds or {}):
            df = spark.read.jdbc(root, role, predicates=key_ranges(*jdbc_bounds[role]), properties=options or {})
        else:
            df = reader.option("url", root).option("dbtable", role).load()
        return as_role(df, T.StructType.fromDDL(schemas[role]))
    return RoleTables(**{r: read(r) for r in ROLES})
