"""Workspace: bound role tables and the materialised, scored feature store.

The store is the shared input of every analysis, so it is built once per
(session, data directory, config) and written as a Parquet table under the
shared ``spark.checkpoint.dir``, then read back. That cuts the lineage:
losing an executor costs a re-read, not a rebuild of nine aggregations,
and every analysis plans against a two-line scan instead of the whole
store derivation. ``materialize="cache"`` persists instead (the lineage is
deterministic -- every tie has an explicit tie-break -- so a lost block
recomputes to the same rows).

``release()`` removes the tables. ``workspace()`` reuses one per session
while the config and the input files (paths, sizes, modification times) are
the same; otherwise it releases the old one and builds anew, so frames
taken from the old workspace must not be used after that.
"""

from __future__ import annotations

import os
import uuid
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.config import FIXTURE_PROFILE, Config
from paylens.session import ensure_checkpoint_dir
from paylens.sources import files
from paylens.sources.bindings import RoleTables, bind_fixture_tables
from paylens.sources.tables import Tables

# what the role bindings and the revenue binding read
SOURCE_TABLES = ("customer", "nation", "orders", "lineitem", "events", "documents")
_CACHE: dict = {}


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: Config = FIXTURE_PROFILE,
                 materialize: str = "auto", roles: RoleTables | None = None, revenue: DataFrame | None = None):
        """``roles`` and ``revenue``: production inputs; without them the test
        tables under ``sf_dir`` play their parts."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg
        self.tables = Tables(spark, sf_dir)
        self.materialize = "table" if materialize == "auto" else materialize
        self._written: list[str] = []
        self._tables: list[str] = []
        if roles is not None:
            self.__dict__["roles"] = roles
        if revenue is not None:
            self.__dict__["revenue"] = revenue

    def _materialize(self, df: DataFrame, name: str) -> DataFrame:
        if self.materialize == "table":
            path = self.output_folder(name)
            df.write.mode("overwrite").parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)
        return df.persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def roles(self) -> RoleTables:
        return bind_fixture_tables(self.tables)

    @cached_property
    def revenue(self) -> DataFrame:
        """The second revenue source: revenue_usd, active_users_28d."""
        from paylens.sources.revenue import lineitem_revenue_source
        return lineitem_revenue_source(self.tables)

    @cached_property
    def store(self) -> DataFrame:
        from paylens.operators.features import feature_store
        from paylens.operators.propensity import with_propensity
        return self._materialize(with_propensity(feature_store(self.roles, self.economy, gathered=True), self.cfg), "store")

    @cached_property
    def economy(self) -> DataFrame:
        from paylens.operators.economy import player_game_economy
        econ = player_game_economy(self.roles.game_session, self.roles.player.schema["player_id"].dataType)
        return self._materialize(econ, "economy")

    def output_folder(self, name: str) -> str:
        """A fresh shared folder for files of this workspace; ``release`` removes it."""
        path = os.path.join(ensure_checkpoint_dir(self.spark), f"paylens-{name}-{uuid.uuid4().hex}")
        self._written.append(path)
        return path

    @cached_property
    def spend_sketches(self) -> DataFrame:
        """Quantile sketches by tenant and sign-up month."""
        from paylens.operators.sketches import spend_sketches
        return self._materialize(spend_sketches(self.store, ("acquisition_source",)), "spend-sketches")

    @cached_property
    def buyer_sketches(self) -> DataFrame:
        """Sketches of the distinct buyers by product and month."""
        from paylens.operators.sketches import audience_sketches
        done = self.roles.pcoin_transaction.filter(F.col("status").cast("string") == "completed")
        return self._materialize(audience_sketches(done, "player_id", ("product_id",)), "buyer-sketches")

    @cached_property
    def bucketed(self) -> tuple[DataFrame, DataFrame]:
        """The store without its score, and the score, as tables bucketed and sorted by player."""
        from paylens.sources.sinks import write_bucketed
        out = []
        for name, df in (("store", self.store.drop("propensity", "is_holdout")),
                         ("score", self.store.select("player_id", "propensity", "is_holdout"))):
            table = f"paylens_{name}_{uuid.uuid4().hex}"
            self._tables.append(table)
            out.append(write_bucketed(df, table, self.output_folder(f"bucketed-{name}"), "player_id"))
        return tuple(out)

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose the store (``player_features``), the game economy
        (``pgs``) and the nine role tables as session temp views for SQL."""
        names = []
        for name, df in (("player_features", self.store), ("pgs", self.economy), *self.roles.as_dict().items()):
            df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def release(self):
        """Remove the materialised tables; the workspace builds them again if used again."""
        self.__dict__.pop("bucketed", None)
        for table in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()
        for name in ("store", "economy", "spend_sketches", "buyer_sketches"):
            df = self.__dict__.pop(name, None)
            if df is not None and self.materialize == "cache":
                df.unpersist()
        self.__dict__.pop("_analyses", None)
        for path in self._written:
            files.delete(self.spark, path)
        self._written.clear()


def workspace(spark: SparkSession, sf_dir: str, cfg: Config = FIXTURE_PROFILE) -> Workspace:
    root = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, root, cfg)
    now = tuple(files.identity(spark, f"{root}/{t}.parquet") for t in SOURCE_TABLES)
    seen, ws = _CACHE.get(key, (None, None))
    if ws is None or seen != now:
        if ws is not None:
            ws.release()
        ws = Workspace(spark, root, cfg)
        _CACHE[key] = (now, ws)
    return ws
