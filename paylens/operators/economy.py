"""Per-player game economy from session participants.

Each session is unnested into one row per participant (a player listed
twice counts twice), then collapsed per player with a partially
aggregated ``groupBy``. The win flag compares the raw id text against the
winners before the id is normalised into the store's key type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.functions.exact import MONEY
from paylens.functions.json import id_texts, participant_ids


def player_game_economy(game_session: DataFrame, key_type: T.DataType = T.LongType()) -> DataFrame:
    ids = participant_ids(F.col("participants"), game_session.schema["participants"].dataType)
    winners = id_texts(F.col("winner_ids"), game_session.schema["winner_ids"].dataType)
    rows = (game_session
            .select(F.explode(ids).alias("pid"), winners.alias("winners"), "bet_amount", "total_pot")
            .filter(F.col("pid").isNotNull()))
    win = F.coalesce(F.array_contains(F.col("winners"), F.col("pid")), F.lit(False))
    key = F.lower(F.col("pid"))
    # an id text that is not a valid key drops out instead of failing the job
    keyed = rows.withColumn("player_id", key.try_cast(key_type)).filter(F.col("player_id").isNotNull())
    return (keyed.groupBy("player_id")
            .agg(F.count("*").alias("games"),
                 F.sum("bet_amount").cast(MONEY).alias("wagered"),
                 F.count(F.when(win, 1)).alias("wins"),
                 F.coalesce(F.sum(F.when(win, F.col("total_pot"))), F.lit(0)).cast(MONEY).alias("won")))
