"""Canonical role schemas (explicit, no inference), FIXTURES.md section 1.

Semi-structured attributes are JSON text here (the source's shape). Files
that hold them as typed arrays and maps keep those types (``tables.as_role``);
the same operators take both.
"""

from __future__ import annotations

ROLE_SCHEMAS = {
    "player": ("player_id bigint, created_at timestamp_ntz, last_seen timestamp_ntz, country_code string, "
               "gender string, language string, acquisition_source string, invited_by bigint, "
               "is_deleted boolean, pcoins double, coins double, login_dates array<date>"),
    "survey_response": "survey_id bigint, player_id bigint, created_at timestamp_ntz, responses string",
    "player_room": "player_id bigint, current_streak int",
    "room": "manager_id bigint, furniture_objects string, wardrobe_items string",
    "game_session": ("session_id bigint, host_player_id bigint, game_type string, bet_amount decimal(18,2), "
                     "total_pot decimal(18,2), participants string, winner_ids array<string>, "
                     "created_at timestamp_ntz"),
    "pet_feeding": "player_id bigint, created_at timestamp_ntz",
    "arcade_score": "player_id bigint, created_at timestamp_ntz",
    "pcoin_transaction": ("tx_id bigint, player_id bigint, product_id string, price decimal(18,2), "
                          "status string, created_at timestamp_ntz"),
    "prime_subscription_event": "player_id bigint, price decimal(18,2), event_type string, created_at timestamp_ntz",
}
