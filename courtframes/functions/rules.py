"""Rules of one season as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Team-foul quotas by kind of period, the last two minutes, shot-clock resets.
QUOTA, QUOTA_OVERTIME = 4, 3
TWO_MINUTES_S, LAST_TWO_FREE = 120.0, 1
FULL_RESET_S, FRONT_RESET_S = 24.0, 14.0
# Action codes of fouls and what they are.
FOULS = {
    1: ("personal", "team"), 2: ("shooting", "team"), 3: ("loose_ball", "team"), 4: ("offensive", "other"), 5: ("inbound", "team"),
    6: ("away_from_play", "team"), 9: ("clear_path", "team"), 10: ("double_personal", "other"), 11: ("technical", "technical"),
    12: ("non_unsportsmanlike_technical", "technical"), 13: ("hanging_technical", "technical"), 14: ("flagrant_1", "team"), 15: ("flagrant_2", "team"),
    16: ("double_technical", "technical"), 17: ("defensive_3_seconds", "technical"), 18: ("delay_of_game", "technical"), 19: ("taunting", "technical"),
    25: ("excess_timeout", "technical"), 26: ("offensive_charge", "other"), 27: ("personal_block", "team"), 28: ("personal_take", "team"),
    29: ("shooting_block", "team"), 30: ("too_many_players", "technical"),
}


def quota(period: Column) -> Column:
    return F.when(period <= 4, QUOTA).otherwise(QUOTA_OVERTIME)


def in_penalty(period: Column, clock_s: Column, before: Column, last_two_before: Column) -> Column:
    return (before >= quota(period)) | ((clock_s <= TWO_MINUTES_S) & (last_two_before >= LAST_TWO_FREE))


def fouls_to_give(period: Column, clock_s: Column, before: Column, last_two_before: Column) -> Column:
    """Common fouls a team may still commit before the penalty."""
    left = F.greatest(quota(period) - before, F.lit(0))
    late = F.greatest(LAST_TWO_FREE - last_two_before, F.lit(0))
    return F.when(clock_s <= TWO_MINUTES_S, F.least(left, late)).otherwise(left)


def shot_clock_after_foul(remaining_s: Column, frontcourt: Column) -> Column:
    return F.when(frontcourt, F.greatest(remaining_s, F.lit(FRONT_RESET_S))).otherwise(FULL_RESET_S)


def foul_detail(action: Column) -> Column:
    table = F.create_map(*[F.lit(x) for k, (detail, _) in FOULS.items() for x in (k, detail)])
    return F.coalesce(table[action.cast("int")], F.lit("unknown"))


def is_team_foul(action: Column) -> Column:
    return action.isin([k for k, (_, kind) in FOULS.items() if kind == "team"])


def is_technical(action: Column) -> Column:
    """Fouls that technical free throws follow."""
    return F.coalesce(action.isin([k for k, (_, kind) in FOULS.items() if kind == "technical"]), F.lit(False))
