"""Declared schemas and column lists.

One place for every column list the operators use, so no stage infers a
schema or slices ``df.columns`` by position.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the published feature definitions for
# results to agree (column names, category labels, thresholds, pitch size).
# ---------------------------------------------------------------------------

# Pitch: 120 x 80, goal line at x = 120, posts at y = 36 and y = 44.
PITCH_X = 120.0
PITCH_Y = 80.0
GOAL_X = 120.0
GOAL_Y1 = 36.0
GOAL_Y2 = 44.0

# Preferred foot: share of one foot at or above this makes it the preferred one.
FOOT_SHARE = 0.66
FEET = ("Right Foot", "Left Foot")
TWO_FOOTED = "Two-Footed"

# Pass height codes.
PASS_HEIGHT_CODES = {"Ground Pass": 0, "Low Pass": 1}
PASS_HEIGHT_OTHER = 2
PASS_HEIGHT_MISSING = -1
PASS_ANGLE_MISSING = 4.0
PASS_LENGTH_MISSING = 0.0

# Vendor probability at or above this counts as a predicted goal.
VENDOR_THRESHOLD = 0.5

COMPETITION_DROP = ["competition_youth", "match_updated", "competition_gender",
                    "match_updated_360", "match_available_360", "match_available"]

MATCH_DROP = ["match_status", "match_status_360", "last_updated", "last_updated_360",
              "shot_fidelity_version", "xy_fidelity_version"]

EXCLUDED_COMPETITIONS = ["Indian Super league", "Major League Soccer"]
COMPETITION_GENDER = "male"
SEASON_AFTER = "2014"

# One-hot maps: source column -> {category: output column}.
DUMMIES = {
    "play_pattern": {
        "Other": "other_pp",
        "From Free Kick": "from_fk",
        "From Throw In": "from_ti",
        "From Corner": "from_corner",
        "From Counter": "from_counter",
        "From Goal Kick": "from_gk",
        "From Keeper": "from_keeper",
        "From Kick Off": "from_ko",
        "Regular Play": "from_rp",
    },
    "shot_type": {
        "Free Kick": "fk_type",
        "Penalty": "pk_type",
    },
    "shot_technique": {
        "Half Volley": "half_volley_technique",
        "Volley": "volley_technique",
        "Lob": "lob_technique",
        "Overhead Kick": "overhead_technique",
        "Backheel": "backheel_technique",
        "Diving Header": "diving_h_technique",
    },
}

BOOL_TO_INT = ["preferred_foot_shot", "under_pressure", "shot_aerial_won",
               "shot_first_time", "shot_one_on_one",
               "shot_open_goal", "shot_follows_dribble", "goal",
               "pass_aerial_won", "pass_cross", "pass_cut_back", "pass_switch", "pass_through_ball",
               "pass_inswinging", "pass_outswinging", "pass_straight", "pass_no_touch"]

# Input columns the feature pipeline reads (plus season, competition, team_id).
EVENTS = [
    "id", "match_id", "minute", "second", "type", "period", "location", "team", "player_id", "player", "position",
    "play_pattern", "shot_body_part", "shot_technique", "shot_type", "shot_freeze_frame",
    "under_pressure", "shot_aerial_won", "shot_first_time", "shot_one_on_one",
    "shot_open_goal", "shot_follows_dribble",
    "shot_statsbomb_xg", "shot_outcome",
    "pass_body_part", "shot_end_location",
    "pass_assisted_shot_id", "pass_height", "pass_length", "pass_angle",
    "pass_aerial_won", "pass_cross", "pass_cut_back", "pass_switch", "pass_through_ball",
    "pass_inswinging", "pass_outswinging", "pass_straight", "pass_no_touch"]

# Output columns of the feature pipeline, in order (team_id is appended).
VARIABLES = [
    "id", "player", "player_id", "match_id", "team", "period", "minute", "second",
    "shot_location_x", "shot_location_y", "distance_to_goal", "shot_angle",
    "preferred_foot_shot",
    "from_rp", "from_fk", "from_ti", "from_corner", "from_counter", "from_gk", "from_keeper", "from_ko",
    "header", "fk_type", "pk_type",
    "half_volley_technique", "volley_technique", "lob_technique", "overhead_technique", "backheel_technique",
    "diving_h_technique",
    "under_pressure", "shot_aerial_won", "shot_first_time", "shot_one_on_one", "shot_open_goal",
    "shot_follows_dribble",
    "players_inside_area",
    "assisted", "pass_height", "pass_length", "pass_angle",
    "pass_aerial_won", "pass_cross", "pass_cut_back", "pass_switch", "pass_through_ball",
    "pass_inswinging", "pass_outswinging", "pass_straight", "pass_no_touch",
    "shot_outcome", "shot_end_location", "shot_end_x", "shot_end_y", "sb_prediction",
    "shot_statsbomb_xg", "goal"]

# Model inputs (40).
FEATURES = [
    "distance_to_goal", "shot_angle",
    "preferred_foot_shot",
    "from_rp", "from_fk", "from_ti", "from_corner", "from_counter", "from_gk", "from_keeper", "from_ko",
    "header", "fk_type", "pk_type",
    "half_volley_technique", "volley_technique", "lob_technique", "overhead_technique", "backheel_technique",
    "diving_h_technique",
    "under_pressure", "shot_aerial_won", "shot_first_time", "shot_one_on_one", "shot_open_goal",
    "shot_follows_dribble",
    "players_inside_area",
    "assisted", "pass_height", "pass_length", "pass_angle",
    "pass_aerial_won", "pass_cross", "pass_cut_back", "pass_switch", "pass_through_ball",
    "pass_inswinging", "pass_outswinging", "pass_straight", "pass_no_touch"]

# Model inputs without pass data (27), for estimators that need non-negative inputs.
FEATURES_NP = [
    "distance_to_goal", "shot_angle",
    "preferred_foot_shot",
    "from_rp", "from_fk", "from_ti", "from_corner", "from_counter", "from_gk", "from_keeper", "from_ko",
    "header", "fk_type", "pk_type",
    "half_volley_technique", "volley_technique", "lob_technique", "overhead_technique", "backheel_technique",
    "diving_h_technique",
    "under_pressure", "shot_aerial_won", "shot_first_time", "shot_one_on_one", "shot_open_goal",
    "shot_follows_dribble",
    "players_inside_area"]

# Value bands of the shot-distribution view, inclusive at both ends.
XG_BANDS = [(0.00, 0.25), (0.25, 0.50), (0.50, 0.75), (0.75, 1.00)]

# All columns of a landed event, in the published order.
EVENT_COLUMNS = [
    "50_50", "ball_receipt_outcome", "ball_recovery_recovery_failure", "carry_end_location", "clearance_aerial_won",
    "counterpress", "dribble_nutmeg", "dribble_outcome", "dribble_overrun", "duel_outcome", "duel_type", "duration",
    "foul_committed_advantage", "foul_committed_card", "foul_won_advantage", "foul_won_defensive",
    "goalkeeper_body_part", "goalkeeper_end_location", "goalkeeper_outcome", "goalkeeper_position",
    "goalkeeper_technique", "goalkeeper_type", "id", "index", "interception_outcome", "location", "match_id",
    "minute", "pass_aerial_won", "pass_angle", "pass_assisted_shot_id", "pass_backheel", "pass_body_part",
    "pass_cross", "pass_cut_back", "pass_deflected", "pass_end_location", "pass_goal_assist", "pass_height",
    "pass_length", "pass_outcome", "pass_recipient", "pass_recipient_id", "pass_shot_assist", "pass_switch",
    "pass_type", "period", "play_pattern", "player", "player_id", "position", "possession", "possession_team",
    "possession_team_id", "related_events", "second", "shot_aerial_won", "shot_body_part", "shot_end_location",
    "shot_first_time", "shot_freeze_frame", "shot_key_pass_id", "shot_one_on_one", "shot_outcome",
    "shot_statsbomb_xg", "shot_technique", "shot_type", "substitution_outcome", "substitution_outcome_id",
    "substitution_replacement", "substitution_replacement_id", "tactics", "team", "team_id", "timestamp", "type",
    "under_pressure", "competition", "season", "block_offensive", "foul_committed_offensive", "foul_committed_type",
    "injury_stoppage_in_chain", "pass_miscommunication", "pass_technique", "pass_through_ball", "block_deflection",
    "ball_recovery_offensive", "foul_committed_penalty", "foul_won_penalty", "shot_open_goal", "shot_redirect",
    "bad_behaviour_card", "block_save_block", "shot_deflected", "miscontrol_aerial_won", "clearance_body_part",
    "clearance_head", "clearance_left_foot", "clearance_right_foot", "goalkeeper_punched_out", "off_camera", "out",
    "pass_inswinging", "pass_outswinging", "pass_straight", "goalkeeper_shot_saved_to_post", "pass_no_touch",
    "shot_saved_to_post", "goalkeeper_success_in_play", "clearance_other", "player_off_permanent",
    "goalkeeper_shot_saved_off_target", "shot_saved_off_target", "shot_follows_dribble", "dribble_no_touch",
    "goalkeeper_lost_out", "half_start_late_video_start", "goalkeeper_lost_in_play",
    "goalkeeper_penalty_saved_to_post", "goalkeeper_saved_to_post", "goalkeeper_success_out",
]

# --------------------------------------------------------------------------- end of fixed values

# Columns of the assisting pass carried onto the shot (every pass_* input but the body part).
PASS_COLUMNS = [c for c in EVENTS if c.startswith("pass_") and c != "pass_body_part"]

# Flags of the assisting pass.
PASS_FLAGS = [c for c in PASS_COLUMNS if c in BOOL_TO_INT]

BOOLEAN_INPUTS = [c for c in BOOL_TO_INT if c not in ("preferred_foot_shot", "goal")]

# Typed freeze frame.
FRAME_PLAYER = T.StructType([
    T.StructField("location", T.ArrayType(T.DoubleType())),
    T.StructField("player", T.StructType([T.StructField("id", T.LongType()),
                                          T.StructField("name", T.StringType())])),
    T.StructField("position", T.StructType([T.StructField("id", T.IntegerType()),
                                            T.StructField("name", T.StringType())])),
    T.StructField("teammate", T.BooleanType()),
])
FRAME = T.ArrayType(FRAME_PLAYER)

# Types of the event columns that are not text.
_TYPES = {
    T.LongType(): ["match_id", "player_id", "team_id", "possession_team_id", "pass_recipient_id",
                   "substitution_outcome_id", "substitution_replacement_id"],
    T.IntegerType(): ["index", "period", "minute", "second", "possession"],
    T.DoubleType(): ["duration", "pass_angle", "pass_length", "shot_statsbomb_xg"],
}
_TYPE_OF = {c: t for t, cols in _TYPES.items() for c in cols}

# Words that make the name of a column a yes/no flag.
_FLAG_NAMES = set(BOOLEAN_INPUTS) | {
    "counterpress", "off_camera", "out", "injury_stoppage_in_chain", "ball_recovery_recovery_failure",
    "ball_recovery_offensive", "block_offensive", "block_deflection", "block_save_block", "clearance_aerial_won",
    "clearance_head", "clearance_left_foot", "clearance_right_foot", "clearance_other", "dribble_nutmeg",
    "dribble_overrun", "dribble_no_touch", "foul_committed_advantage", "foul_committed_offensive",
    "foul_committed_penalty", "foul_won_advantage", "foul_won_defensive", "foul_won_penalty",
    "goalkeeper_punched_out", "goalkeeper_shot_saved_to_post", "goalkeeper_success_in_play",
    "goalkeeper_shot_saved_off_target", "goalkeeper_lost_out", "goalkeeper_lost_in_play",
    "goalkeeper_penalty_saved_to_post", "goalkeeper_saved_to_post", "goalkeeper_success_out",
    "half_start_late_video_start", "miscontrol_aerial_won", "pass_backheel", "pass_deflected", "pass_goal_assist",
    "pass_miscommunication", "pass_shot_assist", "player_off_permanent", "shot_deflected", "shot_redirect",
    "shot_saved_off_target", "shot_saved_to_post"}

# Declared event schema.  Readers conform any landed file to this (missing ->
# typed null, extras dropped).
EVENT_SCHEMA = T.StructType([
    T.StructField(c, _TYPE_OF.get(c, T.BooleanType() if c in _FLAG_NAMES else T.StringType()))
    for c in EVENT_COLUMNS])

COMPETITION_SCHEMA = T.StructType([
    T.StructField("competition_id", T.IntegerType()),
    T.StructField("season_id", T.IntegerType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("competition_name", T.StringType()),
    T.StructField("competition_gender", T.StringType()),
    T.StructField("competition_youth", T.BooleanType()),
    T.StructField("competition_international", T.BooleanType()),
    T.StructField("season_name", T.StringType()),
    T.StructField("match_updated", T.StringType()),
    T.StructField("match_updated_360", T.StringType()),
    T.StructField("match_available_360", T.StringType()),
    T.StructField("match_available", T.StringType()),
])

MATCH_SCHEMA = T.StructType([
    T.StructField("match_id", T.LongType()),
    T.StructField("competition_id", T.IntegerType()),
    T.StructField("season_id", T.IntegerType()),
    T.StructField("competition", T.StringType()),
    T.StructField("season", T.StringType()),
    T.StructField("match_date", T.StringType()),
    T.StructField("home_team", T.StringType()),
    T.StructField("away_team", T.StringType()),
    T.StructField("home_score", T.IntegerType()),
    T.StructField("away_score", T.IntegerType()),
    T.StructField("match_status", T.StringType()),
    T.StructField("match_status_360", T.StringType()),
    T.StructField("last_updated", T.StringType()),
    T.StructField("last_updated_360", T.StringType()),
    T.StructField("shot_fidelity_version", T.StringType()),
    T.StructField("xy_fidelity_version", T.StringType()),
])

LINEUP_PLAYER = T.StructType([
    T.StructField("player_id", T.LongType()),
    T.StructField("player_name", T.StringType()),
    T.StructField("jersey_number", T.IntegerType()),
    T.StructField("country", T.StringType()),
])

LINEUP_SCHEMA = T.StructType([
    T.StructField("match_id", T.LongType()),
    T.StructField("teams", T.MapType(T.StringType(), T.ArrayType(LINEUP_PLAYER))),
])

# CSV files as pandas writes them: quotes inside a field are doubled
CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "multiLine": "false"}
