"""DuckDB oracle text for the registered queries.

Each query body runs after the CTEs returned by :func:`shots_ctes`, which
restate the feature pipeline over the binding view ``b`` in plain SQL.  The
text is only ever executed by the external checker, never by this library.
"""

from __future__ import annotations

from pitchlake.binding import BINDING_SQL, FRAME_SQL
from pitchlake.schemas import PASS_FLAGS

_PASS_FLAGS_SQL = ", ".join(PASS_FLAGS)

_TRI_WHOLE = "abs(s.x*(36e0-44e0) + 120e0*(44e0-s.y) + 120e0*(s.y-36e0))/2e0"
_TRI_PARTS = ("(abs(s.x*(36e0-fr.py) + 120e0*(fr.py-s.y) + fr.px*(s.y-36e0))/2e0"
              " + abs(s.x*(44e0-fr.py) + 120e0*(fr.py-s.y) + fr.px*(s.y-44e0))/2e0"
              " + abs(fr.px*(44e0-36e0) + 120e0*(36e0-fr.py) + 120e0*(fr.py-44e0))/2e0)")

SHOT_COLUMNS_SQL = """s.id, s.player, s.player_id, s.match_id, s.team, s.period, s.minute, s.second,
  s.x AS shot_location_x, s.y AS shot_location_y,
  round(sqrt(pow(s.x-120e0,2)+pow(s.y-40e0,2)),2) AS distance_to_goal,
  round(degrees(atan2(abs((120e0-s.x)*8e0), (120e0-s.x)*(120e0-s.x)+(36e0-s.y)*(44e0-s.y))),6) AS shot_angle,
  CASE WHEN f.preferred_foot='Two-Footed' AND s.shot_body_part IN ('Right Foot','Left Foot') THEN 1
       WHEN f.preferred_foot = s.shot_body_part THEN 1 ELSE 0 END AS preferred_foot_shot,
  CASE WHEN s.play_pattern='Regular Play' THEN 1 ELSE 0 END AS from_rp,
  CASE WHEN s.play_pattern='From Free Kick' THEN 1 ELSE 0 END AS from_fk,
  CASE WHEN s.play_pattern='From Throw In' THEN 1 ELSE 0 END AS from_ti,
  CASE WHEN s.play_pattern='From Corner' THEN 1 ELSE 0 END AS from_corner,
  CASE WHEN s.play_pattern='From Counter' THEN 1 ELSE 0 END AS from_counter,
  CASE WHEN s.play_pattern='From Goal Kick' THEN 1 ELSE 0 END AS from_gk,
  CASE WHEN s.play_pattern='From Keeper' THEN 1 ELSE 0 END AS from_keeper,
  CASE WHEN s.play_pattern='From Kick Off' THEN 1 ELSE 0 END AS from_ko,
  CASE WHEN s.shot_body_part='Head' THEN 1 ELSE 0 END AS header,
  CASE WHEN s.shot_type='Free Kick' THEN 1 ELSE 0 END AS fk_type,
  CASE WHEN s.shot_type='Penalty' THEN 1 ELSE 0 END AS pk_type,
  CASE WHEN s.shot_technique='Half Volley' THEN 1 ELSE 0 END AS half_volley_technique,
  CASE WHEN s.shot_technique='Volley' THEN 1 ELSE 0 END AS volley_technique,
  CASE WHEN s.shot_technique='Lob' THEN 1 ELSE 0 END AS lob_technique,
  CASE WHEN s.shot_technique='Overhead Kick' THEN 1 ELSE 0 END AS overhead_technique,
  CASE WHEN s.shot_technique='Backheel' THEN 1 ELSE 0 END AS backheel_technique,
  CASE WHEN s.shot_technique='Diving Header' THEN 1 ELSE 0 END AS diving_h_technique,
  coalesce(CAST(s.under_pressure AS INT),0) AS under_pressure,
  coalesce(CAST(s.shot_aerial_won AS INT),0) AS shot_aerial_won,
  coalesce(CAST(s.shot_first_time AS INT),0) AS shot_first_time,
  CASE WHEN s.shot_type='Penalty' THEN 1 ELSE coalesce(CAST(s.shot_one_on_one AS INT),0) END AS shot_one_on_one,
  coalesce(CAST(s.shot_open_goal AS INT),0) AS shot_open_goal,
  coalesce(CAST(s.shot_follows_dribble AS INT),0) AS shot_follows_dribble,
  CASE WHEN s.shot_type='Penalty' THEN 1 WHEN s.n_frame>0 THEN CAST(coalesce(i.n,0) AS INT)
       WHEN s.empty_frame THEN 0 END AS players_inside_area,
  CASE WHEN p.pass_assisted_shot_id IS NOT NULL THEN 1 ELSE 0 END AS assisted,
  coalesce(p.pass_height,-1) AS pass_height, coalesce(p.pass_length,0e0) AS pass_length,
  coalesce(p.pass_angle,4e0) AS pass_angle,
  """ + ", ".join(f"coalesce(CAST(p.{c} AS INT),0) AS {c}" for c in PASS_FLAGS) + """,
  s.shot_outcome, s.shot_end_location, 120e0 AS shot_end_x, s.id*31%801/10e0 AS shot_end_y,
  CASE WHEN s.shot_statsbomb_xg >= 0.5e0 THEN 1 ELSE 0 END AS sb_prediction,
  s.shot_statsbomb_xg, CASE WHEN s.shot_outcome='Goal' THEN 1 ELSE 0 END AS goal, s.team_id"""


def shots_ctes(season: str | None = None, one_per_shot: bool = False) -> str:
    """CTEs b, fr, ev, foot, ins, pa, shots (the feature table)."""
    season_cond = f" AND season = '{season}'" if season else ""
    if one_per_shot:
        pa = ("pa AS (SELECT * FROM (SELECT pass_assisted_shot_id, "
              "CASE pass_height WHEN 'Ground Pass' THEN 0 WHEN 'Low Pass' THEN 1 ELSE 2 END AS pass_height, "
              f"pass_length, pass_angle, {_PASS_FLAGS_SQL}, row_number() OVER (PARTITION BY pass_assisted_shot_id "
              "ORDER BY period DESC, minute DESC, second DESC, id DESC) AS rn FROM ev "
              "WHERE pass_assisted_shot_id IS NOT NULL) WHERE rn = 1)")
    else:
        pa = ("pa AS (SELECT pass_assisted_shot_id, "
              "CASE pass_height WHEN 'Ground Pass' THEN 0 WHEN 'Low Pass' THEN 1 ELSE 2 END AS pass_height, "
              f"pass_length, pass_angle, {_PASS_FLAGS_SQL} FROM ev WHERE pass_assisted_shot_id IS NOT NULL)")
    return f"""WITH b AS ({BINDING_SQL}),
fr AS ({FRAME_SQL}),
ev AS (SELECT * FROM b WHERE (type='Shot' OR pass_assisted_shot_id IS NOT NULL){season_cond}),
foot AS (SELECT player_id,
    CASE WHEN CAST(l AS DOUBLE)/(l+r) >= 0.66e0 THEN 'Left Foot'
         WHEN CAST(r AS DOUBLE)/(l+r) >= 0.66e0 THEN 'Right Foot' ELSE 'Two-Footed' END AS preferred_foot,
    CAST(l AS BIGINT) AS left_foot, CAST(r AS BIGINT) AS right_foot
  FROM (SELECT player_id, count(*) FILTER (WHERE bp='Left Foot') AS l, count(*) FILTER (WHERE bp='Right Foot') AS r
        FROM (SELECT player_id, CASE WHEN type='Pass' THEN pass_body_part WHEN type='Shot' THEN shot_body_part END AS bp FROM ev) u
        WHERE bp IN ('Right Foot','Left Foot') GROUP BY player_id) c),
ins AS (SELECT fr.id, count(*) FILTER (WHERE abs({_TRI_WHOLE} - {_TRI_PARTS}) <= 1e-8 + 1e-10*abs({_TRI_PARTS})) AS n
  FROM fr JOIN ev s ON s.id = fr.id GROUP BY fr.id),
{pa},
shots AS (SELECT {SHOT_COLUMNS_SQL}
  FROM ev s LEFT JOIN foot f ON s.player_id = f.player_id
  LEFT JOIN ins i ON i.id = s.id
  LEFT JOIN pa p ON s.id = p.pass_assisted_shot_id
  WHERE s.type = 'Shot')
"""


def binding_ctes(frames: bool = False) -> str:
    parts = [f"b AS ({BINDING_SQL})"]
    if frames:
        parts.append(f"fr AS ({FRAME_SQL})")
    return "WITH " + ",\n".join(parts) + "\n"
