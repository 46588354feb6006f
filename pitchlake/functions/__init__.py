"""Column-level building blocks (no DataFrame in, no DataFrame out)."""

from pitchlake.functions.encode import (flag, one_hot, pass_height_code, preferred_foot,  # noqa: F401
                                        used_preferred_foot, vendor_label)
from pitchlake.functions.frames import frame_text, parse_frame  # noqa: F401
from pitchlake.functions.geometry import (decimal_clock, distance_to_goal,  # noqa: F401
                                          match_clock, parse_point, players_in_triangle, point_x,
                                          point_y, shot_angle, triangle_area)
