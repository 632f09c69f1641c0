from .geo import EARTH_RADIUS_KM, chord_km, haversine_km, unit_xyz_km
from .predicates import any_distinct, corrected_level, empty_to_null, text_flag
from .timeconv import file_date, hour_floor, instant_to_wall, local_day_bounds, wall_to_instant

__all__ = [
    "EARTH_RADIUS_KM",
    "any_distinct",
    "chord_km",
    "corrected_level",
    "empty_to_null",
    "file_date",
    "haversine_km",
    "hour_floor",
    "instant_to_wall",
    "local_day_bounds",
    "text_flag",
    "unit_xyz_km",
    "wall_to_instant",
]
