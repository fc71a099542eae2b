"""Parameters of all stages, with YAML files that override them by section and key.

Section names, key names, ids and defaults are fixed values, so that existing files keep their meaning.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

# Semantic ids of the drawings' annotation.
WALL_IDS, DOOR_IDS, WINDOW_IDS = (33, 34), (1, 2, 3, 5), (7,)
STAIR_IDS, ESCALATOR_IDS, ELEVATOR_IDS = (28,), (30,), (29,)
TOILET_IDS, KITCHEN_IDS, ROW_CHAIR_IDS = (25, 26, 27), (19,), (31,)
FURNITURE_IDS, PARKING_IDS = (11, 13, 14, 17), (32,)
# Room types by priority.
PRIORITY = (
    ("Stairs", STAIR_IDS), ("Escalator", ESCALATOR_IDS), ("Elevator", ELEVATOR_IDS), ("WC", TOILET_IDS),
    ("Kitchen", KITCHEN_IDS), ("Auditorium", ROW_CHAIR_IDS), ("Office", FURNITURE_IDS), ("Parking", PARKING_IDS),
)
# Types that are not clickable.
NOT_CLICKABLE = ("Wall", "Door", "Window", "Stairs", "Escalator", "Elevator", "Walkways", "Gallery", "Deadzone")
# Colours of room types, and of other parts of the rendered plan.
TYPE_COLORS = {
    "Stairs": "#f7ce4b", "Escalator": "#f7ce4b", "Elevator": "#ed702d", "WC": "#ee7ca2", "Kitchen": "#719752", "Auditorium": "#426b51",
    "Office": "#7ab591", "Parking": "#66433e", "Walkways": "#e5e7eb", "Deadzone": "#cbd5e1",
}
WALL_FILL, WALL_EDGE, WINDOW_COLOR, DOOR_COLOR, OPEN_FILL, OPEN_EDGE = "#6b7280", "#1f2937", "#2563eb", "#e03e9b", "#ffffff", "#9ca3af"


# Sections, keys and defaults of configuration files.
@dataclass(frozen=True)
class Parsing:
    boundary_semantic_ids: tuple = WALL_IDS
    door_semantic_ids: tuple = DOOR_IDS
    window_semantic_ids: tuple = WINDOW_IDS
    y_flip: bool = True
    arc_resolution: int = 20
    boundary_snap_tolerance: float = 0.5


@dataclass(frozen=True)
class Hatching:
    min_length: float = 10.0
    max_diagonal_angle_deg: float = 2.0
    enabled: bool = True


@dataclass(frozen=True)
class Openings:
    max_area_ratio: float = 0.05
    min_rect_thickness: float = 0.1
    min_rect_opening: float = 1.0
    split_l_shaped_windows: bool = True
    area_ratio_threshold: float = 0.75
    min_silhouette: float = 0.3
    max_clusters: int = 3
    enabled: bool = True


@dataclass(frozen=True)
class Cleaning:
    round_precision: int = 3
    snap_tolerance: float = 0.1
    min_line_length: float = 0.01


@dataclass(frozen=True)
class Separation:
    min_room_area: float = 1.0
    separator_min_area: float = 25.0
    separator_min_thickness: float = 0.7
    separator_min_log_gap: float = 0.2
    separator_fallback_method: str = "otsu"
    separator_manual_thickness: float | None = None
    separator_column_max_area: float = 100.0
    separator_column_min_aspect: float = 0.6
    synth_wall_default_radius: float = 0.5


@dataclass(frozen=True)
class Classification:
    stair_ids: tuple = STAIR_IDS
    elevator_ids: tuple = ELEVATOR_IDS
    toilet_ids: tuple = TOILET_IDS
    kitchen_ids: tuple = KITCHEN_IDS
    kitchen_wc_distance: float = 5.0
    walkway_max_thickness: float = 14.0
    walkway_max_solidity: float = 0.8

    def priority(self) -> tuple:
        """Room types with their ids, by priority."""
        own = {"Stairs": self.stair_ids, "Elevator": self.elevator_ids, "WC": self.toilet_ids, "Kitchen": self.kitchen_ids}
        return tuple((name, own.get(name, ids)) for name, ids in PRIORITY)


@dataclass(frozen=True)
class Export:
    floor_level: str | None = None  # of all files that aren't given one; otherwise it is read from the file's name
    default_facil_type: str = "Office"  # of rooms that neither objects nor shape say anything about


@dataclass(frozen=True)
class Config:
    parsing: Parsing = field(default_factory=Parsing)
    hatching: Hatching = field(default_factory=Hatching)
    door_closing: Openings = field(default_factory=Openings)
    cleaning: Cleaning = field(default_factory=Cleaning)
    polygonization: Separation = field(default_factory=Separation)
    classification: Classification = field(default_factory=Classification)
    export: Export = field(default_factory=Export)


def load_config(path: str | None) -> Config:
    """Defaults, with known keys of known sections overridden; unknown keys are ignored, a missing file gives the defaults."""
    import yaml

    try:
        with open(path or "") as f:
            data = yaml.safe_load(f) or {}
    except FileNotFoundError:
        return Config()
    out = {}
    for section in fields(Config):
        base = section.default_factory()
        known = {x.name for x in fields(base)}
        own = {k: tuple(v) if isinstance(v, list) else v for k, v in (data.get(section.name) or {}).items() if k in known}
        if own.get("floor_level") is not None:
            own["floor_level"] = str(own["floor_level"])
        out[section.name] = replace(base, **own)
    return Config(**out)
