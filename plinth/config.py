"""Thresholds and enumerations.  Fixed values of the domain, stated as they are."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Region:
    id: str
    name: str
    crs: int
    xmin: float
    ymin: float
    xmax: float
    ymax: float


# Region boxes in geographic degrees and their projected zones.
REGIONS = (
    Region("1", "wagga", 7855, 147.343486, -35.129815, 147.387300, -35.087395),
    Region("2", "launceston", 7855, 147.098107, -41.447082, 147.168781, -41.405697),
    Region("3", "tweed", 7856, 153.502319, -28.221012, 153.550214, -28.171330),
)

# Zones in which buildings are kept.
RESIDENTIAL_ZONES = (
    "General Residential",
    "Inner Residential",
    "Large Lot Residential",
    "Low Density Residential",
    "Medium Density Residential",
    "Environmental Living",
    "Village",
    "Rural Activity Zone",
    "Rural Landscape",
    "Mixed Use",
    "Urban Mixed Use",
)

# Property type codes.
PROPERTY_TYPES = {
    "C": "Commercial",
    "Com": "Commercial",
    "Commercial": "Commercial",
    "I": "Industrial",
    "Ind": "Industrial",
    "Industrial": "Industrial",
    "R": "Residential",
    "Res": "Residential",
    "Residential": "Residential",
    "E": "Education",
    "Edu": "Education",
    "Education": "Education",
    "EM": "Emergency",
    "Emer": "Emergency",
    "Emergency": "Emergency",
    "M": "Medical",
    "Med": "Medical",
    "Medical": "Medical",
    "W": "Worship",
    "Wor": "Worship",
    "Worship": "Worship",
    "Other": "Other",
}

# Wall material codes.
WALL_MATERIALS = {
    "BK": "Brick",
    "BK - Brick": "Brick",
    "BKBD - Brick Board": "Brick",
    "BKR - Brick Rendered": "Brick",
    "BKV - Brick Veneer": "Brick",
    "BKVR - Brick Veneer Rendered": "Brick",
    "BRICK": "Brick",
    "Block": "Brick",
    "Brick": "Brick",
    "MBK - Masonry Brick": "Brick",
    "MBKR - Masonry Brick Rendered": "Brick",
    "MBKV - Masonry Brick Veneer": "Brick",
    "C - Concrete": "Concrete",
    "CB - Colorbond": "Colorbond",
    "CBKV - Concrete Brick Veneer": "Concrete",
    "CBL - Concrete Block": "Concrete",
    "CBLR - Concrete Block Rendered": "Concrete",
    "CLADDING": "Cladding",
    "CONCRETE": "Concrete",
    "CONR - Concrete Rendered": "Concrete",
    "CSHT - Cement Sheet": "Cement Sheet",
    "CSTR - Cement Sheet Rendered": "Cement Sheet",
    "CTP - Concrete Tilt Panel": "Concrete",
    "FC": "Fibre Cement",
    "FIBRO": "Fibre Cement",
    "Fibro": "Fibre Cement",
    "GI - Galvanised Iron": "Galvanised Iron",
    "Glass": "Glass",
    "IW - Imitation Weatherboard": "Weatherboard",
    "METC - Metal Cladding": "Metal",
    "Metal": "Metal",
    "OT": "Other",
    "OTHER": "Other",
    "Other": "Other",
    "PCP - Precast Concrete Panel": "Concrete",
    "Precast Concrete": "Concrete",
    "RENDER": "Rendered",
    "STON - Stone": "Stone",
    "Stone": "Stone",
    "TIMB - Timber": "Timber",
    "TIMBER": "Timber",
    "Timber": "Timber",
    "VB - Vertical Board": "Weatherboard",
    "WB": "Weatherboard",
    "WB - Weatherboard": "Weatherboard",
    "NO": None,
    "None": None,
    "YES": None,
}

# Property types of zones.
ZONE_PROPERTY_TYPES = {
    "General Residential": "Residential",
    "Inner Residential": "Residential",
    "Low Density Residential": "Residential",
    "Medium Density Residential": "Residential",
    "Environmental Living": "Residential",
    "Large Lot Residential": "Residential",
    "Village": "Residential",
    "Commercial": "Commercial",
    "Industrial": "Industrial",
    "Mixed Use": "Mixed Use",
    "Urban Mixed Use": "Mixed Use",
    "Rural Activity Zone": None,
    "Rural Landscape": None,
}

# Detector classes by id, label sources (a parameter where labels come from others), LAS classes.
CLASSES = ("Front Door", "Foundation", "Garage Door", "Stairs", "Window")
LABEL_SOURCES = {"survey": "Survey Validation", "nexis": "NEXIS", "council": "Council Validation"}
LAS_CLASSES = ("never", "unassigned", "ground", "low_veg", "med_veg", "high_veg", "building", "noise")


@dataclass(frozen=True)
class Clip:
    tolerance: float = 0.1
    buffer_m: float = 5.0


@dataclass(frozen=True)
class Views:
    search_m: float = 40.0
    direct: float = 15.0
    semi: tuple[float, float] = (20.0, 40.0)
    oblique: tuple[float, float] = (45.0, 50.0)
    eps: float = 1e-8
    occlusion_slack: float = 0.5
    overlap_area: float = 1e-4


@dataclass(frozen=True)
class Scoring:
    door_override: float = 0.15
    low_variance: float = 0.05
    weight_low: float = 3.0
    weight_high: float = 2.5
    diversity: float = 1.5
    direct_bonus: float = 0.15
    oblique_bonus: float = -0.1
    detection: float = 0.35
    similarity: float = 0.20
    ground: float = 0.20
    focus: float = 0.15
    view: float = 0.10
    distance_m: float = 50.0


@dataclass(frozen=True)
class Raster:
    width: int = 11000
    height: int = 5500
    upper_crop: float = 0.25
    lower_crop: float = 0.60
    nodata: float = 9999.0
    nodata_class: int = 255


@dataclass(frozen=True)
class Heights:
    area_m2: float = 1.67
    ratio: float = 0.40
    least: float = 0.0
    most: float = 2.0


CLIP, VIEWS, SCORING, RASTER, HEIGHTS = Clip(), Views(), Scoring(), Raster(), Heights()
