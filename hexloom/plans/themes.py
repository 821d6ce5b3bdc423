"""Themes: feature types, the attributes their metrics read, and the metrics.

Attribute names on the left of ATTRIBUTES are what the predicates use; the expressions read
the feature files' columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom.operators.pyramid import Ratio, Spec

# Attribute values that are counted, in the order of the output columns.
PLACE_GROUPS = (
    "food_and_drink", "shopping", "services_and_business", "health_care", "travel_and_transportation", "lifestyle_services", "education",
    "community_and_government", "cultural_and_historic", "sports_and_recreation", "lodging", "arts_and_entertainment", "geographic_entities",
)
PLACE_KINDS = (
    "restaurant", "beauty_salon", "hotel", "grocery_store", "cafe", "coffee_shop", "bar", "pharmacy", "gas_station", "fast_food_restaurant", "bakery",
    "gym", "park", "hospital", "school",
)
SEGMENT_TYPES = (
    "road", "rail", "water",
)
ROAD_CLASSES = (
    "motorway", "trunk", "primary", "secondary", "tertiary", "residential", "living_street", "unclassified", "service", "pedestrian", "footway",
    "steps", "path", "track", "cycleway", "bridleway",
)
ROAD_FLAGS = (
    "bridge", "tunnel", "link",
)
ROAD_SURFACES = (
    "paved", "unpaved",
)
# Column name and the attribute value that it counts.
INFRASTRUCTURE = {
    "power": "power", "barrier": "barrier", "transportation": "transportation", "transit": "transit", "bridge": "bridge", "pedestrian": "pedestrian",
    "emergency": "emergency", "utility": "utility", "waste_mgmt": "waste_management", "water_infra": "water", "pier": "pier", "airport": "airport",
    "communication": "communication",
}
LAND_USE = {
    "agriculture": "agriculture", "residential": "residential", "managed": "managed", "horticulture": "horticulture", "recreation": "recreation",
    "developed": "developed", "golf": "golf", "park": "park", "education": "education", "cemetery": "cemetery", "pedestrian": "pedestrian",
    "construction": "construction", "winter_sports": "winter_sports", "resource": "resource_extraction", "protected": "protected",
}
# Fixed values.
WATER = (
    "river", "lake", "ocean", "stream", "canal", "pond", "reservoir", "spring",
)
BUILDING_TYPES = (
    "residential", "commercial", "industrial", "civic", "education", "medical", "religious", "entertainment", "military", "agricultural", "service",
    "transportation", "outbuilding",
)
BUILDING_CLASSES = {
    "house": "house", "apartments": "apartments", "detached": "detached", "class_commercial": "commercial", "class_industrial": "industrial",
    "retail": "retail", "warehouse": "warehouse", "office": "office", "class_school": "school", "university": "university", "class_hospital":
    "hospital", "church": "church", "mosque": "mosque", "class_hotel": "hotel", "garage": "garage", "farm": "farm", "barn": "barn", "factory":
    "factory", "greenhouse": "greenhouse", "hangar": "hangar",
}


def _equal(attribute: str, values, prefix: str = "n_") -> dict[str, str]:
    values = values if isinstance(values, dict) else {v: v for v in values}
    return {f"{prefix}{c}": f"{attribute} = '{v}'" for c, v in values.items()}


PLACES = Spec(
    total="place_count",
    counts=_equal("place_group", PLACE_GROUPS) | _equal("place_kind", PLACE_KINDS),
    sums={"confidence_sum": ("confidence", "double")},
    ratios={"avg_confidence": Ratio("confidence_sum", "place_count", "decimal(4,3)")},
    hidden=("confidence_sum",),
)
TRANSPORTATION = Spec(
    total="segment_count",
    counts=_equal("subtype", SEGMENT_TYPES)
    | _equal("class", ROAD_CLASSES)
    | {"n_class_unknown": "class = 'unknown'"}
    | {f"n_{f}": f"subtype = 'road' and is_{f}" for f in ROAD_FLAGS}
    | {f"n_{s}": f"subtype = 'road' and surface = '{s}'" for s in ROAD_SURFACES},
)
INFRA = Spec(total="infra_count", counts=_equal("subtype", INFRASTRUCTURE))
LANDUSE = Spec(total="landuse_count", counts=_equal("subtype", LAND_USE, "n_lu_"))
WATERS = Spec(total="water_count", counts=_equal("subtype", WATER) | {"n_salt_water": "is_salt", "n_intermittent": "is_intermittent"})
BASE = Spec(total="infra_count", counts={c: "" for s in (INFRA, LANDUSE, WATERS) for c in (s.total, *s.counts) if c != "infra_count"})
BUILDINGS = Spec(
    total="building_count",
    counts=_equal("subtype", BUILDING_TYPES) | _equal("class", BUILDING_CLASSES) | {"n_has_parts": "has_parts", "n_with_height": "height is not null", "n_with_floors": "num_floors is not null"},
    sums={"height_sum": ("height", "double"), "floors_sum": ("num_floors", "double")},
    maxima={"max_height_m": ("height", "float"), "max_floors": ("num_floors", "int")},
    ratios={"avg_height_m": Ratio("height_sum", "n_with_height", "float"), "avg_floors": Ratio("floors_sum", "n_with_floors", "float")},
    hidden=("height_sum", "floors_sum"),
    order=("building_count", *(f"n_{c}" for c in (*BUILDING_TYPES, *BUILDING_CLASSES)), "n_has_parts", "n_with_height", "avg_height_m", "max_height_m", "n_with_floors", "avg_floors", "max_floors"),
)


@dataclass(frozen=True)
class Feature:
    """A feature type: its folder, its metrics, and the attributes by SQL expressions over its columns."""

    folder: str
    spec: Spec
    attributes: dict[str, str]


_FLAGS = {f"is_{f}": f"exists(road_flags, f -> array_contains(f.values, 'is_{f}'))" for f in ROAD_FLAGS}
FEATURES = {
    "places": [Feature("theme=places/type=place", PLACES, {"place_group": "try_element_at(taxonomy.hierarchy, 1)", "place_kind": "categories.primary", "confidence": "confidence"})],
    "transportation": [Feature("theme=transportation/type=segment", TRANSPORTATION, {"subtype": "subtype", "class": "class", "surface": "try_element_at(road_surface, 1).value", **_FLAGS})],
    "base": [
        Feature("theme=base/type=infrastructure", INFRA, {"subtype": "subtype"}),
        Feature("theme=base/type=land_use", LANDUSE, {"subtype": "subtype"}),
        Feature("theme=base/type=water", WATERS, {"subtype": "subtype", "is_salt": "is_salt", "is_intermittent": "is_intermittent"}),
    ],
    "buildings": [Feature("theme=buildings/type=building", BUILDINGS, {"subtype": "subtype", "class": "class", "has_parts": "has_parts", "height": "height", "num_floors": "num_floors"})],
}
SPECS = {"places": PLACES, "transportation": TRANSPORTATION, "base": BASE, "buildings": BUILDINGS}


def attributes(features: DataFrame, feature: Feature, *keep: str) -> DataFrame:
    """Only the columns that the metrics read, so the scan reads nothing else."""
    return features.select(*keep, *(F.expr(e).alias(a) for a, e in feature.attributes.items()))
