"""Rule tables. All are fixed values: results depend on them and on their order."""

from __future__ import annotations

# Issue -> (keywords, {subcategory: keywords}), in order of precedence.
TAXONOMY = {
    "health": (
        ["health", "hospital", "medical", "disease", "inspection", "safety", "hygiene", "bodysafe", "e.coli", "bacteria", "outbreak", "clinic", "healthcare"],
        {
            "water_quality": ["beach", "water", "e.coli", "swimming", "lake", "bacteria"],
            "food_safety": ["dinesafe", "restaurant", "food", "inspection", "kitchen"],
            "personal_services": ["bodysafe", "aesthetics", "tattoo", "spa", "salon", "sterilization"],
            "mental_health": ["opioid", "overdose", "addiction", "mental", "shelter"],
            "outbreaks": ["outbreak", "infection", "communicable", "disease", "healthcare"],
        },
    ),
    "transportation": (
        ["transit", "ttc", "subway", "bus", "traffic", "road", "cycling", "bike", "pedestrian", "intersection", "speed", "signal"],
        {
            "traffic_management": ["traffic", "signal", "intersection", "speed", "volume"],
            "road_safety": ["red-light", "camera", "safety", "collision", "accident"],
            "cycling": ["bike", "cycling", "bicycle", "trail"],
            "infrastructure": ["sidewalk", "road", "construction", "centreline"],
        },
    ),
    "environment": (
        ["environment", "climate", "green", "park", "tree", "energy", "renewable", "emission", "pollution", "ravine", "nature"],
        {
            "energy": ["energy", "renewable", "solar", "consumption", "electricity"],
            "natural_areas": ["ravine", "park", "nature", "forest", "trail"],
            "water_environment": ["beach", "lake", "water", "observation"],
        },
    ),
    "housing": (
        ["housing", "rental", "apartment", "shelter", "homeless", "affordable", "tenant", "landlord", "eviction", "benefit", "subsidy", "supportive housing", "property tax", "seniors"],
        {
            "rental_housing": ["apartment", "rental", "building", "tenant"],
            "shelter": ["shelter", "homeless", "emergency"],
            "condominiums": ["condo", "condominium", "registered"],
            "housing_to_plan": ["HousingTO", "strategy", "targets", "evictions prevented", "supportive homes", "MURA", "CHPR", "portable benefits"],
        },
    ),
    "public_safety": (
        ["police", "crime", "safety", "emergency", "fire", "ambulance", "911"],
        {"crime": ["crime", "police", "theft", "assault", "robbery"]},
    ),
    "poverty_reduction": (["poverty", "low-income", "inequality", "food", "assistance", "welfare", "odsp"], {}),
    "business_and_economy": (
        ["business", "employment", "economy", "commercial", "job", "workforce"],
        {"employment": ["employment", "job", "workforce", "labour"]},
    ),
}

# Dataset -> (primary issue, secondary issues, subcategory).
DATASET_ISSUES = {
    "outbreaks-in-toronto-healthcare-institutions": ("health", [], "outbreaks"),
    "annual-summary-of-reportable-communicable-diseases": ("health", [], "communicable-diseases"),
    "toronto-population-health-status-indicators": ("health", ["demographics"], "population-health"),
    "toronto-beaches-water-quality": ("health", ["environment"], "water_quality"),
    "toronto-beaches-observations": ("environment", ["health"], "water_environment"),
    "bodysafe": ("health", [], "personal_services"),
    "dinesafe": ("health", [], "food_safety"),
    "chemical-tracking-chemtrac": ("health", ["environment"], "chemical_safety"),
    "fatal-and-non-fatal-suspected-opioid-overdoses-in-the-shelter-system": ("health", ["housing", "poverty_reduction"], "mental_health"),
    "apartment-building-registration": ("housing", [], "rental_housing"),
    "registered-residential-non-residential-condominiums": ("housing", [], "condominiums"),
    "housing-to-action-plan": ("housing", ["poverty_reduction", "health"], "housing_to_plan"),
    "toronto-employment-survey-summary-tables": ("business_and_economy", ["demographics"], "employment"),
    "traffic-volumes-at-intersections-for-all-modes": ("transportation", [], "traffic_management"),
    "traffic-signal-timing": ("transportation", [], "traffic_management"),
    "red-light-cameras": ("transportation", ["public_safety"], "road_safety"),
    "red-light-camera-annual-charges": ("transportation", ["public_safety"], "road_safety"),
    "street-furniture-bicycle-parking": ("transportation", [], "cycling"),
    "sidewalk-construction-program": ("transportation", [], "infrastructure"),
    "safety-zone-watch-your-speed-program-monthly-summary": ("transportation", ["public_safety"], "road_safety"),
    "renewable-energy-installations": ("environment", [], "energy"),
    "annual-energy-consumption": ("environment", [], "energy"),
    "ravine-natural-feature-protection-area": ("environment", [], "natural_areas"),
    "parks-drinking-fountains": ("environment", ["health"], "natural_areas"),
    "police-annual-statistical-report": ("safety", [], "crime-statistics"),
    "fire-incidents": ("safety", [], "fire-services"),
}

# Data type -> words, in order of precedence; else "record".
DATA_TYPES = {
    "inspection": ["inspection", "audit", "review", "check", "dinesafe", "bodysafe"],
    "outbreak": ["outbreak", "epidemic", "infection", "communicable"],
    "complaint": ["complaint", "request", "311", "service request", "report"],
    "permit": ["permit", "license", "registration", "application", "certificate"],
    "incident": ["incident", "accident", "collision", "occurrence", "event", "fatal"],
    "measurement": ["measurement", "reading", "observation", "sample", "monitor", "quality"],
    "location": ["location", "facility", "centre", "center", "station", "site"],
    "inventory": ["inventory", "list", "directory", "catalogue", "registry"],
    "boundary": ["boundary", "zone", "district", "ward", "area", "region"],
    "schedule": ["schedule", "calendar", "hours", "timing"],
    "statistics": ["statistics", "summary", "annual", "report"],
}

# Kind of records by words in their keys, in order of precedence; else "general".
KEY_TYPES = {
    "inspection": ["inspection", "infraction", "severity", "pass", "fail", "status", "establishment"],
    "incident": ["outbreak", "incident", "case", "date_declared", "causative", "active"],
    "observation": ["observation", "sample", "reading", "measurement", "count", "level"],
    "registry": ["registration", "registered", "license", "permit", "certificate"],
    "statistics": ["total", "count", "average", "rate", "percentage", "summary", "annual"],
    "location": ["latitude", "longitude", "geometry", "coordinates", "location", "address"],
}

# Keys whose name is not their snake case form.
FIELD_NAMES = {
    "Active": "is_active",
    "Type of Outbreak": "outbreak_type",
    "E.Coli Level": "ecoli_level",
    "Number of Storeys": "num_storeys",
    "Number of Units": "num_units",
    "Lat": "latitude",
    "Lon": "longitude",
    "Long": "longitude",
}

# Search names of fields, exactly as they are spelt.
SEARCH_NAMES = {
    "addr_full": "addrFull", "address_full": "addrFull", "full_address": "addrFull", "ADDR_FULL": "addrFull", "ADDRESS": "address",
    "Street_No.": "street_no",
    "establishment_name": "estName", "est_name": "estName", "Establishment_Name": "estName", "ESTABLISHMENT_NAME": "estName", "Name": "estName", "NAME": "estName",
    "inspection_date": "insDate", "ins_date": "insDate", "Inspection_Date": "insDate", "INSPECTION_DATE": "insDate",
    "inspection_status": "insStatus", "ins_status": "insStatus", "Inspection_Status": "insStatus", "INSPECTION_STATUS": "insStatus",
    "infraction_type": "infType", "Infraction_Type": "infType", "infraction_category": "infCategory", "Infraction_Category": "infCategory",
    "deficiency_desc": "defDesc", "Deficiency_Description": "defDesc",
    "e_coli": "eColi", "ecoli": "eColi", "E_Coli": "eColi", "E.Coli": "eColi", "ECOLI": "eColi",
    "Beach_Name": "beachName", "beach_name": "beachName", "BEACH_NAME": "beachName", "Site_Name": "siteName", "site_name": "siteName", "SITE_NAME": "siteName",
    "Collection_Date": "collectionDate", "collection_date": "collectionDate", "COLLECTION_DATE": "collectionDate",
    "Three_+_Bedroom_Units": "three_plus_bedroom_units", "Three_+_Bedroom_Units_Pct": "three_plus_bedroom_units_pct", "Date_of_Registration": "registration_date",
}
# Fields whose spellings in capitals, or with a capital for each word, are the same field.
SEARCH_SPELT = [
    "street_name", "street_no", "postal_code", "ward", "neighbourhood", "year", "total_units", "bachelor_units", "one_bedroom_units", "two_bedroom_units",
    "three_plus_bedroom_units", "commercial_units", "bachelor_units_pct", "one_bedroom_units_pct", "two_bedroom_units_pct", "three_plus_bedroom_units_pct",
    "registration_date", "condo_plan_no", "intersection", "street_1", "street_2", "traffic_volume", "speed_limit", "direction", "incident_type", "offence",
    "division", "occurrence_date", "reported_date", "premises_type", "crime_type", "mci_category", "park_name", "facility_type", "asset_type", "business_name",
    "business_type", "license_type", "license_status", "permit_type", "permit_status", "permit_number", "issue_date", "expiry_date",
]

# Best first.
FORMAT_PRIORITY = ["datastore", "json", "geojson", "csv", "xlsx", "xls", "xml", "txt", "zip", "shp"]
FORMAT_SUFFIXES = [
    ".csv", ".json", ".xml", ".xlsx", ".xls", ".txt", ".zip", ".shp", ".geojson",
    " - csv", " - json", " - xml", " - xlsx", " csv", " json", " xml", " xlsx", "_csv", "_json", "_xml", "_xlsx", "-csv", "-json", "-xml", "-xlsx",
]
GEO_WORDS = ["shapefile", "shp", "geo", "boundary", "wgs84", "map", "polygon", "point", "line", "spatial", "gis", "geometry", "coordinate", "lat", "lon", "shape"]

# Fields joined into the searchable text, common ones and those of an issue.
SEARCH_FIELDS = {
    "common": ["dataset_name", "comments", "observation", "description", "name", "title", "address"],
    "health": ["beachName", "estName", "siteName", "defDesc", "establishment_name", "establishment_type", "establishment_address", "infraction_details", "institution_name", "institution_address", "outbreak_type", "causative_agent_1"],
    "housing": ["full_address", "street_name", "street_no", "property_type", "ward_name", "neighbourhood", "Street_Name", "Street_No"],
    "transportation": ["station_name", "route_name", "street_name", "intersection", "location_name"],
    "environment": ["park_name", "facility_name", "location_name", "site_name"],
}
FALLBACK_FIELDS = ["address", "addrFull", "street_name", "neighbourhood", "ward", "estName", "observation", "defDesc", "comments", "beachName", "business_name", "park_name", "facility_name", "intersection", "route_name", "description", "name"]
BOOSTS = {"searchable_text": 3.0, "estName": 2.0, "business_name": 2.0, "address": 2.0, "park_name": 2.0, "intersection": 2.0}
ID_FIELDS = ["id", "_id", "estName", "business_name", "address", "insDate"]

# The English stop words of the analyser.
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with"]

FEED_EXTENSIONS = [".rss", ".xml", ".atom", ".feed"]
PAGE_EXTENSIONS = [".html", ".htm", ".php", ".aspx", ".jsp"]
