"""Raw and typed column contracts.

Fixed values: every list below states column names that the data or its consumers prescribe.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw tables as text. Only the partition year of the sale table is numeric.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "mutation": (
        "idmutation", "idopendata", "datemut", "anneemut", "moismut", "idnatmut", "libnatmut",
        "vefa", "coddep", "codinsee", "valeurfonc", "nbdispo", "nblot", "nbcomm", "nbpar",
        "nbparmut", "codtypbien", "libtypbien", "sbati", "sbatmai", "sbatapt", "sbatact", "sterr",
        "nblocmut", "nblocmai", "nblocapt", "nblocact", "nblocdep", "nbsuf", "latitude",
        "longitude",
    ),
    "disposition": ("iddispo", "idmutation", "nodispo", "valeurfonc", "nblot", "coddep"),
    "local": (
        "iddispoloc", "iddispopar", "idmutation", "idloc", "codtyploc", "libtyploc", "nbpprinc",
        "sbati", "coddep", "datemut", "anneemut",
    ),
    "disposition_parcelle": (
        "iddispopar", "iddispo", "idparcelle", "idmutation", "idpar", "coddep", "codcomm",
        "prefsect", "nosect", "noplan", "datemut", "anneemut", "parcvendue", "dcntsol",
        "dcntagri", "dcntnat",
    ),
    "parcelle": (
        "idparcelle", "idpar", "coddep", "codcomm", "prefsect", "nosect", "noplan", "geompar",
    ),
    "adresse": (
        "idadr", "coddep", "codcomm", "codvoie", "typvoie", "novoie", "codepostal",
    ),
    "adresse_local": ("iddispoloc", "idadr"),
    "adresse_dispoparc": ("iddispopar", "idadr"),
    "ann_nature_mutation": ("idnatmut", "libnatmut"),
    "ann_type_local": ("codtyploc", "libtyploc"),
    "ann_cgi": ("artcgi", "libartcgi"),
    "ann_nature_culture": ("natcult", "libnatcult"),
    "ann_nature_culture_speciale": ("natcultspe", "libnatcultspe"),
    "geo_departments": ("code", "nom", "departement", "region", "epci", "geometry"),
    "geo_communes": ("code", "nom", "departement", "region", "epci", "geometry"),
}

# The 13 declared sources of the models.
SOURCE_TABLES = (
    "mutation", "disposition", "local", "disposition_parcelle", "parcelle", "adresse",
    "ann_nature_mutation", "ann_type_local", "ann_cgi", "ann_nature_culture",
    "ann_nature_culture_speciale", "geo_departments", "geo_communes",
)
PRINCIPAL_TABLES = (
    "mutation", "disposition", "disposition_parcelle", "local", "parcelle", "adresse",
)
REFERENCE_TABLES = (
    "ann_nature_mutation", "ann_type_local", "ann_cgi", "ann_nature_culture",
    "ann_nature_culture_speciale",
)
# Key of each reference table.
REFERENCE_KEYS = {
    "ann_nature_mutation": "idnatmut", "ann_type_local": "codtyploc", "ann_cgi": "artcgi",
    "ann_nature_culture": "natcult", "ann_nature_culture_speciale": "natcultspe",
}
SIMPLE_EXPORT_TABLES = ("disposition", "local", "adresse", *REFERENCE_TABLES)
DEPARTMENT_TABLES = (
    "mutation", "disposition", "disposition_parcelle", "local", "parcelle", "adresse", "suf",
    "lot", "volume", "mutation_article_cgi", "adresse_dispoparc", "adresse_local",
)

# Tables whose text columns may hold quoted newlines.
MULTILINE_TABLES = ("adresse", *REFERENCE_TABLES)

YEAR_COLUMN = "anneemut"

# Dump conventions: table prefix, geometry columns, prefix of array columns.
DUMP_TABLE_PREFIX = "dvf_plus_"
GEOMETRY_COLUMNS = ("geomlocmut", "geomparmut", "geompar", "geomloc")
ARRAY_PREFIX = "l_"

# Sale columns before export.
MUTATION_ARRAYS = {
    "l_codinsee": "codinsee", "l_section": "section", "l_par": "par", "l_artcgi": "artcgi",
}
MUTATION_POINT = "geomlocmut"
MUTATION_DROPPED = (
    "geomparmut", "geompar", "codservch", "refdoc", "idmutinvar", "l_dcnt", "l_idpar",
    "l_idparmut", "l_idlocmut",
)
PARCELLE_DROPPED = ("geompar", "geomparmut")
DISPOSITION_PARCELLE_DROPPED = ("geomloc", "geompar")

# Boundary files and the table each one feeds; minimum number of features.
GEOJSON_FILES = {
    "departements-1000m.geojson": "geo_departments",
    "departments.geojson": "geo_departments",
    "communes-1000m.geojson": "geo_communes",
    "communes.geojson": "geo_communes",
}
GEOJSON_PROPERTIES = ("code", "nom", "departement", "region", "epci")
MINIMUM_FEATURES = {"geo_departments": 100, "geo_communes": 30_000}

# Years of the partitioned tables, end exclusive; calendar bounds, end exclusive.
YEAR_RANGE = (2014, 2026)
CALENDAR_RANGE = ("2014-01-01", "2026-01-01")
DATE_RULE = ("2014-01-01", "2025-06-30")
YEAR_RULE = (2014, 2025)

# Staging: output column, raw column(s), conversion.
STAGING: dict[str, tuple[tuple[str, str, str], ...]] = {
    "mutations": (
        ("mutation_id", "idmutation", "long"),
        ("mutation_opendata_id", "idopendata", "string"),
        ("transaction_date", "datemut", "date"),
        ("transaction_year", "anneemut", "long"),
        ("transaction_month", "moismut", "long"),
        ("mutation_nature_id", "idnatmut", "long"),
        ("mutation_nature_label", "libnatmut", "string"),
        ("is_vefa", "vefa", "flag"),
        ("department_code", "coddep", "string"),
        ("insee_code", "codinsee", "string"),
        ("transaction_price_eur", "valeurfonc", "double"),
        ("disposition_count", "nbdispo", "long"),
        ("lot_count", "nblot", "long"),
        ("commune_count", "nbcomm", "long"),
        ("parcel_count", "nbpar", "long"),
        ("sold_parcel_count", "nbparmut", "long"),
        ("property_type_code", "codtypbien", "string"),
        ("property_type_label", "libtypbien", "string"),
        ("total_built_area_sqm", "sbati", "double"),
        ("house_built_area_sqm", "sbatmai", "double"),
        ("apartment_built_area_sqm", "sbatapt", "double"),
        ("commercial_built_area_sqm", "sbatact", "double"),
        ("land_area_sqm", "sterr", "double"),
        ("premises_count", "nblocmut", "long"),
        ("house_count", "nblocmai", "long"),
        ("apartment_count", "nblocapt", "long"),
        ("commercial_count", "nblocact", "long"),
        ("outbuilding_count", "nblocdep", "long"),
        ("fiscal_subdivision_count", "nbsuf", "long"),
        ("latitude", "latitude", "double"),
        ("longitude", "longitude", "double"),
    ),
    "dispositions": (
        ("disposition_id", "iddispo", "long"),
        ("mutation_id", "idmutation", "long"),
        ("disposition_number", "nodispo", "long"),
        ("disposition_price_eur", "valeurfonc", "double"),
        ("lot_count", "nblot", "long"),
        ("department_code", "coddep", "string"),
    ),
    "locals": (
        ("local_id", "iddispoloc", "long"),
        ("disposition_parcel_id", "iddispopar", "long"),
        ("mutation_id", "idmutation", "long"),
        ("local_identifier", "idloc", "string"),
        ("local_type_code", "codtyploc", "long"),
        ("local_type_label", "libtyploc", "string"),
        ("main_room_count", "nbpprinc", "long"),
        ("built_area_sqm", "sbati", "double"),
        ("department_code", "coddep", "string"),
        ("transaction_date", "datemut", "date"),
        ("transaction_year", "anneemut", "long"),
    ),
    "parcelles": (
        ("disposition_parcel_id", "iddispopar", "long"),
        ("disposition_id", "iddispo", "long"),
        ("parcel_id", "idparcelle", "long"),
        ("mutation_id", "idmutation", "long"),
        ("parcel_identifier", "idpar", "string"),
        ("department_code", "coddep", "string"),
        ("commune_code", "coddep codcomm", "commune"),
        ("section_prefix", "prefsect", "string"),
        ("section_number", "nosect", "string"),
        ("plan_number", "noplan", "string"),
        ("transaction_date", "datemut", "date"),
        ("transaction_year", "anneemut", "long"),
        ("is_parcel_sold", "parcvendue", "flag"),
        ("built_land_area_sqm", "dcntsol", "double"),
        ("agricultural_land_area_sqm", "dcntagri", "double"),
        ("natural_land_area_sqm", "dcntnat", "double"),
    ),
    "geo_departments": (
        ("department_code", "code", "string"),
        ("department_name", "nom", "string"),
        ("geometry", "geometry", "geojson"),
    ),
    "geo_communes": (
        ("commune_code", "code", "string"),
        ("commune_name", "nom", "string"),
        ("geometry", "geometry", "geojson"),
    ),
}
STAGED_FROM = {
    "mutations": "mutation",
    "dispositions": "disposition",
    "locals": "local",
    "parcelles": "disposition_parcelle",
    "geo_departments": "geo_departments",
    "geo_communes": "geo_communes",
}

# Fact columns taken over from the enriched sale: output, input.
FACT_COLUMNS = (
    ("transaction_id", "mutation_opendata_id"),
    ("mutation_id", "mutation_id"),
    ("transaction_date", "transaction_date"),
    ("transaction_year", "transaction_year"),
    ("transaction_month", "transaction_month"),
    ("mutation_nature_id", "mutation_nature_id"),
    ("mutation_nature_label", "mutation_nature_label"),
    ("is_vefa", "is_vefa"),
    ("department_code", "department_code"),
    ("department_name", "department_name"),
    ("commune_code", "commune_code"),
    ("property_type_code", "property_type_code"),
    ("property_type_label", "property_type_label"),
    ("transaction_price_eur", "transaction_price_eur"),
    ("built_area_sqm", "total_built_area_sqm"),
    ("land_area_sqm", "land_area_sqm"),
    ("price_per_sqm", "price_per_sqm"),
    ("premises_count", "premises_count"),
    ("house_count", "house_count"),
    ("apartment_count", "apartment_count"),
    ("commercial_count", "commercial_count"),
    ("outbuilding_count", "outbuilding_count"),
    ("room_count", "room_count"),
    ("latitude", "latitude"),
    ("longitude", "longitude"),
)


def text_schema(columns: list[str] | tuple[str, ...]) -> T.StructType:
    """All-text schema in the given column order."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def raw_schema(table: str) -> T.StructType:
    return text_schema(RAW_COLUMNS[table])
