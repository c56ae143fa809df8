"""DuckDB SQL twins of the registered queries, written independently of the Spark operators.

Every text starts from the raw trial tables (``oracle_with``) and adds the models it needs.
"""

from __future__ import annotations

import math

from salesmart.functions import projection as P
from salesmart.operators.quality import declared_checks
from salesmart.sources.contracts import (
    MINIMUM_FEATURES,
    PRINCIPAL_TABLES,
    RAW_COLUMNS,
    REFERENCE_TABLES,
    SIMPLE_EXPORT_TABLES,
    SOURCE_TABLES,
)
from salesmart.sources.trial_tables import (
    TRIAL_TABLES,
    boundary_oracle,
    oracle_with,
    raw_columns,
    raw_sql,
)

_DATE = "CASE WHEN regexp_full_match(datemut, '\\d{4}-\\d{1,2}-\\d{1,2}') THEN TRY_CAST(datemut AS DATE) END"


def _flag(name: str) -> str:
    return f"coalesce(upper({name}) IN ('T', 'TRUE', '1'), false)"


# model -> (what it reads, SQL)
_MODELS: dict[str, tuple[tuple[str, ...], str]] = {
    "all_mutations": (("mutation",), f"""
SELECT CAST(idmutation AS BIGINT) AS mutation_id, idopendata AS mutation_opendata_id,
  {_DATE} AS transaction_date, CAST(anneemut AS BIGINT) AS transaction_year,
  CAST(moismut AS BIGINT) AS transaction_month, CAST(idnatmut AS BIGINT) AS mutation_nature_id,
  libnatmut AS mutation_nature_label, {_flag('vefa')} AS is_vefa, coddep AS department_code,
  codinsee AS insee_code, CAST(valeurfonc AS DOUBLE) AS transaction_price_eur,
  CAST(nbdispo AS BIGINT) AS disposition_count, CAST(nblot AS BIGINT) AS lot_count,
  CAST(nbcomm AS BIGINT) AS commune_count, CAST(nbpar AS BIGINT) AS parcel_count,
  CAST(nbparmut AS BIGINT) AS sold_parcel_count, codtypbien AS property_type_code,
  libtypbien AS property_type_label, CAST(sbati AS DOUBLE) AS total_built_area_sqm,
  CAST(sbatmai AS DOUBLE) AS house_built_area_sqm,
  CAST(sbatapt AS DOUBLE) AS apartment_built_area_sqm,
  CAST(sbatact AS DOUBLE) AS commercial_built_area_sqm, CAST(sterr AS DOUBLE) AS land_area_sqm,
  CAST(nblocmut AS BIGINT) AS premises_count, CAST(nblocmai AS BIGINT) AS house_count,
  CAST(nblocapt AS BIGINT) AS apartment_count, CAST(nblocact AS BIGINT) AS commercial_count,
  CAST(nblocdep AS BIGINT) AS outbuilding_count,
  CAST(nbsuf AS BIGINT) AS fiscal_subdivision_count, CAST(latitude AS DOUBLE) AS latitude,
  CAST(longitude AS DOUBLE) AS longitude
FROM mutation"""),
    "stg_mutations": (("all_mutations",), "SELECT * FROM all_mutations WHERE transaction_price_eur > 0"),
    "stg_dispositions": (("disposition",), """
SELECT CAST(iddispo AS BIGINT) AS disposition_id, CAST(idmutation AS BIGINT) AS mutation_id,
  CAST(nodispo AS BIGINT) AS disposition_number, CAST(valeurfonc AS DOUBLE) AS disposition_price_eur,
  CAST(nblot AS BIGINT) AS lot_count, coddep AS department_code FROM disposition"""),
    "stg_locals": (("local",), f"""
SELECT CAST(iddispoloc AS BIGINT) AS local_id, CAST(iddispopar AS BIGINT) AS disposition_parcel_id,
  CAST(idmutation AS BIGINT) AS mutation_id, idloc AS local_identifier,
  CAST(codtyploc AS BIGINT) AS local_type_code, libtyploc AS local_type_label,
  CAST(nbpprinc AS BIGINT) AS main_room_count, CAST(sbati AS DOUBLE) AS built_area_sqm,
  coddep AS department_code, {_DATE} AS transaction_date,
  CAST(anneemut AS BIGINT) AS transaction_year FROM local_"""),
    "stg_parcelles": (("disposition_parcelle",), f"""
SELECT CAST(iddispopar AS BIGINT) AS disposition_parcel_id, CAST(iddispo AS BIGINT) AS disposition_id,
  CAST(idparcelle AS BIGINT) AS parcel_id, CAST(idmutation AS BIGINT) AS mutation_id,
  idpar AS parcel_identifier, coddep AS department_code, coddep || codcomm AS commune_code,
  prefsect AS section_prefix, nosect AS section_number, noplan AS plan_number,
  {_DATE} AS transaction_date, CAST(anneemut AS BIGINT) AS transaction_year,
  {_flag('parcvendue')} AS is_parcel_sold, CAST(dcntsol AS DOUBLE) AS built_land_area_sqm,
  CAST(dcntagri AS DOUBLE) AS agricultural_land_area_sqm,
  CAST(dcntnat AS DOUBLE) AS natural_land_area_sqm FROM disposition_parcelle"""),
    "department_shapes": ((), boundary_oracle("geo_departments")),
    "commune_shapes": ((), boundary_oracle("geo_communes")),
    "stg_geo_departments": (("department_shapes",), """
SELECT code AS department_code, nom AS department_name,
  CASE WHEN is_valid THEN geometry END AS geometry FROM department_shapes WHERE code IS NOT NULL"""),
    "stg_geo_communes": (("commune_shapes",), """
SELECT code AS commune_code, nom AS commune_name,
  CASE WHEN is_valid THEN geometry END AS geometry FROM commune_shapes WHERE code IS NOT NULL"""),
    "disposition_agg": (("stg_dispositions",), """
SELECT mutation_id, count(*) AS disposition_count_actual,
  sum(disposition_price_eur) AS total_disposition_price_eur FROM stg_dispositions GROUP BY mutation_id"""),
    "local_agg": (("stg_locals",), """
SELECT mutation_id, max(main_room_count) AS max_room_count,
  CAST(sum(main_room_count) AS BIGINT) AS total_room_count,
  max(built_area_sqm) AS max_local_built_area_sqm FROM stg_locals GROUP BY mutation_id"""),
    "parcelle_agg": (("stg_parcelles",), """
SELECT mutation_id, first(commune_code ORDER BY disposition_parcel_id, commune_code NULLS FIRST) AS commune_code,
  count(DISTINCT commune_code) AS commune_count_parcelle,
  sum(built_land_area_sqm) AS total_built_land_area_sqm,
  sum(agricultural_land_area_sqm) AS total_agricultural_land_area_sqm,
  sum(natural_land_area_sqm) AS total_natural_land_area_sqm FROM stg_parcelles GROUP BY mutation_id"""),
    "int_transactions_enriched": (("stg_mutations", "disposition_agg", "local_agg", "parcelle_agg"), """
SELECT m.mutation_id, mutation_opendata_id, transaction_date, transaction_year, transaction_month,
  mutation_nature_id, mutation_nature_label, is_vefa, department_code,
  coalesce(p.commune_code, insee_code) AS commune_code, insee_code, transaction_price_eur,
  property_type_code, property_type_label, total_built_area_sqm, house_built_area_sqm,
  apartment_built_area_sqm, commercial_built_area_sqm, land_area_sqm, premises_count, house_count,
  apartment_count, commercial_count, outbuilding_count, coalesce(max_room_count, 0) AS room_count,
  total_room_count, latitude, longitude,
  round(total_disposition_price_eur, 2) AS total_disposition_price_eur, total_built_land_area_sqm,
  total_agricultural_land_area_sqm, total_natural_land_area_sqm
FROM stg_mutations m LEFT JOIN disposition_agg d ON m.mutation_id = d.mutation_id
  LEFT JOIN local_agg l ON m.mutation_id = l.mutation_id
  LEFT JOIN parcelle_agg p ON m.mutation_id = p.mutation_id"""),
    "fct_transactions": (("int_transactions_enriched", "stg_geo_departments"), """
SELECT mutation_opendata_id AS transaction_id, mutation_id, transaction_date, transaction_year,
  transaction_month, mutation_nature_id, mutation_nature_label, is_vefa,
  e.department_code, department_name, commune_code, property_type_code, property_type_label,
  transaction_price_eur, total_built_area_sqm AS built_area_sqm, land_area_sqm,
  CASE WHEN total_built_area_sqm <> 0 THEN transaction_price_eur / total_built_area_sqm END AS price_per_sqm,
  premises_count, house_count, apartment_count, commercial_count, outbuilding_count, room_count,
  latitude, longitude
FROM int_transactions_enriched e LEFT JOIN stg_geo_departments g ON e.department_code = g.department_code"""),
    "distinct_pairs": (("stg_mutations",), """
SELECT DISTINCT insee_code AS commune_code, department_code FROM stg_mutations WHERE insee_code IS NOT NULL"""),
    "all_commune_codes": (("stg_parcelles", "distinct_pairs"), """
SELECT commune_code, department_code FROM stg_parcelles WHERE commune_code IS NOT NULL
UNION ALL SELECT commune_code, department_code FROM distinct_pairs"""),
    "mode_by_group": (("all_commune_codes",), """
SELECT commune_code, department_code FROM (
  SELECT *, row_number() OVER (PARTITION BY commune_code ORDER BY votes DESC, department_code NULLS LAST) AS r
  FROM (SELECT commune_code, department_code, count(*) AS votes FROM all_commune_codes GROUP BY ALL))
WHERE r = 1"""),
    "dim_communes": (("mode_by_group", "stg_geo_communes"), """
SELECT m.commune_code, coalesce(commune_name, m.commune_code) AS commune_name, department_code
FROM mode_by_group m LEFT JOIN stg_geo_communes g ON m.commune_code = g.commune_code"""),
    "dim_property_types": (("stg_mutations",), """
SELECT DISTINCT property_type_code, property_type_label, property_type_code[1] AS property_type_level1,
  CASE property_type_code[1] WHEN '1' THEN 'Built property' WHEN '2' THEN 'Unbuilt land'
    ELSE 'Other' END AS property_type_level1_label
FROM stg_mutations WHERE property_type_code IS NOT NULL"""),
    "calendar": ((), """
SELECT CAST(d AS DATE) AS day FROM range(DATE '2014-01-01', DATE '2026-01-01', INTERVAL 1 DAY) t(d)"""),
    "calendar_of_sales": (("stg_mutations",), """
SELECT CAST(unnest(range(make_date(lo, 1, 1), make_date(hi + 1, 1, 1), INTERVAL 1 DAY)) AS DATE) AS day
FROM (SELECT min(transaction_year) AS lo, max(transaction_year) AS hi FROM stg_mutations)"""),
    "dim_dates": (("calendar",), "SELECT {dates} FROM calendar"),
    "dim_geography": (("department_shapes", "commune_shapes"), """
SELECT code AS geo_code, nom AS geo_name, 'department' AS geo_level, code AS department_code,
  nom AS department_name, CASE WHEN is_valid THEN geometry END AS geometry,
  round(cy, 6) AS centroid_lat, round(cx, 6) AS centroid_lon
FROM department_shapes WHERE code IS NOT NULL
UNION ALL
SELECT code, nom, 'commune', CASE WHEN code LIKE '97%' THEN code[1:3] ELSE code[1:2] END,
  CAST(NULL AS VARCHAR), CASE WHEN is_valid THEN geometry END, round(cy, 6), round(cx, 6)
FROM commune_shapes WHERE code IS NOT NULL"""),
}

DATE_COLUMNS = """day AS date_key, day AS full_date, CAST(year(day) AS INTEGER) AS year,
  CAST(quarter(day) AS INTEGER) AS quarter, CAST(month(day) AS INTEGER) AS month,
  monthname(day) AS month_name, CAST(dayofweek(day) + 1 AS INTEGER) AS day_of_week,
  dayofweek(day) IN (0, 6) AS is_weekend"""
_MODELS["dim_dates"] = (("calendar",), f"SELECT {DATE_COLUMNS} FROM calendar")


# list columns of a dumped sale
_DUMP_LISTS = (
    "l_codinsee", "l_section", "l_par", "l_artcgi", "l_dcnt", "l_idpar", "l_idparmut", "l_idlocmut",
)


def oracle(final: str, *needs: str) -> str:
    """One statement: raw tables and models that ``needs`` stand on, then the final query."""
    models: list[str] = []
    raw: list[str] = []

    def visit(name: str) -> None:
        if name not in _MODELS:
            if name not in raw:
                raw.append(name)
            return
        for parent in _MODELS[name][0]:
            visit(parent)
        if name not in models:
            models.append(name)

    for name in needs:
        visit(name)
    parts = [f"{m} AS ({_MODELS[m][1]})" for m in models]
    if raw:
        head = oracle_with(*raw)
        return head + "".join(",\n" + p for p in parts) + "\n" + final
    return "WITH " + ",\n".join(parts) + "\n" + final


def model_oracle(name: str) -> str:
    return oracle(f"SELECT * FROM {name}", name)


def _grid_sql(x: str, y: str) -> tuple[str, str]:
    """Inverse conic projection as nested SQL expressions."""
    e = P.ECCENTRICITY
    radius = f"sqrt(({x} - {P.GRID['x0']}) * ({x} - {P.GRID['x0']}) + ({P.APEX_Y} - {y}) * ({P.APEX_Y} - {y}))"
    iso = f"(-ln({radius} / {P.CONE_RADIUS}) / {P.CONE})"
    lat = f"(2 * atan(exp({iso})) - {math.pi / 2})"
    for _ in range(6):
        sine = f"({e} * sin({lat}))"
        lat = f"(2 * atan(exp({iso} + {e} * atanh({sine}))) - {math.pi / 2})"
    lon = f"(degrees(atan2({x} - {P.GRID['x0']}, {P.APEX_Y} - {y}) / {P.CONE}) + {P.GRID['lon0']})"
    return f"degrees({lat})", lon


def _utm_sql(x: str, y: str, meridian: float, south: bool) -> tuple[str, str]:
    radius, beta, delta = P.utm_series()
    shift = P.UTM_SOUTH_NORTHING if south else 0.0
    xi = f"(({y} - {shift}) / {P.UTM_SCALE * radius})"
    eta = f"(({x} - {P.UTM_EASTING}) / {P.UTM_SCALE * radius})"
    cosh = lambda v: f"((exp({v}) + exp(-({v}))) / 2)"
    sinh = lambda v: f"((exp({v}) - exp(-({v}))) / 2)"
    xi1, eta1 = xi, eta
    for j, b in enumerate(beta, start=1):
        xi1 += f" - {b!r} * sin({2 * j} * {xi}) * {cosh(f'{2 * j} * {eta}')}"
        eta1 += f" - {b!r} * cos({2 * j} * {xi}) * {sinh(f'{2 * j} * {eta}')}"
    xi1, eta1 = f"({xi1})", f"({eta1})"
    chi = f"asin(sin({xi1}) / {cosh(eta1)})"
    lat = chi
    for j, d in enumerate(delta, start=1):
        lat += f" + {d!r} * sin({2 * j} * {chi})"
    return f"degrees({lat})", f"(degrees(atan2({sinh(eta1)}, cos({xi1}))) + {meridian})"


def latlon_sql(x: str, y: str, department: str) -> tuple[str, str]:
    """Rounded latitude and longitude of a projected position, by department."""
    lat = lon = ""
    for code, (meridian, south) in P.UTM_ZONES.items():
        a, b = _utm_sql(x, y, meridian, south)
        lat += f" WHEN '{code}' THEN {a}"
        lon += f" WHEN '{code}' THEN {b}"
    a, b = _grid_sql(x, y)
    return (
        f"round(CASE {department}{lat} ELSE {a} END, 6)",
        f"round(CASE {department}{lon} ELSE {b} END, 6)",
    )


def raw_rows(table: str, columns: str = "*", where: str = "") -> str:
    alias = "local_" if table == "local" else table
    return oracle(f"SELECT {columns} FROM {alias} {where}", table)


def exported_mutation(where: str = "") -> str:
    """Dumped sales after export: list columns by their first entry, position as lat/lon."""
    plain = (
        "idmutation, idopendata, datemut, anneemut, moismut, idnatmut, libnatmut, vefa, coddep, "
        "valeurfonc, nbdispo, nblot, nbcomm, nbpar, nbparmut, codtypbien, libtypbien, sbati, "
        "sbatmai, sbatapt, sbatact, sterr, nblocmut, nblocmai, nblocapt, nblocact, nblocdep, nbsuf"
    )
    first = lambda c: f"nullif(split_part(trim({c}, '{{}}'), ',', 1), '')"
    lat, lon = latlon_sql("point_x", "point_y", "coddep")
    return oracle(
        f"SELECT {plain}, {first('l_codinsee')} AS codinsee, {first('l_section')} AS section, "
        f"{first('l_par')} AS par, {first('l_artcgi')} AS artcgi, {lat} AS latitude, "
        f"{lon} AS longitude FROM mutation_dump {where}",
        "mutation_dump",
    )


def _report() -> str:
    """Failing rows of every declared check, as one UNION ALL."""
    rows = []
    for c in declared_checks():
        if c.test == "unique":
            found = (
                f"(SELECT count(*) FROM (SELECT {c.column} FROM {c.model} WHERE {c.column} IS NOT NULL "
                f"GROUP BY 1 HAVING count(*) > 1))"
            )
        elif c.test == "not_null":
            found = f"(SELECT count(*) FROM {c.model} WHERE {c.column} IS NULL)"
        elif c.test == "relationships":
            found = (
                f"(SELECT count(*) FROM {c.model} a WHERE a.{c.column} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {c.to} b WHERE b.{c.field} = a.{c.column}))"
            )
        elif c.test == "accepted_values":
            values = ", ".join(f"'{v}'" for v in c.values)
            found = f"(SELECT count(DISTINCT {c.column}) FROM {c.model} WHERE {c.column} NOT IN ({values}))"
        else:
            found = f"(SELECT count(*) FROM {c.model} WHERE NOT ({c.column} {c.values[0]}))"
        rows.append(
            f"SELECT '{c.model}' AS model, '{c.column}' AS \"column\", '{c.test}' AS test, "
            f"'{c.severity}' AS severity, {found} AS failures"
        )
    final = (
        "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
        "ELSE 'fail' END AS status FROM (" + "\nUNION ALL ".join(rows) + ")"
    )
    return oracle(final, *dict.fromkeys(c.model for c in declared_checks()))


def _counts(tables: tuple[str, ...], total: bool) -> str:
    rows = [
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM ({raw_sql(t)})".format(
            **{n: n for n in TRIAL_TABLES}
        )
        for t in tables
    ]
    body = "\nUNION ALL ".join(rows)
    if not total:
        return body
    return (
        f"WITH c AS ({body}) SELECT * FROM c UNION ALL "
        "SELECT '(total)', CAST(sum(row_count) AS BIGINT) FROM c"
    )


def _orphans(child: str, key: str, parent: str, field: str) -> str:
    return oracle(
        f"SELECT {key} AS orphan_key, count(*) AS row_count FROM {child} c WHERE {key} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{field} = c.{key}) GROUP BY 1",
        child, parent,
    )


def _coverage(used: str, key: str, official: str, code: str) -> str:
    return oracle(
        f"""SELECT DISTINCT {key} AS code, 'not_official' AS gap FROM {used} u WHERE {key} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {official} o WHERE o.{code} = u.{key})
UNION ALL SELECT DISTINCT {code}, 'not_sold' FROM {official} o WHERE {code} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {used} u WHERE u.{key} = o.{code})""",
        used, official,
    )


def _fact(final: str) -> str:
    return oracle(final, "fct_transactions")


def _spherical_centroid() -> str:
    """Edges of all rings as rows, with their arcs; rings and shapes are grouped again."""
    rings = "from_json(geometry->'$.coordinates', '{}')"
    deep = '[[[["DOUBLE"]]]]'
    flat = '[[["DOUBLE"]]]'
    d = lambda p, n: f"({p}{n} - o{n})"
    near = {
        "x": f"{d('p', 'y')} * {d('q', 'z')} - {d('p', 'z')} * {d('q', 'y')}",
        "y": f"{d('p', 'z')} * {d('q', 'x')} - {d('p', 'x')} * {d('q', 'z')}",
        "z": f"{d('p', 'x')} * {d('q', 'y')} - {d('p', 'y')} * {d('q', 'x')}",
    }
    normal = {"x": "py * qz - pz * qy", "y": "pz * qx - px * qz", "z": "px * qy - py * qx"}
    axes = ("x", "y", "z")
    return oracle(
        "SELECT * FROM (WITH shapes AS (SELECT row_number() OVER () AS id, coalesce(code, '?' || nom) AS code, "
        f"CASE WHEN NOT is_valid THEN NULL WHEN geometry->>'$.type' = 'Polygon' THEN [{rings.format(flat)}] "
        f"ELSE {rings.format(deep)} END AS polygons FROM commune_shapes), "
        "parts AS (SELECT id, unnest(polygons) AS polygon, generate_subscripts(polygons, 1) AS part FROM shapes), "
        "rings AS (SELECT id, part, unnest(polygon) AS ring, generate_subscripts(polygon, 1) AS r FROM parts), "
        "points AS (SELECT id, part, r, unnest(ring) AS spot, generate_subscripts(ring, 1) AS i FROM rings), "
        "units AS (SELECT id, part, r, i, cos(radians(spot[2])) * cos(radians(spot[1])) AS px, "
        "cos(radians(spot[2])) * sin(radians(spot[1])) AS py, sin(radians(spot[2])) AS pz FROM points), "
        "edges AS (SELECT *, " + ", ".join(f"lead(p{n}) OVER w AS q{n}, first(p{n}) OVER w AS o{n}" for n in axes)
        + " FROM units WINDOW w AS (PARTITION BY id, part, r ORDER BY i)), "
        "arcs AS (SELECT *, " + ", ".join(f"{normal[n]} AS n{n}" for n in axes) + ", px * qx + py * qy + pz * qz AS dot FROM edges), "
        "known AS (SELECT *, sqrt(nx * nx + ny * ny + nz * nz) AS sine FROM arcs), "
        "weighed AS (SELECT *, CASE WHEN sine < 1e-3 AND dot > 0 THEN sine * sine / 6 + 3 * sine ** 4 / 40 "
        "ELSE atan2(sine, dot) / sine - 1 END AS more FROM known), "
        "vectors AS (SELECT id, part, r, " + ", ".join(f"sum({near[n]} + more * n{n}) AS v{n}, sum(p{n}) AS m{n}" for n in axes)
        + " FROM weighed GROUP BY 1, 2, 3), "
        "whole AS (SELECT id, " + ", ".join(
            f"sum(CASE WHEN r = 1 THEN 1 ELSE -1 END * CASE WHEN vx * mx + vy * my + vz * mz < 0 THEN -1 ELSE 1 END * v{n}) AS c{n}" for n in axes)
        + " FROM vectors GROUP BY 1) "
        "SELECT code, round(degrees(atan2(cy, cx)), 6) AS lon, "
        "round(degrees(atan2(cz, sqrt(cx * cx + cy * cy))), 6) AS lat FROM shapes LEFT JOIN whole USING (id))",
        "commune_shapes",
    )


def _banded_median(key: str, value: str, name: str, where: str = "TRUE") -> str:
    """The middle amounts of each group by sorting, each put into the band of its first three digits."""
    middle = (
        "(c // w * w + CASE WHEN c < 0 THEN -1 ELSE 1 END * (w - 1)::DOUBLE / 2) / 100"
    )
    return _fact(
        f"SELECT {key}, round((max(CASE WHEN i = (n - 1) // 2 THEN {middle} END) "
        f"+ max(CASE WHEN i = n // 2 THEN {middle} END)) / 2, 4) AS {name}, max(n) AS n FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY c) - 1 AS i, "
        f"count(*) OVER (PARTITION BY {key}) AS n, "
        "CAST(rpad('1', CAST(greatest(length(CAST(abs(c) AS VARCHAR)) - 3, 0) + 1 AS INTEGER), '0') AS BIGINT) AS w FROM ("
        f"SELECT {key}, CAST(round(CAST({value} AS DECIMAL(36, 6)) * 100, 0) AS BIGINT) AS c "
        f"FROM fct_transactions WHERE {value} IS NOT NULL AND {where})) GROUP BY 1",
    )


def build() -> dict[str, str]:
    lat, lon = latlon_sql("point_x", "point_y", "coddep")
    sql: dict[str, str] = {
        # sources
        "scan_csv_table": raw_rows("disposition"),
        "scan_csv_chunks": raw_rows("mutation"),
        "scan_geojson": raw_rows("geo_communes"),
        "scan_copy_dump": oracle(
            "SELECT 'mutation' AS table_name, * EXCLUDE (point_x, point_y) "
            "REPLACE (CAST(anneemut AS VARCHAR) AS anneemut, "
            + ", ".join(f"trim({c}, '{{}}') AS {c}" for c in _DUMP_LISTS)
            + ") FROM mutation_dump UNION ALL BY NAME SELECT 'disposition' AS table_name, * FROM disposition",
            "mutation_dump", "disposition"),
        "scan_source_tables": "SELECT table_name, row_count, n_columns FROM ("
            + _counts(SOURCE_TABLES, False) + ") JOIN (VALUES "
            + ", ".join(f"('{t}', {len(RAW_COLUMNS[t])})" for t in SOURCE_TABLES)
            + ") v(name, n_columns) ON name = table_name",
        "gen_date_spine": oracle(
            "SELECT day, count(transaction_date) AS sales FROM calendar_of_sales "
            "LEFT JOIN stg_mutations ON day = transaction_date GROUP BY day",
            "calendar_of_sales", "stg_mutations"),
        # sinks
        "write_csv_export": raw_rows("disposition_parcelle"),
        "write_partitioned_clustered": model_oracle("fct_transactions"),
        "write_clustered": model_oracle("fct_transactions"),
        "read_clustered": _fact(
            "SELECT * FROM fct_transactions WHERE transaction_year BETWEEN 2018 AND 2020 "
            "AND property_type_label IN ('UNE MAISON', 'UN APPARTEMENT') AND department_code IN ('13', '75')"),
        "delete_rows_clustered": _fact("SELECT * FROM fct_transactions WHERE department_code IN ('13', '2A', '75')"),
        "write_truncate": model_oracle("stg_dispositions"),
        "write_chunk": oracle(
            "SELECT CASE WHEN transaction_year < 2020 THEN '001' ELSE '1' END AS batch_id, "
            "count(*) AS row_count, CAST(sum(CAST(transaction_price_eur AS DECIMAL(20, 2))) AS DOUBLE) AS total_price_eur "
            "FROM stg_mutations GROUP BY 1", "stg_mutations"),
        "materialize_layer": model_oracle("dim_property_types"),
        "load_row_counts": _counts(SOURCE_TABLES, True),
        "list_partitions": _fact(
            "SELECT CAST(transaction_year AS INTEGER) AS partition_id, count(*) AS total_rows "
            "FROM fct_transactions GROUP BY 1"),
        # projections and filters
        "export_mutation": exported_mutation(),
        "export_parcelle": raw_rows("parcelle", "* EXCLUDE (geompar)"),
        "export_disposition_parcelle": raw_rows("disposition_parcelle"),
        "export_simple": raw_rows("local"),
        "array_first": oracle(
            "SELECT idmutation, nullif(split_part(trim(l_codinsee, '{}'), ',', 1), '') AS codinsee, "
            "nullif(split_part(trim(l_artcgi, '{}'), ',', 1), '') AS artcgi FROM mutation_dump",
            "mutation_dump"),
        "point_to_latlon": oracle(
            f"SELECT idmutation, coddep, {lat} AS latitude, {lon} AS longitude FROM mutation_dump",
            "mutation_dump"),
        "filter_departments": raw_rows("disposition", "*", "WHERE coddep IN ('2A', '04', '971')"),
        "delete_outside_departments": raw_rows("adresse", "*", "WHERE coddep IN ('2B', '10', '974')"),
        "stg_mutations": model_oracle("stg_mutations"),
        "stg_dispositions": model_oracle("stg_dispositions"),
        "stg_locals": model_oracle("stg_locals"),
        "stg_parcelles": model_oracle("stg_parcelles"),
        "stg_geo_departments": model_oracle("stg_geo_departments"),
        "stg_geo_communes": model_oracle("stg_geo_communes"),
        "price_positive": oracle(
            "SELECT mutation_id, transaction_price_eur FROM all_mutations WHERE transaction_price_eur > 0",
            "all_mutations"),
        "not_null_filter": oracle(
            "SELECT commune_code, department_code FROM stg_parcelles WHERE commune_code IS NOT NULL",
            "stg_parcelles"),
        "dash_filters": _fact(
            "SELECT * FROM fct_transactions WHERE transaction_year BETWEEN 2018 AND 2020 "
            "AND property_type_label IN ('UNE MAISON', 'UN APPARTEMENT') AND department_code = '13'"),
        # joins
        "int_transactions_enriched": model_oracle("int_transactions_enriched"),
        "fct_transactions": model_oracle("fct_transactions"),
        "dim_communes": model_oracle("dim_communes"),
        "fk_anti_join": _orphans("stg_dispositions", "mutation_id", "stg_mutations", "mutation_id"),
        "resume_anti_join": oracle(
            "SELECT anneemut, count(*) AS row_count FROM mutation WHERE anneemut >= 2018 GROUP BY 1",
            "mutation"),
        "label_lookup": oracle(
            "SELECT m.idmutation, m.idnatmut, a.libnatmut AS nature_label FROM mutation m "
            "LEFT JOIN ann_nature_mutation a ON m.idnatmut = a.idnatmut",
            "mutation", "ann_nature_mutation"),
        "label_lookup_local": oracle(
            "SELECT l.iddispoloc, l.codtyploc, a.libtyploc AS type_label FROM local_ l "
            "LEFT JOIN ann_type_local a ON l.codtyploc = a.codtyploc", "local", "ann_type_local"),
        "address_join_parcel": oracle(
            "SELECT p.iddispopar, x.idadr, a.codvoie, a.typvoie, a.novoie, a.codepostal "
            "FROM disposition_parcelle p JOIN adresse_dispoparc x ON p.iddispopar = x.iddispopar "
            "LEFT JOIN adresse a ON x.idadr = a.idadr",
            "disposition_parcelle", "adresse_dispoparc", "adresse"),
        "export_simple_columns": oracle(
            "\nUNION ALL ".join(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, "
                f"count({c}) AS filled, count(DISTINCT {c}) AS different FROM {'local_' if t == 'local' else t}"
                for t in SIMPLE_EXPORT_TABLES for c in raw_columns(t)
            ), *SIMPLE_EXPORT_TABLES),
        "address_join": oracle(
            "SELECT l.iddispoloc, x.idadr, a.codvoie, a.typvoie, a.novoie, a.codepostal FROM local_ l "
            "JOIN adresse_local x ON l.iddispoloc = x.iddispoloc LEFT JOIN adresse a ON x.idadr = a.idadr",
            "local", "adresse_local", "adresse"),
        # aggregations
        "disposition_agg": oracle(
            "SELECT mutation_id, disposition_count_actual, "
            "round(total_disposition_price_eur, 2) AS total_disposition_price_eur FROM disposition_agg",
            "disposition_agg"),
        "local_agg": model_oracle("local_agg"),
        "parcelle_agg": model_oracle("parcelle_agg"),
        "arg_first": oracle("SELECT mutation_id, commune_code FROM parcelle_agg", "parcelle_agg"),
        "mode_by_group": model_oracle("mode_by_group"),
        "dim_property_types": model_oracle("dim_property_types"),
        "distinct_pairs": model_oracle("distinct_pairs"),
        "tile_count_by_type": _fact(
            "SELECT property_type_label, count(*) AS transaction_count FROM fct_transactions GROUP BY 1"),
        "tile_value_by_type": _fact(
            "SELECT property_type_label, CAST(sum(CAST(transaction_price_eur AS DECIMAL(20, 2))) AS DOUBLE) AS total_price_eur "
            "FROM fct_transactions GROUP BY 1"),
        "tile_avg_price_by_year": _fact(
            "SELECT transaction_year, round(avg(transaction_price_eur), 6) AS avg_price_eur "
            "FROM fct_transactions GROUP BY 1"),
        "tile_volume_by_year": _fact(
            "SELECT transaction_year, count(*) AS transaction_count, "
            "round(avg(transaction_price_eur), 6) AS avg_price_eur FROM fct_transactions GROUP BY 1"),
        "tile_ppsqm_by_department": _fact(
            "SELECT department_code, round(avg(price_per_sqm), 6) AS avg_price_per_sqm, "
            "count(*) AS transaction_count FROM fct_transactions WHERE price_per_sqm IS NOT NULL GROUP BY 1"),
        "validate_rounded_avg": _fact(
            "SELECT transaction_year, count(*) AS cnt, round(avg(transaction_price_eur)) AS avg_price, "
            "(SELECT count(*) FROM fct_transactions) AS total_rows FROM fct_transactions GROUP BY 1"),
        "raw_count_by_department": raw_rows(
            "mutation", "coddep, count(*) AS cnt", "WHERE anneemut = 2023 GROUP BY coddep"),
        "year_department_stats": _fact(
            "SELECT department_code, count(*) AS transaction_count, "
            "round(avg(transaction_price_eur), 6) AS avg_price FROM fct_transactions "
            "WHERE transaction_year = 2023 GROUP BY 1"),
        "trend_for_segment": _fact(
            "SELECT transaction_year, round(avg(transaction_price_eur), 6) AS avg_price, count(*) AS n "
            "FROM fct_transactions WHERE transaction_year BETWEEN 2020 AND 2023 "
            "AND department_code = '13' AND property_type_code = '21' GROUP BY 1"),
        "median_price_by_year": _fact(
            "SELECT transaction_year, round(median(transaction_price_eur), 4) AS median_price_eur "
            "FROM fct_transactions GROUP BY 1"),
        "median_ppsqm_by_department": _fact(
            "SELECT department_code, round(median(price_per_sqm), 4) AS median_price_per_sqm "
            "FROM fct_transactions WHERE price_per_sqm IS NOT NULL GROUP BY 1"),
        "sketch_median_price_by_year": _banded_median(
            "transaction_year", "transaction_price_eur", "median_price_eur"),
        "sketch_median_ppsqm_by_department": _banded_median(
            "department_code", "price_per_sqm", "median_price_per_sqm", "transaction_year BETWEEN 2019 AND 2022"),
        "ppsqm_distribution": _fact(
            "SELECT least(floor(price_per_sqm / 500.0), 40) * 500.0 AS band_start, "
            "count(*) AS transaction_count FROM fct_transactions WHERE price_per_sqm IS NOT NULL GROUP BY 1"),
        "volume_by_commune": oracle(
            "SELECT f.commune_code, transaction_count, geo_name, centroid_lat, centroid_lon FROM "
            "(SELECT commune_code, count(*) AS transaction_count FROM fct_transactions GROUP BY 1) f "
            "LEFT JOIN (SELECT * FROM dim_geography WHERE geo_level = 'commune') g "
            "ON f.commune_code = g.geo_code", "fct_transactions", "dim_geography"),
        "accumulate_row_counts": oracle(
            "SELECT 'mutation' AS table_name, count(*) AS row_count FROM mutation "
            "WHERE anneemut <> 2014", "mutation"),
        # sorts
        "top_types": _fact(
            "SELECT property_type_label, count(*) AS cnt FROM fct_transactions GROUP BY 1 "
            "ORDER BY cnt DESC, 1 LIMIT 10"),
        "order_by_year": _fact(
            "SELECT transaction_year, count(*) AS transaction_count FROM fct_transactions GROUP BY 1 ORDER BY 1"),
        "order_by_metric": _fact(
            "SELECT department_code, CAST(sum(CAST(transaction_price_eur AS DECIMAL(20, 2))) AS DOUBLE) AS total_price_eur "
            "FROM fct_transactions GROUP BY 1 ORDER BY 2 DESC, 1"),
        # set operations
        "all_commune_codes": model_oracle("all_commune_codes"),
        "dim_geography": model_oracle("dim_geography"),
        # scalars
        "scalar_casts": oracle(
            "SELECT mutation_id, transaction_year, transaction_month, transaction_price_eur, "
            "land_area_sqm, sold_parcel_count, latitude, department_code FROM all_mutations", "all_mutations"),
        "normalize_bool": oracle("SELECT mutation_id, is_vefa FROM all_mutations", "all_mutations"),
        "safe_parse_date": oracle(
            "SELECT mutation_id, transaction_date FROM all_mutations", "all_mutations"),
        "commune_code": oracle(
            "SELECT disposition_parcel_id, commune_code FROM stg_parcelles", "stg_parcelles"),
        "department_from_commune": oracle(
            "SELECT mutation_id, insee_code, CASE WHEN insee_code LIKE '97%' THEN insee_code[1:3] "
            "ELSE insee_code[1:2] END AS derived_department FROM all_mutations", "all_mutations"),
        "level1_label": oracle(
            "SELECT mutation_id, property_type_code[1] AS level1, CASE property_type_code[1] "
            "WHEN '1' THEN 'Built property' WHEN '2' THEN 'Unbuilt land' ELSE 'Other' END AS level1_label "
            "FROM all_mutations", "all_mutations"),
        "price_per_sqm": oracle(
            "SELECT mutation_id, CASE WHEN total_built_area_sqm <> 0 THEN "
            "transaction_price_eur / total_built_area_sqm END AS price_per_sqm FROM all_mutations",
            "all_mutations"),
        "dim_dates": oracle(f"SELECT {DATE_COLUMNS} FROM calendar_of_sales", "calendar_of_sales"),
        "calendar_attributes": oracle(
            f"SELECT mutation_id, {DATE_COLUMNS} FROM (SELECT mutation_id, transaction_date AS day "
            "FROM stg_mutations WHERE transaction_date IS NOT NULL)", "stg_mutations"),
        "geojson_parse": oracle(
            "SELECT coalesce(code, '?' || nom) AS code, is_valid FROM commune_shapes", "commune_shapes"),
        "polygon_centroid": oracle(
            "SELECT coalesce(code, '?' || nom) AS code, round(cx, 6) AS lon, round(cy, 6) AS lat "
            "FROM commune_shapes", "commune_shapes"),
        "spherical_centroid": _spherical_centroid(),
        # ingestion
        "manifest_read_write": oracle(
            "SELECT 'mutation' AS table_name, count(*) AS row_count FROM mutation", "mutation"),
        "chunk_cycle": raw_rows("mutation"),
        "stream_ingest": raw_rows("mutation"),
        "stream_dumps": oracle(
            "SELECT 'mutation' AS table_name, * REPLACE (CAST(anneemut AS VARCHAR) AS anneemut) FROM mutation "
            "UNION ALL BY NAME SELECT 'disposition' AS table_name, * FROM disposition", "mutation", "disposition"),
        "reingest_subset": raw_rows("mutation", where="WHERE anneemut <> 2014"),
        "incremental_merge": oracle(
            "SELECT mutation_id, CASE WHEN transaction_year >= 2022 THEN 2 ELSE 1 END AS release, "
            "CASE WHEN transaction_year >= 2022 THEN transaction_price_eur "
            "ELSE transaction_price_eur + 1000.0 END AS transaction_price_eur, department_code "
            "FROM stg_mutations", "stg_mutations"),
        # data quality
        "dq_unique": oracle(
            "SELECT mutation_id AS value, count(*) AS row_count FROM stg_dispositions "
            "WHERE mutation_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1", "stg_dispositions"),
        "dq_not_null": oracle(
            "UNPIVOT (SELECT count(*) - count(transaction_date) AS transaction_date, "
            "count(*) - count(insee_code) AS insee_code, "
            "count(*) - count(property_type_code) AS property_type_code, "
            "count(*) - count(mutation_id) AS mutation_id FROM stg_mutations) "
            "ON transaction_date, insee_code, property_type_code, mutation_id "
            "INTO NAME column_name VALUE failures", "stg_mutations"),
        "dq_relationships": _orphans("stg_parcelles", "mutation_id", "stg_mutations", "mutation_id"),
        "dq_accepted_values": oracle(
            "SELECT property_type_code[1] AS value, count(*) AS row_count FROM stg_mutations "
            "WHERE property_type_code[1] NOT IN ('1', '2') GROUP BY 1", "stg_mutations"),
        "dq_expression": oracle(
            "SELECT count(*) AS failures FROM all_mutations WHERE NOT (transaction_price_eur > 0)",
            "all_mutations"),
        "dq_report": _report(),
        "dq_date_range": oracle(
            "SELECT count(*) FILTER (transaction_date NOT BETWEEN DATE '2014-01-01' AND DATE '2025-06-30') "
            "AS outside, count(*) FILTER (transaction_date IS NULL) AS missing FROM stg_mutations",
            "stg_mutations"),
        "dq_year_range": oracle(
            "SELECT count(*) FILTER (transaction_year NOT BETWEEN 2014 AND 2025) AS outside FROM stg_mutations",
            "stg_mutations"),
        "dq_fk_chain": oracle(
            "SELECT 'parcel_link_to_disposition' AS step, count(DISTINCT disposition_id) AS orphan_keys, "
            "count(*) AS orphan_rows FROM stg_parcelles p WHERE disposition_id NOT IN "
            "(SELECT disposition_id FROM stg_dispositions) UNION ALL "
            "SELECT 'local_to_parcel_link', count(DISTINCT disposition_parcel_id), count(*) FROM stg_locals "
            "WHERE disposition_parcel_id NOT IN (SELECT disposition_parcel_id FROM stg_parcelles)",
            "stg_parcelles", "stg_dispositions", "stg_locals"),
        "dq_department_codes": oracle(
            "SELECT department_code AS value, count(*) AS row_count FROM stg_mutations GROUP BY 1 "
            "HAVING value IS NULL OR value = '20' "
            "OR NOT regexp_full_match(value, '0[1-9]|[1-8][0-9]|9[0-5]|2[AB]|97[12346]')",
            "stg_mutations"),
        "dq_type_not_null": oracle(
            "SELECT count(*) FILTER (property_type_code IS NULL) AS failures, count(*) AS row_count "
            "FROM stg_mutations", "stg_mutations"),
        "dq_geometry_null_rate": oracle(
            "SELECT department_code, count(*) AS row_count, count(*) - count(latitude) AS missing, "
            "round((count(*) - count(latitude)) / count(*), 6) AS null_rate FROM stg_mutations GROUP BY 1",
            "stg_mutations"),
        "dq_department_coverage": _coverage(
            "stg_mutations", "department_code", "stg_geo_departments", "department_code"),
        "dq_commune_coverage": _coverage(
            "stg_parcelles", "commune_code", "stg_geo_communes", "commune_code"),
        "dq_min_features": "SELECT table_name, row_count AS features, minimum, row_count >= minimum AS ok FROM ("
            + _counts(("geo_departments", "geo_communes"), False) + ") JOIN (VALUES "
            + ", ".join(f"('{t}', CAST({n} AS BIGINT))" for t, n in MINIMUM_FEATURES.items())
            + ") v(name, minimum) ON name = table_name",
        "dq_expected_tables": "SELECT table_name, row_count, 'pass' AS status FROM ("
            + _counts(PRINCIPAL_TABLES + REFERENCE_TABLES, False) + ")",
    }
    return sql
