"""Raw sale tables derived from the TPC-H-like trial tables (see FIXTURES.md).

The SQL is valid in Spark and in DuckDB, so one text feeds the job and its oracle. A raw table is
built from the columns asked for: a lookup join whose columns nobody needs is left out, which
changes no row because every lookup is a left join on a unique key.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from salesmart.functions.scalars import pg_array
from salesmart.sources.contracts import RAW_COLUMNS

TRIAL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _money(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) AS STRING)"


def _department(nation: str) -> str:
    return (
        f"CASE {nation} WHEN 0 THEN '2A' WHEN 1 THEN '2B' WHEN 2 THEN '971' WHEN 3 THEN '974' "
        f"ELSE lpad(CAST({nation} AS STRING), 2, '0') END"
    )


def _suffix(number: str, dep: str = "dep") -> str:
    return f"lpad(CAST({number} AS STRING), CAST(5 - length({dep}) AS INT), '0')"


def _sale_date(key: str) -> str:
    return f"(date '2014-01-01' + CAST(({key} * 37) % 4383 AS INT))"


_SALE_DATE_TEXT = "CASE WHEN k % 97 = 0 THEN 'not-a-date' ELSE CAST(d AS STRING) END"

# Row sources: `sales` has one row per order, `lines` one per order line. Every line key stays
# below 2**63 up to 6e11 orders.
_SALES = f"""(SELECT o_orderkey AS k, o_custkey AS cust, o_totalprice AS price,
  {_sale_date('o_orderkey')} AS d FROM {{orders}}) sales"""
_LINES = f"""(SELECT (l_orderkey * 8 + l_linenumber) * 1048576
    + (l_partkey * 1009 + l_suppkey) % 1048576 AS pk,
  l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_extendedprice AS x,
  l_quantity AS qty, l_linestatus AS ls, l_returnflag AS rf, {_sale_date('l_orderkey')} AS d
  FROM {{lineitem}}) lines"""
_PLACE_OF_SALE = f"""LEFT JOIN (SELECT c_custkey AS ck, {_department('c_nationkey')} AS dep
  FROM {{customer}}) places ON cust = ck"""
_PLACE_OF_LINE = f"""LEFT JOIN (SELECT o_orderkey AS bk, {_department('c_nationkey')} AS dep
  FROM {{orders}} LEFT JOIN {{customer}} ON o_custkey = c_custkey) places ON k = bk"""
_SIZE_OF_LINE = "LEFT JOIN (SELECT p_partkey AS sp, p_size AS sz FROM {part}) sizes ON p = sp"

# Projected position of a sale in metres: national grid, or the zone of an overseas department.
POSITION_X = (
    "CAST(CASE dep WHEN '971' THEN 600000 + (k * 97) % 90000 WHEN '974' THEN 310000 + (k * 97) % 60000 "
    "ELSE 300000 + (k * 97) % 600000 END AS DOUBLE)"
)
POSITION_Y = (
    "CAST(CASE dep WHEN '971' THEN 1760000 + (k * 131) % 60000 WHEN '974' THEN 7630000 + (k * 131) % 60000 "
    "ELSE 6200000 + (k * 131) % 800000 END AS DOUBLE)"
)

_SALE_COLUMNS = {
    "idmutation": _text("k"),
    "idopendata": f"'OD-' || {_text('k')}",
    "datemut": _SALE_DATE_TEXT,
    "anneemut": "CAST(year(d) AS BIGINT)",
    "moismut": _text("month(d)"),
    "idnatmut": _text("1 + k % 5"),
    "libnatmut": "CASE WHEN k % 5 = 0 THEN 'Vente' ELSE 'Autre' END",
    "vefa": "CASE k % 7 WHEN 0 THEN 't' WHEN 1 THEN 'TRUE' WHEN 2 THEN '1' WHEN 3 THEN 'f' "
            "WHEN 4 THEN 'false' WHEN 5 THEN '0' ELSE NULL END",
    "coddep": "dep",
    # k % 31 = 0: a commune code that many departments claim, so that the vote has ties.
    "codinsee": f"CASE WHEN k % 19 = 0 THEN NULL WHEN k % 31 = 0 THEN '75' || lpad({_text('k % 20')}, 3, '0') "
                f"ELSE dep || {_suffix('k % 30')} END",
    "valeurfonc": f"CASE WHEN k % 11 = 0 THEN '0' WHEN k % 13 = 0 THEN NULL ELSE {_money('price')} END",
    "nbdispo": _text("1 + k % 3"),
    "nblot": _text("k % 6"),
    "nbcomm": _text("1 + k % 2"),
    "nbpar": _text("1 + k % 8"),
    "nbparmut": f"CASE WHEN k % 37 = 0 THEN NULL ELSE {_text('1 + k % 4')} END",
    "codtypbien": "CASE WHEN k % 23 = 0 THEN NULL WHEN k % 4 = 0 THEN '111' WHEN k % 4 = 1 THEN '121' "
                  "WHEN k % 4 = 2 THEN '21' ELSE '3' END",
    "libtypbien": "CASE WHEN k % 23 = 0 THEN NULL WHEN k % 4 = 0 THEN 'UNE MAISON' "
                  "WHEN k % 4 = 1 THEN 'UN APPARTEMENT' WHEN k % 4 = 2 THEN 'TERRAIN DE TYPE TAB' "
                  "ELSE 'ACTIVITE' END",
    "sbati": f"CASE WHEN k % 4 = 2 THEN '0' WHEN k % 29 = 0 THEN NULL ELSE {_text('20 + k % 180')} END",
    "sbatmai": f"CASE WHEN k % 4 = 0 THEN {_text('20 + k % 180')} ELSE '0' END",
    "sbatapt": f"CASE WHEN k % 4 = 1 THEN {_text('20 + k % 180')} ELSE '0' END",
    "sbatact": f"CASE WHEN k % 4 = 3 THEN {_text('20 + k % 180')} ELSE NULL END",
    "sterr": _text("k % 2500"),
    "nblocmut": _text("k % 4"),
    "nblocmai": _text("CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END"),
    "nblocapt": _text("CASE WHEN k % 4 = 1 THEN 1 + k % 3 ELSE 0 END"),
    "nblocact": _text("CASE WHEN k % 4 = 3 THEN 1 ELSE 0 END"),
    "nblocdep": f"CASE WHEN k % 41 = 0 THEN NULL ELSE {_text('k % 3')} END",
    "nbsuf": _text("k % 5"),
    "latitude": "CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(CAST(41 + CAST(k % 1000 AS DOUBLE) / 100 AS DECIMAL(9,4)) AS STRING) END",
    "longitude": "CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(CAST(CAST(k % 1300 AS DOUBLE) / 100 - 5 AS DECIMAL(9,4)) AS STRING) END",
}

# The sale table as a dump delivers it: arrays as text, a point geometry, internal columns.
_DUMP_ONLY = {
    "l_codinsee": f"CASE WHEN k % 19 = 0 THEN '{{{{}}}}' ELSE '{{{{' || dep || {_suffix('k % 30')} || ',' || dep || {_suffix('k % 7')} || '}}}}' END",
    "l_section": f"CASE WHEN k % 9 = 0 THEN NULL ELSE '{{{{A' || {_text('k % 10')} || ',B}}}}' END",
    "l_par": f"'{{{{' || {_text('k')} || '}}}}'",
    "l_artcgi": "CASE WHEN k % 2 = 0 THEN '{{683}}' ELSE '{{257-7-1-2,683}}' END",
    "l_dcnt": f"'{{{{0,0,' || {_text('k % 900')} || '}}}}'",
    "l_idpar": f"'{{{{' || {_text('k')} || '}}}}'",
    "l_idparmut": "'{{}}'",
    "l_idlocmut": "'{{}}'",
    "point_x": POSITION_X,
    "point_y": POSITION_Y,
    "geomparmut": "'poly'",
    "geompar": "'poly'",
    "codservch": "'S'",
    "refdoc": _text("k"),
    "idmutinvar": f"'INV-' || {_text('k')}",
}

_DISPOSITION_COLUMNS = {
    "iddispo": _text("pk"),
    "idmutation": _text("k"),
    "nodispo": _text("n"),
    "valeurfonc": _money("x"),
    "nblot": _text("p % 3"),
    "coddep": "dep",
}
_LOCAL_COLUMNS = {
    "iddispoloc": _text("pk"),
    "iddispopar": _text("pk"),
    "idmutation": _text("k"),
    "idloc": f"'L' || {_text('p')} || '-' || {_text('s')}",
    "codtyploc": _text("1 + p % 4"),
    "libtyploc": "CASE p % 4 WHEN 0 THEN 'Maison' WHEN 1 THEN 'Appartement' WHEN 2 THEN 'Dependance' "
                 "ELSE 'Local industriel' END",
    "nbpprinc": f"CASE WHEN p % 9 = 0 THEN NULL ELSE {_text('sz % 8')} END",
    "sbati": _text("10 + sz"),
    "coddep": "dep",
    "datemut": _SALE_DATE_TEXT,
    "anneemut": _text("year(d)"),
}
_PARCEL_LINK_COLUMNS = {
    "iddispopar": _text("pk"),
    "iddispo": _text("pk"),
    "idparcelle": _text("p"),
    "idmutation": _text("k"),
    "idpar": f"dep || '-' || {_text('p')}",
    "coddep": "dep",
    "codcomm": f"CASE WHEN p % 17 = 0 THEN NULL ELSE {_suffix('p % 30')} END",
    "prefsect": "'000'",
    "nosect": f"'A' || {_text('p % 10')}",
    "noplan": f"lpad({_text('p % 1000')}, 4, '0')",
    "datemut": _SALE_DATE_TEXT,
    "anneemut": _text("year(d)"),
    "parcvendue": "CASE p % 4 WHEN 0 THEN 't' WHEN 1 THEN 'f' WHEN 2 THEN 'True' ELSE NULL END",
    "dcntsol": _text("CAST(qty AS INT)"),
    "dcntagri": _text("n * 10"),
    "dcntnat": _text("n"),
}

_PARTS = "(SELECT p_partkey AS p, {dep} AS dep FROM {part}) parts".replace(
    "{dep}", _department("(p_partkey % 25)")
)
_PARCEL_COLUMNS = {
    "idparcelle": _text("p"),
    "idpar": f"dep || '-' || {_text('p')}",
    "coddep": "dep",
    "codcomm": _suffix("p % 30"),
    "prefsect": "'000'",
    "nosect": f"'A' || {_text('p % 10')}",
    "noplan": f"lpad({_text('p % 1000')}, 4, '0')",
    "geompar": "'poly'",
}
_SUPPLIERS = "(SELECT s_suppkey AS s, {dep} AS dep FROM {supplier}) suppliers".replace(
    "{dep}", _department("s_nationkey")
)
_ADDRESS_COLUMNS = {
    "idadr": _text("s"),
    "coddep": "dep",
    "codcomm": _suffix("s % 30"),
    "codvoie": f"'V' || {_text('s % 50')}",
    "typvoie": "CASE WHEN s % 3 = 0 THEN 'RUE' WHEN s % 3 = 1 THEN 'AVE' ELSE NULL END",
    "novoie": _text("1 + s % 99"),
    "codepostal": f"lpad({_text('s % 95')}, 2, '0') || '000'",
}

# Boundaries: rectangles whose centre follows from the code; every 5th has a hole, every 7th is a
# pair, every 11th is broken, every 13th is missing.


def _ring(x0: str, y0: str, w: int, h: int) -> str:
    """SQL text of one rectangular ring with integer corners."""
    def at(dx: int, dy: int) -> str:
        return f"'[' || CAST({x0} + {dx} AS STRING) || ',' || CAST({y0} + {dy} AS STRING) || ']'"

    corners = (at(0, 0), at(w, 0), at(w, h), at(0, h), at(0, 0))
    return "'[' || " + " || ',' || ".join(corners) + " || ']'"


_BOX = _ring("gx", "gy", 4, 4)
_HOLE = _ring("(gx + 1)", "(gy + 1)", 2, 1)
_SECOND = _ring("(gx + 10)", "gy", 2, 2)


def _geometry(kind: str, body: str) -> str:
    return "'{{\"type\":\"" + kind + "\",\"coordinates\":' || " + body + " || '}}'"


_BOUNDARY = (
    "CASE WHEN g % 13 = 12 THEN NULL "
    "WHEN g % 11 = 10 THEN '{{\"type\":\"Polygon\",\"coordinates\":[[[0,0],[1,1]]]}}' "
    f"WHEN g % 7 = 6 THEN {_geometry('MultiPolygon', chr(39) + '[[' + chr(39) + ' || ' + _BOX + ' || ' + chr(39) + '],[' + chr(39) + ' || ' + _SECOND + ' || ' + chr(39) + ']]' + chr(39))} "
    f"WHEN g % 5 = 4 THEN {_geometry('Polygon', chr(39) + '[' + chr(39) + ' || ' + _BOX + ' || ' + chr(39) + ',' + chr(39) + ' || ' + _HOLE + ' || ' + chr(39) + ']' + chr(39))} "
    f"ELSE {_geometry('Polygon', chr(39) + '[' + chr(39) + ' || ' + _BOX + ' || ' + chr(39) + ']' + chr(39))} END"
)
_BOUNDARY_POSITION = "CAST(g % 60 AS BIGINT) AS gx, CAST(20 + g % 50 AS BIGINT) AS gy"
# Closed-form centroids of the shapes above, for the oracles.
BOUNDARY_CENTROID_X = (
    "CASE WHEN g % 13 = 12 OR g % 11 = 10 THEN NULL "
    "WHEN g % 7 = 6 THEN (16.0 * (gx + 2) + 4.0 * (gx + 11)) / 20.0 "
    "WHEN g % 5 = 4 THEN CAST(gx + 2 AS DOUBLE) ELSE CAST(gx + 2 AS DOUBLE) END"
)
BOUNDARY_CENTROID_Y = (
    "CASE WHEN g % 13 = 12 OR g % 11 = 10 THEN NULL "
    "WHEN g % 7 = 6 THEN (16.0 * (gy + 2) + 4.0 * (gy + 1)) / 20.0 "
    "WHEN g % 5 = 4 THEN (16.0 * (gy + 2) - 2.0 * (gy + 1.5)) / 14.0 ELSE CAST(gy + 2 AS DOUBLE) END"
)
BOUNDARY_VALID = "NOT (g % 13 = 12 OR g % 11 = 10)"
_DEPARTMENT_ROWS = f"""(SELECT n_nationkey AS g, {_department('n_nationkey')} AS dep, n_name AS nm,
  n_regionkey AS rg, {_BOUNDARY_POSITION.replace('g %', 'n_nationkey %')}
  FROM {{nation}}) departments"""
_COMMUNE_ROWS = f"""(SELECT nk * 30 + i AS g, {_department('nk')} AS dep, i, nk,
  {_BOUNDARY_POSITION.replace('g %', '(nk * 30 + i) %')}
  FROM (SELECT DISTINCT c_nationkey AS nk, c_custkey % 30 AS i FROM {{customer}}) seen) communes"""
# One department and one commune number have no code, so names and coverage have gaps.
_DEPARTMENT_COLUMNS = {
    "code": "CASE WHEN g = 24 THEN NULL ELSE dep END",
    "nom": "nm",
    "departement": "dep",
    "region": _text("rg"),
    "epci": "CAST(NULL AS STRING)",
    "geometry": _BOUNDARY,
}
_COMMUNE_COLUMNS = {
    "code": f"CASE WHEN i = 29 THEN NULL ELSE dep || {_suffix('i')} END",
    "nom": f"'Commune ' || dep || '/' || {_text('i')}",
    "departement": "dep",
    "region": _text("nk % 5"),
    "epci": f"'E' || {_text('nk')}",
    "geometry": _BOUNDARY,
}

# Which order lines stand for premises, and which for parcels.
_IS_BUILT = "WHERE ls = 'O'"
_HAS_PARCEL = "WHERE rf <> 'R'"

# table -> (columns, row source, row filter)
_LAYOUT: dict[str, tuple[dict[str, str], str, str]] = {
    "mutation": (_SALE_COLUMNS, _SALES, ""),
    "mutation_dump": (
        {**{c: e for c, e in _SALE_COLUMNS.items() if c not in ("codinsee", "latitude", "longitude")},
         **_DUMP_ONLY},
        _SALES, "",
    ),
    "disposition": (_DISPOSITION_COLUMNS, _LINES, ""),
    "local": (_LOCAL_COLUMNS, _LINES, _IS_BUILT),
    "disposition_parcelle": (_PARCEL_LINK_COLUMNS, _LINES, _HAS_PARCEL),
    "parcelle": (_PARCEL_COLUMNS, _PARTS, ""),
    "adresse": (_ADDRESS_COLUMNS, _SUPPLIERS, ""),
    "adresse_local": (
        {"iddispoloc": _text("pk"), "idadr": _text("s")}, _LINES, _IS_BUILT,
    ),
    "adresse_dispoparc": (
        {"iddispopar": _text("pk"), "idadr": _text("s")}, _LINES, _HAS_PARCEL,
    ),
    "ann_nature_mutation": (
        {"idnatmut": _text("1 + r_regionkey"),
         "libnatmut": "CASE r_regionkey WHEN 0 THEN 'Vente' WHEN 1 THEN 'Vente en l''etat futur' "
                      "WHEN 2 THEN 'Echange' WHEN 3 THEN 'Vente de terrain' ELSE 'Adjudication' END"},
        "{region}", "",
    ),
    "ann_type_local": (
        {"codtyploc": _text("1 + r_regionkey"),
         "libtyploc": "CASE r_regionkey WHEN 0 THEN 'Maison' WHEN 1 THEN 'Appartement' "
                      "WHEN 2 THEN 'Dependance' ELSE 'Local industriel' END"},
        "{region}", "WHERE r_regionkey < 4",
    ),
    "ann_cgi": (
        {"artcgi": f"'683-' || {_text('n_nationkey')}", "libartcgi": "n_name"}, "{nation}", "",
    ),
    "ann_nature_culture": (
        {"natcult": f"'T' || {_text('n_nationkey')}", "libnatcult": "n_name"}, "{nation}", "",
    ),
    "ann_nature_culture_speciale": (
        {"natcultspe": f"'S' || {_text('r_regionkey')}", "libnatcultspe": "r_name"}, "{region}", "",
    ),
    "geo_departments": (_DEPARTMENT_COLUMNS, _DEPARTMENT_ROWS, ""),
    "geo_communes": (_COMMUNE_COLUMNS, _COMMUNE_ROWS, ""),
}


def raw_columns(table: str) -> list[str]:
    """Columns of one raw table."""
    return list(_LAYOUT[table][0])


def raw_sql(table: str, columns: Iterable[str] | None = None) -> str:
    """SELECT text of one raw table with ``{table}`` marks for the trial tables."""
    expressions, rows, where = _LAYOUT[table]
    wanted = list(columns) if columns is not None else list(expressions)
    used = " ".join(expressions[c] for c in wanted)
    joins = []
    if rows is _SALES and "dep" in used:
        joins.append(_PLACE_OF_SALE)
    if rows is _LINES and "dep" in used:
        joins.append(_PLACE_OF_LINE)
    if rows is _LINES and "sz" in used:
        joins.append(_SIZE_OF_LINE)
    select = ",\n  ".join(f"{expressions[c]} AS {c}" for c in wanted)
    return f"SELECT {select}\nFROM {rows} {' '.join(joins)} {where}"


def oracle_with(*tables: str) -> str:
    """``WITH`` clause that gives an oracle query the named raw tables (``local`` as ``local_``)."""
    names = {t: t for t in TRIAL_TABLES}
    parts = []
    for table in tables:
        alias = "local_" if table == "local" else table
        parts.append(f"{alias} AS ({raw_sql(table).format(**names)})")
    return "WITH " + ",\n".join(parts)


def boundary_oracle(level: str) -> str:
    """Rows of one boundary table with closed-form validity and centroid, for oracles."""
    expressions, rows, _ = _LAYOUT[level]
    select = ", ".join(f"{e} AS {c}" for c, e in expressions.items())
    return (
        f"SELECT {select}, {BOUNDARY_VALID} AS is_valid, {BOUNDARY_CENTROID_X} AS cx, "
        f"{BOUNDARY_CENTROID_Y} AS cy FROM {rows}"
    ).format(**{t: t for t in TRIAL_TABLES})


class TrialTables:
    """Raw tables over one folder of trial Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def trial(self, name: str) -> DataFrame:
        if name not in self._read:
            path = os.path.join(self.folder, f"{name}.parquet")
            self._read[name] = self.spark.read.parquet(path)
        return self._read[name]

    def table(self, name: str, columns: Iterable[str] | None = None) -> DataFrame:
        """Raw table ``name`` with all or some of its columns."""
        sql = raw_sql(name, columns)
        inputs = {t: self.trial(t) for t in TRIAL_TABLES if "{" + t + "}" in sql}
        return self.spark.sql(sql, **inputs)

    def mutation_dump(self) -> DataFrame:
        """Sale table as dumped: typed arrays and positions still as projected coordinates."""
        df = self.table("mutation_dump")
        arrays = [c for c in df.columns if c.startswith("l_")]
        return df.withColumns({c: pg_array(df[c]) for c in arrays})


assert set(RAW_COLUMNS) <= set(_LAYOUT), "every contract table has a trial projection"
