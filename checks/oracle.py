"""SQL for each registered query, written from the rules and not from the DataFrame code."""

from __future__ import annotations

from checks.fixtures import SQL

NAME_FIELDS = ["sample_project", "sample_orderer", "sampling_laboratory", "analytical_laboratory", "reporting_institute"]
NEEDS = {"codes": (), "areas": (), "dense_areas": (), "clustered_areas": (), "rules": (), "members": ("packages",)}


def with_tables(names: str, body: str, extra: str = "") -> str:
    """``body`` behind CTEs for the named test tables, then further CTEs."""
    ordered: list[str] = []
    for name in names.split():
        for n in (*NEEDS.get(name, ()), name):
            if n not in ordered:
                ordered.append(n)
    ctes = [f"{n} AS ({SQL[n]})" for n in ordered]
    if extra:
        ctes.append(extra)
    return f"WITH {', '.join(ctes)}\n{body}"


def base(col: str) -> str:
    bare = f"regexp_replace({col}, '[.]zip$', '')"
    return f"split_part({bare}, '_version_', 1)"


# -- enrichment ------------------------------------------------------------------------------


def name_sv(field: str) -> str:
    return (
        f"coalesce((SELECT c.name_sv FROM codes c WHERE c.field = '{field}' AND c.code = trim(o.{field}_code)), '') "
        f"AS {field}_name_sv"
    )


def add_name_sv(field: str) -> str:
    return with_tables(
        "observations codes",
        f"""SELECT o.row_number, o.{field}_code, coalesce(c.name_sv, '') AS {field}_name_sv
        FROM observations o LEFT JOIN codes c ON c.field = '{field}' AND c.code = trim(o.{field}_code)""",
    )


HOUR = r"""try_cast(coalesce(nullif(regexp_extract(sample_time, '^([0-9]{1,2})[:.]([0-9]{1,2})([:.][0-5]?[0-9])?$', 1), ''),
  regexp_extract(sample_time, '^([0-9]{2})([0-9]{2})$', 1)) AS int)"""
MINUTE = r"""try_cast(coalesce(nullif(regexp_extract(sample_time, '^([0-9]{1,2})[:.]([0-9]{1,2})([:.][0-5]?[0-9])?$', 2), ''),
  regexp_extract(sample_time, '^([0-9]{2})([0-9]{2})$', 2)) AS int)"""
FIXED_TIME = f"""CASE WHEN {HOUR} BETWEEN 0 AND 23 AND {MINUTE} BETWEEN 0 AND 59
  THEN lpad(cast({HOUR} AS varchar), 2, '0') || ':' || lpad(cast({MINUTE} AS varchar), 2, '0')
  ELSE coalesce(sample_time, '') END"""


def full_date(col: str) -> str:
    return f"CASE length({col}) WHEN 4 THEN {col} || '-01-01' WHEN 7 THEN {col} || '-01' ELSE {col} END"


FILLED_SAMPLE_DATE = "CASE WHEN trim(coalesce(sample_date, '')) = '' THEN visit_date ELSE sample_date END"

RULED_PARAMETER = """CASE WHEN parameter = 'Temperature' AND data_type_internal = 'sealpathology' THEN 'Body temperature'
  WHEN parameter = 'Temperature' AND data_type_internal = 'harbourporpoise' THEN 'Water temperature' ELSE parameter END"""
RULED_SUBSTRATE = """CASE WHEN data_type_internal <> 'epibenthos' THEN substrate WHEN substrate = 'Brand#2' THEN 'Brand 2'
  WHEN substrate = 'Brand#4' THEN '' ELSE substrate END"""
DELIVERY = "CASE WHEN data_type_internal = 'planktonbarcoding' THEN 'Plankton Barcoding' ELSE '' END"

_NAME_JOINS = "\n".join(
    f"LEFT JOIN codes c{i} ON c{i}.field = '{f}' AND c{i}.code = trim(o.{f}_code)" for i, f in enumerate(NAME_FIELDS)
)
_NAME_COLUMNS = ",\n".join(f"coalesce(c{i}.name_sv, '') AS {f}_name_sv" for i, f in enumerate(NAME_FIELDS))
ENRICHED = f"""enriched AS (
SELECT o.* REPLACE (
    {FIXED_TIME} AS sample_time,
    {full_date('visit_date')} AS visit_date,
    {full_date('(' + FILLED_SAMPLE_DATE + ')')} AS sample_date,
    {RULED_PARAMETER} AS parameter,
    {RULED_SUBSTRATE} AS substrate),
  {_NAME_COLUMNS},
  coalesce(visit_date, '') AS reported_visit_date, coalesce(sample_date, '') AS reported_sample_date,
  {DELIVERY} AS delivery_datatype
FROM observations o
{_NAME_JOINS})"""


# -- areas and projection --------------------------------------------------------------------


def located(source: str) -> str:
    return f"""edges AS (
  SELECT a.area, a.lat AS y1, a.lon AS x1, b.lat AS y2, b.lon AS x2
  FROM areas a JOIN (SELECT area, max(seq) AS m FROM areas GROUP BY area) k ON a.area = k.area
  JOIN areas b ON a.area = b.area AND b.seq = CASE WHEN a.seq = k.m THEN 1 ELSE a.seq + 1 END),
positions AS (SELECT DISTINCT sample_latitude_dd AS y, sample_longitude_dd AS x FROM {source} WHERE sample_latitude_dd IS NOT NULL),
hits AS (SELECT y, x, area FROM positions, edges
  WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
  GROUP BY y, x, area HAVING count(*) % 2 = 1),
flags AS (SELECT y, x, max(CASE WHEN area = 'RC' THEN 1 ELSE 0 END) = 1 AS location_rc,
  max(CASE WHEN area = 'RG' THEN 1 ELSE 0 END) = 1 AS location_rg,
  max(CASE WHEN area = 'RO' THEN 1 ELSE 0 END) = 1 AS location_ro
FROM hits GROUP BY y, x),
located AS (SELECT o.*, coalesce(f.location_rc, false) AS location_rc, coalesce(f.location_rg, false) AS location_rg,
  coalesce(f.location_ro, false) AS location_ro
FROM {source} o LEFT JOIN flags f ON o.sample_latitude_dd = f.y AND o.sample_longitude_dd = f.x),
masked AS (SELECT *, location_rc OR location_rg AS rred, location_rc OR location_rg OR location_ro AS main FROM located)"""


def projected(source: str) -> str:
    """SWEREF 99 TM of each position: the published series with its constants worked out here."""
    f = 1 / 298.257222101
    n, e2 = f / (2 - f), f * (2 - f)
    radius = 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    a, b, c, d = e2, (5 * e2**2 - e2**3) / 6, (104 * e2**3 - 45 * e2**4) / 120, 1237 * e2**4 / 1260
    beta = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    ]
    north = " + ".join(f"{t!r} * sin({2 * i}e0 * xi) * cosh({2 * i}e0 * eta)" for i, t in enumerate(beta, 1))
    east = " + ".join(f"{t!r} * cos({2 * i}e0 * xi) * sinh({2 * i}e0 * eta)" for i, t in enumerate(beta, 1))
    conformal = (
        f"phi - sin(phi) * cos(phi) * ({a!r}::double + {b!r}::double * sin(phi)**2 + {c!r}::double * sin(phi)**4 "
        f"+ {d!r}::double * sin(phi)**6)"
    )
    return f"""g0 AS (SELECT DISTINCT sample_latitude_dd AS y, sample_longitude_dd AS x FROM {source} WHERE sample_latitude_dd IS NOT NULL),
g1 AS (SELECT y, x, radians(y) AS phi, radians(x - 15e0) AS dl FROM g0),
g2 AS (SELECT *, {conformal} AS cl FROM g1),
g3 AS (SELECT y, x, atan(tan(cl) / cos(dl)) AS xi, atanh(cos(cl) * sin(dl)) AS eta FROM g2),
grid AS (SELECT y, x,
  cast(round({radius!r}::double * (eta + {east}) + 500000e0, 3) AS decimal(12,3)) AS gx,
  cast(round({radius!r}::double * (xi + {north}), 3) AS decimal(12,3)) AS gy FROM g3)"""


# -- masks -----------------------------------------------------------------------------------

# The parameters whose values are masked, each once.
MASKED_PARAMETERS = [
    "Secchi depth",
    "Section sediment cover",
    "Section hard clay cover",
    "Section soft clay cover",
    "Section silt cover",
    "Section silt clay cover",
    "Section silt soft clay cover",
    "Section sand cover",
    "Section gravel fine medium cover",
    "Section gravel coarse cover",
    "Section cobble medium cover",
    "Section cobble coarse cover",
    "Section large boulder cover",
    "Section rock cover",
    "Section shell gravel cover",
    "Section shell cover",
    "Section bare substrate cover",
    "Section debris cover",
    "Section detritus cover",
    "Section unidentified substrate cover",
    "Section epi zostera cover",
    "Section unidentified plantae cover",
    "Section nassarius tracks cover",
    "Section paguridae tracks cover",
    "Section animalia burrows cover",
    "Section animalia tracks cover",
    "Section unidentified algae cover",
    "Sediment depos cover",
    "Section boulder cover",
    "Section gravel cover",
    "Section stone cover",
    "Loss on ignition",
    "Sediment dry weight content",
    "Sediment water content",
    "Redox potential",
    "Sediment colour code",
    "Sediment sieve fraction",
    "Depth distribution (max depth)",
    "Large boulder cover",
    "Rock cove",
    "Sand cover",
    "Silt cover",
    "QFLAG Secchi depth",
    "H2S smell",
    "Substrate",
    "Substrate cover",
    "Section substrate",
    "Section substrate cover",
    "Sediment deposition cover",
    "Species distribution min depth",
    "Species distribution max depth",
    "Substrate specific cover",
    "Sediment cover",
    "Hard clay cover",
    "Soft clay cover",
    "Silt clay cover",
    "Gravel fine medium cover",
    "Gravel coarse cover",
    "Cobble medium cover",
    "Cobble coarse cover",
    "Shell gravel cover",
    "Shell cover",
    "Bare substrate cover",
    "Debris cover",
    "Detritus cover",
    "Unidentified substrate cover",
    "Total cover of all species",
]
PARAMETERS = ", ".join("'" + p + "'" for p in MASKED_PARAMETERS)


def when(mask: str, value: str, col: str) -> str:
    return f"CASE WHEN {mask} THEN '{value}' ELSE {col} END AS {col}"


MASKED_999 = ["bottom_depth_m", "secchi_depth_m", "visit_Secchi_note", "substrate"]
MASKED_NA = ["secchi_comment", "sample_substrate_comnt_rock", "shark_sample_id_md5"]
MASKED_DEPTH = ["sample_min_depth_m", "sample_max_depth_m"]


def masked_cells(main: str, rred: str) -> str:
    cells = [when(main, "999", c) for c in MASKED_999]
    cells += [when(main, "NA", c) for c in MASKED_NA]
    cells += [when(rred, "999", c) for c in MASKED_DEPTH]
    cells.append(when(f"{main} AND parameter IN ({PARAMETERS})", "999", "value"))
    for c in ("scientific_name", "reported_scientific_name"):
        cells.append(when(f"{main} AND data_type_internal = 'epibenthos' AND {c} LIKE 'COVER%'", "NA", c))
    cells.append(
        when(
            f"{main} AND data_type_internal = 'physicalchemical' AND quality_flag <> '' AND contains(parameter, 'Secchi depth')",
            "",
            "quality_flag",
        )
    )
    return ", ".join(cells)


def restricted(source: str, final_where: str = "true", drop: str = "main, rred, location_rc, location_rg, location_ro", applies: str = "true", prefix: str = "") -> str:
    """The restricted rows of CTE ``source`` (already located as ``masked``)."""
    return f"""SELECT {prefix} o.* EXCLUDE ({drop}) REPLACE ({masked_cells(f'({applies} AND main)', f'({applies} AND rred)')}),
  CASE WHEN {applies} THEN location_rc END AS location_rc, CASE WHEN {applies} THEN location_rg END AS location_rg,
  CASE WHEN {applies} THEN location_ro END AS location_ro,
  CASE WHEN {applies} THEN gx END AS sample_sweref99tm_x, CASE WHEN {applies} THEN gy END AS sample_sweref99tm_y
FROM {source} o LEFT JOIN grid ON o.sample_latitude_dd = grid.y AND o.sample_longitude_dd = grid.x
WHERE NOT ({applies} AND main AND data_type_internal = 'profile') AND {final_where}"""


OBS_MASKED = located("observations")
PUBLISHED_CTES = f"{ENRICHED}, {located('enriched')}, {projected('enriched')}"
DROP_PUBLISHED = "main, rred, location_rc, location_rg, location_ro, row_number"
KEYED = "row_number, data_type_internal"


def _obs(body: str, extra: str = "", tables: str = "observations") -> str:
    return with_tables(tables, body, extra)


REPORTS_SQL = """reports AS (
  SELECT 'all' AS report, * FROM log
  UNION ALL SELECT 'transformation', * FROM log WHERE level = 'error' AND log_type = 'transformation'
  UNION ALL SELECT 'validation', * FROM log WHERE level IN ('warning', 'error') AND log_type = 'validation')"""

DATASETS = "datasets AS (SELECT DISTINCT dataset_name AS name, data_type_internal FROM observations)"
GATE = "(data_type_internal IN ('epibenthos', 'physicalchemical', 'profile', 'sealpathology', 'harbourporpoise') AND data_type_internal <> 'profile')"

MEMBERS_TYPED = """typed AS (SELECT *, CASE length(package) % 3 WHEN 0 THEN 'profile' ELSE 'epibenthos' END AS data_type_internal FROM members),
pruned AS (SELECT * FROM typed WHERE data_type_internal = 'profile' OR NOT (member LIKE 'processed_data/%'
  OR member LIKE 'received_data/%' OR lower(member) LIKE 'readme%'))"""

ISSUES = """used AS (SELECT dataset_name AS package, unnest([{pairs}]) AS u FROM observations),
counted AS (SELECT package, u.field AS field, trim(u.code) AS code, count(*) AS n FROM used
  WHERE trim(coalesce(u.code, '')) <> '' GROUP BY ALL)""".format(
    pairs=", ".join(f"{{'field': '{f}', 'code': {f}_code}}" for f in NAME_FIELDS)
)


def oracle_sql() -> dict[str, str]:
    sql = {
        # names and catalogue
        "base_name": with_tables("packages", f"SELECT name, slot, {base('name')} AS base_name FROM packages"),
        "latest_per_base": with_tables("packages", f"SELECT {base('name')} AS base_name, max(name) AS name FROM packages GROUP BY 1"),
        "replace_latest": with_tables(
            "packages",
            f"""SELECT {base('name')} AS base_name, name FROM packages WHERE slot = 'stored'
            AND {base('name')} NOT IN (SELECT {base('name')} FROM packages WHERE slot = 'incoming')
            UNION ALL SELECT {base('name')} AS base_name, max(name) AS name FROM packages WHERE slot = 'incoming' GROUP BY 1""",
        ),
        "append_to_store": with_tables("packages", "SELECT DISTINCT name FROM packages"),
        "store_actions": with_tables(
            "packages",
            f"""SELECT 'copy' AS action, max(name) AS name, 'in/' || max(name) AS path FROM packages WHERE slot = 'incoming' GROUP BY {base('name')}
            UNION ALL SELECT 'remove', name, 'store/' || name FROM packages WHERE slot = 'stored'
            AND {base('name')} IN (SELECT {base('name')} FROM packages WHERE slot = 'incoming')
            AND name NOT IN (SELECT max(name) FROM packages WHERE slot = 'incoming' GROUP BY {base('name')})""",
        ),
        "ordered_packages": with_tables("packages", "SELECT DISTINCT name FROM packages ORDER BY name"),
        "remove_by_base_name": with_tables(
            "packages removals",
            f"""SELECT {base('name')} AS base_name, name FROM packages WHERE slot = 'stored'
            AND {base('name')} NOT IN (SELECT {base('name')} FROM removals)""",
        ),
        "select_removed": with_tables(
            "packages removals",
            f"""SELECT {base('name')} AS base_name, name FROM packages WHERE slot = 'stored'
            AND {base('name')} IN (SELECT {base('name')} FROM removals)""",
        ),
        "merge_removal_names": with_tables("packages removals", "SELECT name FROM removals UNION SELECT name FROM packages WHERE slot = 'stored'"),
        "discard_names": with_tables(
            "packages removals", f"SELECT name FROM packages WHERE slot = 'stored' AND name NOT IN (SELECT name FROM packages WHERE slot = 'incoming')"
        ),
        "count_waiting_removals": with_tables("removals", "SELECT count(*) AS n FROM removals"),
        "publish_gate": _obs(f"SELECT name, data_type_internal, {GATE} AS allowed FROM datasets", DATASETS),
        "filter_not_allowed": _obs(f"SELECT name, data_type_internal FROM datasets WHERE {GATE}", DATASETS),
        "refused_packages": _obs(
            f"SELECT name || ' (data type ' || data_type_internal || ' not allowed)' AS msg FROM datasets WHERE NOT {GATE}", DATASETS
        ),
        "fan_out_targets": with_tables(
            "packages",
            """SELECT name, slot, t.target, t.restrict FROM packages CROSS JOIN
            (VALUES ('PROD', true), ('UTVTST', false)) AS t(target, restrict)""",
        ),
        # enrichment
        "fix_time_format": _obs(f"SELECT row_number, {FIXED_TIME} AS sample_time FROM observations"),
        "unreadable_times": _obs(
            """SELECT dataset_name AS package, 'warning' AS level, 'transformation' AS log_type,
            'Unreadable sample_time ' || sample_time || ' (' || count(*) || ' rows)' AS msg
            FROM observations WHERE sample_time = '25:61' GROUP BY dataset_name, sample_time"""
        ),
        "unmatched_codes": _obs(
            """SELECT package, 'warning' AS level, 'transformation' AS log_type,
            'No name for ' || field || ' code ' || code || ' (' || n || ' rows)' AS msg FROM counted
            WHERE (field, code) NOT IN (SELECT (field, code) FROM codes)""",
            ISSUES,
            "observations codes",
        ),
        "add_reported_dates": _obs(
            "SELECT row_number, visit_date AS reported_visit_date, sample_date AS reported_sample_date FROM observations"
        ),
        "add_sample_date": _obs(f"SELECT row_number, {FILLED_SAMPLE_DATE} AS sample_date FROM observations"),
        "create_fake_full_dates": _obs(
            f"SELECT row_number, {full_date('visit_date')} AS visit_date, {full_date('sample_date')} AS sample_date FROM observations"
        ),
        "apply_value_rules": _obs(f"SELECT row_number, {RULED_PARAMETER} AS parameter, {RULED_SUBSTRATE} AS substrate FROM observations"),
        "apply_value_rules_joined": _obs(f"SELECT row_number, {RULED_PARAMETER} AS parameter, {RULED_SUBSTRATE} AS substrate FROM observations"),
        "manual_seal_pathology": _obs(
            f"""SELECT row_number, CASE WHEN data_type_internal = 'sealpathology' THEN {RULED_PARAMETER} ELSE parameter END AS parameter
            FROM observations"""
        ),
        "manual_harbour_porpoise": _obs(
            f"""SELECT row_number, CASE WHEN data_type_internal = 'harbourporpoise' THEN {RULED_PARAMETER} ELSE parameter END AS parameter
            FROM observations"""
        ),
        "manual_epibenthos": _obs(f"SELECT row_number, parameter, {RULED_SUBSTRATE} AS substrate FROM observations"),
        "add_datatype_plankton_barcoding": _obs(f"SELECT row_number, {DELIVERY} AS delivery_datatype FROM observations"),
        "enrich": with_tables("observations codes", "SELECT * FROM enriched", ENRICHED),
        "add_names_sv_joined": with_tables(
            "observations codes", "SELECT row_number, " + ", ".join(f"{f}_name_sv" for f in NAME_FIELDS) + " FROM enriched", ENRICHED
        ),
        # positions
        "add_position_sweref99tm": _obs(
            """SELECT row_number, gx AS sample_sweref99tm_x, gy AS sample_sweref99tm_y FROM observations
            LEFT JOIN grid ON sample_latitude_dd = y AND sample_longitude_dd = x""",
            projected("observations"),
        ),
        "add_locations": _obs("SELECT row_number, location_rc, location_rg, location_ro FROM located", OBS_MASKED, "observations areas"),
        "mask_areas": _obs("SELECT row_number, main, rred FROM masked", OBS_MASKED, "observations areas"),
        # masks
        "mask_match_in_column": _obs(
            """SELECT row_number, coalesce(scientific_name LIKE 'COVER%', false) AS cover,
            coalesce(contains(parameter, 'Secchi depth') AND quality_flag <> '', false) AS secchi_flag, false AS absent FROM observations"""
        ),
        "select_columns_like": _obs("SELECT row_number, secchi_depth_m, visit_Secchi_note, secchi_comment FROM observations"),
        "mask_columns": _obs(
            "SELECT row_number, "
            + ", ".join([when("main", "999", c) for c in MASKED_999] + [when("main", "NA", c) for c in MASKED_NA] + [when("rred", "999", c) for c in MASKED_DEPTH])
            + ", substrate_extra FROM masked",
            OBS_MASKED,
            "observations areas",
        ),
        "mask_parameter_rows": _obs(
            f"SELECT row_number, parameter, {when(f'main AND parameter IN ({PARAMETERS})', '999', 'value')} FROM masked",
            OBS_MASKED,
            "observations areas",
        ),
        "replace_with_mask": _obs(
            "SELECT row_number, "
            + ", ".join(
                [when(f"main AND data_type_internal = 'epibenthos' AND {c} LIKE 'COVER%'", "NA", c) for c in ("scientific_name", "reported_scientific_name")]
            )
            + ", "
            + when("main AND data_type_internal = 'physicalchemical' AND quality_flag <> '' AND contains(parameter, 'Secchi depth')", "", "quality_flag")
            + " FROM masked",
            OBS_MASKED,
            "observations areas",
        ),
        "remove_profiles": _obs(
            "SELECT row_number, data_type_internal FROM masked WHERE NOT (main AND data_type_internal = 'profile')", OBS_MASKED, "observations areas"
        ),
        "drop_columns": _obs("SELECT dataset_name, count(*) AS n, count(DISTINCT sample_project_code) AS n_projects FROM observations GROUP BY 1"),
        # plans
        "restrict": with_tables("observations areas", restricted("masked"), f"{OBS_MASKED}, {projected('observations')}"),
        "restrict_unrestricted_type": with_tables(
            "observations areas",
            restricted("masked", applies="(data_type_internal <> 'physicalchemical')"),
            f"{OBS_MASKED}, {projected('observations')}",
        ),
        "publish": with_tables(
            "observations codes areas",
            restricted("masked", "data_type_internal <> 'sealpathology'", DROP_PUBLISHED),
            PUBLISHED_CTES,
        ),
        "publish_targets": with_tables(
            "observations codes areas",
            restricted("masked", "data_type_internal <> 'sealpathology'", DROP_PUBLISHED, prefix="'PROD' AS target,")
            + "\nUNION ALL\n"
            + restricted("masked", drop=DROP_PUBLISHED, applies="false", prefix="'UTVTST' AS target,"),
            PUBLISHED_CTES,
        ),
        # members
        "prune_members": with_tables("members", "SELECT package, member FROM pruned", MEMBERS_TYPED),
        "check_members_left": with_tables(
            "members",
            """SELECT p.package, p.member, n AS n_left, 'warning' AS level, 'workflow' AS log_type,
            n || ' files left in the restricted package, 3 expected: ' || member AS msg
            FROM pruned p JOIN (SELECT package, count(*) AS n FROM pruned GROUP BY 1) k ON p.package = k.package WHERE n <> 3""",
            MEMBERS_TYPED,
        ),
        # log
        "log_filter": with_tables("log", "SELECT package, level, log_type, msg FROM log WHERE level = 'error' AND log_type = 'transformation'"),
        "live_log": with_tables("log", "SELECT package, level, log_type, msg FROM log WHERE level <> 'debug'"),
        "summarize_log": with_tables("log", "SELECT report, level, log_type, count(*) AS n FROM reports GROUP BY 1, 2, 3", REPORTS_SQL),
        "format_log_line": with_tables(
            "log", "SELECT package, CASE WHEN level IN ('warning', 'error') THEN upper(level) ELSE level END || ': ' || msg AS line FROM log"
        ),
        "write_reports": with_tables("log", "SELECT report, package, level, log_type, msg FROM reports", REPORTS_SQL),
        "run_validators": _obs(
            """SELECT dataset_name AS package, 'warning' AS level, 'validation' AS log_type, 'No position in ' || count(*) || ' rows' AS msg
            FROM observations WHERE sample_latitude_dd IS NULL GROUP BY 1
            UNION ALL SELECT dataset_name, 'info', 'validation', 'Blank time in ' || count(*) || ' rows'
            FROM observations WHERE sample_time = '' GROUP BY 1"""
        ),
        # addresses
        "normalize_url": r"""SELECT page_id, CASE WHEN u = '' OR starts_with(u, 'https://') THEN u ELSE 'https://' || u END AS url
            FROM (SELECT page_id, trim(replace(regexp_replace(coalesce(url, ''), '^\s+|\s+$', '', 'g'), '\', '/'), '/') AS u FROM pages) q""",
    }
    sql.update(_file_sql())
    for field in NAME_FIELDS:
        sql[f"add_{field.removeprefix('sample_')}_name_sv"] = add_name_sv(field)
    return sql


# -- files -----------------------------------------------------------------------------------

OBSERVED_TEXT = [
    "dataset_name", "data_type_internal", "row_number", "parameter", "value", "quality_flag", "scientific_name",
    "reported_scientific_name", "bottom_depth_m", "sample_min_depth_m", "sample_max_depth_m", "secchi_depth_m",
    "visit_Secchi_note", "secchi_comment", "sample_substrate_comnt_rock", "substrate", "substrate_extra",
    "shark_sample_id_md5", "sample_project_code", "sample_orderer_code", "sampling_laboratory_code",
    "analytical_laboratory_code", "reporting_institute_code", "visit_date", "sample_date", "sample_time",
    "sample_latitude_dd", "sample_longitude_dd",
]
PUBLISHED_EXTRA = [f"{f}_name_sv" for f in NAME_FIELDS] + [
    "reported_visit_date", "reported_sample_date", "location_rc", "location_rg", "location_ro",
    "sample_sweref99tm_x", "sample_sweref99tm_y",
]


def as_text(columns: list[str]) -> str:
    return ", ".join(f"coalesce(cast({c} AS varchar), '') AS {c}" for c in columns)


def _file_sql() -> dict[str, str]:
    package = "dataset_name || '_version_2024-05-01.zip'"
    length = " + ".join(f"length(coalesce(cast({c} AS varchar), ''))" for c in OBSERVED_TEXT)
    published = [c for c in OBSERVED_TEXT if c != "row_number"] + PUBLISHED_EXTRA
    odd = "(right(dataset_name, 1) IN ('1', '3', '5', '7', '9'))"
    v = lambda c: f"coalesce(cast({c} AS varchar), '')"
    publish_sql = restricted("masked", "data_type_internal <> 'sealpathology'", DROP_PUBLISHED)
    # a data type that no plankton package has gets no such column of its own: blank when read together
    return {
        "list_packages": _obs(f"SELECT DISTINCT {package} AS package, dataset_name AS base_name, '2024-05-01' AS version FROM observations"),
        "read_members": _obs(
            f"""SELECT p.package, m.member FROM (SELECT DISTINCT {package} AS package FROM observations) p CROSS JOIN
            (VALUES ('shark_data.txt'), ('shark_metadata.txt'), ('processed_data/data.txt'), ('received_data/raw.csv'), ('README.txt')) AS m(member)"""
        ),
        "package_info": _obs(f"SELECT DISTINCT {package} AS package, data_type_internal, {len(OBSERVED_TEXT)} AS n_columns FROM observations"),
        "read_data_table": _obs(f"SELECT {package} AS package, {as_text(OBSERVED_TEXT)} FROM observations"),
        "read_data_table_tree": _obs(f"SELECT {package} AS package, {as_text(OBSERVED_TEXT)} FROM observations"),
        "failed_packages": _obs(
            "SELECT DISTINCT dataset_name || '_version_broken.zip -> BadZipFile: File is not a zip file' AS msg FROM observations"
        ),
        "write_packages": _obs(
            f"SELECT {package} AS package, count(*) AS n, cast(sum({length} + {len(OBSERVED_TEXT) - 1}) AS bigint) AS n_chars FROM observations GROUP BY 1"
        ),
        "write_data_table": _obs(f"SELECT {package} AS package, {as_text(OBSERVED_TEXT)} FROM observations"),
        "publish_archives_mixed_headers": with_tables(
            "observations codes areas",
            f"""SELECT {package} AS package,
            CASE WHEN NOT {odd} OR data_type_internal = 'planktonbarcoding' THEN delivery_datatype ELSE data_type_internal END AS delivery_datatype,
            CASE WHEN {odd} THEN '' ELSE data_type_internal END AS data_type_internal,
            {as_text([c for c in published if c != 'data_type_internal'])} FROM published""",
            f"{PUBLISHED_CTES}, published AS ({publish_sql})",
        ),
        "publish_archives_two_folders": with_tables(
            "observations codes areas",
            f"SELECT {package} AS package, delivery_datatype, {as_text(published)} FROM published",
            f"{PUBLISHED_CTES}, published AS ({publish_sql})",
        ),
        "publish_archives_marked": with_tables(
            "observations codes areas",
            f"SELECT {package} AS package, delivery_datatype, {as_text(published)} FROM published",
            f"{PUBLISHED_CTES}, published AS ({publish_sql})",
        ),
        "publish_archives_repeated_members": with_tables(
            "observations codes areas",
            f"""SELECT {package} AS package, 'shark_data.txt' AS text, count(*) + 1 AS n FROM published GROUP BY 1
            UNION ALL SELECT package, m.member, m.n FROM (SELECT DISTINCT {package} AS package FROM published) p CROSS JOIN (VALUES ('shark_metadata.txt', 1),
              ('processed_data/data.txt', 1), ('received_data/raw.csv', 2), ('README.txt', 1)) AS m(member, n)
            UNION ALL SELECT package, 'Listed more than once, the last one is used: ' || m.member, 1
            FROM (SELECT DISTINCT {package} AS package FROM observations) p CROSS JOIN (VALUES ('shark_data.txt'), ('README.txt')) AS m(member)""",
            f"{PUBLISHED_CTES}, published AS ({publish_sql})",
        ),
        "publish_archives_untyped": _obs(
            f"""SELECT DISTINCT {package} AS package, CASE WHEN {odd} THEN 'no data type, so it is unknown what to mask' ELSE 'written' END AS state
            FROM observations WHERE {odd} OR data_type_internal <> 'sealpathology'"""
        ),
        "round_trip_ragged": _obs(
            f"""SELECT package, member, line, count(*) AS n FROM (
            SELECT {package} AS package, 'shark_data.txt' AS member, {v('parameter')} || chr(9) || {v('value')} || chr(9) || 'n' || {v('value')}
              || chr(9) || {v('value')} || ' ' || {v('value')} || repeat(chr(9), 5) AS line FROM observations
            UNION ALL SELECT package, t.member, t.line FROM (SELECT DISTINCT {package} AS package FROM observations) p CROSS JOIN (VALUES
              ('shark_data.txt', concat_ws(chr(9), 'parameter', 'note', 'note', 'ends', {', '.join(repr(f + '_name_sv') for f in NAME_FIELDS)})),
              ('empty/', ''), ('a/b.txt', 'x'), ('a/b.txt', 'y')) AS t(member, line)) q GROUP BY 1, 2, 3"""
        ),
        "read_data_table_odd_headers": _obs(
            f"SELECT {package} AS package, " + ", ".join(f"'{i}-' || {v('value')} AS c{i}" for i in range(8)) + " FROM observations"
        ),
        "write_package_tables": _obs(
            f"""SELECT {package} AS package, count(*) + 1 AS n,
            cast(sum({length} + {len(OBSERVED_TEXT) - 1}) + {len(chr(9).join(OBSERVED_TEXT))} AS bigint) AS n_chars FROM observations GROUP BY 1"""
        ),
        "write_table_files": _obs(
            f"""SELECT package, n, n_chars, n_chars + n AS n_bytes FROM (SELECT {package} AS package, count(*) + 1 AS n,
            cast(sum({length} + {len(OBSERVED_TEXT) - 1}) + {len(chr(9).join(OBSERVED_TEXT))} AS bigint) AS n_chars FROM observations GROUP BY 1) q"""
        ),
        "read_codes": with_tables("codes", "SELECT field, code, name_sv FROM codes"),
        "read_areas": _obs("SELECT row_number, location_rc, location_rg, location_ro FROM located", OBS_MASKED, "observations areas"),
        "read_rules": _obs(f"SELECT row_number, {RULED_PARAMETER} AS parameter, {RULED_SUBSTRATE} AS substrate FROM observations"),
        "add_locations_clustered": _obs(
            "SELECT row_number, location_rc, location_rg, location_ro FROM located", OBS_MASKED.replace("areas", "clustered_areas"), "observations clustered_areas"
        ),
        "add_locations_dense": _obs(
            "SELECT row_number, location_rc, location_rg, location_ro FROM located", OBS_MASKED.replace("areas", "dense_areas"), "observations dense_areas"
        ),
        "publish_log": _obs(
            f"""SELECT {package} AS package, 'workflow' AS log_type, {package} || ' (data type sealpathology not allowed)' AS msg
            FROM datasets d(dataset_name, data_type_internal) WHERE data_type_internal = 'sealpathology'
            UNION ALL SELECT name || '_version_broken.zip', 'workflow', name || '_version_broken.zip -> BadZipFile: File is not a zip file' FROM datasets""",
            DATASETS,
        ),
        "publish_archives": with_tables(
            "observations codes areas",
            f"SELECT {package} AS package, delivery_datatype, {as_text(published)} FROM published",
            f"{PUBLISHED_CTES}, published AS ({publish_sql})",
        ),
        "write_removal_list": with_tables("packages removals", "SELECT name FROM removals UNION SELECT name FROM packages WHERE slot = 'stored'"),
        "update_stores": _obs(
            """SELECT 'data sets' AS place, name || '_version_2024-05-01.zip' AS name FROM datasets
            UNION ALL SELECT 'store', name || '_version_2025-01-01.zip' FROM datasets WHERE data_type_internal <> 'profile'
            UNION ALL SELECT 'log', 'Copied package: ' || name || '_version_2025-01-01.zip' FROM datasets
            UNION ALL SELECT 'log', 'Removing old package: ' || name || '_version_2024-05-01.zip' FROM datasets
            UNION ALL SELECT 'log', 'Removing old package: ' || name || '_version_2025-01-01.zip' FROM datasets WHERE data_type_internal = 'profile'""",
            DATASETS,
        ),
    }
