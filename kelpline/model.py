"""Names, lists and replacement values the published data depends on."""

# ---------------------------------------------------------------------------
# File and package naming, encoding, column names. They must equal
# what readers of the published packages expect.
# ---------------------------------------------------------------------------
ARCHIVE_SUFFIX = ".zip"
VERSION_MARKER = "_version_"
DATA_FILE = "shark_data.txt"
REMOVAL_FILE = "remove.txt"
ENCODING = "cp1252"
JAVA_ENCODING = "windows-1252"
SEPARATOR = "\t"

DATA_TYPE = "data_type_internal"
LATITUDE = "sample_latitude_dd"
LONGITUDE = "sample_longitude_dd"
PARAMETER = "parameter"
VALUE = "value"

NAME_SV_FIELDS = [
    "sample_project",
    "sample_orderer",
    "sampling_laboratory",
    "analytical_laboratory",
    "reporting_institute",
]
RESTRICTING_AREAS = ["RC", "RG", "RO"]
CLEANUP_COLUMNS = ["row_number"]

PROCESSED_FOLDER = "processed_data/"
RECEIVED_FOLDER = "received_data/"
README_PATTERN = r"(?i)(^|/)readme[^/]*$"
EXPECTED_MEMBERS = 3

LOG_LEVELS = ["debug", "info", "warning", "error"]

# Environments, and the chain of targets one run in an environment serves.
ENVIRONMENTS = ["TEST", "PROD", "UTVTST", "UTV", "LOKALT"]
PUBLISH_FOLLOWERS = {"PROD": "UTVTST"}
REMOVE_FOLLOWERS = {"PROD": "UTV"}

# ---------------------------------------------------------------------------
# What restriction writes, and where.
# ---------------------------------------------------------------------------
REPLACE_PARAMETER_VALUE = "999"
REPLACE_COLUMN_VALUE = "999"
REPLACE_COMMENT_VALUE = "NA"
REPLACE_SCIENTIFIC_NAME_VALUE = "NA"
REPLACE_SECCHI_VALUE = ""

COVER_PATTERN = "^COVER.*$"
NON_BLANK_PATTERN = ".+"
SECCHI_PARAMETER_PATTERN = "Secchi depth"

DEPTH_COLUMNS = [
    "bottom_depth_m",
    "water_depth_m",
    "transect_min_depth_m",
    "transect_max_depth_m",
    "transect_start_depth_m",
    "transect_stop_depth_m",
    "section_start_depth_m",
    "section_end_depth_m",
]

SAMPLE_DEPTH_COLUMNS = [
    "sample_min_depth_m",
    "sample_max_depth_m",
    "sample_depth_m",
]

SECCHI_COLUMNS = [
    ".*secchi.*",
    ".*Secchi.*",
]

SUBSTRATE_COLUMNS = [
    "sediment_type",
    "oxidized_layer_cm",
    "sect_substrate",
    "substrate",
    "sediment_deposition_code",
    "bottom_slope_deg",
    "sample_substrate_cover_boulder",
    "sample_substrate_cover_rock",
    "sample_substrate_cover_softbottom",
    "sample_substrate_cover_stone",
    "sample_substrate_cover_gravel",
    "sample_substrate_cover_sand",
    "section_bare_substrate",
    "section_substrate_cover_boulder",
    "section_substrate_cover_gravel",
    "section_substrate_cover_rock",
    "section_substrate_cover_sand",
    "section_substrate_cover_softbottom",
    "section_substrate_cover_stone",
    "section_debris_cover",
]

VALUE_COLUMNS = DEPTH_COLUMNS + SECCHI_COLUMNS + SUBSTRATE_COLUMNS

COMMENT_COLUMNS = [
    ".*comment.*",
    ".*comnt.*",
    "shark_sample_id",
    "shark_sample_id_md5",
    "shark_transect_id_md5",
    "station_cluster",
    "station_marking",
]

# The list names "Rock cove", not "Rock cover", and repeats seven entries; both are
# part of the published behaviour, so rows of "Rock cover" keep their value.
RESTRICTED_PARAMETERS = [
    "Secchi depth",
    "Section sediment cover",
    "Section hard clay cover",
    "Section soft clay cover",
    "Section silt cover",
    "Section silt clay cover",
    "Section silt soft clay cover",
    "Section silt cover",
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
    "Depth distribution (max depth)",
    "Substrate specific cover",
    "Substrate cover",
    "Sediment cover",
    "Hard clay cover",
    "Soft clay cover",
    "Silt cover",
    "Sand cover",
    "Silt clay cover",
    "Gravel fine medium cover",
    "Gravel coarse cover",
    "Cobble medium cover",
    "Cobble coarse cover",
    "Large boulder cover",
    "Rock cove",
    "Shell gravel cover",
    "Shell cover",
    "Bare substrate cover",
    "Debris cover",
    "Detritus cover",
    "Unidentified substrate cover",
    "Total cover of all species",
]

# Internal data type names used by type-specific steps.
EPIBENTHOS = "epibenthos"
PHYSICAL_CHEMICAL = "physicalchemical"
PROFILE = "profile"
PLANKTON_BARCODING = "planktonbarcoding"
SEAL_PATHOLOGY = "sealpathology"
HARBOUR_PORPOISE = "harbourporpoise"
RULE_TYPES = [SEAL_PATHOLOGY, HARBOUR_PORPOISE, EPIBENTHOS]
PLANKTON_BARCODING_LABEL = "Plankton Barcoding"
