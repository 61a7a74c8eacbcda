"""Fixed values the results depend on: word lists, patterns, tables and limits."""

# --- file names ---------------------------------------------------------------
# Raw data extensions, and those the stem drops.
RAW_EXTENSIONS = (".raw", ".mzml", ".mzxml", ".mzdata", ".wiff", ".wiff2", ".d", ".lcd", ".cdf", ".abf", ".ibf", ".baf", ".tdf")
STEM_SUFFIX = r"(?i)\.(raw|mzml|mzxml|mzdata|wiff2?|d|lcd|cdf)$"
VENDOR_FOLDER = r"(?i)^(.*?\.(?:d|raw))/.+"
CONVERSION_EXTENSIONS = (".mzxml", ".mzdata")
NESTED_ARCHIVES = (".zip", ".7z", ".rar", ".tar", ".tgz", ".gz", ".bz2", ".xz")
METADATA_PREFIX = "__MACOSX/"
MIN_DUPLICATE_BYTES = 1024

# Encoding order, 0 vendor, 1 re-encoding, 2 mzML, 3 mzXML.
ENCODING_RANKS = (
    (0, r"(?i)\.(raw|d|wiff2?|lcd|baf|tdf)(\.(zip|gz|lzma))?$"),
    (1, r"(?i)\.(cdf|abf|ibf)(\.(zip|gz|lzma))?$"),
    (2, r"(?i)\.(i?mzml)(\.(zip|gz|lzma))?$"),
    (3, r"(?i)\.(mzxml)(\.(zip|gz|lzma))?$"),
)

# --- name tokens --------------------------------------------------------------
# Polarity and chromatography tokens.
POLARITY_TOKEN = r"(?i)(positive|negative|pos|neg)(?![a-z])"
HILIC_TOKEN = r"(?i)hilic"
RP_TOKEN = r"(?i)((?<![a-z])c(?:18|30|8)(?![0-9])|rplc|(?<![a-z])rp(?![a-z])|rp(?=pos|neg))"

# Acquisition tokens, their modes, and the targeted methods.
ACQUISITION_WORDS = (
    "t-?dd-?ms2?|t-?dda|targeted-?dd-?ms2?|hermes|dd-?ms2?|dda|dia[12](?![0-9])|dia|swath|aif|(?:hd)?mse|"
    "scan0[1-9](?![0-9])|ms1(?![0-9])|full-?scan|prm|srm|mrm|sim|tms2"
)
TARGETED_TOKENS = ("MRM", "PRM", "SIM", "SRM", "tMS2")
INCLUSION_LIST_TOKENS = ("tDDA",)
TOKEN_MODES = {"DDA": "DDA", "tDDA": "DDA", "DIA": "DIA", "DIA1": "DIA", "DIA2": "DIA", "SWATH": "SWATH",
               "AIF": "AIF", "MSe": "DIA", "MS1": "MS1"}
DIA_FAMILY = ("AIF", "DIA", "SWATH")

# Words for an MS level, longest first. (kind, label, pattern, ignores case)
LEVEL_WORDS = (
    ("MS/MS", "MSMS", r"auto-?ms-?ms|ms-?ms", True),
    ("MS/MS", "MS2", r"(?:dd-?)?ms2(?![0-9])", True),
    ("MS/MS", "MSe", r"(?:HD)?MS[eE](?![A-Za-z0-9])", False),
    ("MS/MS", "SONAR", r"sonar(?![a-z])", True),
    ("MS/MS", "MSn", r"MSn(?![A-Za-z0-9])", False),
    ("MS/MS", "IDA", r"IDA(?![A-Za-z0-9])", False),
    ("MS-only", "MSProfile", r"ms-?prof(?:ile)?", True),
    ("MS-only", "Profile", r"prof(?:ile)?(?![a-z])", True),
    ("MS-only", "MS1", r"ms1(?![0-9])", True),
    ("MS-only", "FullScan", r"full-?scan", True),
    ("MS-only", "MS", r"MS(?![A-Z0-9])(?![en](?![a-z]))", False),
)

# Methods other than collisional fragmentation, and how text spells them.
NON_CID_METHODS = ("EAD", "OAD", "ECD", "ETD", "EThcD", "ETciD", "NETD", "EDD", "EID", "UVPD", "IRMPD")
SPELLED_METHODS = (
    ("EAD", "electron[- ]activated dissociation"),
    ("OAD", "oxygen[- ]attachment dissociation"),
    ("ECD", "electron[- ]capture dissociation"),
    ("ETD", "electron[- ]transfer dissociation"),
    ("EID", "electron[- ]induced dissociation"),
    ("UVPD", "ultraviolet photodissociation"),
    ("IRMPD", "infrared multiphoton dissociation"),
)
GUID = r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"
STATEMENT_FIELD = r"(?i)fragment|dissociation|activation|collision"
INSTRUMENT_FIELD = r"(?i)instrument"
STUDY_TEXT_FIELD = r"(?i)keyword|title|description|abstract|summary|publication"

# Which instruments can fragment so (method, capable family, vendors).
METHOD_INSTRUMENTS = (
    ("EAD", r"zeno\s*-?\s*tof|\b[78]600\b", r"sciex|applied biosystems"),
    ("OAD", r"lcms\s*-?\s*90[35]0|\b90[35]0\b", r"shimadzu"),
    ("ETD", r"fusion|lumos|eclipse|ascend|tribrid|\betd\b", r"thermo|bruker|agilent"),
    ("EThcD", r"fusion|lumos|eclipse|ascend|tribrid|\betd\b", r"thermo|bruker|agilent"),
    ("ETciD", r"fusion|lumos|eclipse|ascend|tribrid|\betd\b", r"thermo|bruker|agilent"),
    ("NETD", r"fusion|lumos|eclipse|ascend|tribrid|\betd\b", r"thermo|bruker|agilent"),
    ("ECD", r"ft\s*-?\s*icr|fticr|solarix|\bapex\b|\bexd\b|\becd\b|6545\s*xt", r"bruker|agilent"),
    ("EDD", r"ft\s*-?\s*icr|fticr|solarix|\bapex\b", r"bruker"),
    ("EID", r"ft\s*-?\s*icr|fticr|solarix|\bapex\b|\bexd\b", r"bruker|agilent"),
    ("UVPD", r"fusion|lumos|eclipse|ascend|tribrid|\buvpd\b", r"thermo"),
    ("IRMPD", r"ft\s*-?\s*icr|fticr|solarix|\bapex\b|ion\s*trap|\bltq\b|\blcq\b|amazon|esquire|\bhct\b|\bqtrap\b|\birmpd\b",
     r"bruker|thermo"),
)
MODEL_WORDS = (
    r"\d|exactive|orbitrap|tripletof|qtrap|synapt|xevo|vion|impact|maxis|timstof|compact|\bltq\b|\blcq\b|velos|"
    r"elite|fusion|lumos|eclipse|ascend|exploris|astral|zeno|solarix|\bapex\b|q-?tof|\btof\b|ion\s*trap|amazon|"
    r"esquire|\bhct\b|fticr|ft-icr"
)
UNRECORDED_INSTRUMENTS = ("", "unknown", "not available", "n/a", "na", "none", "-", "ms", "lc-ms", "lc/ms", "lcms",
                          "mass spectrometer", "mass spectrometry")
ION_MOBILITY_INSTRUMENT = r"(?i)tims|synapt|vion|6560|cyclic"
NON_ION_MOBILITY_FORMATS = ("bruker_baf", "bruker_tsf")

# --- decisions ----------------------------------------------------------------
# Flags, statuses and reasons of a decision document.
BLOCKING_FLAGS = ("folder_header_disagreement", "mixed_acquisition", "ms1_only", "name_token_disputed",
                  "polarity_switching", "shared_content")
LEGACY_BLOCKING_FLAGS = ("declared_technical_disputed",)
POLICY_VERSION = (1, 3, 0)
UNIT_EXCLUSION_REASONS = ("no_product_ion_files", "no_files", "shared_content_unassigned")
HELD_REASONS = ("needs_person", "shared_content_unassigned")
NO_PRODUCT_ION_ROW_REASONS = ("belongs_to_other_unit", "duplicate_content", "ms1_only_no_msms", "not_in_archive")
DROPPED_FOR_GOOD_REASONS = ("no_sample_metadata", "no_signal_abstained", "other", "out_of_scope", "requires_conversion")
DECLARED_SOURCES = ("catalog_row", "catalog_unit", "mwtab", "repository_page")
WEAK_FIELDS = ("crc32", "modified", "mtime", "size", "size_bytes", "timestamp")
ROW_REASONS = ("belongs_to_other_unit", "no_signal_abstained", "duplicate_content", "out_of_scope_ms1_only",
               "ms1_only_no_msms", "polarity_switching", "requires_conversion", "not_in_archive", "needs_person",
               "shared_content_unassigned", "other")
MEMBER_REASONS = ("not_raw_data", "archive_metadata", "alternative_format_copy", "requires_conversion",
                  "duplicate_content", "belongs_to_other_unit", "no_signal_abstained", "out_of_scope",
                  "out_of_scope_ms1_only", "ms1_only_no_msms", "polarity_switching", "needs_person",
                  "shared_content_unassigned", "no_sample_metadata", "other")
NON_SAMPLE_CLASS = r"(?i)^(blank|blk|qc|pooled[ _-]?qc|pool|solvent|system[ _-]?blank|all)s?$"

# --- planning -----------------------------------------------------------------
# Pools, exclusion order, archive floor.
POOL_MODES = {"declared": ("DDA", "DIA", "AIF", "SWATH"), "acquisition_unknown": ("Unknown",)}
POOL_ION_MODES = ("Positive", "Negative", "Both")
MZDATA_SUFFIX = r"(?i)\.mzdata(\.xml)?$"
ANALYSIS_ROLES = ("raw", "converted")
ARCHIVE_KINDS = ("archive", "bundle")
ARCHIVE_FLOOR_BYTES_PER_SAMPLE = 50_000
NOT_REPLANNED = ("diagnosing", "done", "downloading", "invalidated_after_done", "running", "split_done")
REOPENABLE = ("done", "invalidated_after_done", "split_done")

# --- operation ----------------------------------------------------------------
# Retries, outages, stalls and disk.
MAX_ATTEMPTS = 3
RETRY_DELAYS = (600, 3600)
MAX_INTERRUPTIONS = 5
OUTAGE_GROUPS = 3
HOLDER_STALE_SECONDS = 600
FILE_FACTOR = 1.66
ARCHIVE_FACTOR = 2.66
RESERVE_BYTES = 500 * 1000**3
RESERVE_FRACTION = 0.05
UNKNOWN_SIZE_RESERVE = 200 * 1000**3
DOWNLOAD_FLOOR = 100 * 1000**3
OBSERVED_MINIMUM = 5
OBSERVED_QUANTILE = 0.9
BLOCKING_CHECKS = ("ELIG-1", "ACQ-1", "SUM-1", "CNT-1", "INP-1", "ID-1", "PRE-2", "CONV-1", "LIB-2")
NETWORK_TYPES = ("ConnectionAbortedError", "ConnectionError", "ConnectionRefusedError", "ConnectionResetError",
                 "DownloadConnectionLost", "DownloadIncomplete", "DownloadStalled", "IncompleteRead",
                 "RemoteDisconnected", "RetryableDownloadError", "SSLEOFError", "SSLError", "TimeoutError",
                 "URLError", "gaierror", "timeout")
NETWORK_TEXT = (
    r"(?i)\bHTTP(?: Error)? (?:5\d\d|429)\b|urlopen error|timed out|Connection (?:reset|aborted|refused)|"
    r"forcibly closed|Remote end closed|IncompleteRead|getaddrinfo failed|Name or service not known|"
    r"Temporary failure in name resolution|EOF occurred in violation of protocol|"
    r"No bytes arrived from the server for|The connection was lost during the transfer|"
    r"Download ended at \d+ of \d+ declared bytes"
)
LEASE_LIMITS = (
    (r"Remote object is (\d+) bytes; limit is \d+ bytes", 0),
    (r"Download exceeded the (\d+)-byte safety limit", 1),
    (r"Required repository bundle is (\d+) bytes; the (?:download lease|approved) limit is \d+ bytes", 0),
)
EXTRACTION_EXPANDS = r"expands to (\d+) bytes; \d+ are free and \d+ are held in reserve"
EXTRACTION_SHORT = r"Free space fell below the \d+-byte reserve while|\binsufficient_disk_space\b"
REFUSAL_PREFIXES = ("attribution_", "cross_unit_", "curated_selection_")

# --- release ------------------------------------------------------------------
# Redaction rules over text, in report order.
PATH_RULES = (
    ("drive_letter_path", r"(?<![A-Za-z0-9])[A-Za-z]:(?:\\\\|\\|/)"),
    ("unc_path", r"(?:^|[\s\"'=(\[,])(?:\\\\\\\\|\\\\)[A-Za-z0-9._$-]+(?:\\\\|\\)[A-Za-z0-9._$-]+"),
    ("user_profile_path", r"(?i)(?:^|[\\/\"'\s])(?:Users|home|Documents and Settings)(?:\\\\|\\|/)[^\\/\"'\s]+(?:\\\\|\\|/)"),
)
LIBRARY_FILE = r"(?i)(?:\\\\|\\|/)([^\\/\"'\s<>|*?:]+\.(?:msp|lbm|lbm2|lbm3))(?![A-Za-z0-9])"
SECRET_TOKENS = (
    r"sk-ant-[A-Za-z0-9_\-]{8,}",
    r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{20,}",
    r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![0-9A-Z])",
    r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}",
)
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
ABSOLUTE_CELL = r"^(?:[A-Za-z]:[\\/]|\\\\|/)"
