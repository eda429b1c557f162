"""Fixed values shared by the column functions and operators."""

# Text that means "no value", one set per field family.
MISSING_METADATA = ["", "unknown", "none", "null", "na", "n/a", "not provided", "missing", "not collected"]
MISSING_TYPING = ["", "unknown", "none", "null", "na", "n/a", "?", "-"]
MISSING_LIN_CODE = ["", "na", "n/a", "none", "null", "unknown", "-"]
MISSING_EXPORT_ALLELE = ["", "0", "-", "?", "None", "null"]
MISSING_STORED_ALLELE = ["", "0", "-", "?", "none", "null", "unknown", "na", "n/a"]
MISSING_LOCATION = ["", "unknown", "none", "na", "n/a"]
MISSING_STATE = ["", "?", "unknown", "unknown country", "public_context", "na", "n/a", "nan", "none", "null", "missing"]

# Boolean words in sample sheets.
TRUE_WORDS = ["1", "true", "yes", "y"]
FALSE_WORDS = ["", "0", "false", "no", "n"]

# Patterns of identifiers, dates and accessions.
SHORT_UUID = r"^[1-9A-HJ-NP-Za-km-z]{20,22}$"
PROTEIN_RESIDUES = r"^[ACDEFGHIKLMNPQRSTVWYXBZUO]*$"
SHA1 = r"^[0-9a-fA-F]{40}$"
SAFE_IDENTIFIER = r"^[A-Za-z0-9_.-]+$"
NUMERIC_DATE = r"^\d{4}(\.\d+)?$"
RANGE_DATE = r"^\[\d{4}(\.\d+)?:\d{4}(\.\d+)?\]$"
AMBIGUOUS_DATE = r"^\d{4}-(\d{2}|XX)-(\d{2}|XX)$"
ACCESSION = r"\b(SAM[NED][A-Z]?\d+|[SED]RR\d+|GC[AF]_\d+(?:\.\d+)?|PRJ[END][AB]\d+|[SED]RP\d+)\b"
STRONG_ACCESSION = r"^(SAM[NED][A-Z]?\d+|[SED]RR\d+|GC[AF]_\d+(\.\d+)?)$"
RUN_ACCESSION = r"^[SED]RR\d+$"
SAMPLE_ACCESSION = r"^SAM[NED][A-Z]?\d+$"
ASSEMBLY_ACCESSION = r"^GC[AF]_\d+(\.\d+)?$"

# Lineage code scheme and depths.
LIN_SCHEME = "scgMLST629_S"
LIN_COMPONENTS = 10
LIN_DEPTHS = (5, 6, 7)
UNUSABLE_TYPING_STATUS = ["conflict", "malformed", "unsupported", "missing", "unassigned", "failed"]
UNUSABLE_PROFILE_STATUS = ["conflict", "failed", "unassigned", "unsupported"]
FOCAL_ORIGINS = ["local", "query", "focal"]
INPUT_ROLES = ["local", "query", "focal", "input"]

# Country spellings that differ from the canonical name.
COUNTRY_ALIASES = {
    "uk": "United Kingdom",
    "u.k.": "United Kingdom",
    "great britain": "United Kingdom",
    "united states of america": "United States",
    "usa": "United States",
    "u.s.a.": "United States",
    "south korea": "South Korea",
    "republic of korea": "South Korea",
    "russian federation": "Russia",
    "viet nam": "Vietnam",
    "czech republic": "Czechia",
    "turkey": "Türkiye",
    "unknown region": "Unknown",
    "myanmar": "Myanmar (Burma)",
    "burma": "Myanmar (Burma)",
    "uae": "United Arab Emirates",
    "u.a.e.": "United Arab Emirates",
}

# NCBI translation table 11, codons in TCAG order, and its start codons.
CODON_BASES = "TCAG"
CODON_AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
START_CODONS = ["TTG", "CTG", "ATT", "ATC", "ATA", "ATG", "GTG"]
