"""Fixed values of the curation rules: word lists, extension sets and thresholds, all overridable by arguments."""

# Extensions that only qualitative-analysis software writes.
QDA_EXTENSIONS = ("qdpx", "qdc", "mqda", "mqbac", "mqtc", "mqex", "mqmtr", "mx24", "mx24bac", "mc24", "mex24", "mex22", "mx22", "mx20", "mx18", "mx12", "mx11", "mx5", "mx2", "m2k", "nvp", "nvpx", "atlasproj", "hpr7", "pprj", "qlt", "f4p", "qpd")

# Extensions that such software shares with others.
AMBIGUOUS_EXTENSIONS = ("mod", "mx3", "mx4", "mtr", "sea", "ppj", "loa")

# Names of qualitative-analysis software.
QDA_TERMS = ("maxqda", "maxquda", "max qda", "nvivo", "atlas.ti", "atlas ti", "atlasti", "qda miner", "provalis", "refi-qda", "quirkos", "f4analyse", "f4 analyze", "qdacity", "dedoose", "code system")

# Extensions of primary data.
PRIMARY_EXTENSIONS = (
    "txt", "pdf", "rtf", "doc", "docx", "odt", "md", "html", "htm", "epub", "csv", "tsv", "tab", "xls", "xlsx", "ods", "json", "jsonl", "xml",
    "wav", "mp3", "m4a", "aac", "flac", "ogg", "mp4", "mov", "avi", "mkv", "m4v", "jpg", "jpeg", "png", "tif", "tiff", "gif", "bmp", "webp", "svg", "srt", "vtt",
)

# Extensions and phrases of metadata exports.
METADATA_EXTENSIONS = ("xml", "json", "jsonld", "rdf", "xsd", "dtd")
METADATA_TERMS = ("ddi xml metadata export", "metadata export", "export metadata", "metadata-only", "metadata only")

# Extensions of primary data inside archives.
ARCHIVE_PRIMARY_EXTENSIONS = ("txt", "pdf", "rtf", "doc", "docx", "odt", "md", "csv", "tsv", "tab", "wav", "mp3", "m4a", "aac", "flac", "ogg", "mp4", "mov", "avi", "mkv", "srt", "vtt")

# The DOI pattern, titles that are file names, titles that name nothing.
DOI_PATTERN = r"10\.\d{4,9}/[-._;()/:a-z0-9]+"
FILE_TITLE_PATTERN = r"(?i)\.(pdf|txt|csv|tsv|tab|docx?|xlsx?|json|xml|qdpx|nvpx|nvp|mx[0-9]+|zip|png|jpe?g|wav|mp3|mp4|rtf|md)$"
GENERIC_TITLES = ("unknown", "dataset", "data set", "replication data for", "supplementary data", "supplementary files", "untitled")
TITLE_LENGTH = 20

# The two term lists of the context classifier.
LEGAL_TERMS = ("international criminal law", "charging document", "prosecution", "appeals briefs", "appeal ground", "defendant", "international criminal court", "icc", "ictr", "scsl")
RESEARCH_TERMS = ("aireas", "safecast", "citizen sensing", "risk governance", "responses survey", "environmental risk")

# Repositories of the acquisition ledger.
LEDGER_REPOSITORIES = {"dans": (5, "https://dans.knaw.nl/en/"), "icpsr": (15, "https://icpsr.umich.edu/"), "zenodo": (99, "https://zenodo.org/")}

SCOPES = ("MY_CORE", "PEER_SHARED")
#: White space as Python's str.strip and \s see it, for Java and RE2 alike.
SPACE = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]"
