"""Word lists and formats.  All of these are fixed values."""

# fixed values: words that say what kind of business it is, not which
LEGAL_SUFFIXES = (
    "inc", "incorporated", "corp", "corporation", "llc", "ltd", "limited",
    "pvt", "private", "llp", "co", "company", "gmbh", "sa", "sarl", "nv",
    "plc", "bv", "ag", "enterprises", "services", "group", "holdings",
    "center", "service", "the",
)

# fixed values: name words too frequent to retrieve by
GENERIC_NAME_TOKENS = (
    "enterprises", "company", "consulting", "solutions", "services",
    "industries", "international", "management", "development", "technologies",
    "associates", "trading", "group", "holdings", "agency", "global",
    "corporation", "incorporated", "limited", "private", "system", "systems",
)

# fixed values: stop words of the inverted blocker
COMMON_ADDRESS_STOPS = (
    "road", "street", "avenue", "drive", "lane", "near", "opposite", "behind",
    "floor", "building", "block", "sector", "nagar", "colony", "apartment",
    "suite", "unit", "plot", "town", "city", "post", "dist", "district", "state",
)
COMMON_NAME_STOPS = (
    "and", "the", "for", "with", "ltd", "inc", "pvt", "limited", "private",
    "corp", "llc", "llp", "company", "co", "services", "enterprises", "group",
    "center", "service",
)

# fixed values: stop words of the keys in dialect "train"
TRAIN_ADDRESS_STOPS = (
    *COMMON_ADDRESS_STOPS,
    "first", "second", "third", "main", "cross", "phase", "house", "door", "no",
)
TRAIN_NAME_STOPS = (
    "the", "and", "for", "with", "inc", "ltd", "pvt", "llc", "corp", "company", "co",
    "services", "enterprises", "group", "holdings", "private", "limited", "incorporated",
)

# fixed values: stop words of the address key in dialect "test"
TEST_ADDRESS_STOPS = ("road", "street", "lane", "avenue", "nagar", "floor", "block", "plot")

# fixed values: domain endings taken out of names
DOMAIN_ENDINGS = ("com", "in", "org", "net", "co", "biz", "info", "io", "ai", "gov", "edu", "me")

# fixed values: look-alike characters and the letters they stand for
LEET_FROM, LEET_TO = "01354@$", "olesaas"

# fixed values: words that the diagnosis of name words passes over
PROBE_STOPS = ("the", "and", "for", "with", "inc", "ltd", "pvt", "llc", "corp", "company", "co")

# fixed values: the order of the model's inputs
FEATURES = (
    "exact_compact", "exact_core", "exact_leet", "name_jw", "core_jw", "name_jaccard",
    "name_containment", "core_jaccard", "len_ratio", "addr_jaccard", "addr_containment", "addr_jw",
    "postal_match", "postal_conflict", "nums_jaccard", "nums_conflict",
    "name_strong_addr_strong", "name_strong_addr_conflict", "retrieval_score", "channel_count", "is_s2",
)

RAW = ("entity_id", "business_name", "business_address", "country")
