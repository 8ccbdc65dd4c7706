"""Fixed values of the data contract.

They must equal the contract's values for results to agree; they are stated as plain text.
"""

# Relation names and the names under which the target node lists them.
REVERSE_NAMES = {
    "supersedes": "superseded_by",
    "iterates": "iterated_by",
    "extends": "extended_by",
    "clarifies": "clarified_by",
    "references": "referenced_by",
    "aligns_with": "aligns_with_by",
    "conflicts_with": "conflicts_with_by",
    "cites_basis": "cited_as_basis_by",
    "derives_from": "landed_by",
}

# Region levels, widest first.
LEVELS = ["国家", "省", "市", "区"]

# Labels of the derivation link: old label to evidence class.
LINKAGE_CLASSES = {"直接落地": "直接落地", "借鉴框架": "补充细化", "主题对应": "同向部署"}

# Synonyms accepted on read, with the name used on write.
DOCUMENT_TYPES = {"policy": "policy", "core_policy": "core_policy", "核心政策": "core_policy"}
LEGACY_FIELDS = {"fetched_method": "fetched_via"}

# Confidence words seen in old records. The contract gives no numbers; these are the
# three source grades it lists for commentary.
CONFIDENCE_WORDS = {"high": 0.9, "medium": 0.7, "low": 0.5}

POLARITIES = ["supportive", "critical", "neutral", "mixed"]
SOURCE_TYPES = ["A", "B", "C", "D", "E"]
COMMENTARY_TYPES = ["A", "B", "C", "D", "E"]
SIGNAL_ROLES = ["risk", "opportunity", "execution", "attention", "interpretation", "noise"]

# Header fields of a raw document.
ALLOWED_FIELDS = [
    "id", "aliases", "title", "official_number", "issuer", "date", "region", "provenance",
    "issuer_canonical", "type", "subtype", "confidence", "dup_aliases", "dedup_at",
    "dedup_rule", "_duplicate_of", "_duplicate_reason",
]
FORBIDDEN_FIELDS = [
    "tags", "重要性", "行动分类", "价值标签", "scores", "影响分析", "行动建议", "related",
    "business_tags",
]
IMMUTABLE_EXCEPT = [
    "related_policy", "related_policy_source", "not_policy_related", "commentary_type",
    "id", "aliases", "date", "region", "issuer", "issuer_canonical",
]

# The only heading allowed in a raw body, and the headings that belong to derived tables.
ALLOWED_SECTIONS = ["政策原文"]

# Words that announce a claim of being first.
CLAIM_WORDS = ["首批", "首个", "首破", "首次", "创新", "标杆", "唯一", "第一"]
BANNED_PHRASES = ["四大业务", "五条业务线", "六大业务"]
IMPACT_KEYS = ["加油", "充电", "电力_储能_V2G_交易"]
SANITIZE = {"A 立即:": "A 趁早:"}

# Importance weights in tenths and the step thresholds of the action class.
WEIGHTS = {"D1": 4, "D2": 4, "D3": 2}
ARCHIVE_BELOW = 3
URGENT_FROM = 4
PRACTICAL_FROM = 4
STEP_UP_FROM = 4
STEP_DOWN_TO = 2

# Lengths and rates.
OPENING_CHARS = 800
LOW_QUALITY_CHARS = 3000
CONSENSUS_SOURCES = 3
CONFIDENCE_HIGH = 0.85
CONFIDENCE_MID = 0.70
DRAFTING_MONTHS = (6, 12)
PLACEHOLDER_YEAR = 1900

# Methods that recompute an identity field, in order of preference.
DATE_METHODS = [
    "url_path_pattern", "url_path_month_only", "body_publish_time", "body_chinese_date",
    "title_extract", "url_year_only",
]
