"""Declared inputs: products, source layouts, the unified schema and fixed word lists."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The product dimension (product_key, product_id, product_name, vendor, tier)
# ---------------------------------------------------------------------------
PRODUCT_ROWS = [
    ("oracle_netsuite", "ORC-NS-001", "Oracle NetSuite", "Oracle", "enterprise"),
    ("sap_cloud_erp", "SAP-S4-001", "SAP S/4HANA Cloud", "SAP", "enterprise"),
    ("microsoft_dynamics_365", "MSFT-D365-001", "Microsoft Dynamics 365", "Microsoft", "enterprise"),
    ("quickbooks_enterprise", "QB-ENT-001", "QuickBooks Enterprise", "Intuit", "smb"),
    ("quickbooks_online", "QB-ONLINE-001", "QuickBooks Online", "Intuit", "smb"),
    ("quickbooks_desktop_pro", "QB-DESK-PRO-001", "QuickBooks Desktop Pro", "Intuit", "smb"),
    ("intuit_enterprise_suite", "INT-IES-001", "Intuit Enterprise Suite", "Intuit", "smb"),
    ("sage_intacct", "SGE-INT-001", "Sage Intacct", "Sage", "smb"),
    ("workday_financial", "WD-FIN-001", "Workday Financial Management", "Workday", "enterprise"),
    ("acumatica", "ACU-ERP-001", "Acumatica", "Acumatica", "smb"),
    ("xero", "XRO-ACC-001", "Xero", "Xero", "smb"),
    ("certinia", "CRT-ERP-001", "Certinia", "Certinia", "enterprise"),
]
PRODUCT_SCHEMA = "product_key string, product_id string, product_name string, vendor string, tier string"

# ---------------------------------------------------------------------------
# Unified review schema. The declared type drives coercion.
# ---------------------------------------------------------------------------
STR, FLOAT, INT, BOOL = "str", "float", "int", "bool"

UNIFIED_FIELDS: dict[str, str] = {
    "review_id": STR,
    "product_id": STR,
    "product_name": STR,
    "source_platform": STR,
    "source_actor": STR,
    "scraped_at": STR,
    "likes": STR,
    "dislikes": STR,
    "recommendations": STR,
    "use_case": STR,
    "overall_rating": FLOAT,
    "ease_of_use": FLOAT,
    "support_rating": FLOAT,
    "value_rating": FLOAT,
    "likely_to_recommend": FLOAT,
    "reviewer_name": STR,
    "reviewer_title": STR,
    "reviewer_company_size": STR,
    "reviewer_industry": STR,
    "reviewer_location": STR,
    "time_using_product": STR,
    "review_date": STR,
    "is_verified": BOOL,
    "is_incentivized": BOOL,
    "product_overall_rating": FLOAT,
    "product_review_count": INT,
    "extraction_confidence": FLOAT,
}
REQUIRED_FIELDS = ["review_id", "product_id", "product_name", "source_platform", "source_actor", "scraped_at"]
MAPPED_FIELDS = [
    f
    for f in UNIFIED_FIELDS
    if f not in {"product_id", "product_name", "source_platform", "source_actor", "scraped_at", "extraction_confidence"}
]
SPARK_TYPES = {STR: T.StringType(), FLOAT: T.DoubleType(), INT: T.LongType(), BOOL: T.BooleanType()}

CONFIDENCE_FIELDS = ["likes", "dislikes", "overall_rating", "reviewer_company_size", "review_date"]
TEXT_FIELDS = ["likes", "dislikes", "use_case"]


@dataclass(frozen=True)
class SourceLayout:
    """Where one source keeps each unified field, as dotted paths into its raw item."""

    key: str
    platform: str
    fields: dict[str, str]
    bonus: list[str] = field(default_factory=list)
    platform_path: str | None = None

    def __post_init__(self):
        unknown = set(self.fields) - set(MAPPED_FIELDS)
        if unknown:
            raise ValueError(f"{self.key}: not unified fields: {sorted(unknown)}")
        keys = self.bonus_keys
        if len(set(keys)) != len(keys):
            raise ValueError(f"{self.key}: two bonus paths share a key")

    @property
    def bonus_keys(self) -> list[str]:
        return [p.rsplit(".", 1)[-1] for p in self.bonus]


# The three source layouts.
LAYOUTS: dict[str, SourceLayout] = {
    layout.key: layout
    for layout in [
        SourceLayout(
            key="jupri",
            platform="g2",
            fields={
                "review_id": "id",
                "likes": "answers.0",
                "dislikes": "answers.1",
                "recommendations": "answers.2",
                "use_case": "answers.3",
                "overall_rating": "score",
                "reviewer_name": "name",
                "reviewer_title": "role",
                "reviewer_company_size": "segment",
                "reviewer_industry": "industry",
                "reviewer_location": "location.country",
                "review_date": "date.published",
            },
            bonus=[
                "title",
                "date.submitted",
                "date.updated",
                "helpful",
                "url",
                "source.type",
                "switched_from",
                "product_slug",
                "product_id",
                "location.region",
                "location.primary",
            ],
        ),
        SourceLayout(
            key="samstorm",
            platform="capterra",
            fields={
                "review_id": "reviewId",
                "likes": "pros",
                "dislikes": "cons",
                "overall_rating": "overallRating",
                "ease_of_use": "easeOfUse",
                "support_rating": "customerService",
                "value_rating": "valueForMoney",
                "likely_to_recommend": "likelihood_to_recommend",
                "reviewer_name": "reviewerName",
                "reviewer_title": "reviewerTitle",
                "reviewer_company_size": "companySize",
                "review_date": "publishedDate",
            },
            bonus=["sourceUrl", "featuresRating", "reviewTitle"],
        ),
        SourceLayout(
            key="focused_vanguard",
            platform="multi",
            fields={
                "review_id": "id",
                "likes": "pros",
                "dislikes": "cons",
                "use_case": "body",
                "overall_rating": "rating",
                "reviewer_name": "author",
                "reviewer_title": "authorTitle",
                "reviewer_company_size": "companySize",
                "review_date": "publishedAt",
            },
            bonus=["sourcePlatform", "sourceUrl"],
            platform_path="sourcePlatform",
        ),
    ]
}

# Fixed values.
PLATFORMS = {"g2": "g2", "G2": "g2", "capterra": "capterra", "Capterra": "capterra", "gartner": "gartner", "Gartner": "gartner"}
TRUE_WORDS = ["true", "yes", "1", "verified"]
INCENTIVIZED_TYPES = ["g2gives", "g2_incentivized"]
LOOKBACK_DAYS = 90

NULL_COLUMNS = [
    "ease_of_use", "support_rating", "value_rating", "likely_to_recommend",
    "time_using_product", "is_verified", "product_overall_rating", "product_review_count",
]
PIPELINE_COLUMNS = [
    "scraped_at", "extraction_confidence", "source_actor",
    "bonus_primary", "bonus_updated", "bonus_helpful", "recommendations",
]
META_COLUMNS = [
    "review_id", "product_id", "product_name", "source_platform", "review_date", "review_submitted_at",
    "overall_rating", "reviewer_name", "reviewer_title", "reviewer_company_size", "reviewer_industry",
    "reviewer_location", "reviewer_region", "review_title", "review_type", "is_incentivized", "review_url",
    "switched_from_product", "switched_from_reason",
]
CONTEXT_COLUMNS = [
    "review_id", "product_id", "product_name", "reviewer_company_size", "reviewer_industry",
    "overall_rating", "is_incentivized", "review_date", "switched_from_product",
]
LONG_COLUMNS = CONTEXT_COLUMNS + [
    "text_field", "text", "topic_id", "probability", "top_keywords", "label", "macro_group", "group_label",
    "plain_description", "is_noise", "is_product_cluster",
]
DOC_TOPIC_COLUMNS = [
    "review_id", "product_id", "product_name", "reviewer_company_size", "reviewer_industry", "source_platform",
    "review_date", "overall_rating", "is_incentivized", "switched_from_product", "switched_from_reason",
]

# ---------------------------------------------------------------------------
# Text and scoring parameters (fixed values)
# ---------------------------------------------------------------------------
MIN_CHARS = 50
MIN_SENTENCE_CHARS = 15
NULL_TOKENS = ["nan", "None", ""]
EXCLUDED_GROUPS = ["noise", "outlier", "unassigned", ""]
RATING_WEIGHTS = {"positive": 5.0, "neutral": 3.0, "negative": 1.0}
NEUTRAL_RATING = 3.0
OUTLIER_KEYWORDS = "outlier — no coherent topic"
UNLABELLED = "unlabelled"

# Abbreviation patterns in the order they apply (whole word, any case).
ABBREVIATIONS: list[tuple[str, str]] = [
    ("ap aging", "accounts payable aging report"),
    ("ar aging", "accounts receivable aging report"),
    ("rev rec", "revenue recognition"),
    ("asc 606", "revenue recognition standard"),
    ("fp&a", "financial planning and analysis"),
    ("fpa", "financial planning and analysis"),
    ("ap", "accounts payable"),
    ("ar", "accounts receivable"),
    ("gl", "general ledger"),
    ("coa", "chart of accounts"),
    ("p&l", "profit and loss"),
    ("pnl", "profit and loss"),
    ("tb", "trial balance"),
    ("po", "purchase order"),
    ("pos", "point of sale"),
    ("so", "sales order"),
    ("wms", "warehouse management system"),
    ("mrp", "material requirements planning"),
    ("wip", "work in progress"),
    ("skus?", "stock keeping unit"),
    ("bom", "bill of materials"),
    ("3pl", "third party logistics"),
    ("kpis?", "key performance indicator"),
    ("roi", "return on investment"),
    ("gaap", "generally accepted accounting principles"),
    ("ifrs", "international financial reporting standards"),
    ("sox", "sarbanes oxley compliance"),
    ("1099", "1099 tax form"),
    ("w-?2", "w2 payroll form"),
    ("pto", "paid time off"),
    ("hris", "human resources information system"),
    ("hcm", "human capital management"),
    ("psa", "professional services automation"),
    ("sow", "statement of work"),
    ("crm", "customer relationship management"),
    ("api", "application programming interface"),
    ("sso", "single sign on"),
    ("2fa", "two factor authentication"),
    ("ui", "user interface"),
    ("ux", "user experience"),
    ("sla", "service level agreement"),
    ("etl", "data extraction transformation loading"),
]

# Stop phrases taken out of topic keywords.
PRODUCT_STOP = [
    "netsuite", "net suite", "oracle",
    "sap", "s4", "s4hana", "hana", "4hana", "s/4hana", "ecc", "brf", "fiori",
    "microsoft", "dynamics", "dynamics 365", "business central", "bc", "gp", "navision", "nav", "d365", "365", "central",
    "quickbooks", "quickbooks online", "quickbooks enterprise", "quickbooks desktop",
    "qb", "qbo", "qbe", "qbd", "quick books", "quickbook", "online", "desktop", "pro", "desktop pro",
    "intuit", "intuit enterprise", "ies",
    "sage", "intacct", "sage intacct", "intaact",
    "workday", "workday financial",
    "acumatica", "aia", "var", "vars",
    "xero",
    "certinia", "financialforce", "financial force", "ffa", "ff",
    "erp", "software", "system", "platform", "tool", "product", "application", "solution", "program", "saas",
    "cloud", "cloud based", "books", "book", "likes", "dislikes", "dislike",
]
META_STOP = [
    "downsides", "downside", "complaints", "complain", "negatives", "negative", "honestly", "nothing", "anything",
    "haven", "moment", "head", "think", "comes", "mind", "change", "thing", "great", "good", "perfectly", "enjoyed",
    "deserves", "relevant", "works",
]
ALL_STOP = PRODUCT_STOP + META_STOP

# Default English function words for the vectoriser; any other list can be passed in.
ENGLISH_STOP = """
a about above after again all also am an and any are as at be because been before being below between both but by
can could did do does doing down during each few for from further had has have having he her here hers him his how
i if in into is it its itself just me more most my myself no nor not now of off on once only or other our ours out
over own same she should so some such than that the their theirs them then there these they this those through to
too under until up very was we were what when where which while who whom why will with would you your yours
""".split()

# Scoring defaults. The general lexicon is ours; callers pass their own (token -> +1 / -1).
SENTIMENT_LEXICON = {
    **dict.fromkeys(
        "accurate best clear comprehensive easy efficient excellent fantastic fast flexible friendly great helpful "
        "intuitive love perfectly powerful quick reliable robust simple smooth streamlined useful".split(),
        1,
    ),
    **dict.fromkeys(
        "bad broken bug bugs clunky complex confusing costly difficult error errors expensive fails frustrating hard "
        "lacks limited missing nightmare no poor slow terrible worst".split(),
        -1,
    ),
}

MIN_TOPIC_SIZE = 10
MAX_TOPICS = 60
TOP_TERMS = 10
MIN_DF = 5
MAX_DF = 0.85
