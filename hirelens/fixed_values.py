"""Fixed values.

Every list, map and constant here is a fixed value: classification results,
reject reasons and canonical names are only comparable between installations
that use the same entries in the same order. Code lives elsewhere; pass your
own lists to the functions that take them to change behaviour.
"""

# --- value domains (fixed values) -------------------------------------------

RUN_STATUSES = ["running", "success", "failed", "partial_success"]

ROLES = [
    "data_analyst",
    "data_engineer",
    "bi_analyst",
    "data_scientist",
    "machine_learning_engineer",
    "analytics_engineer",
    "other",
    "unknown",
]
NON_TARGET_ROLES = ["unknown", "other"]
TARGET_ROLES = [r for r in ROLES if r not in NON_TARGET_ROLES]

ANALYSIS_METHODS = ["rule_based", "ai_assisted", "manual_review"]
EXTRACTION_METHODS = ["ai", "rule_based", "manual"]

SKILL_CATEGORIES = [
    "Programming",
    "Database",
    "Spreadsheet",
    "Data Visualization",
    "Data Engineering",
    "Data Warehousing",
    "Orchestration",
    "Cloud",
    "DevOps",
    "Version Control",
    "Machine Learning",
    "Statistics",
    "Data Management",
    "Automation",
    "Other Technical",
]
DEFAULT_CATEGORY = "Other Technical"

# --- record completeness (fixed values) -------------------------------------

REQUIRED_PAYLOAD_FIELDS = ["job_id", "title", "company", "location", "description_text"]

# --- location rules (fixed values) ------------------------------------------

NO_COUNTRY_WORDS = ["remote", "worldwide", "anywhere"]

COUNTRY_NAMES = {
    "united states": "United States",
    "united kingdom": "United Kingdom",
    "morocco": "Morocco",
    "france": "France",
    "spain": "Spain",
    "germany": "Germany",
    "canada": "Canada",
    "india": "India",
    "netherlands": "Netherlands",
    "belgium": "Belgium",
    "italy": "Italy",
    "portugal": "Portugal",
    "ireland": "Ireland",
    "australia": "Australia",
}

US_STATE_CODES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN",
    "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV",
    "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN",
    "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC",
]

US_METRO_SIGNALS = [
    "metropolitan area",
    "metroplex",
    "greater chicago area",
    "greater new york city area",
    "greater boston",
    "greater seattle",
    "greater los angeles",
    "greater houston",
    "greater atlanta",
    "greater phoenix",
    "greater denver",
    "greater miami",
    "greater minneapolis-st. paul",
    "washington dc",
    "washington dc-baltimore",
    "new york city",
    "bay area",
    "san francisco bay area",
    "silicon valley",
    "los angeles metropolitan area",
    "atlanta metropolitan area",
    "dallas-fort worth",
    "dallas fort worth",
    "dallas-fort worth metroplex",
]

REMOTE_SIGNALS = ["remote", "work from home", "work-from-home", "fully remote", "remote-first"]
ONSITE_SIGNALS = ["on-site", "onsite", "on site"]

# --- role phrases, in match order (fixed values) ----------------------------

ML_TITLES = [
    "machine learning engineer",
    "ml engineer",
    "ai engineer",
    "deep learning engineer",
    "computer vision engineer",
    "nlp engineer",
    "machine learning intern",
    "ai intern",
    "ml intern",
]
ML_SIGNALS = [
    "machine learning engineering",
    "mlops",
    "model deployment",
    "deploy machine learning models",
    "production machine learning",
    "ml pipelines",
    "deep learning models",
]
ANALYTICS_ENGINEER_TITLES = [
    "analytics engineer",
    "analytic engineer",
    "dbt developer",
    "data modeling engineer",
]
ANALYTICS_ENGINEER_SIGNALS = [
    "dbt",
    "data modeling",
    "semantic layer",
    "analytics engineering",
    "warehouse models",
]
DATA_ENGINEER_TITLES = [
    "data engineer",
    "junior data engineer",
    "entry level data engineer",
    "big data engineer",
    "etl engineer",
    "data pipeline engineer",
    "data platform engineer",
    "cloud data engineer",
    "data infrastructure engineer",
]
DATA_ENGINEER_SIGNALS = [
    "etl pipelines",
    "data pipelines",
    "data warehouse",
    "data warehouses",
    "data lake",
    "spark",
    "airflow",
    "kafka",
    "pipeline orchestration",
]
DATA_SCIENTIST_TITLES = [
    "data scientist",
    "junior data scientist",
    "entry level data scientist",
    "product data scientist",
    "decision scientist",
    "research scientist",
    "applied scientist",
]
DATA_SCIENTIST_SIGNALS = [
    "statistical modeling",
    "predictive modeling",
    "experimentation",
    "a/b testing",
    "machine learning models",
    "causal inference",
    "forecasting models",
]
BI_TITLES = [
    "business intelligence analyst",
    "bi analyst",
    "business intelligence developer",
    "bi developer",
    "data visualization analyst",
    "reporting analyst",
    "dashboard developer",
    "tableau developer",
    "power bi developer",
    "powerbi developer",
]
DATA_ANALYST_TITLES = [
    "data analyst",
    "junior data analyst",
    "entry level data analyst",
    "data analyst intern",
    "data analytics intern",
    "analytics analyst",
    "product analyst",
    "product data analyst",
    "business data analyst",
    "data quality analyst",
    "data reporting analyst",
    "operations analyst",
    "marketing analyst",
]
ANALYST_TITLE_SIGNALS = [
    "analyst",
    "analytics associate",
    "data associate",
    "reporting associate",
]
DATA_ANALYSIS_SIGNALS = [
    "sql",
    "excel",
    "data analysis",
    "analyze data",
    "dashboards",
    "metrics",
    "reporting",
    "data-driven",
]
NON_TARGET_TITLES = [
    "software engineer",
    "frontend developer",
    "front end developer",
    "backend developer",
    "back end developer",
    "full stack developer",
    "project manager",
    "program manager",
    "product manager",
    "account manager",
    "sales",
    "recruiter",
    "human resources",
    "finance manager",
    "marketing manager",
    "customer success",
    "technical writer",
]
WEAK_DATA_TITLES = ["data", "analytics", "insights", "reporting", "business intelligence"]

EXCLUSION_WORDS = [
    "senior",
    "sr",
    "lead",
    "principal",
    "staff",
    "manager",
    "head",
    "director",
    "architect",
]
EXCLUSION_REASON = "senior/exclusion keyword in title: "

# --- documented seniority keywords, in class order (fixed values) -----------

SENIORITY_KEYWORDS = {
    "Internship": ["intern", "internship", "stagiaire", "stage", "trainee"],
    "Junior": ["junior", "entry-level", "débutant", "0-2 years"],
    "Intermediate": ["3-5 years", "confirmed", "intermediate"],
    "Senior": ["senior", "lead", "expert", "manager", "architect", "5+ years"],
}
SENIORITY_UNKNOWN = "Unknown"

# --- skill vocabulary (fixed values) ----------------------------------------

CANONICAL_SKILLS = {
    "Apache Spark": "Spark",
    "PySpark": "Spark",
    "Apache Airflow": "Airflow",
    "Apache Kafka": "Kafka",
    "Microsoft Power BI": "Power BI",
    "PowerBI": "Power BI",
    "Postgres": "PostgreSQL",
    "Postgre SQL": "PostgreSQL",
    "Google Cloud Platform": "GCP",
    "Amazon Web Services": "AWS",
    "Microsoft Azure": "Azure",
    "Data Build Tool": "dbt",
    "DBT": "dbt",
    "AI": "Artificial Intelligence",
    "A.I.": "Artificial Intelligence",
    "Database": "Databases",
}

CATEGORY_BY_SKILL = {
    "SQL": "Database",
    "Databases": "Database",
    "Microsoft Access": "Database",
    "Oracle": "Database",
    "Artificial Intelligence": "Machine Learning",
    "Power BI": "Data Visualization",
    "Tableau": "Data Visualization",
    "Looker": "Data Visualization",
    "Google Analytics": "Data Visualization",
    "Python": "Programming",
    "R": "Programming",
    "NumPy": "Programming",
    "Excel": "Spreadsheet",
}

CATEGORY_ALIASES = {
    "Programming Language": "Programming",
    "Scripting Language": "Programming",
    "Query Language": "Database",
    "Database Technology": "Database",
    "Relational Database": "Database",
    "Relational Databases": "Database",
    "Business Intelligence": "Data Visualization",
    "BI": "Data Visualization",
    "BI Tool": "Data Visualization",
    "BI Tools": "Data Visualization",
    "Visualization": "Data Visualization",
    "Dashboarding": "Data Visualization",
    "Dashboard": "Data Visualization",
    "Dashboards": "Data Visualization",
    "Reporting": "Data Visualization",
    "Reporting Tool": "Data Visualization",
    "Reporting Tools": "Data Visualization",
    "Big Data Processing": "Data Engineering",
    "Data Pipeline": "Data Engineering",
    "Data Pipelines": "Data Engineering",
    "ETL": "Data Engineering",
    "ELT": "Data Engineering",
    "Data Modeling": "Data Engineering",
    "Dimensional Modeling": "Data Engineering",
    "Data Warehouse": "Data Warehousing",
    "Data Warehouses": "Data Warehousing",
    "Cloud Data Warehouse": "Data Warehousing",
    "Cloud Data Warehousing": "Data Warehousing",
    "Workflow Orchestration": "Orchestration",
    "Pipeline Orchestration": "Orchestration",
    "Cloud Platform": "Cloud",
    "Cloud Computing": "Cloud",
    "Cloud Services": "Cloud",
    "Containerization": "DevOps",
    "Containerisation": "DevOps",
    "Version Control System": "Version Control",
    "ML": "Machine Learning",
    "AI": "Machine Learning",
    "Artificial Intelligence": "Machine Learning",
    "Machine Learning Framework": "Machine Learning",
    "Data Mining": "Machine Learning",
    "Predictive Modeling": "Machine Learning",
    "Statistical Modeling": "Statistics",
    "Statistical Analysis": "Statistics",
    "A/B Testing": "Statistics",
    "Hypothesis Testing": "Statistics",
    "Data Governance": "Data Management",
    "Data Quality": "Data Management",
    "Data Lineage": "Data Management",
    "Metadata Management": "Data Management",
    "Workflow Automation": "Automation",
    "Process Automation": "Automation",
}

# "PowerPoint" is stored in mixed case while the lookup is lower case, so it is
# kept unless strict matching is asked for.
REJECTED_SKILLS = [
    "communication",
    "teamwork",
    "leadership",
    "problem solving",
    "problem-solving",
    "collaboration",
    "stakeholder management",
    "attention to detail",
    "fast-paced environment",
    "data",
    "tools",
    "technology",
    "technologies",
    "software",
    "business",
    "analytics",
    "reporting",
    "PowerPoint",
]
MAX_SKILL_LENGTH = 80
SINGLE_LETTER_SKILL = "R"
MAX_DESCRIPTION_CHARACTERS = 6000

MAX_ALIAS_LENGTH = 60
MAX_ALIAS_WORDS = 6
BROAD_ALIAS_MARKERS = [
    " or ",
    " and ",
    ",",
    ";",
    "(",
    ")",
    " such as ",
    " including ",
    " preferred",
    " experience with ",
]

# --- page and URL formats (fixed values) ------------------------------------

JOB_URL_PREFIX = "https://www.linkedin.com/jobs/view/"
SITE_ROOT = "https://www.linkedin.com"
SEARCH_URL = "https://www.linkedin.com/jobs/search/"
FRAGMENT_URL = "https://www.linkedin.com/jobs-guest/jobs/api/seeMoreJobPostings/search"
PAGE_SOURCE_NAME = "linkedin"
DIRECT_ID_PATTERN = r"/jobs/view/(\d+)"
SLUG_ID_PATTERN = r"/jobs/view/[^/?#]*?-(\d+)(?:[/?#]|$)"
CURRENT_JOB_PARAMETER = "currentJobId"
NAVIGATION_PARAMETERS = ["start", "currentJobId", "position", "pageNum", "trk"]
RESTRICTION_MARKERS = ["captcha", "authwall", "sign in to linkedin", "join linkedin"]
CARD_LINK_CLASS = "base-card__full-link"
CARD_LINK_PATH = "/jobs/view/"
SEARCH_CONFIG_FIELDS = [
    "location",
    "max_urls_per_search",
    "offset_step",
    "max_pages",
    "delay_seconds",
    "output_dir",
    "searches",
]
DEFAULT_MAX_CONSECUTIVE_NO_NEW = 2

# payload field -> (kind, tag, classes, attributes, attribute to read)
PAGE_SELECTORS = {
    "job_id": ("comment", None, [], {"id": "decoratedJobPostingId"}, None),
    "title": ("text", "h1", ["top-card-layout__title", "topcard__title"], {}, None),
    "company": ("text", "a", ["topcard__org-name-link"], {}, None),
    "location": ("text", "span", ["topcard__flavor--bullet"], {}, None),
    "posted_time_text": ("text", "span", ["posted-time-ago__text"], {}, None),
    "applicants_text": ("text", "figcaption", ["num-applicants__caption"], {}, None),
    "description": ("markup", "div", ["show-more-less-html__markup"], {}, None),
    "canonical_url": ("attribute", "link", [], {"rel": "canonical"}, "href"),
    "linkedin_url": ("attribute", "meta", [], {"property": "lnkd:url"}, "content"),
    "og_title": ("attribute", "meta", [], {"property": "og:title"}, "content"),
    "og_description": ("attribute", "meta", [], {"property": "og:description"}, "content"),
    "title_id": ("attribute", "meta", [], {"name": "titleId"}, "content"),
    "company_id": ("attribute", "meta", [], {"name": "companyId"}, "content"),
}
CRITERIA_ITEM = ("li", ["description__job-criteria-item"])
CRITERIA_KEY = ("h3", ["description__job-criteria-subheader"])
CRITERIA_VALUE = ("span", ["description__job-criteria-text"])

# --- report settings (fixed values) -----------------------------------------

GAP_SKILLS = 15
LONG_MENTION_LENGTH = 80
LONG_MENTION_ROWS = 30
NO_SKILLS_TEXT = "No skills extracted"
