"""Default vocabularies. All of them are parameters of the operators using them.

Fixed values: the word lists, patterns, formats and limits below define the
results and must stay as they are, in this order.
"""

JOB_TYPES = [
    ("full-time", "full-time"), ("full time", "full-time"), ("fulltime", "full-time"),
    ("part-time", "part-time"), ("part time", "part-time"), ("parttime", "part-time"),
    ("contract", "contract"), ("freelance", "freelance"),
    ("temporary", "temporary"), ("temp", "temporary"),
    ("internship", "internship"), ("intern", "internship"),
    ("volunteer", "volunteer"),
]

EXPERIENCE_LEVELS = [
    ("entry", ["entry", "junior", "graduate", "jr"]),
    ("mid", ["mid", "intermediate", "associate"]),
    ("senior", ["senior", "sr", "lead", "principal"]),
    ("executive", ["executive", "director", "vp", "c-level", "head"]),
]

REMOTE_PHRASES = [
    "remote", "work from home", "wfh", "anywhere", "distributed", "worldwide", "global",
]

KES_PLACES = ["kenya", "nairobi", "mombasa", "kisumu", "nakuru"]

TAG_KEYWORDS = [
    "python", "java", "javascript", "typescript", "react", "angular", "vue",
    "node.js", "django", "flask", "fastapi", "spring", "docker", "kubernetes",
    "aws", "azure", "gcp", "sql", "postgresql", "mongodb", "redis",
    "git", "ci/cd", "agile", "scrum", "rest", "graphql", "api",
    "machine learning", "data science", "ai", "devops", "linux",
    "excel", "accounting", "marketing", "sales", "finance",
    "project management", "communication", "leadership",
]

# Titles of category and aggregator pages, matched case-insensitively.
JUNK_TITLE_PATTERNS = [
    "%Hiring For jobs%", "%Hiring Full Time jobs%",
    "%Job In Kenya Jobs%", "Jobs in Kenya%", "Jobs in Nairobi%",
    "%Trending%Jobs%", "%Latest%Jobs in Kenya%",
    "%Explore the Trending%", "%Check out the%Jobs%",
    "%Exciting Trending%", "%Latest In-Demand%",
    "%Your CV Format%", "Click here to%", "%post comments%",
    "CURRENT%JOBS IN KENYA%", "Current%Jobs in Kenya%",
    "All jobs |%", "%Jobs Archive%", "Jobweb Kenya:%",
    "%Jobs, Employment%", "%Now Hiring jobs%",
    "%Immediate jobs in%", "%We Are Hiring jobs%",
    "%Vacancies jobs in%", "%Companies Hiring jobs%",
    "%Hiring jobs in%", "%jobs in Kenya (%",
]
JUNK_SOURCE_PATTERN = "google_%"
GENERIC_TITLE_PATTERN = "% Jobs"
MIN_DESCRIPTION = 30
MIN_TITLE = 5
STALE_DAYS = 30

# Prose extraction
CITIES = ["Nairobi", "Mombasa", "Kisumu", "Nakuru", "Lagos", "Kampala", "Dar es Salaam"]
LOCATION_LABELS = ["Location", "Workplace", "Based in"]
LOCATION_COUNTRIES = ["Kenya", "Nigeria", "Uganda", "Tanzania"]
CITY_COUNTRIES = ["Kenya", "Nigeria"]
PROSE_JOB_TYPES = [
    ("Full-Time", ["full-time", "fulltime", "full time"]),
    ("Part-Time", ["part-time", "parttime"]),
    ("Contract", ["contract"]),
    ("Internship", ["internship"]),
]
JOB_TYPE_PROSE_PATTERN = "full[- ]time|part[- ]time|contract|internship|freelance"
CHIP_JOB_TYPES = [
    "full time", "part time", "contract", "freelance", "internship", "temporary",
]
PLACE_PROSE_PATTERN = "nairobi|mombasa|kisumu|nakuru|kenya|kampala|dar es salaam"
NAVIGATION_PHRASES = [
    "skip to content", "share this", "whatsapp", "opened career",
    "copyright", "privacy policy", "terms", "read more & apply",
]
REQUIREMENT_WORDS_POST = [
    "requirement", "qualification", "minimum position",
    "what we're looking for", "what you'll need", "the person",
    "skills required", "education", "must have", "ideal candidate",
]
REQUIREMENT_WORDS_ATS = [
    "requirement", "qualification", "what we're looking for",
    "what you'll need", "you should have", "what we need",
]

# Section headings: (section, pattern), first match decides.
SECTION_HEADINGS = {
    "brightermonday": [
        ("desc", "description|summary|about the (job|role|position)"),
        ("req", "requirement|qualification|what we (need|look|want)|must have|skills"),
        ("offer", "what we offer|benefit|package|compensation"),
    ],
    "summitrecruitment": [
        ("desc", "description|summary|about|role|position|overview"),
        ("req", "requirement|qualification|what we (need|look|want)|must have|competenc|skills required"),
        ("offer", "what we offer|benefit|package|compensation"),
    ],
    "fuzu": [
        ("desc", "description|summary|about|role"),
        ("req", "requirement|qualification|skills"),
    ],
}
BOILERPLATE_TAGS = ["script", "style", "nav", "header", "footer", "aside"]
ERROR_WIDTH = 2000

# Deadlines: the label removed first, and the formats tried in order
# (strptime notation).
DEADLINE_LABEL = r"(deadline|closing\s*date|expires?)\s*:?\s*"
DEADLINE_LABEL_WITH_DATE = r"(deadline|closing\s*date|expires?|date)\s*:?\s*"
DEADLINE_LABEL_SHORT = r"[Dd]eadline[:\s]*"
DEADLINE_FORMATS = ["%d %B %Y", "%B %d, %Y", "%d/%m/%Y", "%Y-%m-%d", "%d %b %Y", "%d-%m-%Y"]
DEADLINE_FORMATS_5 = ["%d %B %Y", "%B %d, %Y", "%d/%m/%Y", "%Y-%m-%d", "%d %b %Y"]
DEADLINE_FORMATS_4 = ["%d %b %Y", "%B %d, %Y", "%d/%m/%Y", "%Y-%m-%d"]

# Run plans: source -> page budget.
DAILY_PLAN = [
    ("linkedin", "software developer", "Kenya", 3),
    ("myjobsinkenya", None, None, 5),
    ("brightermonday", None, None, 5),
    ("indeed", "", "Kenya", 3),
    ("glassdoor", "software", "Kenya", 2),
    ("fuzu", None, None, 5),
    ("google_search", "jobs hiring", "Kenya", 2),
    ("adzuna", "software", "Kenya", 3),
    ("jobwebkenya", None, None, 5),
    ("corporatestaffing", None, None, 5),
    ("kenyajob", None, None, 5),
    ("summitrecruitment", None, None, 3),
]
QUICK_PLAN = [
    ("linkedin", "developer", "Kenya", 2),
    ("brightermonday", "developer", "Kenya", 2),
    ("indeed", "developer", "Kenya", 2),
]
