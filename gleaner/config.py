"""Fixed vocabularies and tunable settings of the posting engine."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

# ---- Fixed values -----------------------------------------------------------------------

AGGREGATOR_ROOTS = (
    "jooble.org", "adzuna.com", "adzuna.co.uk", "adzuna.ca", "adzuna.com.au", "adzuna.de", "adzuna.fr", "adzuna.nl",
    "adzuna.it", "adzuna.pl", "adzuna.at", "adzuna.ch", "adzuna.ru", "adzuna.in", "adzuna.sg", "adzuna.co.za",
    "adzuna.com.br", "adzuna.com.mx", "indeed.com", "google.com", "linkedin.com", "ziprecruiter.com", "glassdoor.com",
    "rapidapi.com",
)
SOURCE_PRIORS = {
    "greenhouse": 0.90, "lever": 0.90, "ashby": 0.90, "usajobs": 0.90, "siop": 0.80, "onemodel": 0.80, "included_ai": 0.75,
    "schema_org": 0.85, "text_classifier": 0.75, "jobspy_linkedin": 0.60, "jobspy_indeed": 0.60, "jobspy_glassdoor": 0.60,
    "jobspy_zip_recruiter": 0.55, "jsearch": 0.55, "adzuna": 0.55, "jooble": 0.50, "google_alerts": 0.40,
}
DEFAULT_PRIOR = 0.50
PROVENANCE_FIELDS = ("is_remote", "work_arrangement", "location", "location_country", "salary_min", "salary_max", "date_posted")
SENIORITY_RULES = (
    (r"\bintern(ship)?\b", "Intern"),
    (r"\b(managing\s+director)\b", "Executive"),
    (r"\b(staff)\s+(program\s+manager|scientist|engineer)\b", "Senior IC"),
    (r"\b(fellow)\b", "Senior IC"),
    (r"\b(chief|c-suite|chro|cpo|cao|cdo|cto)\b", "Executive"),
    (r"\bsvp\b", "Executive"),
    (r"\b(senior|sr\.?)\s+vice\s+president\b", "Executive"),
    (r"\bvice\s+president\b", "VP"),
    (r"\bvp\b", "VP"),
    (r"\b(senior|sr\.?)\s+director\b", "Senior Director"),
    (r"\bglobal\s+head\s+of\b", "Senior Director"),
    (r"\bhead\s+of\b", "Director"),
    (r"\bdirector\b", "Director"),
    (r"\b(senior|sr\.?)\s+manager\b", "Senior Manager"),
    (r"\bmanager\b", "Manager"),
    (r"\bprincipal\b", "Senior IC"),
    (r"\bstaff\b", "Senior IC"),
    (r"\b(senior|sr\.?)\s+(analyst|scientist|engineer|researcher|consultant|associate|specialist)\b", "Senior IC"),
    (r"\blead\b", "Senior IC"),
    (r"\b(analyst|scientist|engineer|researcher|specialist|coordinator|associate)\b", "IC"),
    (r"\bconsultant\b", "IC"),
)
SENIORITIES = ("Executive", "VP", "Senior Director", "Director", "Senior Manager", "Manager", "Senior IC", "IC", "Intern", "Unknown")
SALARY_BANDS = ((200_000, "Director"), (150_000, "Senior Manager"), (100_000, "Manager"), (60_000, "IC"))
CATEGORY_RULES = (
    (r"\b(employee\s+listening|voice\s+of\s+(the\s+)?employee|continuous\s+listening|listening\s+strategy|survey\s+analyst.*listening)\b", "Employee Listening"),
    (r"\bHRIS\b", "HRIS & Systems"),
    (r"\b(people\s+scien|research\s+scien|I-O\s+psych|industrial.organizational|behavioral\s+scien|psychometri)", "Research / I-O"),
    (r"\b(data\s+engineer|analytics\s+engineer|automation\s+engineer|data\s+architect)\b", "Data Engineering"),
    (r"\b(pay\s+equity|workplace\s+equity|compensation\s+analy)", "Pay Equity"),
    (r"\b(workforce\s+planning|SWP|workforce\s+optimi)", "Workforce Planning"),
    (r"\b(talent\s+intelligen|workforce\s+intelligen|skills\s+intelligen)", "Talent Intelligence"),
    (r"\b(employee\s+experience|EX\s+advisor|culture\s+analy|engagement\s+manager|engagement\s+director)", "EX & Culture"),
    (r"\b(people\s+analy|HR\s+analy|workforce\s+analy|talent\s+analy|human\s+capital\s+analy)", "People Analytics"),
)
CONSULTING_COMPANIES = ("deloitte", "pwc", "mckinsey", "ey", "kpmg", "mercer", "wtw", "korn ferry", "kincentric", "bain", "bcg", "accenture")
CONSULTING_SUFFIXES = ("inc", "llc", "corp", "ltd", "co", "corporation", "company", "group", "consulting", "llp", "& co", "& company")
COMPANY_SUFFIXES = ("inc", "llc", "corp", "ltd", "co", "corporation", "company")
TITLE_ABBREVIATIONS = ((r"\bsr\.?\b", "senior"), (r"\bjr\.?\b", "junior"), (r"\bmgr\b", "manager"), (r"\bdir\b", "director"), (r"\bvp\b", "vice president"))
TOOL_PATTERNS = (
    ("Qualtrics", r"(?i)\bqualtrics\b"), ("Medallia", r"(?i)\bmedallia\b"), ("Glint", r"(?i)\bglint\b"), ("Culture Amp", r"(?i)\bculture\s*amp\b"),
    ("Perceptyx", r"(?i)\bperceptyx\b"), ("Workday Peakon", r"(?i)\b(peakon|workday\s+peakon)\b"), ("Gallup", r"(?i)\bgallup\b"),
    ("Lattice", r"(?i)\blattice\b"), ("15Five", r"(?i)\b15\s*five\b"), ("BetterUp", r"(?i)\bbetterup\b"), ("SurveyMonkey", r"(?i)\b(surveymonkey|momentive)\b"),
    ("Microsoft Viva", r"(?i)\b(viva\s+insights?|microsoft\s+viva|workplace\s+analytics)\b"), ("Quantum Workplace", r"(?i)\bquantum\s+workplace\b"),
    ("TINYpulse", r"(?i)\btinypulse\b"), ("Workday", r"(?i)\bworkday\b(?!\s+peakon)"), ("SAP SuccessFactors", r"(?i)\b(successfactors|sap\s+sf)\b"),
    ("Oracle HCM", r"(?i)\b(oracle\s+hcm|oracle\s+cloud\s+hcm)\b"), ("ADP", r"(?i)\badp\b"), ("UKG", r"(?i)\b(ukg|ultimate\s+kronos|ultipro)\b"),
    ("BambooHR", r"(?i)\bbamboohr\b"), ("Dayforce", r"(?i)\b(dayforce|ceridian)\b"), ("Greenhouse", r"(?i)\bgreenhouse\b"), ("Lever", r"(?i)\blever\b"),
    ("iCIMS", r"(?i)\bicims\b"), ("SmartRecruiters", r"(?i)\bsmartrecruiters\b"), ("Ashby", r"(?i)\bashby\b"), ("Tableau", r"(?i)\btableau\b"),
    ("Power BI", r"(?i)\bpower\s*bi\b"), ("Looker", r"(?i)\blooker\b"), ("R", r"\bR\b(?!\s*(?:&|\band\b))"), ("Python", r"(?i)\bpython\b"),
    ("SQL", r"(?i)\bsql\b"), ("SPSS", r"(?i)\bspss\b"), ("SAS", r"(?i)\bsas\b"), ("Stata", r"(?i)\bstata\b"), ("Snowflake", r"(?i)\bsnowflake\b"),
    ("Databricks", r"(?i)\bdatabricks\b"), ("BigQuery", r"(?i)\bbigquery\b"), ("Redshift", r"(?i)\bredshift\b"),
    ("Organizational Network Analysis", r"(?i)\b(ONA|organizational\s+network\s+analy)"), ("Visier", r"(?i)\bvisier\b"), ("One Model", r"(?i)\bone\s+model\b"),
    ("Included.ai", r"(?i)\bincluded\s*(\.ai)?\b"), ("Crunchr", r"(?i)\bcrunchr\b"), ("ChartHop", r"(?i)\bcharthop\b"),
)
ARRANGEMENT_PATTERNS = (
    (r"\b(?:not\s+a\s+remote|no\s+remote\s+(?:work|option|policy|position|role)|this\s+is\s+not\s+(?:a\s+)?remote|remote\s+is\s+not)\b", "onsite", 0.90),
    (r"\b(?:on[- ]?site\s+only|in[- ]?office\s+only|must\s+(?:work\s+)?on[- ]?site|must\s+be\s+(?:in|on)[- ]?site|full[- ]?time\s+in\s+(?:the\s+)?office)\b", "onsite", 0.90),
    (r"\b(?:fully\s+remote|100%\s+remote|remote[- ]first|remote[- ]only|work\s+from\s+anywhere|remote\s+anywhere)\b", "remote", 0.90),
    (r"\b\d+(?:\s*[-–]\s*\d+)?\s*days?\s*(?:a\s+week|per\s+week|each\s+week|weekly)?\s*(?:in[- ](?:the\s+)?(?:office|person|hq)|on[- ]?site)\b", "hybrid", 0.85),
    (r"\bhybrid\s+(?:work|role|schedule|position|model|team|policy|arrangement|setup)\b", "hybrid", 0.85),
    (r"\b(?:this\s+is\s+a\s+remote|remote\s+(?:position|role|opportunity|job|eligible))\b", "remote", 0.75),
    (r"\b(?:work\s+from\s+home|telecommut(?:e|ing))\b", "remote", 0.70),
    (r"\bhybrid\b", "hybrid", 0.60),
    (r"\b(?:on[- ]?site|in[- ](?:the\s+)?office|in[- ]person)\b", "onsite", 0.50),
)
RESTRICTIVENESS = {"onsite": 0, "hybrid": 1, "remote": 2}
REMOTE_WORDS = r"\bfully\s+remote\b|\b100%\s+remote\b|\bremote\s+position\b|\bwork\s+from\s+home\b|\bremote\s+eligible\b"
HYBRID_WORDS = r"\bhybrid\b|\b\d+\s*days?\s+(?:in\s+)?(?:the\s+)?office\b|\bin-office\s+\d+\b"
ONSITE_WORDS = r"\bon[\s-]?site\b|\bin[\s-]?office\b|\bin[\s-]?person\b|\bno\s+remote\s+(?:work|option|policy|position|role)\b"
STATES = (
    "AL|AK|AZ|AR|CA|CO|CT|DE|FL|GA|HI|ID|IL|IN|IA|KS|KY|LA|ME|MD|MA|MI|MN|MS|MO|MT|NE|NV|NH|NJ|NM|NY|NC|ND|OH|OK|OR|PA|RI|SC|SD|TN|"
    "TX|UT|VT|VA|WA|WV|WI|WY|DC|PR"
)
SALARY_PATTERNS = (
    r"(?i)(?:salary|pay|compensation|range)[:\s]+\$?\s*([\d,]+)\s*(?:-|–|—|to)\s*\$?\s*([\d,]+)",
    r"(?i)\$\s*(\d+)\s*k\s*(?:-|–|—|to)\s*\$?\s*(\d+)\s*k",
    r"\$\s*([\d,]+)\s*(?:-|–|—|to)\s*\$\s*([\d,]+)",
    r"\$\s*([\d,]+)\s*(?:-|–|—|to)\s*([\d,]+)",
)
META_REFRESH = r"""(?i)<meta\s+http-equiv=["']refresh["']\s+content=["']\s*\d+\s*;\s*url=([^"']+)"""
SCRIPT_REDIRECTS = (
    r"""(?i)(?:window\.)?location(?:\.href)?\s*=\s*["']([^"']+)["']""",
    r"""(?i)location\.replace\s*\(\s*["']([^"']+)["']""",
    r"""(?i)location\.assign\s*\(\s*["']([^"']+)["']""",
)
TITLE_SEPARATORS = (" — ", " – ", " - ", " at ", " @ ", " | ")
RSS_SEPARATORS = (" - ", " | ", " – ", " — ")
COSIGNALS = (
    "analytics", "insights", "data", "dashboard", "survey", "Python", "SQL", "Tableau", "R programming", "Qualtrics", "Workday", "people data", "HRIS", "Visier",
)
ANALYTIC_SIGNALS = ("analytics", "insights", "data", "survey", "listening")
PLANNING_SIGNALS = ANALYTIC_SIGNALS + ("manager", "director", "lead", "head", "analyst", "optimization", "optimisation", "strategy", "strategic")
PLANNING_VETOES = (
    "nurse", "nursing", "shift schedule", "shift schedules", "staff schedule", "staff scheduling", "staffing ratio", "staffing ratios", "clinical staff",
    "retail staff", "call center", "call centre", "contact center", "contact centre",
)

# ---- Settings ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Gate:
    """A term that only counts beside one of its co-terms."""

    coterms: tuple[str, ...]
    points: int
    #: Characters on either side of the hit in which a co-term counts; None for the whole title.
    window: int | None = 60
    else_points: int = 0
    #: Characters of the description that count; None for all, 0 for none.
    body: int | None = None
    #: Terms anywhere in title or description that shut the gate.
    vetoes: tuple[str, ...] = ()


def published_gates() -> dict[str, Gate]:
    """Gates of the published keyword list."""
    return {
        "continuous listening": Gate(("employee", "workforce"), 50, 60, 25, body=0),
        "xm scientist": Gate(("employee", "EX", "EE"), 25),
        "behavioral scientist": Gate(("HR", "people", "employee", "workforce"), 25),
        "labor economist": Gate(("HR", "people", "employee", "employer", "workforce", "corporate", "company"), 25),
        "partner experience analyst": Gate(("Starbucks", "HR", "people", "partner engagement"), 25),
        "employee engagement": Gate(ANALYTIC_SIGNALS + ("analyst", "director", "head", "vp"), 25),
        "employee experience": Gate(ANALYTIC_SIGNALS, 5, None, body=400),
        "workforce planning": Gate(PLANNING_SIGNALS, 15, None, body=400, vetoes=PLANNING_VETOES),
    }


# Names that sources and classes are shown by.
SOURCE_NAMES = {
    "greenhouse": "Greenhouse", "lever": "Lever", "ashby": "Ashby", "onemodel": "Niche Board", "included_ai": "Niche Board", "siop": "Niche Board",
    "google_alerts": "RSS Alert", "talkwalker": "RSS Alert", "jsearch": "JSearch", "jooble": "Jooble", "adzuna": "Adzuna", "usajobs": "USAJobs",
    "jobspy_linkedin": "LinkedIn", "jobspy_indeed": "Indeed", "jobspy_glassdoor": "Glassdoor", "jobspy_zip_recruiter": "ZipRecruiter",
}
RELEVANCE_NAMES = {"RELEVANT": "Relevant", "PARTIALLY_RELEVANT": "Partial"}
#: Sources whose posting is itself where one applies.
TERMINAL_SOURCES = ("jobspy_linkedin",)


@dataclass(frozen=True)
class Lexicon:
    """Weighted terms by tier; ``load`` reads the published YAML layout."""

    title: dict[str, int] = field(default_factory=dict)
    description: dict[str, int] = field(default_factory=dict)
    capped: frozenset[str] = frozenset()
    negative: tuple[str, ...] = ()
    reducers: dict[str, int] = field(default_factory=dict)
    gates: dict[str, Gate] = field(default_factory=dict)
    cosignals: tuple[str, ...] = ()
    cosignal_terms: frozenset[str] = frozenset()
    boost_companies: frozenset[str] = frozenset()
    #: Reducers that don't count beside one of their co-terms.
    waivers: dict[str, tuple[str, ...]] = field(default_factory=dict)
    include_at: int = 50
    review_at: int = 15
    cap: int = 16
    boost: int = 10
    vendor_cap: int = 14
    most: int = 100

    @classmethod
    def load(cls, keywords: str | Path, companies: str | Path | None = None, **settings) -> Lexicon:
        """From a keyword YAML (tiers, negatives, reducers, thresholds) and a company YAML."""
        import yaml

        k = yaml.safe_load(Path(keywords).read_text(encoding="utf-8"))

        def terms(name: str) -> list[str]:
            found = k.get(name) or []
            return list(found.get("terms") or []) if isinstance(found, dict) else list(found)

        def points(name: str, default: int) -> int:
            found = k.get(name)
            return int(found.get("score", default)) if isinstance(found, dict) else default

        title = {t: points(n, p) for n, p in (("tier3_title", 7), ("tier2_title", 25), ("tier1_title", 50)) for t in terms(n)}
        description = {t: points(n, p) for n, p in (("tier2_description", 10), ("tier1_description", 30)) for t in terms(n)}
        reducers = {}
        for level, default in (("standard", -20), ("medium", -25), ("hard", -40)):
            found = (k.get("negative_score_reducers") or {}).get(level) or []
            spec = found if isinstance(found, dict) else {"terms": found}
            for t in spec.get("terms") or []:
                reducers[t] = int(spec.get("score", default))
        boost: set[str] = set()
        if companies:
            c = yaml.safe_load(Path(companies).read_text(encoding="utf-8"))
            boost = {e["name"].strip().lower() for tier in ("tier1", "tier2") for e in c.get(tier) or [] if e.get("name")}
        settings = {
            "gates": published_gates(), "cosignals": COSIGNALS, "waivers": {"change management consultant": ("listening", "analytics")},
        } | settings
        return cls(
            title=title, description=description, capped=frozenset(terms("tier2_description")) - frozenset(terms("tier1_description")),
            negative=tuple(terms("negative_auto_reject")), reducers=reducers, cosignal_terms=frozenset(terms("tier3_title")),
            boost_companies=frozenset(boost), **settings,
        )


def missing_settings(settings: dict[str, str | None], required: tuple[str, ...]) -> list[str]:
    """The required settings that are absent or blank, in order."""
    return [name for name in required if not (settings.get(name) or "").strip()]


def insecure_settings(settings: dict[str, str | None], addresses: tuple[str, ...]) -> list[str]:
    """Addresses that are set and aren't https."""
    return [name for name in addresses if (v := (settings.get(name) or "").strip()) and not v.lower().startswith("https://")]
