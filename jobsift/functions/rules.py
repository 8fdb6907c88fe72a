"""Screening rules as data.

Fixed values: these lists must equal the screening query this engine
reproduces, in the same order, for the results to match.
"""

# --- Fixed values: blocked companies, as the screening query spells them (36 names). ---
BLOCKED_COMPANIES_INTENDED = [
    "Gainwell Technologies",
    "HireMeFast LLC",
    "Phoenix Recruitment",
    "Team Remotely Inc",
    "Patterned Learning Career",
    "RemoteWorker US",
    "RemoteWorker UK",
    "TransPerfect",
    "DolphinsElite",
    "Canonical",
    "SynergisticIT",
    "DataAnnotation",
    "Talentify.io",
    "Recruiter.com",
    "Providence Health & Services",
    "Get It Recruit - Educational Services",
    "FedEx Dataworks",
    "Actalent",
    "Get It Recruit - Information Technology",
    "SimplyApply",
    "Opinion Focus Panel",
    "AB Media Publishing, LLC",
    "Herr Alexander Wunsch",
    "Ralf U. Nicole Thumm",
    "Boeing Intelligence & Analytics",
    "Opinion Focus Panel LLC",
    "Webpratodos Marketing Digital",
    "Diverserec",
    "FONDS DE DOTATION FUTUR AU PRESENT",
    "IDR, Inc.",
    "TalentBurst, Inc.",
    "Dexian Inc",
    "ManTech",
    "ARCTOS LLC",
    "Northrop Grumman",
    "HII",
]

# --- Fixed values: the list as SQL actually evaluates it (35 values). ---
# A comma is missing after 'Boeing Intelligence & Analytics', and SQL joins two
# adjacent string literals into one, so the two names form a single value and
# neither company is blocked.
BLOCKED_COMPANIES = [
    "Gainwell Technologies",
    "HireMeFast LLC",
    "Phoenix Recruitment",
    "Team Remotely Inc",
    "Patterned Learning Career",
    "RemoteWorker US",
    "RemoteWorker UK",
    "TransPerfect",
    "DolphinsElite",
    "Canonical",
    "SynergisticIT",
    "DataAnnotation",
    "Talentify.io",
    "Recruiter.com",
    "Providence Health & Services",
    "Get It Recruit - Educational Services",
    "FedEx Dataworks",
    "Actalent",
    "Get It Recruit - Information Technology",
    "SimplyApply",
    "Opinion Focus Panel",
    "AB Media Publishing, LLC",
    "Herr Alexander Wunsch",
    "Ralf U. Nicole Thumm",
    "Boeing Intelligence & AnalyticsOpinion Focus Panel LLC",
    "Webpratodos Marketing Digital",
    "Diverserec",
    "FONDS DE DOTATION FUTUR AU PRESENT",
    "IDR, Inc.",
    "TalentBurst, Inc.",
    "Dexian Inc",
    "ManTech",
    "ARCTOS LLC",
    "Northrop Grumman",
    "HII",
]

# --- Fixed values: case-insensitive substrings that exclude a title (ILIKE '%p%'). ---
# Listed in the order of the screening query, the repeated 'tableau' included.
TITLE_EXCLUDED_SUBSTRINGS = [
    "senior",
    "sr",
    "sr.",
    "principal",
    "lead",
    "vice president",
    "staff",
    "tableau",
    "architect",
    "manager",
    "director",
    "supervisor",
    "scrum",
    "front end",
    "front-end",
    "frontend",
    "web",
    "php",
    "desktop",
    "android",
    "ios",
    "mobile",
    "salesforce",
    "power bi",
    "peoplesoft",
    "mulesoft",
    "servicenow",
    "ab initio",
    "wordpress",
    "machine learning",
    "mainframe",
    "tableau",
    "sharepoint",
    "data",
    "analyst",
    "system",
    "solution",
    "devops",
    "cloud",
    "aws",
    "reliability",
    "security",
    "firmware",
    "embedded",
    "as400",
    "technician",
    "tech",
    "supplier",
    "inspector",
    "specialist",
    "support",
    "coordinator",
]

# --- Fixed values: whole words (case-insensitive) that exclude a title. ---
TITLE_EXCLUDED_WORDS = ["ml", "ai", "rpa"]

# --- Fixed values: a kept listing's location contains one of these (case-insensitive). ---
LOCATION_INCLUDED_SUBSTRINGS = ["columbus", "remote"]

# --- Fixed values: the optional junior-only search (case-insensitive substrings). ---
JUNIOR_TITLE_SUBSTRINGS = ["junior", "jr", "jr."]

# --- Fixed values: role names left out of the role-membership report. ---
EXCLUDED_ROLE_NAMES = [
    "pg_signal_backend",
    "rds_iam",
    "rds_replication",
    "rds_superuser",
    "rdsadmin",
    "rdsrepladmin",
    "pg_checkpoint",
    "pg_create_subscription",
    "pg_database_owner",
    "pg_execute_server_program",
    "pg_monitor",
    "pg_read_all_data",
    "pg_read_all_settings",
    "pg_read_all_stats",
    "pg_read_server_files",
    "pg_stat_scan_tables",
    "pg_use_reserved_connections",
    "pg_write_all_data",
    "pg_write_server_files",
    "rds_ad",
    "rds_password",
    "rdstopmgr",
]

# --- Fixed values: per-site link bases and markers. ---
LINKEDIN_VIEW_BASE = "https://www.linkedin.com/jobs/view/"
INDEED_VIEW_BASE = "https://www.indeed.com/viewjob?jk="
ANNUAL_PAY_MARKER = "Annually"
REMOTE_SEARCH_LOCATION = "Remote"
BUILTIN_REMOTE_QUERY_LOCATION = "United States"


# --- Fixed values: the search terms per site, in the order each site runs them. ---
# (site, keyword, search location); Dice is listed although no schedule runs it.
SEARCH_TERMS = [
    ("LinkedIn", "Junior Developer", "Remote"),
    ("LinkedIn", "Junior Developer", "Columbus, Ohio Metropolitan Area"),
    ("LinkedIn", "Developer", "Remote"),
    ("LinkedIn", "Developer", "Columbus, Ohio Metropolitan Area"),
    ("LinkedIn", "Software Engineer", "Remote"),
    ("LinkedIn", "Software Engineer", "Columbus, Ohio Metropolitan Area"),
    ("LinkedIn", "QA", "Remote"),
    ("LinkedIn", "QA", "Columbus, Ohio Metropolitan Area"),
    ("Indeed", "Junior Developer", "Remote"),
    ("Indeed", "Junior Developer", "Columbus, OH"),
    ("Indeed", "Developer", "Remote"),
    ("Indeed", "Developer", "Columbus, OH"),
    ("Indeed", "Software Engineer", "Remote"),
    ("Indeed", "Software Engineer", "Columbus, OH"),
    ("Indeed", "QA", "Remote"),
    ("Indeed", "QA", "Columbus, OH"),
    ("BuiltIn", "Developer", "Remote"),
    ("BuiltIn", "Developer", "Columbus, OH, USA"),
    ("BuiltIn", "Software Engineer", "Remote"),
    ("BuiltIn", "Software Engineer", "Columbus, OH, USA"),
    ("BuiltIn", "QA", "Remote"),
    ("BuiltIn", "QA", "Columbus, OH, USA"),
    ("Dice", "Junior Developer", "Remote"),
    ("Dice", "Junior Developer", "Columbus, OH, USA"),
    ("Dice", "Developer", "Remote"),
    ("Dice", "Developer", "Columbus, OH, USA"),
    ("Dice", "Software Engineer", "Remote"),
    ("Dice", "Software Engineer", "Columbus, OH, USA"),
    ("Dice", "QA", "Remote"),
    ("Dice", "QA", "Columbus, OH, USA"),
]
