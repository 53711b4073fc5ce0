"""Canonical job type, work location, function, experience and shift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from vacancia.functions.rules import Rule, any_keyword, first_rule, known_rules
from vacancia.functions.text import col, strip

# Job types and the words for them, tried in this order.
JOB_TYPES: tuple[Rule, ...] = (
    ("Full-time", ("full time", "full-time", "fulltime", "full_time")),
    ("Part-time", ("part time", "part-time", "parttime", "part_time")),
    ("Contract", ("contract", "contractor")),
    ("Contract-to-hire", ("contract to hire", "contract-to-hire", "c2h")),
    ("Temporary", ("temporary", "temp")),
    ("Internship", ("intern", "internship")),
    ("As Needed", ("as needed", "prn", "ecb")),
)

# Job-type words of two sources that default to full time.
POSITION_TYPES: tuple[Rule, ...] = (
    ("part_time", ("part-time", "part time")),
    ("contract", ("contract", "contractor", "temporary")),
    ("full_time", ("full-time", "full time")),
)
POSITION_NAMES: tuple[Rule, ...] = (
    ("full time", ("full time", "full-time", "fulltime")),
    ("part time", ("part time", "part-time", "parttime")),
    ("contract", ("contract", "contractor")),
)

# Work locations, tried in this order.
WORK_LOCATIONS: tuple[Rule, ...] = (
    ("On-site", ("on-site", "onsite", "on site", "office", "in-person", "in person", "in office")),
    ("Remote", ("remote", "fully remote", "work from home", "wfh", "work-from-home")),
    ("Hybrid", ("hybrid",)),
)
LOCATION_NAMES: tuple[Rule, ...] = (
    ("remote", ("remote", "work from home", "wfh")),
    ("hybrid", ("hybrid", "flexible")),
    ("onsite", ("onsite", "on-site", "in office", "office")),
)

# Title keywords per function, tried in this order.
FUNCTION_KEYWORDS: tuple[Rule, ...] = (
    ("Information Technology", (
        "software", "developer", "programmer", "data", "database", "system", "network",
        "security", "devops", "cloud", "application", "web", "mobile", "qa", "scrum",
        "agile", "cyber")),
    ("Engineering", ("mechanical", "mechanical engineer", "electrical", "electrical engineer", "controls")),
    ("Manufacturing", ("manufacturing", "production", "assembly", "fabrication")),
    ("Sales", ("sales", "account manager", "business development", "account executive")),
    ("Customer Support", ("customer service", "support", "help desk", "client")),
    ("Operations", ("project manager", "program manager", "operations manager")),
    ("Accounting", ("finance", "financial", "accounting", "accountant", "audit")),
    ("Human Resources", ("hr", "human resources", "recruiter", "talent", "benefits")),
    ("Marketing", ("marketing", "brand", "communications", "social media")),
    ("Legal", ("legal", "attorney", "counsel", "compliance", "contract")),
    ("Quality", ("quality", "qa", "qc", "inspector", "quality engineer")),
    ("Skilled Trades", ("technician", "maintenance", "mechanic", "welder", "operator")),
    ("Administrative", ("admin", "administrative", "coordinator", "assistant")),
    ("Security", ("security", "safety", "guard")),
)

# Title keywords of a hospital, tried in this order.
HOSPITAL_KEYWORDS: tuple[Rule, ...] = (
    ("Healthcare", (
        "nurse", "rn", "lpn", "cna", "doctor", "physician", "surgeon", "therapist",
        "medical assistant", "paramedic", "emt", "practitioner", "specialist",
        "anesthesia", "respiratory", "physical therapy", "occupational therapy",
        "speech therapy", "social worker", "chaplain", "dietitian", "nutritionist",
        "lab", "laboratory", "phlebotomist", "radiology", "imaging", "ultrasound",
        "mri", "ct", "x-ray", "pharmacy", "pharmacist", "technician", "tech",
        "medical records", "coding", "health information", "sterile processing",
        "surgical tech", "operating room", "or tech", "cardiology", "echo")),
    ("Information Technology", (
        "software", "developer", "programmer", "engineer", "data",
        "database", "system", "network", "security", "devops", "cloud",
        "application", "web", "mobile", "qa", "testing", "scrum", "agile", "epic",
        "cerner", "health information systems")),
    ("Administrative", (
        "admin", "administrative", "coordinator", "assistant", "office", "clerk",
        "secretary", "receptionist", "registration", "admissions", "discharge",
        "case manager", "utilization review", "quality", "compliance", "risk")),
    ("Accounting", (
        "finance", "financial", "accounting", "accountant", "treasury", "controller",
        "audit", "billing", "revenue cycle", "patient accounts", "collections")),
    ("Human Resources", (
        "hr", "human resources", "recruiter", "talent", "people", "benefits",
        "payroll", "compensation", "training", "development")),
    ("Operations", (
        "maintenance", "facility", "facilities", "engineering", "hvac", "plumbing",
        "electrical", "biomedical", "environmental services", "housekeeping",
        "custodial", "groundskeeper", "plant operations",
        "transport", "driver", "ambulance", "patient transport", "courier")),
    ("Hospitality", (
        "food", "kitchen", "cook", "chef", "dietary", "nutrition", "cafeteria",
        "food service", "culinary")),
    ("Security", ("security", "safety", "guard", "protection", "emergency management")),
)

# Title and department keywords of a school district, tried in this order.
SCHOOL_KEYWORDS: tuple[Rule, ...] = (
    ("Education", (
        "teacher", "instructor", "educator", "faculty", "classroom",
        "special education", "librarian", "counselor", "speech", "tutor",
        "paraprofessional", "para teacher", "academic partner", "iep facilitator",
        "school psychologist", "teaching and learning", "dean of students",
        "interpreter", "coach", "learning director")),
    ("Administrative", (
        "principal", "superintendent", "director", "coordinator", "supervisor",
        "administrative", "admin", "secretary", "clerk")),
    ("Information Technology", (
        "technology", "computer", "network", "systems", "tech support",
        "audio video", "hris", "client services")),
    ("Operations", ("bus", "driver", "transportation", "fleet")),
    ("Accounting", ("business manager", "finance", "accounting", "bookkeeper", "payroll", "buyer")),
    ("Human Resources", ("human resources", "hr", "recruiter", "talent management", "compensation")),
    ("Security", ("security", "safety", "sro", "resource officer", "guard", "police")),
    ("Skilled Trades", (
        "maintenance", "custodial", "custodian", "janitor", "groundskeeper",
        "facilities", "hvac", "carpentry", "electrician", "plumb", "roofer",
        "painter", "sheet metal", "mechanic", "journeyperson", "craftsperson")),
    ("Hospitality", ("cafeteria", "cook", "child nutrition", "nutrition")),
    ("Healthcare", ("nurse", "health assistant", "occupational therapist")),
    ("Customer Support", ("family support", "family specialist", "parent involvement", "family retention")),
)

# Title, team and department keywords of an equipment maker, tried in this order.
MAKER_KEYWORDS: tuple[Rule, ...] = (
    ("Engineering", (
        "mechanical engineer", "mechanical", "combustion engineer", "burner", "thermal",
        "electrical engineer", "electrical", "controls engineer", "instrumentation", "plc",
        "applications engineer", "application engineer", "design engineer",
        "project engineer", "process engineer", "engineer")),
    ("Information Technology", (
        "software", "developer", "programmer", "data", "database",
        "network", "devops", "cloud", "help desk", "it support", "cyber", "erp")),
    ("Manufacturing", (
        "manufacturing", "production", "assembly", "fabrication", "fabricator",
        "machinist", "welder", "welding", "cnc", "shop")),
    ("Skilled Trades", (
        "technician", "maintenance", "mechanic", "electrician", "field service",
        "commissioning")),
    ("Quality", ("quality", "qa", "qc", "inspector")),
    ("Purchasing", (
        "supply chain", "purchasing", "procurement", "buyer", "planner",
        "materials", "inventory", "logistics", "shipping", "receiving", "warehouse")),
    ("Sales", (
        "sales", "account manager", "business development", "account executive",
        "sales representative")),
    ("Customer Support", ("customer service", "customer support", "client services")),
    ("Operations", ("project manager", "program manager", "project coordinator")),
    ("Accounting", (
        "finance", "financial", "accounting", "accountant", "audit", "payroll",
        "controller", "treasury")),
    ("Human Resources", ("human resources", "hr", "recruiter", "talent", "benefits")),
    ("Marketing", ("marketing", "brand", "communications", "social media")),
    ("Legal", ("legal", "attorney", "counsel", "compliance", "contract")),
    ("Administrative", ("admin", "administrative", "coordinator", "assistant", "clerk", "office")),
    ("Security", ("security", "safety", "ehs", "environmental health")),
)

# The function names that exist.
FUNCTION_NAMES = (
    "Accounting", "Administrative", "Customer Support", "Education", "Engineering",
    "Executive", "Healthcare", "Hospitality", "Human Resources", "Information Technology",
    "Law Enforcement", "Legal", "Manufacturing", "Operations", "Other", "Product",
    "Purchasing", "Quality", "Sales", "Science", "Security", "Skilled Trades",
)

# Category words and the function they stand for, tried in this order.
CATEGORY_WORDS: tuple[tuple[str, str], ...] = (
    ("hvac", "Engineering, Mechanical"),
    ("engineering", "Engineering, Mechanical"),
    ("mechanical", "Engineering, Mechanical"),
    ("information technology", "Information Technology"),
    ("software", "Information Technology"),
    ("finance", "Finance"),
    ("human resources", "Human Resources"),
    ("legal", "Legal"),
    ("operations", "Project Management"),
    ("manufacturing", "Manufacturing"),
    ("quality", "Quality"),
    ("sales", "Sales"),
    ("customer", "Customer Service"),
    ("administrative", "Administration"),
    ("marketing", "Marketing"),
)

# Experience names and their ids.
EXPERIENCE_IDS = {
    "": 7,
    "Student": 1,
    "Entry Level": 2,
    "Associate": 3,
    "Mid Senior": 4,
    "Senior": 5,
    "Director": 6,
}
EXPERIENCE_DEFAULT = 7

# Shift words in descriptions and in shift labels.
SECOND_SHIFT_TERMS = ("second shift", "2nd shift", "evening shift", "afternoon shift")
THIRD_SHIFT_TERMS = ("third shift", "3rd shift", "night shift", "midnight shift", "graveyard shift")
SHIFT_LABELS: tuple[Rule, ...] = (
    (3, ("night", "11p", "midnight")),
    (2, ("evening", "3p", "afternoon")),
    (1, ("day", "7a", "morning")),
)


def job_type(text: Column | str) -> Column:
    return first_rule(F.lower(col(text)), JOB_TYPES)


def work_location(text: Column | str) -> Column:
    return first_rule(F.lower(col(text)), WORK_LOCATIONS)


def position_type(text: Column | str) -> Column:
    return F.coalesce(first_rule(F.lower(col(text)), POSITION_TYPES), F.lit("full_time"))


def by_dimension_name(value: Column, words: Sequence[Rule], dimension: Sequence[tuple[int, str]],
                      default: int, fold: bool = False) -> Column:
    """Id of the first dimension row whose name contains the value, else by word, else default.

    ``fold`` reads ``-`` as a space on both sides of the first test.
    """
    low = F.lower(value)
    probe = F.replace(low, F.lit("-"), F.lit(" ")) if fold else low
    rows = sorted((i, n.lower()) for i, n in dimension)
    tests = [(probe != "") & F.lit(n.replace("-", " ") if fold else n).contains(probe) for _, n in rows]
    picks = [F.when(hit, F.lit(i)) for hit, (i, _) in zip(tests, rows)]
    for key, variants in words:
        target = next((i for i, n in rows if key in n), None)
        if target is not None:
            picks.append(F.when(any_keyword(probe, variants), F.lit(target)))
    return F.coalesce(*picks, F.lit(default))


def function_name(text: Column | str, rules: Sequence[Rule] = FUNCTION_KEYWORDS,
                  names: Sequence[str] = FUNCTION_NAMES) -> Column:
    """First category, in rule order, that the dimension has; else ``Other`` if it exists."""
    fallback = "Other" if "Other" in set(names) else None
    return first_rule(F.lower(col(text)), known_rules(rules, names), fallback)


def joined_text(*parts: Column | str) -> Column:
    """Text over which a rule set looks: absent parts are empty."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(col(p), F.lit("")) for p in parts]))


def category_function(category: Column | str, words: Sequence[tuple[str, str]] = CATEGORY_WORDS,
                      names: Sequence[str] = FUNCTION_NAMES) -> Column:
    """Exact dimension name, else the first word whose function exists, else NULL."""
    category = F.nullif(col(category), F.lit(""))
    exact = F.when(category.isin(*names), category)
    rules = known_rules([(name, (word,)) for word, name in words], names)
    return F.coalesce(exact, first_rule(F.lower(category), rules))


def function_with_precedence(category: Column | str, title: Column | str, names: Sequence[str] = FUNCTION_NAMES,
                             rules: Sequence[Rule] = FUNCTION_KEYWORDS) -> Column:
    """A category label wins over keywords in the title."""
    return F.coalesce(category_function(category, names=names), function_name(title, rules, names))


def experience_id(name: Column | str) -> Column:
    pairs = [F.lit(x) for kv in EXPERIENCE_IDS.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(name)), F.lit(EXPERIENCE_DEFAULT))


def _shifts(number: Column) -> Column:
    return F.struct(
        (number == 1).alias("first_shift"),
        (number == 2).alias("second_shift"),
        (number == 3).alias("third_shift"),
    )


def shifts_from_text(text: Column | str) -> Column:
    """Second shift if mentioned, else third, else first; exactly one flag is true."""
    low = F.lower(F.coalesce(col(text), F.lit("")))
    number = F.when(any_keyword(low, SECOND_SHIFT_TERMS), 2).when(
        any_keyword(low, THIRD_SHIFT_TERMS), 3).otherwise(1)
    return _shifts(number)


def shifts_from_label(label: Column | str) -> Column:
    low = strip(F.lower(F.coalesce(col(label), F.lit(""))))
    return _shifts(F.coalesce(first_rule(low, SHIFT_LABELS), F.lit(1)))


def chosen_work_location(location_text: Column | str, page_value: Column | str,
                         default: str = "On-site") -> Column:
    """A remote location text overrides the page value, which overrides the default."""
    remote = F.when(F.lower(col(location_text)).contains("remote"), F.lit("Remote"))
    return F.coalesce(remote, work_location(page_value), F.lit(default))
