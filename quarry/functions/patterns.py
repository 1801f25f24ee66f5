"""Fixed pattern tables for classification and sensitive-data scans.

Only constructs that Java regex and RE2 read the same way are used, so a
Spark scan and an SQL engine built on RE2 count the same matches.
"""

# Sensitive-data patterns (name -> regex).
SENSITIVE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "ipv4": r"\b([0-9]{1,3}\.){3}[0-9]{1,3}\b",
    "phone": r"\(?[0-9]{3}\)?[ -][0-9]{3}-[0-9]{4}",
    "card16": r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b",
}

# Column-name rules (tag, case-insensitive regex on the column name).
NAME_RULES = [
    ("Identifier", r"(?i)(key|_id)$|^id$"),
    ("Financial", r"(?i)(price|acctbal|discount|tax|amount|value)"),
    ("Temporal", r"(?i)(date|time)|^ts$"),
    ("FreeText", r"(?i)^(text|html|comment)$"),
    ("PII:name", r"(?i)^(c_name|contact_name|first_name|last_name)$"),
    ("Web", r"(?i)(url|html)"),
]

# Content tags are "PII:<pattern name>".
CONTENT_TAG_PREFIX = "PII:"
