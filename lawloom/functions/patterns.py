"""Patterns (fixed values) in the common subset of Java's and RE2's syntax, unless marked.

`(?U)` (white space as in Unicode) and `(?d)` (only \\n ends a line) are added where a column
expression is built, so that the same text serves the SQL forms.
"""

from __future__ import annotations

FILENAME = r"^(\d+)-(LD|SP|HP|HO)-(\d+)(?:-([A-Z]{2}_[A-Z](?:[-_][A-Z]{2}_[A-Z])?_[HS]\d+))?$"
CHAMBER = r"([HS])\d+"

ORDINAL_LINE = r"^\d+(?:st|nd|rd|th)\s+(?:MAINE\s+)?LEGISLATURE"  # case-insensitive
LINE_NUMBER = r"^\s*\d{1,3}\s*$"
NUMBER_PREFIX = r"^\s*\d{1,3}\s+"
MARGIN_NUMBER = r"^\d{1,3}\s+"
# case-insensitive, on stripped lines
HEADER = (
    r"^Page\s+\d+|^STATE OF MAINE|^MAINE LEGISLATURE|^HOUSE OF REPRESENTATIVES\s*$"
    r"|^\d+(?:ST|ND|RD|TH)\s+(?:MAINE\s+)?LEGISLATURE\s*$|^(?:FIRST|SECOND|THIRD)\s+(?:REGULAR|SPECIAL)\s+SESSION"
)
HEADER_ID = r"^\d{2,3}-LD-\d{4}$"

BILL_ID = r"\d{2,3}-LD-\d{3,4}"
SESSION_ID = r"(\d{2,3})-LD-\d{4}"
SESSION_ORDINAL = r"(\d{2,3})(?:st|nd|rd|th)\s+(?:MAINE\s+)?LEGISLATURE"
SESSION_STATE = r"(\d{2,3})(?:st|nd|rd|th)\s+(?:Maine|MAINE)"
DOCUMENT_NUMBER = r"(?:Legislative\s+Document|Document)\s+No\.?\s+(\d{3,4})"
BARE_NUMBER = r"No\.?\s+(\d{3,4})"

MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
DATE = rf"({MONTHS})\s+(\d{{1,2}}),?\s+(\d{{4}})"
DATE_IN_HOUSE = rf"(?:House|Senate) of Representatives,\s+{DATE}"
DATE_IN_SENATE = rf"In\s+(?:Senate|House),\s+{DATE}"

_NAME = r"([A-Za-z\s&,]+?)"
COMMITTEE_ACTION = rf"Reference to the Committee on\s+{_NAME}\s+(?:suggested|ordered|referred|assigned|printed)"
COMMITTEE_STOP = rf"Reference to the Committee on\s+{_NAME}(?:\.|$)"
COMMITTEE_TAIL = r"\s+(?:suggested|ordered|referred|assigned).*$"  # case-insensitive
COMMITTEE_OTHER = rf"(?:Committee on|Referred to|Assigned to)\s+{_NAME}(?:\s+(?:suggested|ordered|referred|assigned)|\.|\s+printed|$)"

PERSON = r"([A-Z][A-Za-z'\-]+(?:\s+[A-Z][A-Za-z'\-]+)?)"
OFFICE = r"(?:Senator|Representative|President|Speaker)\s+"
PRESENTED = rf"(?:Presented|Introduced) by\s+{OFFICE}{PERSON}"
PRESENTED_OF = rf"{PRESENTED}\s+of\s+[A-Za-z\s]+"
PRESENTED_ALONE = rf"{PRESENTED}(?:\s+(?:Cosponsored|Be it|of|and|,)|$)"
COSPONSORS = r"Cosponsored by\s+(.+?)(?:Be it enacted|Presented by|Introduced by|$)"
COSPONSOR_OF = rf"{OFFICE}{PERSON}\s+of\s+[A-Za-z\s]+(?:\s+and)?"
COSPONSOR_ALONE = rf"{OFFICE}{PERSON}\b(?:\s+(?:and|of)|,|$)"
LOOSE_HYPHEN = r"([A-Z])\s*-\s*([A-Z])"
# Words that no sponsor's name has.
NOT_NAMES = (
    "President", "Speaker", "Secretary", "Clerk", "Chief", "Governor", "Mayor", "Attorney", "General", "Commissioner", "Treasurer",
    "State", "States", "Department", "Senate", "House", "Bureau", "Office", "Committee", "Government", "Council", "Commission", "Administration",
    "Session", "Regular", "Special", "Legislature", "Legislative", "Constitution", "People", "Law", "Code", "Rules",
    "The", "Maine", "Number", "Town", "Houses", "Hall", "Chamber", "County", "District", "Districts",
)

TITLE_REF = r"Title\s+(\d+(?:-[A-Z])?),\s*(?:Section|§)\s+(\d+)"
MRSA_REF = r"(\d+(?:-[A-Z])?)\s+MRSA\s+§(\d+(?:-[A-Z])?)"

STRAY_NUMBERS = r"(?m)^\s*\d+\s*$"
PAGE_HEADERS = r"STATE OF MAINE|MAINE LEGISLATURE|MAINE STATE LEGISLATURE"
PAGE_NUMBERS = r"Page \d+"
DISCLAIMERS = r"Reproduced from|LAW AND LEGISLATIVE"

INITIATIVE = r"I\.B\.\s+\d+|Initiated Bill"  # case-insensitive
