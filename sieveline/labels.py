"""The closed vocabulary: elements, their groups, sensitivity levels and the word lists of the name filter."""

from __future__ import annotations

# Levels, from the least to the most sensitive; a level's rank is its place.
LEVELS = ("Public", "Private", "Confidential", "Highly Confidential")

# Element labels by the group that rules ask for.
NAME = ("person",)
COMBINATION = ("phone number", "email address", "date of birth", "address", "birthplace", "mother's maiden name")
PRIVATE_ALONE = ("phone number", "email address", "address", "birthplace", "mother's maiden name", "bank account number")
CONFIDENTIAL_ALONE = ("credit card number", "tax file number", "medicare number", "passport number", "driver's licence number", "biometric data", "digital signature")
SENSITIVE = ("medical condition", "health condition", "illness")
ALL_LABELS = tuple(sorted({*NAME, *COMBINATION, *PRIVATE_ALONE, *CONFIDENTIAL_ALONE, *SENSITIVE}))

# Extraction passes as (labels, threshold); None takes the caller's threshold.
BASE_PASSES = ((ALL_LABELS, None), (tuple(sorted(SENSITIVE)), None))
HYBRID_PASSES = (
    (("person", "phone number", "date of birth", "address", "birthplace", "mother's maiden name", "passport number", "driver's licence number"), None),
    (SENSITIVE, 0.6),
)
DEFAULT_THRESHOLD = 0.7
# Extracted, but left out of the hybrid side's findings; and levels that people always review.
SUPPRESSED = ("birthplace", "mother's maiden name")
REVIEW_LEVELS = ("Highly Confidential",)

# Words that are no person's name.
STOPWORDS = tuple(
    "i me my mine myself you your yours yourself he him his she her hers we us our ours they them their theirs it its this that "
    "someone anyone everyone customer client applicant patient team staff manager office everybody nobody".split()
)
NOT_NAMES = (
    *"student students child children parent parents family spouse partner guardian minor adult adults baby kid kids boy girl".split(),
    *"male female man woman men women person people individual".split(),
    "trans male", "trans female", "transgender", "transgender person", "nonbinary", "non-binary",
    *"employee employer member members user users senior teacher teachers facilitator investor supervisor coordinator director".split(),
)
ROLES = tuple(
    "coordinator supervisor manager director officer analyst engineer specialist administrator assistant executive consultant "
    "technician operator representative agent advisor clerk intern trainee program group department teacher student facilitator "
    "investor developer designer planner auditor lead head chief associate".split()
)

# Street words of an address.
STREET_WORDS = tuple(
    "st street rd road ave avenue ln lane dr drive ct court blvd boulevard way pl place terrace tce hwy highway crescent cres "
    "close parade pde square sq".split()
)

# Reasons, in the order in which they are given.
REASON_COMBINATION = "name + combination element -> Confidential"
REASON_CONFIDENTIAL = "confidential element in isolation (e.g. card/gov-id) -> Confidential"
REASON_SENSITIVE = "sensitive (health) information present"
REASON_TOP = "sensitive info + Confidential-level PII (name+combination or card/gov-id) -> Highly Confidential"
REASON_PRIVATE = "personal element in isolation -> Private"
REASON_NONE = "no personal information detected -> Public"
