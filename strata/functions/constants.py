"""Fixed values that must equal the studied application's for equal results.

Everything here is a constant lookup used as a map literal (its size is set by
this file, never by the data).
"""

# --- Fixed values: grade-level synonyms (X1) ------------------------------- #
GRADE_K = ("KINDERGARTEN", "KK", "K")
GRADE_PK = ("PK", "PRE-K", "PREK")
GRADE_HS = ("HS", "HIGH SCHOOL")

# --- Fixed values: withdrawal reason -> group (X2) ------------------------- #
WITHDRAWAL_GROUPS = {
    "Year End": "Graduated/Completed",
    "High School Graduation": "Graduated/Completed",
    "Advanced to another school in district": "Graduated/Completed",
    "SB10 Public Schools Transfer": "Transfer",
    "SB10 Private Schools Tranfer": "Transfer",
    "SB10 State Schools Transfer": "Transfer",
    "School Choice Transfer": "Transfer",
    "USCO": "Transfer",
    "Transfer to Another Public GA School": "Transfer",
    "Transferred Out of State": "Transfer",
    "Transferred Out of Country": "Transfer",
    "Transferred to Private School": "Transfer",
    "Transferred to a Dept of Defense School": "Transfer",
    "Transferred Under the Jurisdiction of DJJ": "Transfer",
    "Transferred to another school in district": "Transfer",
    "Department of Defense": "Transfer",
    "Court Order or Legal Requirement": "Legal/Disciplinary",
    "Expelled": "Legal/Disciplinary",
    "Incarcerated": "Legal/Disciplinary",
    "Removed for Lack of Attendance": "Legal/Disciplinary",
    "Marriage": "Personal/Family",
    "Pregnant/Parent": "Personal/Family",
    "Financial Hardship/Job-Related": "Personal/Family",
    "Low Grades/School Failure": "Personal/Family",
    "Serious Illness/Accident": "Personal/Family",
    "Displaced Due to Natural Disaster": "Personal/Family",
    "Adult Education/Post Secondary": "Alternative Education",
    "Attend Home School": "Alternative Education",
    "Withdrew to TCSG Dual Achieve Program": "Alternative Education",
    "No Longer Participating in Dexter Mosely": "Alternative Education",
    "Youth Challenge": "Alternative Education",
    "Summer Semester": "Alternative Education",
    "Unknown": "Other",
    "Military": "Other",
    "Death": "Other",
    "Under the Age of Compulsory School Attendance": "Other",
}

# --- Fixed values: enrolment reason -> group (X2) -------------------------- #
ENROLLMENT_GROUPS = {
    "Never attended school before": "New Enrollment",
    "Admitted from home school": "New Enrollment",
    "Re-entered after withdrawal, this school this year": "Re-entry",
    "Re-entered - Other": "Re-entry",
    "Re-entered after illness": "Re-entry",
    "Re-entered after incarceration": "Re-entry",
    "Entered from a Department of Defense School": "Transfer",
    "Entered From Another State or U.S. Territory": "Transfer",
    "Entered From Another Country": "Transfer",
    "Transferred from another state or country": "Transfer",
    "Transferred from another GA district": "Transfer",
    "Transferred from private school": "Transfer",
    "Transfered/promoted within the same school system": "Transfer",
    "Admitted under SB10": "School Choice",
    "Admitted under School Choice": "School Choice",
    "Admitted under USCO": "School Choice",
    "Continuing in same school": "Continuing",
}

# --- Fixed values: state code -> state name (X3) --------------------------- #
STATE_NAMES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California",
    "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "FL": "Florida", "GA": "Georgia",
    "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa",
    "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri",
    "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey",
    "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio",
    "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont",
    "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
    "DC": "District of Columbia", "PR": "Puerto Rico", "VI": "Virgin Islands", "AS": "American Samoa",
    "GU": "Guam", "MP": "Northern Mariana Islands",
}

# --- Fixed values: state name -> census region (X4), default "Other" ------- #
CENSUS_REGIONS = {
    "California": "Pacific",
    "Oregon": "Pacific",
    "Washington": "Pacific",
    "Alaska": "Pacific",
    "Hawaii": "Pacific",
    "Arizona": "Mountain",
    "Colorado": "Mountain",
    "Idaho": "Mountain",
    "Montana": "Mountain",
    "Nevada": "Mountain",
    "New Mexico": "Mountain",
    "Utah": "Mountain",
    "Wyoming": "Mountain",
    "Iowa": "West North Central",
    "Kansas": "West North Central",
    "Minnesota": "West North Central",
    "Missouri": "West North Central",
    "Nebraska": "West North Central",
    "North Dakota": "West North Central",
    "South Dakota": "West North Central",
    "Arkansas": "West South Central",
    "Louisiana": "West South Central",
    "Oklahoma": "West South Central",
    "Texas": "West South Central",
    "Illinois": "East North Central",
    "Indiana": "East North Central",
    "Michigan": "East North Central",
    "Ohio": "East North Central",
    "Wisconsin": "East North Central",
    "Alabama": "East South Central",
    "Kentucky": "East South Central",
    "Mississippi": "East South Central",
    "Tennessee": "East South Central",
    "Delaware": "South Atlantic",
    "Florida": "South Atlantic",
    "Georgia": "South Atlantic",
    "Maryland": "South Atlantic",
    "North Carolina": "South Atlantic",
    "South Carolina": "South Atlantic",
    "Virginia": "South Atlantic",
    "West Virginia": "South Atlantic",
    "Washington DC": "South Atlantic",
    "New Jersey": "Mid-Atlantic",
    "New York": "Mid-Atlantic",
    "Pennsylvania": "Mid-Atlantic",
    "Connecticut": "New England",
    "Maine": "New England",
    "Massachusetts": "New England",
    "New Hampshire": "New England",
    "Rhode Island": "New England",
    "Vermont": "New England",
}

# --- Fixed values: sport key -> accepted names (N11) ----------------------- #
SPORT_VARIATIONS = {
    "basketball": ["Basketball"],
    "volleyball": ["Volleyball"],
    "soccer": ["Soccer"],
    "softball": ["Softball"],
    "cross_country": ["Cross-country Running", "Cross Country"],
    "baseball": ["Baseball"],
    "golf": ["Golf"],
    "tennis": ["Tennis"],
    "track": ["Track And Field", "Track and Field"],
    "football": ["Football"],
    "indoor_track": ["Indoor Track"],
    "lacrosse": ["Lacrosse"],
    "cheerleading": ["Cheerleading"],
    "ultimate_frisbee": ["Ultimate Frisbee"],
    "swimming": ["Swimming And Diving", "Swimming"],
    "table_tennis": ["Table Tennis"],
    "rugby": ["Rugby"],
    "bowling": ["Bowling"],
    "ice_hockey": ["Ice Hockey"],
    "badminton": ["Badminton"],
}

# --- Fixed values: subject keywords (rule 17, substring tests) ------------- #
ILLUMINATE_MATH = ("mathematics", "math")
ILLUMINATE_ELA = ("english language arts", "ela", "english", "language arts")
MILESTONE_MATH = ("algebra", "mathematics")
MILESTONE_ELA = ("english language arts", "american literature", "composition")

# --- Fixed values: malformed list-item patterns (N8) ----------------------- #
MALFORMED_PATTERNS = ("test_scores_accepted:[{", ":[{", ":]}", '":[{', '":]}')

# --- Fixed values: RIT quintile labels (C85-C89), after lower + quote strip - #
QUINTILE_HIGH = ("high",)
QUINTILE_HIAVG = ("hiavg", "highavg")
QUINTILE_AVG = ("avg",)
QUINTILE_LOWAVG = ("loavg", "lowavg")
QUINTILE_LOW = ("low",)

# --- Fixed values: Illuminate mastery conditions (C14-C16) ----------------- #
COND_EXTENSION = "Extension"
COND_RETEACH = "Reteach"
COND_REVIEW = "Review & Practice"

# --- Fixed values: expected share within k sigma for normal errors (Q8) --- #
SIGMA_LEVELS = (0.5, 1.0, 1.5, 2.0, 2.5, 3.0)

# --- Fixed values: sigma level -> (lower, upper) percentile of a normal law (Q8)
SIGMA_PERCENTILES = {
    0.5: (30.85, 69.15),
    1.0: (15.87, 84.13),
    1.5: (6.68, 93.32),
    2.0: (2.28, 97.72),
    2.5: (0.62, 99.38),
    3.0: (0.13, 99.87),
}
