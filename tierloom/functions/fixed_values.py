"""Fixed values the cleansing rules depend on.

Everything here is data: label vocabularies, the spellings that stand for each label, id prefixes,
sentinels and thresholds. A label maps to the spellings that mean it, compared after folding to
trimmed upper case.
"""

# --- Fixed values: code letters -> label -------------------------------------------------------
MARITAL_STATUS = {"Single": ("S",), "Married": ("M",)}
CRM_GENDER = {"Female": ("F",), "Male": ("M",)}
ERP_GENDER = {"Female": ("F", "FEMALE"), "Male": ("M", "MALE")}
PRODUCT_LINE = {"Mountain": ("M",), "Road": ("R",), "Other Sales": ("S",), "Touring": ("T",)}

# --- Fixed values: spellings -> canonical label ------------------------------------------------
CAMPAIGN_CHANNEL = {
    "Email": ("EMAIL", "E-MAIL", "E_MAIL"),
    "Social Media": ("SOCIAL MEDIA", "SOCIAL_MEDIA", "SOCIALMEDIA"),
    "SMS": ("SMS", "TEXT"),
    "Direct Mail": ("DIRECT MAIL", "DIRECT_MAIL", "DM", "DIRECTMAIL"),
    "Online": ("ONLINE", "WEB"),
    "TV": ("TV", "TELEVISION", "TV AD"),
    "Radio": ("RADIO", "RADIO AD"),
    "Events": ("EVENTS", "EVENT", "IN-PERSON", "IN PERSON"),
}
ISSUE_CATEGORY = {
    "Billing": ("BILLING",),
    "Technical": ("TECHNICAL",),
    "Shipping": ("SHIPPING",),
    "Returns": ("RETURNS",),
    "Product": ("PRODUCT",),
    "Account": ("ACCOUNT",),
    "General": ("GENERAL",),
}
TICKET_STATUS = {
    "Open": ("OPEN", "OPENED", "O"),
    "Closed": ("CLOSED", "CLOSE", "CLSD"),
    "Resolved": ("RESOLVED", "RESOLVE", "RSOLVD"),
    "Pending": ("PENDING", "PEND", "IN PROGRESS", "IN_PROGRESS"),
}
CUSTOMER_COUNTRY = {"Germany": ("DE",), "United States": ("US", "USA", "UNITED STATES")}
JOB_ROLE = {
    "Manager": ("MANAGER", "MGR", "MG"),
    "Sales Representative": ("SALES REPRESENTATIVE", "SALES REP", "SLS_REP", "SR"),
    "Analyst": ("ANALYST", "ANLST", "ANALST"),
    "Engineer": ("ENGINEER", "ENG", "ENGR"),
    "Support Agent": ("SUPPORT AGENT", "SUP AGENT", "SUPP_AGT"),
    "Team Lead": ("TEAM LEAD", "TL", "T.LEAD", "TEAM_LEAD"),
    "Director": ("DIRECTOR", "DIR", "DIR."),
    "Coordinator": ("COORDINATOR", "COORD", "CO-ORD"),
    "Specialist": ("SPECIALIST", "SPEC", "SPCL"),
    "Consultant": ("CONSULTANT", "CNSLT", "CONSULT"),
}
VENDOR_COUNTRY = {
    "United States": ("USA", "US", "UNITED STATES", "U.S.A", "U.S."),
    "United Kingdom": ("UK", "UNITED KINGDOM", "GBR", "U.K.", "ENGLAND", "GB"),
    "Germany": ("GERMANY", "DE", "GER", "DEUTSCHLAND", "DEU"),
    "France": ("FRANCE", "FR", "FRA"),
    "Canada": ("CANADA", "CAN", "CA"),
    "Australia": ("AUSTRALIA", "AUS", "AU"),
    "Japan": ("JAPAN", "JPN", "JP"),
    "India": ("INDIA", "IND", "IN"),
    "Spain": ("SPAIN", "ESP", "SP"),
    "Italy": ("ITALY", "ITA", "IT"),
}

# --- Fixed values: label groups and bands ------------------------------------------------------
VENDOR_REGION = {
    "North America": ("United States", "Canada"),
    "Europe": ("United Kingdom", "Germany", "France", "Italy", "Spain"),
    "Asia-Pacific": ("Japan", "India", "Australia"),
}
SENIORITY_CUTS = (2, 5, 10)
SENIORITY_LABELS = ("Junior", "Mid-Level", "Senior", "Veteran")

# --- Fixed values: defaults, prefixes, sentinels, bounds ---------------------------------------
NOT_AVAILABLE = "n/a"
MISSING_NAME = "N/A"
UNKNOWN = "Unknown"
UNKNOWN_VENDOR = "Unknown Vendor"
OTHER = "Other"
TICKET_PRODUCT_PREFIX = "PRD-"
CUSTOMER_ID_PREFIX = "NAS"
UNKNOWN_CUSTOMER_ID = 999999
LAST_EMPLOYEE_NUMBER = 300
EMPLOYEE_NUMBER_START = 4
OVERDUE_AFTER_DAYS = 30
MONEY_PLACEHOLDERS = ("N/A", "NA", "N.A.")
