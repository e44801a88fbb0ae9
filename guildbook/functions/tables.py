"""Fixed values that the rules use: word lists, look-up tables, patterns. Data only."""

# State names and codes.
STATE_CODES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE",
    "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS", "kentucky": "KY",
    "louisiana": "LA", "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI", "minnesota": "MN", "mississippi": "MS", "missouri": "MO",
    "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM", "new york": "NY",
    "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI",
    "south carolina": "SC", "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA",
    "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
}
# Legal suffixes, one alternation after the other, each cut once at the end of a name.
SUFFIXES = [r"\b(inc\.?|incorporated|corp\.?|corporation|llc|l\.l\.c\.?)$", r"\b(ltd\.?|limited|co\.?|company|plc)$", r"\b(gmbh|ag|sa|nv|bv)$"]
DEEP_SUFFIXES = [
    r"\b(inc\.?|incorporated)$", r"\b(corp\.?|corporation)$", r"\b(llc|l\.l\.c\.?)$", r"\b(ltd\.?|limited)$", r"\b(co\.?|company)$", r"\b(plc)$",
    r"\b(gmbh|ag|sa|nv|bv)$", r"\b(lp|l\.p\.)$", r"\b(llp|l\.l\.p\.)$",
]
# Abbreviations in names.
ABBREVIATIONS = {
    "mfg": "manufacturing", "intl": "international", "corp": "corporation", "ind": "industries", "mach": "machine", "eng": "engineering",
    "tech": "technology", "svcs": "services", "sys": "systems", "assoc": "associates",
}
# Fields that the quality score counts, and how far sources are trusted.
REQUIRED_FIELDS = ["company_name", "website", "city", "state"]
VALUABLE_FIELDS = ["employee_count_min", "revenue_min_usd", "erp_system", "contacts", "year_founded", "naics_code", "industry", "phone", "email"]
SOURCE_SCORES = {"clearbit": 95, "zoominfo": 90, "apollo": 85, "builtwith": 80, "website": 70, "job_postings": 65, "association": 60, "unknown": 50}
# Competitors in order, each with the texts that name it.
COMPETITORS = {
    "epicor": ["epicor", "epicor erp", "epicor prophet 21", "epicor kinetic"],
    "odoo": ["odoo", "odoo erp", "odoo manufacturing"],
    "infor": ["infor", "infor cloudsuite", "infor syteline", "infor m3", "infor ln"],
    "iqms": ["iqms", "iqms erp", "delmiaworks"],
    "jobboss": ["jobboss", "job boss", "jobboss erp"],
    "syspro": ["syspro", "syspro erp"],
    "acumatica": ["acumatica", "acumatica erp", "acumatica cloud erp"],
    "microsoft dynamics": ["dynamics 365", "microsoft dynamics", "d365", "navision"],
    "aptean": ["aptean", "aptean industrial", "aptean erp"],
    "fulcrum": ["fulcrum", "fulcrum erp"],
    "sap": ["sap", "sap erp", "sap business one", "sap s/4hana", "sap b1"],
    "oracle": ["oracle", "oracle erp", "jd edwards", "jde"],
    "netsuite": ["netsuite", "oracle netsuite"],
    "plex": ["plex", "plex systems", "plex manufacturing cloud"],
    "sage": ["sage", "sage 100", "sage 300", "sage x3", "sage intacct"],
    "qad": ["qad", "qad erp"],
}
# States by manufacturing output, associations of high priority.
HIGH_STATES = ["TX", "OH", "MI", "IN", "IL", "PA", "WI", "CA", "NC", "TN"]
MED_STATES = ["AL", "SC", "GA", "MN", "MO", "IA", "KY", "MS", "NY", "VA", "CT", "OR", "WA", "NJ"]
HIGH_ASSOCIATIONS = ["PMA", "NEMA", "AGMA", "AIA", "SOCMA"]
MARKETING = ["hubspot", "marketo", "mailchimp", "pardot", "activecampaign", "constant contact"]
# What a page's path says about its kind, in order.
PATH_KINDS = {
    "MEMBER_DIRECTORY": r"/members?/?$|/directory/?$|/member-directory|/member-list|/find-a-member|/membership/members|/companies/?$",
    "MEMBER_DETAIL": r"/members?/[\w-]+/?$|/directory/[\w-]+/?$|/company/[\w-]+|/profile/[\w-]+|/member-profile",
    "EVENTS_LIST": r"/events/?$|/calendar/?$|/upcoming-events|/event-calendar|/conferences/?$",
    "EVENT_DETAIL": r"/events?/[\w-]+/?$|/event/[\w-]+|/conference/[\w-]+|/annual-meeting|/expo/?$",
    "EXHIBITORS_LIST": r"/exhibitors?/?$|/exhibitor-list|/exhibitor-directory|/booth-list",
    "SPONSORS_LIST": r"/sponsors?/?$|/sponsor-list|/sponsorship|/our-sponsors",
    "PARTICIPANTS_LIST": r"/attendees?/?$|/participants?/?$|/registered|/speakers?/?$",
    "ASSOCIATION_HOME": r"^/?$|/home/?$|/index",
    "ASSOCIATION_DIRECTORY": r"/about/?$|/about-us|/who-we-are",
    "RESOURCE": r"/resources?/?$|/publications?|/downloads?|/library|/news/?$|/blog/?$",
}
# Phrases of pages that want a login or payment, and terms that forbid collecting.
LOGIN_PHRASES = [
    "please log in", "sign in to view", "members only", "login required", "authentication required", "access denied", "subscription required",
    "premium content", "you must be logged in", "register to view", "create an account",
]
PAYWALL_PHRASES = ["subscribe to continue", "premium access", "unlock this content", "purchase required", "buy now to read", "upgrade your plan"]
TERMS = [
    r"scraping.*(prohibited|forbidden|not allowed)", r"automated.*(access|collection).*(prohibited|forbidden)", r"data mining.*(prohibited|forbidden)",
    r"no.*(crawling|scraping|harvesting)", r"robots?.*(prohibited|forbidden)",
]

# Columns of each kind of export, and names of fields in two sales systems.
EXPORT_COLUMNS = {
    "companies": ["company_name", "website", "domain", "city", "state", "country", "employee_count_min", "employee_count_max", "revenue_min_usd", "industry", "naics_code", "erp_system", "crm_system", "associations", "quality_score", "quality_grade", "contact_count", "primary_contact_name", "primary_contact_email", "source_url", "extracted_at"],
    "events": ["title", "event_type", "start_date", "end_date", "venue", "city", "state", "country", "is_virtual", "event_url", "registration_url", "organizer_association", "sponsor_count", "exhibitor_count", "source_url", "extracted_at"],
    "participants": ["company_name", "company_website", "participant_type", "sponsor_tier", "booth_number", "booth_category", "speaker_name", "speaker_title", "presentation_title", "event_id", "source_url", "extracted_at"],
    "competitors": ["competitor_name", "signal_type", "confidence", "context", "source_company_id", "source_event_id", "source_association", "source_url", "detected_at"],
}
SALESFORCE_FIELDS = {
    "company_name": "Account Name", "website": "Website", "domain": "Domain__c", "city": "BillingCity", "state": "BillingState", "country": "BillingCountry",
    "employee_count_min": "NumberOfEmployees", "revenue_min_usd": "AnnualRevenue", "industry": "Industry", "erp_system": "ERP_System__c",
    "associations": "Associations__c", "quality_score": "Data_Quality_Score__c",
}
HUBSPOT_FIELDS = {
    "company_name": "name", "website": "website", "domain": "domain", "city": "city", "state": "state", "country": "country", "employee_count_min": "numberofemployees",
    "revenue_min_usd": "annualrevenue", "industry": "industry", "erp_system": "erp_system",
}

# Fields of records. type; null: may be null; least, most, shortest, longest, one_of; items: what a list holds; needed: must be there.
_TEXT, _MAYBE = {"type": "string"}, {"type": "string", "null": True}
_COUNT = {"type": "integer", "null": True, "least": 0}
_TEXTS = {"type": "array", "items": _TEXT}
CONTACT_FIELDS = {
    "full_name": {"type": "string", "shortest": 1, "needed": True}, "first_name": _MAYBE, "last_name": _MAYBE, "title": _MAYBE, "department": _MAYBE, "seniority": _MAYBE, "email": _MAYBE,
    "email_verified": {"type": "boolean"}, "phone": _MAYBE, "linkedin_url": _MAYBE, "data_source": _MAYBE, "confidence_score": {"type": "number", "least": 0, "most": 1},
}
PROVENANCE_FIELDS = {
    "source_url": {"type": "string", "needed": True}, "source_type": {"type": "string", "one_of": ["web", "api", "pdf", "manual"]}, "extracted_at": _TEXT,
    "extracted_by": {"type": "string", "needed": True}, "association_code": _MAYBE, "job_id": _MAYBE,
    "page_type": {"type": "string", "null": True, "one_of": ["ASSOCIATION_HOME", "ASSOCIATION_DIRECTORY", "MEMBER_DIRECTORY", "MEMBER_DETAIL", "EVENTS_LIST", "EVENT_DETAIL", "PARTICIPANTS_LIST", "EXHIBITORS_LIST", "SPONSORS_LIST", "RESOURCE", "OTHER"]},
    "confidence": {"type": "number", "least": 0, "most": 1},
}
COMPANY_FIELDS = {
    "id": _TEXT, "company_name": {"type": "string", "shortest": 1, "needed": True}, "normalized_name": _MAYBE, "domain": _MAYBE, "website": _MAYBE, "city": _MAYBE,
    "state": {"type": "string", "null": True, "longest": 50}, "country": _TEXT, "full_address": _MAYBE, "latitude": {"type": "number", "null": True}, "longitude": {"type": "number", "null": True},
    "employee_count_min": _COUNT, "employee_count_max": _COUNT, "revenue_min_usd": _COUNT, "revenue_max_usd": _COUNT, "year_founded": {"type": "integer", "null": True, "least": 1800, "most": 2030},
    "naics_code": _MAYBE, "sic_code": _MAYBE, "industry": _MAYBE, "erp_system": _MAYBE, "crm_system": _MAYBE, "tech_stack": _TEXTS, "associations": _TEXTS,
    "contacts": {"type": "array", "items": CONTACT_FIELDS}, "quality_score": {"type": "integer", "null": True, "least": 0, "most": 100},
    "quality_grade": {"type": "string", "null": True, "one_of": ["A", "B", "C", "D", "F"]}, "data_sources": _TEXTS, "provenance": {"type": "array", "items": PROVENANCE_FIELDS},
    "created_at": _TEXT, "updated_at": _TEXT, "last_verified_at": _MAYBE,
}

# Country codes below which three labels of a host are kept.
COUNTRY_CODES = ["uk", "au", "nz", "za", "br", "mx", "jp", "cn", "in"]
# Trust of sources in scores of whole runs, and points of filled fields.
RUN_SOURCE_SCORES = SOURCE_SCORES | {"website_scrape": 70, "xlsx_seed": 55}
FIELD_POINTS = {
    "company_name": 20, "website": 15, "domain": 10, "city": 5, "state": 5, "country": 3, "member_type": 3, "industry": 5, "sector": 5, "tech_stack": 10,
    "employee_count_min": 5, "revenue_min_usd": 5, "erp_system": 5, "contacts": 4,
}
