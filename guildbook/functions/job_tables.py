"""Fixed values of the job and team page operators."""

# Words by which postings name an ERP vendor, vendors and words in order.
ERP_POSTING_WORDS = {
    "epicor": ["epicor", "epicor kinetic", "prophet 21", "p21", "epicor erp"],
    "sap": ["sap erp", "sap business one", "sap b1", "s/4hana", "sap s4", "sapui5"],
    "oracle": ["oracle erp", "jd edwards", "jde", "oracle cloud erp", "oracle e-business"],
    "netsuite": ["netsuite", "oracle netsuite"],
    "infor": ["infor cloudsuite", "syteline", "infor m3", "infor ln", "infor visual"],
    "microsoft dynamics": ["dynamics 365", "dynamics nav", "dynamics ax", "d365 finance", "business central", "ms dynamics"],
    "syspro": ["syspro"],
    "acumatica": ["acumatica"],
    "plex": ["plex manufacturing", "plex erp", "plex systems"],
    "sage": ["sage 100", "sage 300", "sage x3", "sage intacct", "sage 50", "sage erp"],
    "qad": ["qad erp", "qad cloud"],
    "iqms": ["iqms", "delmiaworks"],
    "global shop solutions": ["global shop solutions", "global shop erp"],
    "jobboss": ["jobboss", "job boss"],
    "aptean": ["aptean"],
    "made2manage": ["made2manage", "m2m erp"],
    "macola": ["macola"],
    "visual manufacturing": ["visual manufacturing", "infor visual"],
    "e2 shop system": ["e2 shop", "e2 manufacturing"],
    "shoptech": ["shoptech", "e2 shop system"],
    "rootstock": ["rootstock erp", "rootstock cloud"],
    "erpnext": ["erpnext"],
    "odoo": ["odoo erp"],
}
# Words of other systems by category.
SYSTEM_POSTING_WORDS = {
    "crm": ["salesforce", "hubspot crm", "dynamics crm", "zoho crm", "pipedrive", "sugar crm"],
    "cad": ["solidworks", "autocad", "catia", "creo parametric", "ptc creo", "autodesk inventor", "nx cad", "fusion 360", "mastercam"],
    "mes": ["mes system", "manufacturing execution system", "plex mes", "aegis", "42q", "opcenter"],
    "plm": ["product lifecycle management", "ptc windchill", "windchill", "siemens teamcenter", "teamcenter", "arena plm", "agile plm"],
    "quality": ["minitab", "quality management system", "qms", "etq", "mastercontrol", "intelex"],
    "warehouse": ["wms", "warehouse management system", "fishbowl", "3pl"],
    "bi": ["power bi", "tableau", "qlik", "qlikview", "qliksense", "looker", "business intelligence", "crystal reports", "ssrs"],
    "scm": ["sap ariba", "ariba", "coupa", "jaggaer", "supply chain management"],
}
# Words that a job title holds.
TITLE_WORDS = ["president", "ceo", "cfo", "cio", "coo", "cto", "chief", "vice president", "vp", "director", "manager", "owner", "founder", "partner"]
# Classes of a person's card (whole class or part of one), the first kind that gives people counts.
PERSON_CARDS = [("team-member", True), ("executive", True), ("leader", True), ("staff-member", True), ("person", True), ("bio", True), ("team", False), ("leadership", False)]
# Where a card has the name and the title; a leading dot marks a class.
NAME_PLACES = ["h3", "h4", ".name", ".title", "strong"]
TITLE_PLACES = [".position", ".role", ".job-title", "p", "span"]
# Fixed value: a name and a title in plain text.
NAME_AND_TITLE = r"([A-Z][a-z]+ [A-Z][a-z]+)\s*[,\n]\s*((?:Chief|VP|Vice President|Director|CEO|CFO|CIO|COO|President|Owner)[^,\n]{0,50})"
