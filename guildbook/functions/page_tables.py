"""Fixed values for pages and texts: what names technologies, mail services, certificates and vendors."""

# Substrings of a page and the technology each shows.
TECHNOLOGIES = {
    "google-analytics.com": "Google Analytics", "googletagmanager.com": "Google Tag Manager", "analytics.js": "Google Analytics", "gtag/js": "Google Analytics",
    "hotjar.com": "Hotjar", "segment.com": "Segment", "amplitude.com": "Amplitude", "mixpanel.com": "Mixpanel", "newrelic.com": "New Relic", "nr-data.net": "New Relic",
    "optimizely.com": "Optimizely", "crazyegg.com": "Crazy Egg", "mouseflow.com": "Mouseflow", "fullstory.com": "FullStory", "heap-analytics": "Heap Analytics",
    "matomo": "Matomo", "piwik": "Matomo", "hubspot.com": "HubSpot", "hs-scripts.com": "HubSpot", "hs-analytics.net": "HubSpot", "marketo.net": "Marketo",
    "marketo.com": "Marketo", "mktoresp.com": "Marketo", "pardot.com": "Pardot", "salesforce.com": "Salesforce", "force.com": "Salesforce", "eloqua.com": "Oracle Eloqua",
    "demandbase.com": "Demandbase", "6sense.com": "6sense", "drift.com": "Drift", "intercom.io": "Intercom", "zendesk.com": "Zendesk", "zdassets.com": "Zendesk",
    "freshdesk.com": "Freshdesk", "livechatinc.com": "LiveChat", "tawk.to": "Tawk.to", "crisp.chat": "Crisp", "olark.com": "Olark", "mailchimp.com": "Mailchimp",
    "cookie-script.com": "Cookie Script", "cookiebot.com": "Cookiebot", "onetrust.com": "OneTrust", "trustarc.com": "TrustArc", "osano.com": "Osano",
    "recaptcha": "Google reCAPTCHA", "cloudflare": "Cloudflare", "akamai": "Akamai", "fastly": "Fastly", "cdn.jsdelivr.net": "jsDelivr CDN", "unpkg.com": "unpkg CDN",
    "cdnjs.cloudflare.com": "cdnjs", "amazonaws.com": "AWS", "azurewebsites.net": "Microsoft Azure", "azure.com": "Microsoft Azure", "wp-content": "WordPress",
    "wp-includes": "WordPress", "wordpress": "WordPress", "drupal": "Drupal", "joomla": "Joomla", "sitecore": "Sitecore", "kentico": "Kentico",
    "contentful.com": "Contentful", "prismic.io": "Prismic", "sanity.io": "Sanity", "adobe.com/experience-manager": "Adobe Experience Manager", "adobedtm.com": "Adobe DTM",
    "adobeaemcloud": "Adobe Experience Manager", "launch-": "Adobe Launch", "react": "React", "__next": "Next.js", "_next/": "Next.js", "nuxt": "Nuxt.js",
    "angular": "Angular", "vue.js": "Vue.js", "jquery": "jQuery", "bootstrap": "Bootstrap", "tailwind": "Tailwind CSS", "shopify.com": "Shopify",
    "bigcommerce.com": "BigCommerce", "magento": "Magento", "woocommerce": "WooCommerce", "youtube.com/embed": "YouTube Embed", "vimeo.com": "Vimeo",
    "wistia.com": "Wistia", "vidyard.com": "Vidyard", "facebook.com/tr": "Facebook Pixel", "connect.facebook.net": "Facebook SDK",
    "linkedin.com/insight": "LinkedIn Insight", "snap.licdn.com": "LinkedIn Insight", "twitter.com/widgets": "Twitter Widget", "platform.twitter.com": "Twitter Widget",
    "googlesyndication.com": "Google AdSense", "googleadservices.com": "Google Ads", "doubleclick.net": "Google DoubleClick", "bing.com/bat": "Microsoft Ads",
    "bat.bing.com": "Microsoft Ads", "fonts.googleapis.com": "Google Fonts", "use.typekit.net": "Adobe Fonts", "fast.fonts.net": "Fonts.com",
}
# Parts of two response headers and the technology each shows.
POWERED_BY = {"express": "Express.js", "asp.net": "ASP.NET", "php": "PHP", "next.js": "Next.js", "nuxt": "Nuxt.js"}
SERVERS = {
    "nginx": "Nginx", "apache": "Apache", "cloudflare": "Cloudflare", "iis": "Microsoft IIS", "akamaighost": "Akamai", "amazons3": "Amazon S3", "gws": "Google Web Server",
    "envoy": "Envoy",
}
# Parts of the generator tag and the site system each shows, in order.
GENERATORS = {
    "wordpress": "WordPress", "drupal": "Drupal", "joomla": "Joomla", "sitecore": "Sitecore", "hubspot": "HubSpot CMS", "wix.com": "Wix", "squarespace": "Squarespace",
    "ghost": "Ghost", "contentful": "Contentful", "adobe experience manager": "Adobe Experience Manager",
}
# Parts of mail hosts and their providers, in order.
MAIL_HOSTS = {
    "google": "Google Workspace", "googlemail": "Google Workspace", "outlook": "Microsoft 365", "microsoft": "Microsoft 365", "pphosted": "Proofpoint",
    "mimecast": "Mimecast", "barracuda": "Barracuda", "messagelabs": "Broadcom (Symantec)", "postmarkapp": "Postmark", "secureserver": "GoDaddy",
    "emailsrvr": "Rackspace", "zoho": "Zoho Mail", "forcepoint": "Forcepoint", "fireeyecloud": "Trellix (FireEye)", "sophos": "Sophos",
}
# Parts of SPF and TXT records and their services.
SPF_SERVICES = {
    "spf.protection.outlook.com": "Microsoft 365", "_spf.google.com": "Google Workspace", "sendgrid.net": "SendGrid", "amazonses.com": "Amazon SES",
    "mailchimp": "Mailchimp", "servers.mcsv.net": "Mailchimp", "hubspot": "HubSpot", "salesforce": "Salesforce", "pardot": "Pardot (Salesforce)",
    "zendesk": "Zendesk", "freshdesk": "Freshdesk", "constantcontact": "Constant Contact", "mandrillapp": "Mandrill (Mailchimp)", "postmarkapp": "Postmark",
    "sparkpostmail": "SparkPost", "mailgun": "Mailgun", "mcsignup": "Mailchimp", "brevo": "Brevo (Sendinblue)", "sendinblue": "Brevo (Sendinblue)",
    "activecampaign": "ActiveCampaign", "intercom": "Intercom", "drift": "Drift", "marketo": "Marketo (Adobe)", "eloqua": "Eloqua (Oracle)",
    "exacttarget": "Salesforce Marketing Cloud", "cust-spf.exacttarget": "Salesforce Marketing Cloud", "shopify": "Shopify", "squarespace": "Squarespace", "wix": "Wix",
    "zoho": "Zoho", "netcore": "Netcore Cloud", "returnpath": "Validity (Return Path)", "proofpoint": "Proofpoint", "mimecast": "Mimecast", "barracuda": "Barracuda",
    "knowbe4": "KnowBe4", "cisco": "Cisco IronPort",
}
# What DMARC policies are called.
DMARC_POLICIES = {"reject": "Strict (reject)", "quarantine": "Moderate (quarantine)", "none": "Monitoring (none)"}
# Certificates by pattern.
CERTIFICATES = {
    r"(?i)\bISO\s*9001\b": "ISO 9001", r"(?i)\bISO\s*14001\b": "ISO 14001", r"(?i)\bISO\s*13485\b": "ISO 13485", r"(?i)\bISO\s*27001\b": "ISO 27001",
    r"(?i)\bISO\s*45001\b": "ISO 45001", r"(?i)\bAS\s*9100\b": "AS9100", r"(?i)\bAS\s*9120\b": "AS9120", r"(?i)\bAS\s*9003\b": "AS9003", r"(?i)\bITAR\b": "ITAR",
    r"(?i)\bNADCAP\b": "NADCAP", r"(?i)\bNIST\s*800[-\s]?171\b": "NIST 800-171", r"(?i)\bCMMC\b": "CMMC", r"(?i)\bUL\s+listed\b": "UL Listed",
    r"(?i)\bCSA\s+certified\b": "CSA Certified", r"(?i)\bFDA\s+registered\b": "FDA Registered", r"(?i)\bRoHS\b": "RoHS", r"\bREACH\b": "REACH",
    r"(?i)\bISO\s*TS\s*16949\b": "IATF 16949", r"(?i)\bIATF\s*16949\b": "IATF 16949", r"(?i)\bQS\s*9000\b": "QS-9000",
}
# Capabilities by pattern.
CAPABILITIES = {
    r"(?i)\bCNC\s+machining\b": "CNC machining", r"(?i)\bCNC\s+turning\b": "CNC turning", r"(?i)\bCNC\s+milling\b": "CNC milling", r"(?i)\bCNC\s+lathe\b": "CNC lathe",
    r"(?i)\b5[-\s]?axis\b": "5-axis machining", r"(?i)\bprecision\s+machining\b": "precision machining", r"(?i)\bscrew\s+machining\b": "screw machining",
    r"(?i)\binjection\s+molding\b": "injection molding", r"(?i)\bblow\s+molding\b": "blow molding", r"(?i)\brotational\s+molding\b": "rotational molding",
    r"(?i)\bthermoforming\b": "thermoforming", r"(?i)\bcompression\s+molding\b": "compression molding", r"(?i)\bdie\s+casting\b": "die casting",
    r"(?i)\binvestment\s+casting\b": "investment casting", r"(?i)\bsand\s+casting\b": "sand casting", r"(?i)\bpermanent\s+mold\b": "permanent mold casting",
    r"(?i)\bmetal\s+stamping\b": "metal stamping", r"(?i)\bprogressive\s+die\b": "progressive die stamping", r"(?i)\bdeep\s+draw(ing)?\b": "deep drawing",
    r"(?i)\broll\s+forming\b": "roll forming", r"(?i)\bhydroforming\b": "hydroforming", r"(?i)\bTIG\s+weld(ing)?\b": "TIG welding", r"(?i)\bMIG\s+weld(ing)?\b": "MIG welding",
    r"(?i)\brobotic\s+weld(ing)?\b": "robotic welding", r"(?i)\bspot\s+weld(ing)?\b": "spot welding", r"(?i)\bbrazin(g)?\b": "brazing",
    r"(?i)\bfriction\s+stir\b": "friction stir welding", r"(?i)\bsheet\s+metal\s+fabrication\b": "sheet metal fabrication", r"(?i)\blaser\s+cutting\b": "laser cutting",
    r"(?i)\bwaterjet\s+cutting\b": "waterjet cutting", r"(?i)\bplasma\s+cutting\b": "plasma cutting", r"(?i)\bpunch\s+press\b": "punch press",
    r"(?i)\b3D\s+print(ing)?\b": "3D printing", r"(?i)\badditive\s+manufacturing\b": "additive manufacturing", r"\bSLS\b": "SLS printing", r"\bSLA\b": "SLA printing",
    r"\bFDM\b": "FDM printing", r"(?i)\bheat\s+treat(ing|ment)?\b": "heat treating", r"(?i)\bpowder\s+coat(ing)?\b": "powder coating", r"(?i)\banodiz(ing|ation)?\b": "anodizing",
    r"(?i)\belectroplat(ing|ed)?\b": "electroplating", r"(?i)\bchrome\s+plat(ing|ed)?\b": "chrome plating", r"(?i)\bnickel\s+plat(ing|ed)?\b": "nickel plating",
    r"(?i)\bshot\s+blast(ing)?\b": "shot blasting", r"(?i)\bsandblast(ing)?\b": "sandblasting", r"(?i)\bpassivation\b": "passivation", r"(?i)\bblack\s+oxide\b": "black oxide",
    r"(?i)\bsub[-\s]?assembly\b": "sub-assembly", r"(?i)\bkitting\b": "kitting", r"(?i)\bfinal\s+assembly\b": "final assembly", r"(?i)\bwire\s+EDM\b": "wire EDM",
    r"(?i)\bsinker\s+EDM\b": "sinker EDM", r"\bEDM\b": "EDM", r"(?i)\bforging\b": "forging", r"(?i)\bextrusion\b": "extrusion", r"(?i)\bcold\s+heading\b": "cold heading",
    r"\bCMM\b": "CMM inspection", r"(?i)\bfirst\s+article\s+inspection\b": "first article inspection", r"\bNDT\b": "NDT/non-destructive testing",
    r"(?i)\bnon[-\s]?destructive\s+test(ing)?\b": "NDT/non-destructive testing",
}
# What job texts say of each ERP vendor.
ERP_WORDS = {
    "SAP": ["SAP", "SAP S/4HANA", "SAP ECC", "SAP Business One", "SAP B1", "SAPUI5"], "Oracle": ["Oracle ERP", "Oracle Cloud", "JD Edwards", "NetSuite", "Oracle NetSuite"],
    "Epicor": ["Epicor", "Epicor Kinetic", "Epicor Prophet 21", "Epicor Eclipse"], "Infor": ["Infor", "Infor CloudSuite", "Infor M3", "Infor LN", "SyteLine", "Infor SyteLine"],
    "Microsoft Dynamics": ["Dynamics 365", "Dynamics AX", "Dynamics NAV", "Business Central", "D365"], "SYSPRO": ["SYSPRO"], "Plex": ["Plex", "Plex Manufacturing", "Plex MES"],
    "Acumatica": ["Acumatica"], "QAD": ["QAD", "QAD Adaptive ERP"], "IFS": ["IFS", "IFS Applications", "IFS Cloud"],
    "Global Shop Solutions": ["Global Shop Solutions", "GSS ERP"], "Sage": ["Sage", "Sage X3", "Sage Intacct", "Sage 100", "Sage 300"],
    "IQMS": ["IQMS", "DELMIAworks"], "JobBOSS": ["JobBOSS", "E2 Shop System"], "MAPICS": ["MAPICS"],
}
# What job texts say of each CRM vendor.
CRM_WORDS = {
    "Salesforce": ["Salesforce", "SFDC", "force.com"], "HubSpot": ["HubSpot"], "Microsoft Dynamics CRM": ["Dynamics CRM", "Dynamics 365 Sales"], "Zoho": ["Zoho CRM"],
    "Pipedrive": ["Pipedrive"], "SAP CRM": ["SAP CRM", "SAP C/4HANA"],
}
# Words near a mention that make it surer.
SURE_WORDS = ["erp", "software", "system", "implementation", "using"]
# Content words of the kinds of pages, and the extractor for each kind.
PAGE_WORDS = {
    "MEMBER_DIRECTORY": ["member directory", "member list", "our members", "find a member", "company directory", "browse members", "member search"],
    "MEMBER_DETAIL": ["company profile", "member profile", "about the company", "contact information", "company details"],
    "EVENTS_LIST": ["upcoming events", "event calendar", "conferences", "trade shows", "webinars", "networking events"],
    "EVENT_DETAIL": ["event details", "register now", "registration", "conference agenda", "event schedule", "keynote speakers"],
    "EXHIBITORS_LIST": ["exhibitors", "exhibitor list", "booth information", "exhibitor directory", "floor plan", "exhibit hall"],
    "SPONSORS_LIST": ["our sponsors", "thank you to our sponsors", "sponsorship levels", "platinum sponsors", "gold sponsors", "silver sponsors"],
    "PARTICIPANTS_LIST": ["attendees", "participants", "registered attendees", "speakers", "presenters", "panelists"],
}
EXTRACTORS = {
    "MEMBER_DIRECTORY": "extraction.directory_parser", "MEMBER_DETAIL": "extraction.html_parser", "EVENTS_LIST": "extraction.event_extractor",
    "EVENT_DETAIL": "extraction.event_extractor", "EXHIBITORS_LIST": "extraction.event_participant_extractor", "SPONSORS_LIST": "extraction.event_participant_extractor",
    "PARTICIPANTS_LIST": "extraction.event_participant_extractor",
}
# Links that lead to no member.
SKIP_LINKS = [
    r"^#", "^javascript:", "^mailto:", "^tel:", r"\.(pdf|doc|docx|xls|xlsx|zip)$", "/login", "/register", "/contact", "/about", "/faq", "/privacy", "/terms", "/search", "/join",
    "/membership$", r"facebook\.com", r"twitter\.com", r"linkedin\.com/company", r"youtube\.com",
]
# Numbers of employees and revenue, years of foundation, in the order in which they are tried.
PEOPLE_PATTERNS = [r"(\d{1,3}(?:,\d{3})*)\+?\s*employees?", r"team of\s*(\d+)", r"workforce of\s*(\d+)", r"over\s*(\d+)\s*(?:employees?|people|staff)"]
YEAR_PATTERNS = [r"(?:founded|established|since)\s*(?:in\s*)?(\d{4})", r"(\d{4})\s*(?:-|–)\s*present"]
REVENUE_PATTERNS = [r"\$(\d+(?:\.\d+)?)\s*(million|billion|m|b)", r"revenue\s*(?:of\s*)?\$(\d+(?:\.\d+)?)\s*(million|billion|m|b)?"]
# Patterns of the kinds of competitor signals.
SIGNAL_KINDS = {
    "SPONSOR": ["sponsor(ed|ship)?", "supported by", "brought to you by", "partnered with"],
    "EXHIBITOR": ["exhibitor", "booth", "vendor", "exhibit(ing)?"],
    "MEMBER_USAGE": ["(we )?(use|using|implement|run|powered by)", "(our )?(erp|system|software)", "success(ful)? (implementation|deployment)"],
    "SPEAKER_BIO": ["speaker", "presenter", "panelist", "(bio|biography)"],
    "PARTNER_INTEGRATION": ["(integration|integrate[ds]?)", "partner(ship)?", "certified", "alliance"],
    "JOB_POSTING": ["job", "career", "hiring", "position", "experience (with|in)"],
    "CASE_STUDY": ["case study", "success story", "customer story", "testimonial"],
    "PRESS_RELEASE": ["press release", "announce", "news"],
}
# What lines of a plain-text directory hold, in the order in which they are tried.
LINES = {
    "phone": r"[\(]?\d{3}[\)\-\.\s]?\d{3}[\-\.\s]?\d{4}", "email": r"[\w\.-]+@[\w\.-]+\.\w+", "website": r"(?i)(?:https?://)?(?:www\.)?[\w\.-]+\.[a-z]{2,}",
    "place": r"^([A-Z][a-zA-Z\s]+),?\s+([A-Z]{2})(?:\s+\d{5})?$",
}
# Classes of elements that are items of a list, and what a page says that keeps visitors out.
ITEM_CLASSES = "member|company|listing|item|card"
BLOCKING = [
    ("rate limited", "rate_limit"), ("too many requests", "rate_limit"), ("access denied", "access_denied"), ("forbidden", "forbidden"),
    ("captcha", "captcha"), ("please verify", "verification"), ("unusual traffic", "unusual_traffic"),
]

#: Types of structured data that count as organisations, and as corporations. Fixed values.
ORGANISATIONS = ["Organization", "LocalBusiness", "Corporation", "MedicalOrganization", "SportsOrganization", "AutomotiveBusiness", "Store"]
CORPORATIONS = ["Organization", "Corporation"]

# Patterns of contacts on pages.
PHONE_PATTERN = r"(?:\+1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]\d{4}"
STREET_PATTERN = r"(?i)\b(\d{1,5})\s+([A-Z][a-zA-Z0-9\s]{2,40}?)\s+(St|Street|Ave|Avenue|Blvd|Boulevard|Dr|Drive|Rd|Road|Ln|Lane|Way|Pkwy|Parkway|Ct|Court|Pl|Place|Cir|Circle|Hwy|Highway|Suite|Ste|Bldg|Building|Floor|Fl)\b"
PLACE_PATTERN = r"(?i)([A-Z][a-zA-Z\s]{2,30}),\s*(AL|AK|AZ|AR|CA|CO|CT|DE|FL|GA|HI|ID|IL|IN|IA|KS|KY|LA|ME|MD|MA|MI|MN|MS|MO|MT|NE|NV|NH|NJ|NM|NY|NC|ND|OH|OK|OR|PA|RI|SC|SD|TN|TX|UT|VT|VA|WA|WV|WI|WY|DC)(?:\s+(\d{5}(?:-\d{4})?))?"
ZIP_PATTERN = r"(?<![.\d])(\d{5}(?:-\d{4})?)(?![.\d])"
STAFF_PATTERN = r"(?i)(?:team of|employs?|over|more than|approximately|about|nearly|workforce of|staff of|employees?:?)\s*(\d[\d,]*)\s*(?:\+\s*)?(?:employees?|people|staff|team members?|professionals?)?"
FOUNDED_PATTERN = r"(?i)(?:founded|established|since|incorporated|started|began)\s+(?:in\s+)?(\d{4})"
MAP_PATTERNS = [r"""(?i)<iframe[^>]+src=["']([^"']*(?:maps\.google|google\.com/maps|maps\.googleapis)[^"']*)["']""", r"""(?i)data-src=["']([^"']*(?:maps\.google|google\.com/maps)[^"']*)["']"""]
