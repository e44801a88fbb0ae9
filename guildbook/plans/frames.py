"""Company tables derived from the given tables by plain expressions that Spark and DuckDB read alike.

Each text is a query over the given tables; frame() runs it in Spark, and the oracle of a query holds it as a WITH clause.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Every tenth company repeats its neighbour's name and site in another form.
COMPANIES = """
SELECT k AS company_id,
  split_part('Al Bor Cas Del Ever Fal Gran Hex Iron Jet', ' ', CAST(r % 10 + 1 AS INT))
    || split_part('ta mo ri ne lo va su ki da pe', ' ', CAST(FLOOR(r / 10.0) % 10 + 1 AS INT))
    || split_part('x n r l m s t d v k', ' ', CAST(FLOOR(r / 100.0) % 10 + 1 AS INT))
    || ' ' || split_part('Precision|Mfg|Metal|Tool|Machine|Intl|Stamping|Forge|Eng|Gear|Castings', '|', CAST(FLOOR(r / 7.0) % 11 + 1 AS INT))
    || ' ' || split_part('Works|Systems|Group|Industries|Parts', '|', CAST(r % 5 + 1 AS INT))
    || CASE WHEN k % 10 = 0 THEN ', Inc.' ELSE split_part('| Inc| LLC| Corp.| Co., Inc.| Ltd| GmbH', '|', CAST(r % 7 + 1 AS INT)) END AS company_name,
  CASE WHEN k % 30 = 10 THEN '' WHEN k % 10 = 0 THEN 'https://www.firm' || CAST(r AS VARCHAR(20)) || '.com/about/' WHEN k % 13 = 5 THEN NULL
    ELSE 'http://firm' || CAST(r AS VARCHAR(20)) || '.com' END AS website,
  split_part('Akron|Toledo|Dayton|Gary|Flint|Tulsa|Reno|Mesa|', '|', CAST(r % 9 + 1 AS INT)) AS city,
  split_part('OH|TX|MI|CA|NY|GA|ON|WA|', '|', CAST(r % 9 + 1 AS INT)) AS state,
  CASE WHEN k % 4 = 3 THEN NULL ELSE '(555) ' || CAST(200 + r % 700 AS VARCHAR(20)) || '-' || CAST(1000 + r % 9000 AS VARCHAR(20)) END AS phone,
  CASE WHEN k % 6 = 0 THEN '' ELSE 'info@firm' || CAST(r AS VARCHAR(20)) || '.com' END AS email,
  CAST(CASE WHEN k % 5 = 4 THEN NULL ELSE 10 + (r * 37) % 1500 END AS INT) AS employee_count_min,
  CAST(CASE WHEN k % 5 = 4 THEN 0 ELSE 20 + (r * 37) % 1500 + r % 90 END AS INT) AS employee_count_max,
  CASE WHEN k % 3 = 0 THEN NULL ELSE 1000000 * (1 + (r * 91) % 4000) END AS revenue_min_usd,
  split_part('||Epicor Kinetic|SAP Business One||Oracle NetSuite|Plex Systems|Sage 100||Syspro', '|', CAST((r * 3) % 10 + 1 AS INT)) AS erp_system,
  split_part('WordPress;Google Analytics;Cloudflare|Shopify;HubSpot|Duplex Printing;jQuery|Google Analytics;Google Tag Manager;Drupal||WordPress;WooCommerce', '|', CAST(r % 6 + 1 AS INT)) AS tech_stack,
  split_part('Salesforce;SendGrid|HubSpot|Mailchimp; Pardot||Marketo;Amazon SES', '|', CAST(k % 5 + 1 AS INT)) AS spf_services,
  split_part('Microsoft 365|Google Workspace|Self-hosted|Proofpoint|Other|', '|', CAST(k % 6 + 1 AS INT)) AS email_provider,
  split_part('PMA|PMA;AGMA|NTMA|AGMA;NEMA;PMA|', '|', CAST(k % 5 + 1 AS INT)) AS associations,
  split_part('WordPress|Drupal||Wix', '|', CAST(k % 4 + 1 AS INT)) AS cms,
  split_part('platinum|gold|silver||', '|', CAST(k % 5 + 1 AS INT)) AS membership_tier,
  k % 17 = 0 AS publicly_traded,
  split_part('clearbit|zoominfo|apollo||other', '|', CAST(k % 5 + 1 AS INT)) AS firmographic_source,
  split_part('builtwith|website||job_postings', '|', CAST(k % 4 + 1 AS INT)) AS tech_source,
  CASE WHEN k % 7 = 0 THEN NULL ELSE TRUE END AS in_association,
  CASE WHEN k % 4 = 0 THEN NULL ELSE k % 3 <> 0 END AS dns_mx_valid,
  CASE WHEN k % 5 = 0 THEN NULL ELSE k % 2 = 0 END AS google_places_matched,
  CASE WHEN k % 6 = 0 THEN NULL ELSE k % 5 = 1 END AS linkedin_found,
  CASE WHEN k % 8 = 0 THEN CAST(k % 101 AS DOUBLE) ELSE NULL END AS validation_score,
  CAST(CASE WHEN k % 11 = 0 THEN NULL ELSE (k * 13) % 700 END AS INT) AS days_old,
  CAST(CASE WHEN k % 3 = 1 THEN 1900 + k % 120 ELSE NULL END AS INT) AS year_founded,
  CASE WHEN k % 2 = 0 THEN '3327' ELSE '' END AS naics_code,
  c_mktsegment AS industry,
  CAST(k % 4 AS INT) AS n_contacts,
  CASE WHEN k % 3 = 0 THEN 'complete' ELSE 'partial' END AS enrichment_status,
  CAST(FLOOR((c_acctbal + 1000) / 110.0) AS INT) AS quality_score,
  c_nationkey AS nation
FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 10 = 0 AND c_custkey > 0 THEN c_custkey - 1 ELSE c_custkey END AS r, c_mktsegment, c_acctbal, c_nationkey FROM customer)
"""

CONTACTS = """
SELECT o_orderkey AS contact_id, o_custkey AS company_id, 'Pat ' || split_part('Lee Kim Roy Fox Day', ' ', CAST(o_orderkey % 5 + 1 AS INT)) AS name,
  split_part('Chief Executive Officer|IT Manager|Activity Coordinator|Plant Manager|VP of Finance|Intern|Owner|Purchasing Agent', '|', CAST(o_orderkey % 8 + 1 AS INT)) AS title,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'p' || CAST(o_orderkey % 40 AS VARCHAR(20)) || '@Firm.com' END AS email,
  o_orderdate AS seen_at
FROM orders
"""

MEMBERSHIPS = """
SELECT DISTINCT o_custkey AS company_id, split_part('PMA NEMA AGMA NTMA AIA', ' ', CAST(substr(o_orderpriority, 1, 1) AS INT)) AS association FROM orders
"""

EVENTS = """
SELECT p_partkey AS event_id, p_name AS title, split_part('PMA NEMA AGMA NTMA AIA', ' ', CAST(p_partkey % 5 + 1 AS INT)) AS organizer FROM part
"""

PARTICIPANTS = """
SELECT DISTINCT l_partkey AS event_id, o_custkey AS company_id, CASE l_returnflag WHEN 'R' THEN 'SPONSOR' WHEN 'A' THEN 'EXHIBITOR' ELSE 'ATTENDEE' END AS kind
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

SIGNALS = """
SELECT event_id AS signal_id, split_part('epicor odoo infor sap plex sage', ' ', CAST(user_id % 6 + 1 AS INT)) AS competitor, event_type AS signal_type,
  user_id AS company_id, event_id % 50 AS event_id, CAST(FLOOR(ABS(value)) % 100 AS DOUBLE) / 100 AS confidence, ts AS detected_at
FROM events
"""

#: Pages of member directories and events, one per customer, with links, boxes, tables and further pages of several kinds.
SITES = """
SELECT k AS page_id, n AS nation,
  'https://assoc' || CAST(n AS VARCHAR(20)) || '.org' || split_part('/members|/events/|/pages/list.html|/sponsors', '|', CAST(k % 4 + 1 AS INT)) AS url,
  '<html><head><title>' || split_part('Member directory|Upcoming events|Welcome|Our sponsors', '|', CAST(k % 4 + 1 AS INT)) || '</title></head><body><h1>'
  || split_part('Find a member|Event calendar|Home|Thank you to our sponsors', '|', CAST(k % 4 + 1 AS INT)) || '</h1>'
  || '<a href="/about">About</a><a href="#top">Top</a><a href="mailto:a@b.org">Mail</a>'
  || '<a href="/member/' || CAST(k AS VARCHAR(20)) || '">Firm</a><a class="company-link" href="profile-' || CAST(k AS VARCHAR(20)) || '.html">Profile</a>'
  || '<div class="member-card"><p><a href="card?id=' || CAST(k AS VARCHAR(20)) || '">Card</a></p></div><table><tr><td><a href="/row/' || CAST(k AS VARCHAR(20)) || '">Row</a> <a href="/second">Second</a></td></tr></table>'
  || '<a href="https://other.org/member/9">Elsewhere</a><a href="http://firm' || CAST(k AS VARCHAR(20)) || '.com/x">Firm ' || CAST(k AS VARCHAR(20)) || '*</a><a href="https://facebook.com/f">Follow</a>'
  || CASE k % 5 WHEN 0 THEN '<a href="?page=2">2</a>' WHEN 1 THEN '<a href="/list/page/2">2</a>' WHEN 2 THEN '<button>Load more</button>' WHEN 3 THEN '<a href="list?offset=100">more firms</a>' ELSE '' END
  || '<p>We have ' || CAST(k % 300 AS VARCHAR(20)) || ' members in this list.</p></body></html>' AS html
FROM (SELECT c_custkey AS k, c_nationkey AS n FROM customer)
"""

#: What pages and jobs say of companies: numbers, years, systems, rivals.
STATEMENTS = """
SELECT k AS company_id,
  'About us. ' || CASE k % 4 WHEN 0 THEN 'We are a team of ' || CAST(k AS VARCHAR(20)) || '. ' WHEN 1 THEN '900,000 employees? No, over ' || CAST(k + 20 AS VARCHAR(20)) || ' people. ' WHEN 2 THEN CAST(k AS VARCHAR(20)) || ' employees. ' ELSE '' END
  || CASE k % 3 WHEN 0 THEN 'Founded in ' || CAST(1850 + k % 150 AS VARCHAR(20)) || '. ' WHEN 1 THEN 'Established 1066, ' || CAST(1900 + k % 100 AS VARCHAR(20)) || ' - present. ' ELSE '' END
  || CASE k % 5 WHEN 0 THEN 'Sales grew to $' || CAST(1 + k % 90 AS VARCHAR(20)) || '.5 million. ' WHEN 1 THEN 'Revenue of $' || CAST(50000 + k AS VARCHAR(20)) || ' last year. ' ELSE '' END
  || split_part('We run Epicor Kinetic, our ERP system is Epicor.|Skills: Salesforce, SFDC and Excel.|Plex or Sage, Sage 100 welcome.|Good pay.|Global Shop Solutions, GSS ERP.|SAP SAP CRM.', '|', CAST(k % 6 + 1 AS INT)) AS text
FROM (SELECT c_custkey AS k FROM customer)
"""

#: Job postings of companies, one per order, with the systems that they name.
POSTINGS = """
SELECT o_orderkey AS job_id, o_custkey AS company_id, split_part('Planner|IT Manager|ERP Analyst|Welder|Buyer|Estimator|Machinist', '|', CAST(o_orderkey % 7 + 1 AS INT)) AS title,
  split_part('Our Epicor ERP is Epicor Kinetic, you know Epicor and Salesforce well|Moving from JD Edwards to Oracle NetSuite, NetSuite skills and SolidWorks or Mastercam are asked for|Reports in Power BI and Tableau|Runs Infor Visual on the floor|Knows Sage 100 or Plex ERP. Sage 100 preferred by all of our plants in the north and in the south of the state|Keeps the QMS and the WMS|Uses E2 Shop System of Shoptech|Drawings live in PTC Windchill', '|', CAST(o_orderkey % 8 + 1 AS INT)) AS snippet
FROM orders
"""

#: Pages of search results with their cards in a script; every fourth has a broken one.
RESULT_PAGES = """
SELECT k AS page_id, '<html><script>window.mosaic.providerData["mosaic-provider-jobcards"] = {"metaData": {"mosaicProviderJobCardsModel": {"results": [{"title": " Planner ' || CAST(k AS VARCHAR(20))
  || ' ", "company": "Firm ' || CAST(k AS VARCHAR(20)) || '", "formattedLocation": "Akron, OH", "formattedRelativeTime": "3 days ago", "snippet": "<b>Runs</b> the   plan<br>daily", "urgentlyHiring": ' || CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END
  || ', "extractedSalary": {"text": "$' || CAST(k AS VARCHAR(20)) || ' an hour", "max": 5}}, {"title": "", "displayTitle": "Welder", "company": null, "truncatedCompany": "Short ' || CAST(k AS VARCHAR(20)) || '"' || CASE WHEN k % 3 = 0 THEN ', "salarySnippet": "by shift"' ELSE '' END
  || '}, {"company": "Nameless"}]}}' || CASE WHEN k % 4 = 3 THEN '' ELSE '}' END || ';</script></html>' AS html
FROM (SELECT c_custkey AS k FROM customer)
"""

#: Answers of providers about companies, one per customer.
PAYLOADS = """
SELECT k AS company_id, split_part('clearbit|apollo|zoominfo|builtwith|' || CASE WHEN k % 2 = 0 THEN 'apollo_people' ELSE 'hunter' END, '|', CAST(k % 5 + 1 AS INT)) AS provider,
  CASE k % 5
    WHEN 0 THEN '{"metrics": {"employees": ' || CAST(k AS VARCHAR(20)) || ', "estimatedAnnualRevenue": ' || CASE k % 3 WHEN 0 THEN '"$' || CAST(k AS VARCHAR(20)) || '.5M"' WHEN 1 THEN '"' || CAST(k AS VARCHAR(20)) || ' k"' ELSE 'null' END || '}, "foundedYear": ' || CAST(1900 + k % 100 AS VARCHAR(20)) || ', "category": {"naicsCode": "3327", "industry": "Metal"}, "linkedin": {"handle": ' || CASE WHEN k % 2 = 0 THEN '"firm' || CAST(k AS VARCHAR(20)) || '"' ELSE 'null' END || '}}'
    WHEN 1 THEN '{"organization": {"estimated_num_employees": ' || CAST(k AS VARCHAR(20)) || ', "industry": "Tools", "linkedin_url": "https://linkedin.com/company/a' || CAST(k AS VARCHAR(20)) || '"}}'
    WHEN 2 THEN '{"data": [{"employeeCount": ' || CAST(k AS VARCHAR(20)) || CASE WHEN k % 2 = 0 THEN ', "revenueInMillions": 12.5' ELSE '' END || ', "yearFounded": 1950, "naicsCode": "3328"}]}'
    WHEN 3 THEN CASE WHEN k % 2 = 0 THEN '{"Results": [{"Result": {"Paths": [{"Technologies": [{"Name": "nginx"}, {"Name": "Epicor", "Categories": ["ERP Software"]}]}, {"Technologies": [{"Name": "HubSpot", "Categories": ["CRM", "Mail"]}]}]}}, {"Result": {"Paths": [{"Technologies": [{"Name": "Plex", "Categories": ["Cloud ERP"]}]}]}}]}' ELSE '{"Results": []}' END
    ELSE CASE WHEN k % 2 = 0 THEN '{"people": [{"name": "Pat ' || CAST(k AS VARCHAR(20)) || '", "title": "Owner", "email": "pat@f.com", "phone_numbers": [{"number": "555-' || CAST(k AS VARCHAR(20)) || '"}, {"number": "1"}]}, {"name": "Lee", "phone_numbers": [], "linkedin_url": "https://linkedin.com/in/lee"}]}'
      ELSE '{"data": {"emails": [{"value": "kim@f.com", "first_name": "Kim", "last_name": "Roy", "position": "CFO"}, {"value": "info@f.com", "first_name": "", "last_name": null, "phone_number": "5551234567"}]}}' END END AS raw
FROM (SELECT c_custkey AS k FROM customer)
"""

#: Team pages with people in cards of two kinds or in the text.
TEAM_PAGES = """
SELECT k AS page_id, '<html><body><h1>Our people</h1>' || CASE k % 3
  WHEN 0 THEN '<div class="team-member wide"><img src="a.png"><h3>Ann Lee</h3><p class="role">Plant Manager</p><a href="mailto:Ann' || CAST(k AS VARCHAR(20)) || '@Firm.com?subject=x">Mail</a><a href="tel:+1 (330) 555-0100">Call</a><a href="https://www.linkedin.com/in/ann">Profile</a></div><div class="team-member"><h3>Bo</h3><strong>Bo Ray</strong><p>Likes boats</p></div><div class="team-member"><h3>Vacancy</h3></div>'
  WHEN 1 THEN '<ul class="our-teams"><li>List</li></ul><section class="bio"><h4>Cy Fox</h4><span>Vice President of Sales</span></section>'
  ELSE '<p>Dee Day, Chief Engineer, and Ed Low, Welder</p>' END || '</body></html>' AS html
FROM (SELECT c_custkey AS k FROM customer)
"""

#: Event pages with sponsors by tier, exhibitors in a table or in items, or speakers.
EVENT_PAGES = """
SELECT k AS page_id, 'https://show' || CAST(n AS VARCHAR(20)) || '.org/event/list' AS url, split_part('SPONSORS_LIST|EXHIBITORS_LIST|EXHIBITORS_LIST|PARTICIPANTS_LIST|EVENT_DETAIL', '|', CAST(k % 5 + 1 AS INT)) AS page_type,
  '<html><body><h1>Trade show</h1>' || CASE k % 5
    WHEN 0 THEN '<section><h2>Gold Level</h2><a href="https://firm' || CAST(k AS VARCHAR(20)) || '.com"><img src="x.png" alt="Firm ' || CAST(k AS VARCHAR(20)) || ' Logo"></a><img alt="Logo"><a href="/away">Other Firm</a></section><div class="silver-box"><a href="s.html">Silver Firm</a><a href="s2.html">silver firm</a><a href="w">www.x.com</a></div>'
    WHEN 1 THEN '<table><tr><th>Name</th><th>Place</th><th>Field</th></tr><tr><td>Firm ' || CAST(k AS VARCHAR(20)) || '</td><td>Booth #' || CAST(100 + k % 900 AS VARCHAR(20)) || '</td><td>Metal</td></tr><tr><td><a href="http://b.com">Bolts</a></td><td>B12</td></tr><tr><td>X</td></tr></table>'
    WHEN 2 THEN '<ul class="exhibitor-list"><li><h4>Item ' || CAST(k AS VARCHAR(20)) || '</h4><span class="category">Tools</span> Stand: ' || CAST(k AS VARCHAR(20)) || '</li><li>Nothing</li></ul>'
    WHEN 3 THEN '<p>Meet our speakers</p><div class="speaker-card"><h3>Ann Lee</h3><p class="position">Head of Sales at Firm ' || CAST(k AS VARCHAR(20)) || '</p><p class="session">Steel</p></div><div class="speaker-card"><h3>Bo Ray</h3></div>'
    ELSE '<div class="gold"><a href="x">Not asked for</a></div>' END || '</body></html>' AS html
FROM (SELECT c_custkey AS k, c_nationkey AS n FROM customer)
"""

#: Profiles of members, and pages of a list of members.
PROFILES = """
SELECT k AS page_id, CASE WHEN k % 3 = 2 THEN '<html><ul class="icons row-fluid"><li class="span4"><a href="/profile.asp?id=' || CAST(k AS VARCHAR(20)) || '">Firm ' || CAST(k AS VARCHAR(20)) || '</a><cite>akron, oh</cite><a href="http://firm' || CAST(k AS VARCHAR(20)) || '.com">Site</a></li><li class="span4"><b>No link</b></li><li class="span4"><a href="/x/directory/2">Second</a><cite>Toledo</cite></li></ul></html>'
  ELSE '<html><div class="profile-header"><h1>' || CASE WHEN k % 3 = 1 AND k % 2 = 0 THEN '' ELSE 'Firm  <i>' || CAST(k AS VARCHAR(20)) || '</i>' END || '</h1></div><div class="company-website"><a href="https://facebook.com/f">Us</a></div><a href="http://x.com/">X</a>'
  || '<p class="location"><span class="city">new YORK</span> <span itemprop="addressRegion">ohio</span></p><a href="tel:330 555-0100">330 555-0100</a><a href="mailto:Info@Firm.com">mail</a><i class="tier-badge">gOLD</i><i class="member-since">Since 1987</i></html>' END AS html
FROM (SELECT c_custkey AS k FROM customer)
"""

#: Pages of one event (structured data, or texts) and lists of events.
EVENT_SITES = """
SELECT k AS page_id, 'https://show' || CAST(n AS VARCHAR(20)) || '.org/events/x.html' AS url, split_part('EVENT_DETAIL|EVENT_DETAIL|EVENTS_LIST|OTHER', '|', CAST(k % 4 + 1 AS INT)) AS page_type, '<html><head>' || CASE k % 4
  WHEN 0 THEN '<script type="application/ld+json">{"name": "Expo ' || CAST(k AS VARCHAR(20)) || '", "startDate": "2025-03-04T09:00", "endDate": "2025-03-06", "location": {"name": "Hall 1", "address": {"addressLocality": "Akron", "addressRegion": "OH", "addressCountry": "US"}}}</script></head><body><h1>Other</h1><a href="/join">Register now</a></body>'
  WHEN 1 THEN '<title>Shop | Site</title></head><body><h1>Welding Workshop ' || CAST(k AS VARCHAR(20)) || '</h1><p>Learn</p><div class="when">March 4-6, 2025</div><div class="venue">Toledo, OH</div></body>'
  ELSE '</head><body><div class="event-card"><h3>Steel Summit</h3><a href="s' || CAST(k AS VARCHAR(20)) || '.html">More</a> May 2, 2025 <i class="place">Online</i></div><div class="event-card"><a class="title" href="/two">Annual Dinner</a></div><div class="event-card"><h3>No</h3></div></body>' END || '</html>' AS html
FROM (SELECT c_custkey AS k, c_nationkey AS n FROM customer)
"""

#: Records of companies in two runs: copies of one name in other forms, and names that are new.
RECORDS = """
SELECT k * 10 + i AS row_id, CASE WHEN i < 3 THEN 1 ELSE 2 END AS run,
  CASE i WHEN 1 THEN 'Firm' || CAST(k AS VARCHAR(20)) || ' Works' WHEN 2 THEN 'Firm' || CAST(k AS VARCHAR(20)) || ' Works LLC' WHEN 3 THEN 'FIRM' || CAST(k AS VARCHAR(20)) || ' WORKS, Inc.' ELSE 'Other' || CAST(k AS VARCHAR(20)) || ' Group' END AS company_name,
  CASE WHEN i < 4 THEN 'f' ELSE 'o' END || CAST(k AS VARCHAR(20)) || '.com' AS domain, CASE WHEN i = 3 THEN '(555) 123-4567' ELSE '' END AS phone, CASE WHEN i = 2 THEN 'Akron' WHEN i = 4 THEN 'Gary' END AS city,
  CAST(CASE i WHEN 1 THEN 10 WHEN 2 THEN 5 WHEN 3 THEN 30 END AS INT) AS employee_count_min, CAST(CASE i WHEN 1 THEN 50 WHEN 2 THEN 70 WHEN 3 THEN 60 ELSE 20 END AS INT) AS quality_score,
  CASE i WHEN 1 THEN 'PMA' WHEN 2 THEN 'NEMA' WHEN 4 THEN 'AGMA' END AS association, 'run' || CAST(CASE WHEN i < 3 THEN 1 ELSE 2 END AS VARCHAR(20)) || '-' || CAST(i AS VARCHAR(20)) AS provenance
FROM (SELECT c_custkey AS k, 1 AS i FROM customer UNION ALL SELECT c_custkey, 2 FROM customer UNION ALL SELECT c_custkey, 3 FROM customer UNION ALL SELECT c_custkey, 4 FROM customer) WHERE i = 1 OR i = 2 AND k % 3 = 0 OR i = 3 AND k % 2 = 0 OR i = 4 AND k % 5 = 0
"""

_LIST = '<html><body><h1>Members</h1><table class="plain"><tr><th>Name</th></tr></table><ul class="list">'
_ITEM = "'<li class=\"member-item\"><a class=\"name\" href=\"/m/{0}\">Firm ' || CAST(k AS VARCHAR(20)) || '-{0}</a></li>'"
_FOUR = " || ".join(_ITEM.format(i) for i in range(4))
_TIER = '<p class="tier">Gold</p>'
_WHOLE = f"'{_LIST}' || {_FOUR} || '</ul>{_TIER}</body></html>'"

#: Pages of watched sources as they were and as they are: nine kinds of change by the page's number.
SNAPSHOTS = f"""
SELECT k AS page_id, 'https://watch' || CAST(k AS VARCHAR(20)) || '.org/members' AS url, CASE k % 9 WHEN 5 THEN 503 WHEN 8 THEN NULL ELSE 200 END AS status, CASE WHEN k % 9 = 8 THEN 'timeout' END AS error,
  {_WHOLE} AS old_html,
  CASE k % 9 WHEN 1 THEN replace({_WHOLE}, 'Firm ', 'Works ') WHEN 2 THEN replace({_WHOLE}, '{_TIER}', '') WHEN 3 THEN '{_LIST}</ul>{_TIER}</body></html>' WHEN 4 THEN '{_LIST}' || {_ITEM.format(0)} || '</ul>{_TIER}</body></html>'
    WHEN 6 THEN '<html><body><h1>Access Denied</h1><p>Please verify: CAPTCHA</p></body></html>' ELSE {_WHOLE} END AS new_html
FROM (SELECT c_custkey AS k FROM customer)
"""

#: Lists of members: in items, or as links to their sites.
DIRECTORIES = """
SELECT k AS page_id, 'https://guild.org/list' || CAST(k AS VARCHAR(20)) AS url, '<html><body><div class="nav"><ul><li><b class="nm">Not a member</b></li></ul></div><div id="members"><ul>'
  || CASE WHEN k % 3 < 2 THEN '<li><b class="nm">Firm ' || CAST(k AS VARCHAR(20)) || '</b><a class="w" href="/go/1">Site</a><i>Akron</i></li><li><b class="nm"></b></li><li><b class="nm">Second</b></li>' ELSE '' END || '</ul>'
  || CASE WHEN k % 3 > 0 THEN '<a href="https://one' || CAST(k AS VARCHAR(20)) || '.com/x">One*</a><a href="https://www.facebook.com/q">F</a><a href="https://two' || CAST(k AS VARCHAR(20)) || '.com">Two</a><a href="/here">Here</a>' ELSE '' END
  || CASE WHEN k % 3 = 2 THEN '<a href="https://one' || CAST(k AS VARCHAR(20)) || '.com/again">Again</a>' ELSE '' END || '</div></body></html>' AS html
FROM (SELECT c_custkey AS k FROM customer)
"""

#: Pages with structured data of organisations: one item, a graph, a list, broken blocks, control characters, several items, none.
ORGANISATION_PAGES = """
SELECT k AS page_id, '<html><head>' || CASE k % 8
  WHEN 0 THEN '<script type="application/ld+json">{"@type": "Organization", "numberOfEmployees": {"@type": "QuantitativeValue", "value": ' || CAST(k + 1 AS VARCHAR(20)) || '}, "foundingDate": "1950-05-01", "telephone": " 555-0' || CAST(k AS VARCHAR(20)) || ' ", "url": "https://firm.com", "address": {"streetAddress": "1 Main St", "addressLocality": "Akron", "addressRegion": "Ohio", "postalCode": "44301", "addressCountry": "US"}, "geo": {"latitude": "41.5", "longitude": -81.25}, "sameAs": ["https://facebook.com/f", "https://www.LinkedIn.com/company/f' || CAST(k AS VARCHAR(20)) || '"]}</script>'
  WHEN 1 THEN '<script type="application/ld+json">{"@context": "x", "@graph": [{"@type": "WebSite", "telephone": "1"}, "text", {"@type": "LocalBusiness", "telephone": 5550100, "numberOfEmployees": {"minValue": 5, "maxValue": "1,0' || CAST(10 + k % 90 AS VARCHAR(20)) || '"}, "address": "2 Oak Ave, Gary", "sameAs": "https://linkedin.com/company/one", "geo": {"lat": 1.5}}]}</script>'
  WHEN 2 THEN '<script type="application/ld+json">[{"@type": "Person", "telephone": "2"}, {"@type": ["Store", "Thing"], "numberOfEmployees": "1,200", "telephone": ""}, {"@type": ["Thing", "NewsOrganization"], "numberOfEmployees": ' || CAST(k AS VARCHAR(20)) || '.0, "foundingDate": 1999, "address": {"addressLocality": "Tulsa"}}, null, 7]</script>'
  WHEN 3 THEN '<script type="application/ld+json">{"@type": "Organization", "telephone": </script><script type="application/ld+json"></script><script type="application/ld+json">{"@type": "Corporation", "foundingDate": 1066, "hasMap": "https://Maps.google.com/' || CAST(k AS VARCHAR(20)) || '", "telephone": {"a": 1}, "address": null}</script>'
  WHEN 4 THEN '<script type="application/ld+json">{"@type": "Organization", "description": "A' || chr(1) || 'B", "name": "F", "address": {"addressRegion": "tx", "addressLocality": ""}, "geo": {"latitude": "north", "longitude": 2}, "map": "/here"}</script>'
  WHEN 6 THEN '<script type="application/ld+json">{"@type": "Organization", "address": {"addressLocality": "Gary"}}</script><script type="application/ld+json">[{"@type": "Organization", "telephone": "3", "address": {"streetAddress": "3 Elm", "addressLocality": "Flint", "addressRegion": "MI"}}, {"@type": "Organization", "telephone": "4", "address": {"addressLocality": "Reno", "postalCode": "89501"}}]</script>'
  WHEN 7 THEN '<script type="application/ld+json">{"@type": "Product", "telephone": "5"}</script>'
  ELSE '' END || '</head><body><p>Text</p></body></html>' AS html
FROM (SELECT c_custkey AS k FROM customer)
"""

#: Records of companies as JSON, whole and broken in several ways.
CONTRACT_RECORDS = """
SELECT k AS record_id, CASE k % 7
  WHEN 0 THEN '{"company_name": "Firm ' || CAST(k AS VARCHAR(20)) || '", "state": "OH", "quality_score": 100, "quality_grade": "A", "year_founded": 2030, "latitude": 1, "revenue_max_usd": 2.0, "contacts": [{"full_name": "A", "confidence_score": 1, "email": null}], "tech_stack": ["x"], "provenance": []}'
  WHEN 1 THEN '{"company_name": "", "state": "' || repeat('x', CAST(50 + k % 2 AS INT)) || '", "year_founded": 2031, "quality_grade": "E", "quality_score": ' || CAST(k % 200 AS VARCHAR(20)) || '}'
  WHEN 2 THEN '{"company_name": null, "employee_count_min": -1, "quality_score": "7", "extra": 1, "country": null, "also": []}'
  WHEN 3 THEN '{"contacts": [{"full_name": "", "confidence_score": 1.5}, {"email_verified": "yes", "nick": "x"}, 5], "associations": ["a", 1]}'
  WHEN 4 THEN '{"company_name": "F", "provenance": [{"source_url": "u", "extracted_by": "x", "source_type": "fax", "confidence": -0.5, "page_type": null}, {"page_type": "HOME"}], "latitude": "n", "revenue_min_usd": 1.5}'
  WHEN 5 THEN '[1]' ELSE '{"company_name": ' END AS record
FROM (SELECT c_custkey AS k FROM customer)
"""

#: Contact pages: an address box, addresses in the text, only a ZIP, none.
CONTACT_PAGES = """
SELECT k AS page_id, CASE k % 5
  WHEN 0 THEN '<address>Short</address><address><b>Firm</b><br>' || CAST(10 + k % 90 AS VARCHAR(20)) || ' North Main Street <i>| Suite 5</i>, new berlin, wi 53151-1234</address><iframe width=1 src="https://www.google.com/maps/embed?k=' || CAST(k AS VARCHAR(20)) || '"></iframe>'
  WHEN 1 THEN '<div data-src="//maps.google.com/x"></div>' ELSE '<p>None</p>' END AS html,
  CASE k % 5 WHEN 0 THEN 'Call 555-1234 or +1 (330) 555-0100. A team of 1,200 people since 1066, founded in 1950. Akron, OH 44301'
  WHEN 1 THEN 'Acme Inc, CO. Visit us at: Fort Wayne, IN 46801. Over 900,000 sold, staff of ' || CAST(1 + k AS VARCHAR(20)) || '. Call 330.555.0199 ext 2'
  WHEN 2 THEN 'The very long name of a firm here, OH 44301. Zoom 46.26486 and 90210-1234.'
  WHEN 3 THEN 'Established 2030. Gary, IN. Tel 330 5550100' ELSE '' END AS text
FROM (SELECT c_custkey AS k FROM customer)
"""

#: Pages of one event whose dates stand in several forms, in structured data, tags or texts.
DATED_EVENTS = """
SELECT k AS page_id, 'https://show.org/e' AS url, 'EVENT_DETAIL' AS page_type, '<html><head>' || CASE k % 8
  WHEN 0 THEN '<script type="application/ld+json">{"name": "E", "startDate": "March 4, 2025 9:00 AM", "endDate": "Thu, 6 Mar 2025"}</script>'
  WHEN 1 THEN '<script type="application/ld+json">{"name": "E", "startDate": "13/4/2025", "endDate": "5/6/2025 10:00"}</script>'
  WHEN 2 THEN '<script type="application/ld+json">{"name": "E", "startDate": "2025-02-01", "endDate": "soon"}</script><meta property="startDate" content="20250304T0900"><meta property="endDate" content="5th of March 2025">'
  WHEN 3 THEN '<meta property="event:start_time" content="next week"><meta property="event:end_time" content="2025/3/9">'
  WHEN 4 THEN '<script type="application/ld+json">{"name": "E", "startDate": "Feb 30, 2025"}</script>'
  WHEN 5 THEN '<meta property="event:start_time" content="2025.10.' || CAST(10 + k % 20 AS VARCHAR(20)) || ' 09:00">'
  ELSE '' END || '</head><body><h1>Steel Expo</h1><div class="when">' || CASE WHEN k % 8 < 7 THEN 'May 2, 2025' ELSE '' END || '</div></body></html>' AS html
FROM (SELECT c_custkey AS k FROM customer)
"""

FRAMES = {"dated_events": DATED_EVENTS, "contract_records": CONTRACT_RECORDS, "contact_pages": CONTACT_PAGES, "organisation_pages": ORGANISATION_PAGES, "records": RECORDS, "snapshots": SNAPSHOTS, "directories": DIRECTORIES, "event_sites": EVENT_SITES, "profiles": PROFILES, "event_pages": EVENT_PAGES, "postings": POSTINGS, "result_pages": RESULT_PAGES, "payloads": PAYLOADS, "team_pages": TEAM_PAGES, "sites": SITES, "statements": STATEMENTS, "companies": COMPANIES, "contacts": CONTACTS, "memberships": MEMBERSHIPS, "trade_events": EVENTS, "participants": PARTICIPANTS, "signals": SIGNALS}
SOURCES = {"dated_events": ["customer"], "contract_records": ["customer"], "contact_pages": ["customer"], "organisation_pages": ["customer"], "records": ["customer"], "snapshots": ["customer"], "directories": ["customer"], "event_sites": ["customer"], "profiles": ["customer"], "event_pages": ["customer"], "postings": ["orders"], "result_pages": ["customer"], "payloads": ["customer"], "team_pages": ["customer"], "sites": ["customer"], "statements": ["customer"], "companies": ["customer"], "contacts": ["orders"], "memberships": ["orders"], "trade_events": ["part"], "participants": ["lineitem", "orders"], "signals": ["events"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables of short rows, of which one file holds many: each row becomes a page or a record, which costs far more than the row.
SHORT = ("customer", "part")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over as many tasks as run at once: a file with one row group would be one task, and all that follows with it."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table; the given tables come in as frames, so no view is left behind."""
    tables = {t: spread(table(spark, sf_dir, t)) if t in SHORT else table(spark, sf_dir, t) for t in SOURCES[name]}
    text = FRAMES[name].replace("{", "{{").replace("}", "}}")  # braces of JSON are not names of tables
    for t in tables:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(text, **tables)


def with_frames(sql: str, *names: str) -> str:
    """DuckDB SQL with derived tables in front."""
    head = ", ".join(f"{n} AS ({FRAMES[n]})" for n in names)
    rest = sql.strip()
    return f"WITH RECURSIVE {head}, {rest[5:]}" if rest.upper().startswith("WITH ") else f"WITH {head} {rest}"
