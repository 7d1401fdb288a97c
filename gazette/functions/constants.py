"""Fixed values.

These lists must equal the reference domain for results to line up: the
section, publication and author names, event types and the categorical
values of the tracking events.  They are stated once, in natural order.
"""

# --- fixed values (reference domain) --------------------------------------
SECTIONS = [
    "Politique", "International", "Economie", "Culture", "Sciences",
    "Sport", "Planete", "Opinions", "Societe",
]
PUBLICATIONS = [
    "Arctic Times", "Courrier Polaire", "Telerama Nord",
    "La Vie Glaciale", "Arctic Times Diplomatique",
]
AUTHORS = [
    "Jean Martin", "Marie Bernard", "Pierre Dubois", "Sophie Thomas",
    "Laurent Robert", "Claire Richard", "Nicolas Petit", "Isabelle Durand",
    "Thomas Leroy", "Camille Moreau", "Antoine Girard", "Lucie Lefevre",
    "Julien Mercier", "Emma Fontaine", "Hugo Rousseau", "Lea Blanc",
]
EVENT_TYPES = [
    "page_view", "scroll", "click", "session_start",
    "paywall_hit", "subscribe_click", "share",
]
BROWSERS = ["Chrome", "Safari", "Firefox", "Edge", "Samsung Internet"]
DEVICES = ["mobile", "desktop", "tablet"]
OS_LIST = ["iOS", "Android", "Windows", "macOS", "Linux"]
COUNTRIES = ["FR", "FR", "FR", "FR", "BE", "CH", "CA", "SN", "MA"]
FR_CITIES = ["Paris", "Lyon", "Marseille", "Toulouse", "Bordeaux", "Lille",
             "Nantes", "Strasbourg", "Nice", "Rennes"]
SOURCES = ["google", "direct", "facebook", "twitter", "newsletter", "apple_news"]
MEDIUMS = ["organic", "direct", "referral", "social", "email", "cpc"]
SUBSCRIPTION_TYPES = ["premium", "standard", "digital_only", "student"]
CONSENT_STATES = ["granted", "denied", "pending"]
AB_VARIANTS = ["control", "variant_a", "variant_b", None]

CAMPAIGNS = [None, "summer_promo", "election_2026", "culture_week"]
REGIONS = ["Ile-de-France", "Provence-Alpes-Cote d'Azur"]

# Churn rule score: recency days / 90 weighted 0.6, low reading
# (1 - min(reads, 60) / 60) weighted 0.25, min(bounces, 30) / 30 weighted 0.15.
CHURN_DAYS_SCALE = 90
CHURN_READS_CAP = 60
CHURN_BOUNCES_CAP = 30
CHURN_W_RECENCY = 0.6
CHURN_W_READING = 0.25
CHURN_W_BOUNCES = 0.15
# Engagement segments, tested in this order: loyal (>= 60 reads and <= 7 days
# since login), regular (>= 20 reads), dormant (>= 45 days), else casual.
LOYAL_MIN_READS = 60
LOYAL_MAX_DAYS = 7
REGULAR_MIN_READS = 20
DORMANT_MIN_DAYS = 45
# A deep read scrolls at least this far.
DEEP_READ_SCROLL_PCT = 75

# Ordinal encoding of the subscription type for the churn model; unknown -> 2.
SUBSCRIPTION_CODE = {"student": 0, "digital_only": 1, "standard": 2, "premium": 3}
SUBSCRIPTION_CODE_DEFAULT = 2

# Paywall buckets (hash % 10): 8,9 hard; 0,1,2 none; anything else soft.
PAYWALL_HARD = [8, 9]
PAYWALL_NONE = [0, 1, 2]
SENIORITY = ["senior", "staff", "contributor"]  # hash % 3: 0, 1, else

# Masking policies.
PRIVILEGED_ROLES = ["ARCTIC_TIMES_ADMIN", "ACCOUNTADMIN"]
ANALYST_ROLE = "ARCTIC_TIMES_ANALYST"
NAME_MASK = "*** MASKED ***"
EMAIL_MASK = "****@"
PHONE_MASK_PREFIX = "+33 **** ** "

# Tier presets: (label, threshold) in evaluation order; `strict` = '>' not '>='.
PERFORMANCE_TIERS = [("VIRAL", 30), ("HIGH", 25), ("NORMAL", 18)]
CONTENT_TIERS = [("VIRAL", 5000), ("HIGH", 1000), ("NORMAL", 200)]
RISK_HIGH = 0.7
RISK_MEDIUM = 0.4
