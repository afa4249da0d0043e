"""Default rule sets: ordered ``class -> patterns`` (case-insensitive regex) and keyword lists."""

# Corpus labeller rules.
LABEL_RULES = {
    "OS_UPDATE_BUG": [
        r"\b(ios|macos|watchos|ipados)\s*\d+(\.\d+)*\b",
        r"\b(update|updated|updating|boot\s*loop|kernel\s*panic|freeze|freezing|crash|crashes|crashing|lag|glitch|bug|slow|restart|loop)\b",
    ],
    "HARDWARE_BATTERY": [
        r"\b(battery|drain|maximum\s*capacity|overheat|swelling|swollen|hot\s*to\s*the\s*touch|charging|charge|charger|port|cable|power|dead)\b",
        r"\b(shattered|cracked\s*screen|broken\s*glass|loose\s*port|earpiece|speaker\s*crackl|water\s*damage|submerged|hardware|camera|speaker|mic)\b",
    ],
    "ACCOUNT_ICLOUD_SECURITY": [
        r"\b(apple\s*id|icloud|iforgot|2fa|two[- ]factor|verification\s*code|locked|disabled|passcode|password|account)\b",
        r"\b(phishing|suspicious\s*email|unauthorized\s*access|hacked|trusted\s*number|security|stolen)\b",
    ],
    "BILLING_SUBSCRIPTIONS": [
        r"\b(charged|refund|subscription|cancel\s*sub|receipt|invoice|billed|double\s*bill|payment\s*method\s*declined|payment|money|cost|price|bill|pay)\b",
        r"\b(app\s*store\s*charge|in-app\s*purchase|apple\s*arcade|apple\s*music\s*billing|apple\s*music|apple\s*tv\+|itunes|in-app)\b",
    ],
    "CONNECTIVITY_SETUP": [
        r"\b(airdrop|bluetooth|airpods\s*disconnect|apple\s*watch\s*pair|pairing|carplay|hotspot|personal\s*hotspot|airpods?|earbuds?|headphone)\b",
        r"\b(no\s*service|searching\.\.\.|carrier\s*settings|wifi\s*greyed|wi-fi\s*drop|wi-?fi|disconnect|cellular|data|signal|sim|carrier|drop)\b",
    ],
    "REPAIR_WARRANTY_STATUS": [
        r"\b(applecare|applecare\+|warranty|genius\s*bar|appointment|repair\s*status|repair\s*id|checkcoverage|replace|replacement|trade-in)\b",
        r"\b(cost\s*to\s*fix|service\s*quote|send\s*in\s*for\s*repair|repair|store)\b",
    ],
    "GENERAL_FEEDBACK_CHURN": [
        r"\b(switching\s*to\s*android|worst\s*experience|customer\s*service|tim\s*cook|unacceptable|terrible\s*service)\b",
        r"\b(feature\s*request|feedback|love\s*the|shoutout|great\s*job)\b",
    ],
}

# Classifier boost rules.
BOOST_RULES = {
    "OS_UPDATE_BUG": [
        r"\b(ios|macos|watchos|ipados)\s*\d+(\.\d+)*\b",
        r"\b(update|updated|updating|boot\s*loop|kernel\s*panic|freeze|freezing|crash|crashes|crashing|lag|glitch|bug)\b",
        r"\b(safari\s*crash|lock\s*screen\s*stuck|stuck\s*on\s*apple\s*logo)\b",
    ],
    "HARDWARE_BATTERY": [
        r"\b(battery\s*health|battery\s*drain|maximum\s*capacity|overheat|swelling|swollen|hot\s*to\s*the\s*touch|battery|charging|charge)\b",
        r"\b(shattered|cracked\s*screen|broken\s*glass|charging\s*port|loose\s*port|earpiece|speaker\s*crackl|water\s*damage|submerged)\b",
        r"\b(camera\s*lens|rattles|microphone\s*quiet|hardware)\b",
    ],
    "ACCOUNT_ICLOUD_SECURITY": [
        r"\b(apple\s*id|icloud|iforgot|2fa|two[- ]factor|verification\s*code|locked\s*account|disabled\s*account|passcode|password)\b",
        r"\b(phishing|suspicious\s*email|unauthorized\s*access|hacked|password\s*reset|trusted\s*number|security)\b",
        r"\b(icloud\s*storage\s*full|storage\s*sync|photo\s*sync)\b",
    ],
    "BILLING_SUBSCRIPTIONS": [
        r"\b(charged|refund|subscription|cancel\s*sub|receipt|invoice|billed|double\s*bill|payment\s*method\s*declined|payment)\b",
        r"\b(app\s*store\s*charge|reportaproblem|in-app\s*purchase|apple\s*arcade|apple\s*music\s*billing|apple\s*music|apple\s*tv\+)\b",
    ],
    "CONNECTIVITY_SETUP": [
        r"\b(airdrop|bluetooth|airpods\s*disconnect|apple\s*watch\s*pair|pairing|carplay|hotspot|personal\s*hotspot|airpods?|earbuds?)\b",
        r"\b(no\s*service|searching\.\.\.|carrier\s*settings|wifi\s*greyed|wi-fi\s*drop|wi-?fi|disconnect)\b",
    ],
    "REPAIR_WARRANTY_STATUS": [
        r"\b(applecare|applecare\+|warranty|genius\s*bar|appointment|repair\s*status|repair\s*id|checkcoverage)\b",
        r"\b(cost\s*to\s*fix|service\s*quote|trade-in\s*value|send\s*in\s*for\s*repair)\b",
    ],
    "GENERAL_FEEDBACK_CHURN": [
        r"\b(switching\s*to\s*android|worst\s*experience|customer\s*service|tim\s*cook|unacceptable|terrible\s*service)\b",
        r"\b(feature\s*request|feedback|love\s*the|shoutout|great\s*job)\b",
    ],
}

# Truth-labelling escalation rules, first hit wins.
LABEL_ESCALATION_RULES = {
    "HARDWARE_PHYSICAL_DAMAGE": [r"\b(swell|swelling|swollen|smoke|fire|burning|exploded)\b"],
    "HIGH_SENTIMENT_CHURN_RISK": [r"\b(lawyer|attorney|sue|court|worst|unacceptable|switching\s*to)\b"],
    "BILLING_REFUND_AUTH": [r"\b(unauthorized|charged\s*twice|dispute|fraud|refund\s*me\s*now)\b"],
    "PII_SECURITY_DM": [r"\b(dm\s*me|send\s*dm|serial\s*number|imei|locked\s*out|hacked|stolen|repair\s*id)\b"],
}

# Run-time escalation policy rules, first hit wins: (reason, risk, suggested action, patterns).
POLICY_RULES = [
    ("HARDWARE_PHYSICAL_DAMAGE", "CRITICAL",
     "Direct customer to halt usage immediately and arrange emergency Genius Bar inspection / priority mail-in repair.",
     [r"\b(swells?|swelling|swollen|smoke|smoking|spark|burning|burn\s*mark|exploded|fire)\b",
      r"\b(submerged|bathtub|dropped\s*in\s*water|liquid\s*damage|shattered\s*back|hinge\s*lines)\b",
      r"\b(wi-?fi|wifi|bluetooth).{0,60}(grey|gray)e?d?\s*out\b",
      r"\b(grey|gray)e?d?\s*out\b"]),
    ("HIGH_SENTIMENT_CHURN_RISK", "HIGH",
     "Route to Senior Customer Relations Specialist with empathy-focused outreach via secure DM.",
     [r"\b(lawyer|attorney|sue|court|legal\s*action|bbb|ftc)\b",
      r"\b(worst\s*(service|experience)|unacceptable|disgusting|supervisor|manager|tim\s*cook|switching\s*to\s*android|switching\s*to\s*samsung)\b"]),
    ("BILLING_REFUND_AUTH", "MEDIUM",
     "Request Apple ID verification via DM to inspect duplicate transactions and initiate financial reversal.",
     [r"\b(unauthorized\s*charge|charged\s*4\s*times|double\s*charge|dispute|fraud|bank\s*blocked)\b",
      r"\b(charged\s*twice|refund\s*me\s*now|unauthorized\s*apple\s*services)\b"]),
    ("PII_SECURITY_DM", "MEDIUM",
     "Invite customer to secure DM to gather Apple ID / hardware serial number / diagnostic logs safely.",
     [r"\b(dm\s*me|send\s*dm|serial\s*number|imei|apple\s*id\s*email|locked\s*out|recovery\s*phone|hacked|stolen|passcode|password)\b",
      r"\b(repair\s*#|repair\s*id|fedex|shipping\s*address|tracking\s*number)\b"]),
    ("LOW_CONFIDENCE_AMBIGUITY", "LOW",
     "Route query to human triage queue due to truncated conversation context.",
     [r"\b(done\s*that\s*already|tried\s*that|didn\'?t\s*work|still\s*not\s*working|what\s*next)\b"]),
]

# Fixed values: (reason, risk, action) of the policy steps after the text rules.
LOW_CONFIDENCE_STEP = (
    "LOW_CONFIDENCE_AMBIGUITY", "LOW",
    "Route query to human triage queue due to low model confidence and semantic ambiguity.")
PAST_CASE_STEP = (
    "PII_SECURITY_DM", "MEDIUM",
    "Escalate to tier-2 human support based on historical resolution pattern.")
AUTO_HANDLE_STEP = (
    "STANDARD_TROUBLESHOOTING", "MINIMAL",
    "Deploy grounded step-by-step resolution draft with relevant official Apple support documentation links.")

# Pattern that marks an outbound author as writing for the brand.
BRAND_SIGNALS = (
    r"(apple\.co|support\.apple|locate\.apple|iforgot\.apple|appleid\.apple|"
    r"apple\s*store|genius\s*bar|applecare|iphone|ipad|macbook|airpods|"
    r"apple\s*watch|ios\s*\d|macos|ipados|watchos)")

# Patterns that make a case HARD (no word boundaries).
HARD_CASE_PATTERNS = [r"[!]{2,}", r"(worst|terrible|sue|lawyer)", r"(swelling|fire|smoke)"]

# Keyword-baseline word lists and its escalation triggers (plain substrings).
BASELINE_KEYWORDS = {
    "OS_UPDATE_BUG": ["update", "ios", "crash", "bug", "freeze"],
    "HARDWARE_BATTERY": ["battery", "screen", "hot", "broken", "charge"],
    "ACCOUNT_ICLOUD_SECURITY": ["apple id", "password", "icloud", "locked"],
    "BILLING_SUBSCRIPTIONS": ["refund", "charged", "bill", "subscription", "money"],
    "CONNECTIVITY_SETUP": ["bluetooth", "wifi", "airpods", "pair", "service"],
    "REPAIR_WARRANTY_STATUS": ["applecare", "repair", "warranty", "appointment"],
    "GENERAL_FEEDBACK_CHURN": ["feedback", "worst", "hate", "love", "service"],
}
BASELINE_ESCALATION_WORDS = ["dm", "refund", "sue", "lawyer", "!"]

# Rubric word lists (plain substrings of the lower-cased reply or query).
ROBOTIC_PHRASES = ["as an ai", "sorry to inform"]
GROUNDED_PHRASES = ["apple.co", "support.apple.com", "locate.apple.com", "iforgot.apple.com",
                    "appleid.apple.com", "reportaproblem.apple.com", "settings >", "recovery mode"]
GENERIC_ADVICE_WORDS = ["restart", "reset", "update", "settings"]
WARM_PHRASES = ["we'd like to help", "we're here to help", "we understand",
                "let's work together", "thanks for reaching out"]
POLITE_PHRASES = ["we can help", "hello"]
ACTION_PHRASES = ["go to settings", "http", "apple.co", "send us a dm",
                  "locate.apple.com", "iforgot", "reportaproblem"]
WEAK_ACTION_PHRASES = ["restart", "check your settings"]
UNSAFE_PHRASES = ["password over tweet", "tweet your password", "post your credit card", "publicly share"]
HAZARD_WORDS = ["swelling", "swollen", "smoke", "burning", "fire"]
HAZARD_WARNINGS = ["stop using", "disconnect", "do not charge"]
