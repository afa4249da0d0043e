"""Class taxonomy and reason codes of the default support domain."""

# Class code, display name, description, typical keywords; list order is the tie-break order.
TAXONOMY = [
    ("OS_UPDATE_BUG", "OS Update & Software Glitches",
     "Issues arising after iOS/macOS/watchOS/iPadOS updates, app crashing, system freezing, lag, boot loops, or software bugs.",
     ["update", "ios", "macos", "version", "lag", "crash", "freeze", "bug", "glitch", "battery drain after update", "reboot"]),
    ("HARDWARE_BATTERY", "Hardware & Battery Health",
     "Physical device defects, degraded battery capacity, overheating, charging port issues, speaker/mic failure, broken glass.",
     ["battery", "draining", "health", "screen", "cracked", "overheating", "hot", "charger", "cable", "speaker", "microphone", "camera"]),
    ("ACCOUNT_ICLOUD_SECURITY", "Apple ID, iCloud & Account Security",
     "Locked Apple ID, forgotten passwords, 2-Factor Authentication issues, iCloud storage full/sync errors, suspicious login alerts.",
     ["apple id", "password", "locked", "icloud", "storage", "sync", "backup", "hacked", "2fa", "verification code", "disabled"]),
    ("BILLING_SUBSCRIPTIONS", "Billing, App Store & Subscriptions",
     "Unexpected App Store charges, subscription management/cancellation, refund requests, payment method declines, double billing.",
     ["charged", "refund", "subscription", "cancel", "bill", "invoice", "receipt", "purchase", "credit card", "payment declined"]),
    ("CONNECTIVITY_SETUP", "Connectivity, Bluetooth & Accessories Setup",
     "Wi-Fi dropouts, cellular data issues, Bluetooth pairing with AirPods/Apple Watch/CarPlay, AirDrop failures.",
     ["wifi", "wi-fi", "bluetooth", "airpods", "apple watch", "pairing", "connect", "airdrop", "cellular", "no service", "hotspot"]),
    ("REPAIR_WARRANTY_STATUS", "Repair, AppleCare+ & Genius Bar",
     "Checking warranty coverage, AppleCare+ claims, Genius Bar appointment scheduling, repair turnaround status, service quotes.",
     ["applecare", "warranty", "genius bar", "appointment", "repair", "service center", "quote", "replacement", "cost to fix"]),
    ("GENERAL_FEEDBACK_CHURN", "General Inquiries & Customer Feedback",
     "Brand feedback, product feature praise or complaints, feature requests, high-level non-technical queries, or general sentiment.",
     ["hate", "love", "feedback", "feature request", "why did apple", "switching to android", "worst", "recommend", "suggestion"]),
]

CLASSES = [row[0] for row in TAXONOMY]
CLASS_NAMES = {row[0]: row[1] for row in TAXONOMY}
DEFAULT_CLASS = "GENERAL_FEEDBACK_CHURN"

# Escalation reason code -> description.
ESCALATION_REASONS = {
    "PII_SECURITY_DM": "Requires customer Private Identifying Information (Apple ID email, serial number, IMEI) or secure diagnostic links.",
    "BILLING_REFUND_AUTH": "Requires financial authorization, chargeback review, or direct App Store refund processing.",
    "HARDWARE_PHYSICAL_DAMAGE": "Physical hardware damage or safety hazard (swollen battery, cracked enclosure) needing in-person Genius Bar inspection.",
    "HIGH_SENTIMENT_CHURN_RISK": "Extreme customer frustration, legal threats, or active churn risk requiring senior human empathy.",
    "LOW_CONFIDENCE_AMBIGUITY": "Customer query is ambiguous, contradictory, or model confidence is below reliability threshold.",
    "MULTI_INTENT_COMPLEX": "Complex multi-faceted issue with compounding root causes.",
}
UNKNOWN_REASON_TEXT = "Requires specialist human intervention."

# Auto-handle reason code -> description.
AUTO_HANDLE_REASONS = {
    "STANDARD_TROUBLESHOOTING": "Standard self-serve troubleshooting steps available (e.g., force restart, network reset, software update check).",
    "PUBLIC_DOCS_GUIDE": "Public Apple support guide and knowledge-base article directly addresses the inquiry.",
    "GENERAL_INFORMATIONAL": "General feature question or non-sensitive status inquiry with clear resolution.",
}

# Decisions and brand account names.
ESCALATE = "ESCALATE_TO_HUMAN"
AUTO_HANDLE = "AUTO_HANDLE"
BRAND_AUTHOR = "AppleSupport"
BRAND_HANDLE = "@AppleSupport"
