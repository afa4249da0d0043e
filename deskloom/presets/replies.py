"""Default reply texts."""

# Reply by escalation reason, and the reply for every other reason.
ESCALATION_REPLIES = {
    "HARDWARE_PHYSICAL_DAMAGE": "Your safety and device care are our priority. Please disconnect the charger and stop using the device. Send us a DM or visit https://locate.apple.com to book an immediate service appointment.",
    "HIGH_SENTIMENT_CHURN_RISK": "We sincerely apologize for the frustrating experience. We want to make this right. Please send us a DM with your case details and phone number so a senior specialist can assist you directly.",
    "BILLING_REFUND_AUTH": "We want to help resolve this billing concern quickly. Please submit a refund request at https://reportaproblem.apple.com or send us a DM with your Apple ID email for review.",
    "LOW_CONFIDENCE_AMBIGUITY": "We'd like to look into this with you! Please send us a DM with more details about your device model and what troubleshooting steps you've tried so far: https://apple.co/dm.",
}
OTHER_ESCALATION_REPLY = "We'd like to look into this securely with you. Please send us a DM with your details or visit https://iforgot.apple.com for account security: https://apple.co/dm."

# Replies chosen by a word in the message, tried in this order.
KEYWORD_REPLIES = [
    (["airpod", "earbud"],
     "We'd like to help with your AirPods. Place both AirPods in the case, open the lid, and hold the setup button for 15 seconds to reset them: https://apple.co/reset-airpods."),
    (["password", "passcode", "apple id", "locked"],
     "Account security is our top priority. We cannot process credentials over Twitter. You can securely reset your password or manage your account at https://iforgot.apple.com or DM us for guidance."),
]

# Reply by class, and the reply for every other class.
CLASS_REPLIES = {
    "OS_UPDATE_BUG": "We'd like to help get this resolved. Have you tried a force restart on your device? Follow these steps: https://apple.co/force-restart. Let us know if the issue persists!",
    "HARDWARE_BATTERY": "We can help you review your hardware and battery health. You can check warranty status and find authorized service providers near you at https://locate.apple.com.",
    "ACCOUNT_ICLOUD_SECURITY": "Account security is our priority. You can securely reset passwords at https://iforgot.apple.com and manage security at https://appleid.apple.com.",
    "BILLING_SUBSCRIPTIONS": "You can view your active subscriptions, recent purchases, and submit refund requests directly at https://reportaproblem.apple.com.",
    "CONNECTIVITY_SETUP": "Let's troubleshoot your connection. For AirPods, reset them in the case (https://apple.co/reset-airpods). For cellular or Wi-Fi, toggle Airplane Mode and check Settings > General > About for carrier updates.",
    "REPAIR_WARRANTY_STATUS": "You can easily check your warranty coverage, AppleCare+ status, and schedule Genius Bar appointments at https://checkcoverage.apple.com.",
}
OTHER_CLASS_REPLY = "Thank you for reaching out to Apple Support! You can submit direct product feedback to our engineering teams anytime at https://apple.com/feedback."

# The canned reply of the majority baseline, and the parts of the keyword baseline's reply.
CANNED_REPLY = "Thank you for reaching out to Apple Support. Please restart your device or visit apple.com for assistance."
KEYWORD_REPLY_HEAD = "Hello! We can help with your "
KEYWORD_REPLY_TAIL = " question. Please check our support website or reply if you need more help."
KEYWORD_REPLY_DM = " Please send a DM."

# Calibration tiers: (tier reply or None for the case's own reply, four scores).
RATING_TIERS = [
    (None, (5, 5, 5, 5)),
    ("We can help you with this issue. Please check your settings and restart your phone. Let us know if you need anything else.", (3, 4, 3, 5)),
    ("As an AI, I am sorry to inform you that you should contact Apple support at apple.com.", (2, 2, 2, 4)),
]

# Notes of the twenty manually rated cases, by position.
MANUAL_NOTES = [
    "Accurate troubleshooting steps with correct Apple URL. Well-calibrated tone.",
    "Reply addresses the core issue directly. DM redirect is appropriate for this case.",
    "Good empathy statement, but the suggested link is slightly generic for the specific issue.",
    "Correct escalation decision — safety concern warranted immediate DM.",
    "Reply is actionable but lacks the specific Settings path the user would need.",
    "Excellent brand voice — warm, concise, and professional.",
    "The reference URL is correct and specific to this device model.",
    "Appropriate security guidance — correctly refuses public credential handling.",
    "Reply correctly identifies hardware failure mode over software bug.",
    "Billing redirect to reportaproblem.apple.com is the correct flow.",
    "Medium quality — generic restart suggestion doesn't address root cause.",
    "Vague reply with no specific steps or links. Would frustrate the customer.",
    "Acceptable tone but missing specific Apple support URL.",
    "Generic 'contact support' advice without actionable detail. Poor.",
    "Correctly identifies churn risk and routes to senior specialist.",
    "Low quality — 'As an AI' framing breaks Apple brand voice completely.",
    "Missing safety warning for a hardware hazard case. Critical failure.",
    "Redundant restart suggestion for what is clearly a hardware defect.",
    "Good DM redirect but should include urgency language for account security.",
    "Reply is well-grounded but slightly too verbose for Twitter's 280 char limit.",
]

# Note formats of the programmatically rated cases, by tier ({cls} and {difficulty} are filled in).
TIER_NOTES = [
    "High quality reference reply for '{cls}' intent.",
    "Generic troubleshooting reply — lacks specificity for {difficulty} difficulty case.",
    "Ungrounded 'As an AI' response inappropriate for {cls} queries.",
]
