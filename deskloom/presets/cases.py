"""Sample corpus rows, templates and adversarial evaluation rows of the default domain."""

# Seed corpus rows (customer_text, intent, agent_text, auto_handle, escalation_reason).
SEED_CASES = [
    ("@AppleSupport My iPhone 13 restarted randomly after the iOS 17.2 update and now keeps freezing on the lock screen. Any fix?",
     "OS_UPDATE_BUG",
     "We'd like to help with your iPhone freezing after the update. Have you tried a force restart yet? Follow these steps: https://apple.co/force-restart. If the issue persists, let us know!",
     True, "STANDARD_TROUBLESHOOTING"),
    ("@AppleSupport My iPhone 12 battery health dropped from 89% to 76% in just two weeks and the back feels unusually hot while charging.",
     "HARDWARE_BATTERY",
     "Safety and battery performance are top priorities. Please send us a DM so we can run a remote hardware diagnostic on your battery health and thermal sensors: https://apple.co/dm",
     False, "PII_SECURITY_DM"),
    ("@AppleSupport My Apple ID was locked for security reasons and the recovery phone number is an old number I no longer have access to.",
     "ACCOUNT_ICLOUD_SECURITY",
     "Account security is our top priority. You can initiate the automated Account Recovery process at https://iforgot.apple.com. Please DM us if you have questions about the recovery status timeline.",
     False, "PII_SECURITY_DM"),
    ("@AppleSupport I was charged $29.99 for an app subscription I canceled during the free trial. I need a refund immediately.",
     "BILLING_SUBSCRIPTIONS",
     "We understand your concern with unexpected charges. You can view your purchase history and submit a refund request directly at https://reportaproblem.apple.com. Let us know if you encounter any errors!",
     True, "PUBLIC_DOCS_GUIDE"),
    ("@AppleSupport My AirPods Pro (2nd gen) keep disconnecting every 5 minutes during phone calls on iPhone 14 Pro.",
     "CONNECTIVITY_SETUP",
     "We'd like to help with your AirPods disconnecting. Place both AirPods in the case, open the lid, press and hold the setup button for 15 seconds until the light flashes amber then white. Guide: https://apple.co/reset-airpods",
     True, "STANDARD_TROUBLESHOOTING"),
    ("@AppleSupport How do I check if my MacBook Air still has active AppleCare+ coverage? I bought it refurbished.",
     "REPAIR_WARRANTY_STATUS",
     "You can check your coverage status instantly! Enter your serial number at https://checkcoverage.apple.com to view warranty status, AppleCare+ eligibility, and service options.",
     True, "PUBLIC_DOCS_GUIDE"),
    ("@AppleSupport Honestly Apple's customer service has gone downhill completely. Waited on hold for 2 hours yesterday and got disconnected. Unacceptable!",
     "GENERAL_FEEDBACK_CHURN",
     "We are deeply sorry to hear about your experience and the long hold time. We take service feedback very seriously. Please DM us with your details so a senior specialist can connect with you directly.",
     False, "HIGH_SENTIMENT_CHURN_RISK"),
    ("@AppleSupport The MacBook Pro 2019 battery is physically swelling and pushing the trackpad up! Is this dangerous?",
     "HARDWARE_BATTERY",
     "Please stop using and charging the MacBook immediately for your safety. Please DM us right away or contact Apple Support phone support so an advisor can arrange priority battery service.",
     False, "HARDWARE_PHYSICAL_DAMAGE"),
    ("@AppleSupport I received an email claiming my Apple ID was accessed from Russia with a link to confirm my password. Is this legitimate?",
     "ACCOUNT_ICLOUD_SECURITY",
     "Do not click any links in that email! That sounds like a phishing attempt. Check your real Apple ID security settings directly at https://appleid.apple.com and forward the suspicious email to reportphishing@apple.com.",
     True, "PUBLIC_DOCS_GUIDE"),
    ("@AppleSupport My credit card was charged 4 times for the same movie rental on Apple TV. Bank says it went through to Apple.",
     "BILLING_SUBSCRIPTIONS",
     "We want to make sure your billing is resolved. Please send us a DM with your Apple ID email so our billing specialist team can review the duplicate invoice transactions.",
     False, "BILLING_REFUND_AUTH"),
    ("@AppleSupport My iPhone says 'No Service' or 'Searching...' constantly after landing at the airport even with cellular roaming enabled.",
     "CONNECTIVITY_SETUP",
     "We want to help you get connected. Try toggling Airplane Mode on for 15 seconds, then check Settings > General > About for a Carrier Settings Update prompt. More steps: https://apple.co/no-service",
     True, "STANDARD_TROUBLESHOOTING"),
    ("@AppleSupport Sent my iPhone in for repair 10 days ago (Repair ID: R94829103). The status has been stuck on 'Diagnosing' for a week with no update.",
     "REPAIR_WARRANTY_STATUS",
     "We understand your concern with your repair timeline. Please send us a DM with your Repair ID and contact email so we can reach out to the repair center for an update.",
     False, "PII_SECURITY_DM"),
    ("@AppleSupport Just wanted to say the trade-in process at the Covent Garden Apple Store was incredible. Staff was super friendly and fast!",
     "GENERAL_FEEDBACK_CHURN",
     "Thank you so much for taking the time to share this wonderful feedback! We'll be sure to pass along your kind words to the team at Apple Covent Garden. Have a great day!",
     True, "GENERAL_INFORMATIONAL"),
    ("@AppleSupport Safari crashes instantly every time I try to open a new tab on macOS Sonoma. Happens even in Safe Mode.",
     "OS_UPDATE_BUG",
     "Thanks for reaching out! Since this occurs in Safe Mode as well, please send us a DM with your exact macOS build number and we can look into deeper troubleshooting steps with you.",
     False, "PII_SECURITY_DM"),
]

# Message templates by class (customer text, agent text, auto_handle, escalation_reason).
TEMPLATES = {
    "OS_UPDATE_BUG": [
        ("My {device} is stuck in a boot loop after installing {os_ver}.", "We'd like to help with your {device}. Try connecting to a computer in Recovery Mode to reinstall without data loss: https://apple.co/recovery", True, "STANDARD_TROUBLESHOOTING"),
        ("Apps keep crashing on {device} ever since the latest update.", "Let's troubleshoot app crashes. Check the App Store for updates, force close the app, and restart your {device}.", True, "STANDARD_TROUBLESHOOTING"),
        ("Battery is draining twice as fast after {os_ver} on {device}.", "After major updates, background indexing can cause temporary battery drain for 24-48 hours. Check Settings > Battery for app breakdown.", True, "STANDARD_TROUBLESHOOTING"),
    ],
    "HARDWARE_BATTERY": [
        ("My {device} battery maximum capacity dropped below 80% with service warning.", "A battery capacity below 80% qualifies for replacement under AppleCare+. Check options at https://locate.apple.com or DM us.", False, "PII_SECURITY_DM"),
        ("Camera lens on my {device} won't focus and rattles when shaking.", "We want to help with your camera focus issue. You can visit an Apple Store or authorized service center for hardware assessment.", True, "PUBLIC_DOCS_GUIDE"),
    ],
    "ACCOUNT_ICLOUD_SECURITY": [
        ("I can't sign in to my Apple ID because I lost my trusted phone number.", "You can begin the account recovery process at https://iforgot.apple.com. Feel free to DM us if you need guidance through the steps.", False, "PII_SECURITY_DM"),
        ("iCloud Photos won't sync between my {device} and Mac.", "Ensure iCloud Photos is toggled on in Settings > [Your Name] > iCloud > Photos on both devices, and that you have sufficient iCloud storage.", True, "STANDARD_TROUBLESHOOTING"),
    ],
    "BILLING_SUBSCRIPTIONS": [
        ("Why was I billed for Apple TV+ when I have 3 free months with my new {device}?", "To redeem promotional trials, follow the prompt inside the Apple TV app. You can review charges and request a refund at https://reportaproblem.apple.com.", True, "PUBLIC_DOCS_GUIDE"),
        ("Where do I cancel my Apple Arcade subscription so it doesn't renew?", "Go to Settings > [Your Name] > Subscriptions > tap Apple Arcade > Cancel Subscription.", True, "STANDARD_TROUBLESHOOTING"),
    ],
    "CONNECTIVITY_SETUP": [
        ("Bluetooth turns off automatically on my {device} every few minutes.", "Try resetting network settings via Settings > General > Transfer or Reset > Reset > Reset Network Settings.", True, "STANDARD_TROUBLESHOOTING"),
        ("Personal Hotspot doesn't appear on my {device} anymore.", "Check with your carrier to ensure hotspot provisioning is active, then toggle Cellular Data in Settings.", True, "STANDARD_TROUBLESHOOTING"),
    ],
    "REPAIR_WARRANTY_STATUS": [
        ("What is the warranty coverage on Apple Pencil replacement tips?", "Apple Pencil accessories carry a one-year limited warranty against manufacturing defects. Check coverage at https://checkcoverage.apple.com.", True, "PUBLIC_DOCS_GUIDE"),
        ("How do I book an appointment at the Apple Store for a screen replacement?", "You can schedule a Genius Bar reservation via the Apple Support app or online at https://locate.apple.com.", True, "PUBLIC_DOCS_GUIDE"),
    ],
    "GENERAL_FEEDBACK_CHURN": [
        ("Switching to Samsung after 10 years because of battery issues on {device}!", "We're sorry to hear about your frustration. If you'd like us to inspect your battery performance before making a switch, please DM us.", False, "HIGH_SENTIMENT_CHURN_RISK"),
        ("I love the new Action Button feature on {device}! Great job Apple team.", "We're thrilled to hear you're loving the new Action Button! Thanks for sharing your feedback with us.", True, "GENERAL_INFORMATIONAL"),
    ],
}

# Slot fillers of the templates.
DEVICES = ["iPhone 13", "iPhone 14 Pro", "iPhone 15", "iPhone 15 Pro Max", "iPad Air",
           "iPad Pro", "MacBook Pro 14", "MacBook Air M2", "Apple Watch Series 9"]
OS_VERSIONS = ["iOS 17.1", "iOS 17.2", "iOS 17.3", "macOS Sonoma", "watchOS 10.2", "iPadOS 17"]

# Source tags of corpus rows.
REAL_SOURCE = "kaggle_twcs"
SYNTHETIC_SOURCE = "synthetic_fallback"
ADVERSARIAL_SOURCE = "constructed_adversarial"

# Notes of sampled evaluation rows.
REAL_SAMPLE_NOTE = "Sampled from Kaggle dataset."
SYNTHETIC_SAMPLE_NOTE = "Sampled from synthetic corpus."

# Adversarial evaluation rows
# (id, customer_tweet, ground_truth_intent, reference_reply, escalated, reason, difficulty, notes).
ADVERSARIAL_CASES = [
    ("gold_adv_001", "@AppleSupport WatchOS 10 completely ruined my battery life and my Apple Watch battery swells up when on the magnetic charger!!",
     "HARDWARE_BATTERY", "Please stop charging and wearing the Apple Watch immediately. Send us a DM so an advisor can arrange immediate hardware inspection.",
     True, "HARDWARE_PHYSICAL_DAMAGE", "HARD", "Adversarial multi-intent: software update mentioned but physical swelling is the priority."),
    ("gold_adv_002", "@AppleSupport Brilliant new feature in iOS 17 where alarms just decide to stay completely silent and make me late for work! 😡",
     "OS_UPDATE_BUG", "We understand how frustrating missed alarms are. Check Settings > Face ID & Attention and try toggling 'Attention Aware Features' off.",
     False, "STANDARD_TROUBLESHOOTING", "HARD", "Sarcastic complaint — inverted polarity, not positive feedback."),
    ("gold_adv_003", "@AppleSupport I forgot my Apple ID passcode and my device is disabled. Can you reset it for me over Twitter?",
     "ACCOUNT_ICLOUD_SECURITY", "We cannot reset passwords over social media for security. You can reset your password securely at https://iforgot.apple.com.",
     False, "PUBLIC_DOCS_GUIDE", "MEDIUM", "PII phishing trap — must NOT attempt password reset publicly."),
    ("gold_adv_004", "@AppleSupport Wi-Fi button on my iPhone is greyed out and Bluetooth toggle spins forever.",
     "CONNECTIVITY_SETUP", "A greyed-out Wi-Fi toggle can indicate a hardware module issue. Please DM us so we can guide you on diagnostic and repair options.",
     True, "PII_SECURITY_DM", "HARD", "Hardware vs. software ambiguity — greyed Wi-Fi = hardware IC failure."),
    ("gold_adv_005", "@AppleSupport Done that already. Still not working.",
     "GENERAL_FEEDBACK_CHURN", "We'd like to help further. Could you send us a DM with more details about what you've tried so far?",
     True, "LOW_CONFIDENCE_AMBIGUITY", "HARD", "Context truncation — isolated follow-up with no prior context."),
    ("gold_adv_006", "@AppleSupport You guys charged my bank account $120 for an annual Tinder subscription I never agreed to! Refund me now or I'm calling my lawyer.",
     "BILLING_SUBSCRIPTIONS", "We understand your concern. You can view all purchases and submit a refund request at https://reportaproblem.apple.com. DM us if you need help.",
     True, "BILLING_REFUND_AUTH", "HARD", "High frustration + legal threat over disputed charge."),
    ("gold_adv_007", "@AppleSupport Someone in another state just logged into my Apple ID and changed my trusted phone number! HELP PLEASE!",
     "ACCOUNT_ICLOUD_SECURITY", "Please DM us immediately so our security team can assist you with securing your Apple ID account right away.",
     True, "PII_SECURITY_DM", "HARD", "Account takeover — high urgency security incident."),
    ("gold_adv_008", "@AppleSupport 3 hours at the retail store today and your staff refused to honor my AppleCare+! I want a supervisor right now!",
     "GENERAL_FEEDBACK_CHURN", "We are very sorry for the frustrating retail store experience. Please DM us your store location and case number so a senior supervisor can follow up.",
     True, "HIGH_SENTIMENT_CHURN_RISK", "HARD", "Severe in-store escalation request."),
    ("gold_adv_009", "@AppleSupport my iphone is literally on fire rn omg what do i do",
     "HARDWARE_BATTERY", "Move away from the device immediately. Do NOT attempt to charge or use it. Call emergency services if needed, then DM us for urgent support.",
     True, "HARDWARE_PHYSICAL_DAMAGE", "HARD", "Extreme safety hazard — fire. Slang/abbreviations (rn, omg)."),
    ("gold_adv_010", "@AppleSupport this update is absolute fire 🔥🔥🔥 love the new features",
     "GENERAL_FEEDBACK_CHURN", "We're thrilled you're enjoying the update! Thanks for sharing your feedback with us.",
     False, "GENERAL_INFORMATIONAL", "HARD", "False positive trap — 'fire' is slang for good, not a safety hazard."),
]
