"""Fixed values of the ticket domain: word lists, labels, thresholds and formats."""

# Keyword sets behind the five topic flags, matched as whole words.
KEYWORDS = {
    "network": ["network", "wifi", "vpn", "connect", "internet", "lan", "router"],
    "printer": ["printer", "imprimante", "print", "scan", "scanner"],
    "security": ["security", "securite", "password", "login", "access", "breach", "hack", "malware"],
    "hardware": ["hardware", "laptop", "pc", "macbook", "screen", "disk", "ssd", "cpu"],
    "software": ["software", "app", "update", "bug", "crash", "install", "version"],
}

# Fragments searched in production log text, matched anywhere.
SUBSTRINGS = {
    "network": ["network", "vpn"],
    "printer": ["printer"],
    "security": ["security", "password"],
    "hardware": ["hardware", "laptop"],
    "software": ["software", "install"],
}

# Class names of the refined queue.
SECURITY_QUEUE = "Security / Access"
HARDWARE_QUEUE = "Hardware / Device"
PRINTER_QUEUE = "Printer / Peripherals"
NETWORK_QUEUE = "Network / Infrastructure"
SOFTWARE_QUEUE = "Software / Product"
OUTAGE_QUEUE = "Service Outages"
GENERAL_QUEUE = "General Technical Support"

# Source queues with a class of their own.
PRODUCT_SUPPORT = "Product Support"
OUTAGES_AND_MAINTENANCE = "Service Outages and Maintenance"

# Labels a user correction may carry.
FEEDBACK_QUEUES = ["network", "hardware", "software", "security", "printer", "other"]
FEEDBACK_URGENCIES = ["low", "medium", "high", "critical"]

# Class that each short correction label stands for.
FEEDBACK_CLASS = {
    "network": NETWORK_QUEUE,
    "hardware": HARDWARE_QUEUE,
    "software": SOFTWARE_QUEUE,
    "security": SECURITY_QUEUE,
    "printer": HARDWARE_QUEUE,
    "other": GENERAL_QUEUE,
}

# The numeric feature columns, in order.
LENGTH_FEATURES = ["body_length", "answer_length", "response_ratio"]
FLAG_FEATURES = ["has_network", "has_printer", "has_security", "has_hardware", "has_software"]
NUMERIC_FEATURES = LENGTH_FEATURES + FLAG_FEATURES

# Limits and thresholds.
MAX_QUERY_CHARS = 5000
MIN_DETECTABLE_CHARS = 20
MIN_DRIFT_ROWS = 100
COLUMN_DRIFT_THRESHOLD = 0.1
DATASET_DRIFT_SHARE = 0.5
RETRAIN_SHARE = 0.05
MIN_F1_QUEUE = 0.70
MIN_F1_URGENCY = 0.65
SIMILARITY_THRESHOLD = 0.4
TOP_K = 5
EMBEDDING_DIM = 384
VOCABULARY_SIZE = 5000
CACHE_TEXT_CHARS = 1000
DEFAULT_MODEL_NAME = "all-MiniLM-L6-v2"

# Words that mark a message needing no prediction, by intent in order of priority.
INTENT_WORDS = {
    "gratitude": ["merci", "thanks", "thank you", "thx"],
    "success": ["ca marche", "ça marche", "c'est bon", "c bon", "ca fonctionne", "ça fonctionne",
                "resolu", "résolu"],
    "positive": ["super", "cool", "parfait", "top", "nickel", "genial", "génial", "excellent", "impec"],
    "confirmation": ["ok", "d'accord", "compris", "entendu", "noté"],
}
CONFIRMATION_MAX_CHARS = 20

# Text formats.
PHONE_MASK = "<tel>"
SNAPSHOT_FORMAT = "yyyyMMdd_HHmmss"
SQL_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
NO_CONTEXT = "[AUCUN DOCUMENT PERTINENT TROUVE DANS LA BASE DE CONNAISSANCES]"
DOC_PROBLEM_HEADER = "Problème :"
DOC_ANSWER_HEADER = "Réponse agent typique :"
USER_MESSAGE_LABELS = ["Categorie:", "Urgence:", "Contexte:", "Question:"]
