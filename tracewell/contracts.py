"""Fixed values of the wire contract.

Everything here is a value that results must agree with: field rules, limits,
word lists, reason strings and the response table.  The operators take these as
parameter defaults, so a caller (or a test) can pass others.
"""

from __future__ import annotations

# --- fixed values: record types, in processing order -----------------------------------------
TYPES = ("errors", "events", "logs", "javascript_errors")

# --- fixed values: limits ---------------------------------------------------------------------
TRUNCATION_SUFFIX = "... (truncated)"
REDACTED = "[REDACTED]"
MASKED = "***"
MAX_DEPTH = 20
MAX_DEPTH_MARKER = "[Max depth exceeded]"

MAX_ERROR_MESSAGE = 10_000
MAX_ERROR_TRACE = 5_000
MAX_FILE_PATH = 500
MAX_URL = 2_000
MAX_HEADERS = 50
MAX_HEADER_VALUE = 500
MAX_ARGV = 50
MAX_ARGV_VALUE = 500
MAX_SOURCE_FILE_BYTES = 1_048_576
MAX_PREVIEW_LINE = 2_000
PREVIEW_LINES = 11
PREVIEW_LINES_BEFORE = 5

MAX_LOG_MESSAGE = 50_000
MAX_LOG_CONTEXT_BYTES = 51_200
MAX_LOG_EXTRA_BYTES = 10_240
MAX_JS_CONTEXT_BYTES = 51_200
MAX_BREADCRUMB_DATA_BYTES = 5_120
MAX_BREADCRUMBS = 20

MAX_ITEM_BYTES = 71_680
MAX_ITEM_FIELD_BYTES = 8_192
MAX_EVENT_ITEM_BYTES = 5_120
MAX_BATCH_ITEMS = 1_000
MAX_BATCH_BYTES = 4_500_000
MAX_SPOOL_ITEMS = 5_000
SPOOL_TTL_SECONDS = 3_600
REPORT_BODY_LIMIT = 60_000
DEDUPE_CACHE = 50
PAUSE_SECONDS = 900
RATE_LIMIT_SUBSTITUTE_SECONDS = 60
REQUESTS_PER_MINUTE = 60
DIAGNOSTICS_DAYS = 14

CONTEXT_REASON = "Context exceeded 50KB limit and was removed"
EXTRA_REASON = "Extra data exceeded 10KB limit and was removed"
BREADCRUMB_REASON = "Breadcrumb data exceeded 5KB limit and was removed"
FIELD_REASON = "Field exceeded the per-item budget and was removed"

# --- fixed values: word lists -----------------------------------------------------------------
# Keys that contain one of these fragments carry a secret (our own list: see README).
SENSITIVE_FRAGMENTS = (
    "password",
    "passwd",
    "secret",
    "token",
    "api_key",
    "apikey",
    "api-key",
    "authorization",
    "signature",
    "credential",
)

SAFE_HEADERS = (
    "accept",
    "accept-charset",
    "accept-encoding",
    "accept-language",
    "cache-control",
    "connection",
    "content-length",
    "content-type",
    "host",
    "referer",
    "user-agent",
    "x-requested-with",
    "x-forwarded-proto",
    "x-forwarded-host",
)

IGNORED_BROWSER_ERRORS = (
    "ResizeObserver loop limit exceeded",
    "ResizeObserver loop completed with undelivered notifications",
    "Script error.",
    "Script error",
    "Failed to fetch",
    "NetworkError when attempting to fetch resource",
    "Network request failed",
    "Load failed",
    "Loading chunk",
    "ChunkLoadError",
    "cancelled",
    "canceled",
    "The operation was aborted",
    "AbortError",
    "Illegal invocation",
)

BROWSER_INFO_KEYS = (
    "screen_width",
    "screen_height",
    "viewport_width",
    "viewport_height",
    "device_memory",
    "hardware_concurrency",
    "connection_type",
)

STANDARD_EVENTS = (
    "product_added_to_cart",
    "product_removed_from_cart",
    "cart_viewed",
    "checkout_started",
    "checkout_completed",
    "sale",
    "user_registered",
    "user_logged_in",
    "user_logged_out",
    "page_view",
    "search",
    "newsletter_signup",
    "contact_form_submitted",
)

FORBIDDEN_EVENT_NAMES = ("test", "bot_action", "fake_event", "debug")

LOG_LEVELS = {
    "debug": 0,
    "info": 1,
    "notice": 2,
    "warning": 3,
    "error": 4,
    "critical": 5,
    "alert": 6,
    "emergency": 7,
}

FATAL_SEVERITIES = (1, 4, 16, 64)

FEATURE_DEFAULTS = {"errors": True, "events": True, "logs": False, "javascript_errors": False}

# --- fixed values: delivery -------------------------------------------------------------------
# type -> (path, wrapper, feature, timeout key)
ENDPOINTS = {
    "errors": ("/errors/store", "errors", "Errors", "errors.timeout"),
    "events": ("/events/store", "events", "Events", "events.timeout"),
    "logs": ("/logs/store", "logs", "Logs", "logging.timeout"),
    "javascript_errors": (
        "/javascript-errors/store",
        "javascript_errors",
        "JavaScriptErrors",
        "javascript_errors.timeout",
    ),
}

# status -> (requeue, drop, pause scope, pause seconds, reason, transient, severity, diagnostic)
DECISIONS = {
    0: (True, False, "feature", 900, "network", True, "error", "Network error during batch send"),
    200: (False, False, "none", None, "200", False, None, None),
    401: (True, False, "global", 900, "401", False, "error", "API authentication failed, invalid or revoked API key"),
    403: (True, False, "feature", 900, "403", False, "error", "API request forbidden"),
    413: (False, True, "feature", 900, "413", False, "critical", "Payload too large, indicates a client bug"),
    422: (False, True, "feature", 900, "422", False, "error", "Validation failed, indicates schema drift or malformed items"),
    429: (True, False, "feature", None, "429", False, "warning", "Rate limit exceeded"),
}
SERVER_ERROR_DIAGNOSTIC = "Server error during batch processing"
UNEXPECTED_STATUS_DIAGNOSTIC = "Unexpected API response status"
FAILED_ITEMS_DIAGNOSTIC = "Some items failed during processing"
UNPROCESSED_ITEMS_DIAGNOSTIC = "Some items were not processed due to timeout"
FALLBACK_MESSAGES = {
    0: "Unknown network error",
    401: "Unauthorized",
    403: "Forbidden",
    413: "Payload Too Large",
    422: "Unprocessable Entity",
}

# --- fixed values: field rules ----------------------------------------------------------------
RULES = {
    "errors": {
        "message": {"required": True, "type": "string", "max": 10000},
        "file": {"required": True, "type": "string", "max": 1000},
        "line": {"required": True, "type": "integer"},
        "type": {"required": True, "type": "string", "max": 255},
        "environment": {"required": True, "type": "string", "max": 50},
        "timestamp": {"required": True, "type": "date"},
        "trace": {"type": "string", "max": 5000},
        "headers": {"type": "array", "max": 50},
        "headers.*": {"type": "array"},
        "headers.*.*": {"type": "string", "max": 500},
        "context": {"type": "string", "max": 30000},
        "highlight_line": {"type": "integer"},
        "user": {"type": "array"},
        "user.*": {},
        "url": {"type": "string", "max": 2000},
        "method": {"type": "string", "enum": ["GET", "POST", "PUT", "PATCH", "DELETE", "HEAD", "OPTIONS"]},
        "php_version": {"type": "string", "max": 20},
        "framework": {"type": "string", "max": 50},
        "framework_version": {"type": "string", "max": 50},
        "is_console": {"type": "boolean"},
        "console_command": {"type": "string", "max": 1000},
        "console_arguments": {"type": "array", "max": 50},
        "console_arguments.*": {"type": "string", "max": 500},
    },
    "events": {
        "event_name": {"required": True, "type": "string", "min": 3, "max": 50, "pattern": "^[a-z][a-z0-9_]*$"},
        "timestamp": {"required": True, "type": "date"},
        "properties": {"type": "array"},
        "properties.*": {},
        "user": {"type": "array"},
        "user.*": {},
        "url": {"type": "string", "max": 2000},
        "user_agent_hash": {"type": "string", "size": 64},
        "session_id_hash": {"type": "string", "size": 64},
    },
    "logs": {
        "level": {
            "required": True,
            "type": "string",
            "enum": ["emergency", "alert", "critical", "error", "warning", "notice", "info", "debug"],
        },
        "message": {"required": True, "type": "string", "max": 50000},
        "channel": {"required": True, "type": "string", "max": 255},
        "timestamp": {"required": True, "type": "date"},
        "context": {"type": "array"},
        "extra": {"type": "array"},
    },
    "javascript_errors": {
        "message": {"required": True, "type": "string", "max": 2000},
        "timestamp": {"required": True, "type": "date"},
        "url": {"required": True, "type": "string", "max": 2000},
        "stack": {"type": "string", "max": 10000},
        "type": {"type": "string", "max": 100},
        "filename": {"type": "string", "max": 500},
        "line": {"type": "integer"},
        "column": {"type": "integer"},
        "user_agent": {"type": "string"},
        "environment": {"type": "string", "max": 50},
        "user_id": {},
        "session_id": {"type": "string", "max": 255},
        "breadcrumbs": {"type": "array", "max": 20},
        "breadcrumbs.*.timestamp": {"required": True, "type": "date"},
        "breadcrumbs.*.category": {"required": True, "type": "string", "max": 100},
        "breadcrumbs.*.message": {"required": True, "type": "string", "max": 500},
        "breadcrumbs.*.data": {"type": "array"},
        "context": {"type": "array"},
        "browser_info": {"type": "array"},
        "browser_info.screen_width": {"type": "integer"},
        "browser_info.screen_height": {"type": "integer"},
        "browser_info.viewport_width": {"type": "integer"},
        "browser_info.viewport_height": {"type": "integer"},
        "browser_info.device_memory": {"type": "number"},
        "browser_info.hardware_concurrency": {"type": "integer"},
        "browser_info.connection_type": {"type": "string"},
    },
}
STRICT_TYPES = ("errors",)
LEGACY_FIELDS = {"errors": ("laravel_version",)}
LEGACY_FRAMEWORK = {"laravel_version": "laravel"}

# --- fixed values: browser reports, before they are shaped --------------------------------------

# What the relay answers about a field that breaks its rule.
REPORT_PROBLEM_TEXTS = {
    "subject": ("The ", " field "),
    "required": "is required.",
    "string": "must be a string.",
    "longer": ("must not be greater than ", " characters."),
    "integer": "must be an integer.",
    "number": "must be a number.",
    "array": "must be an array.",
}

# The rules: (field, kind, required, max length)
BROWSER_REPORT_RULES = (
    ("message", "string", True, 2000),
    ("stack", "string", False, 10000),
    ("type", "string", False, 100),
    ("filename", "string", False, 500),
    ("line", "integer", False, None),
    ("column", "integer", False, None),
    ("url", "string", True, 2000),
    ("timestamp", "string", False, 64),
    ("breadcrumbs", "array", False, None),
    ("context", "array", False, None),
    ("browser_info", "array", False, None),
)
BREADCRUMB_RULES = (
    ("timestamp", "string", True, 64),
    ("category", "string", True, 100),
    ("message", "string", True, 500),
    ("data", "array", False, None),
)
CONNECTION_TYPE_MAX = 50


def top_level_fields(record_type: str) -> tuple[str, ...]:
    """Declared top-level field names of a record type, in contract order."""
    return tuple(path for path in RULES[record_type] if "." not in path)
