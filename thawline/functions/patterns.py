"""Regular expressions used by classification and parsing.

Every pattern is written once, in the dialect subset shared by Java regex
(Spark) and RE2 (the DuckDB oracle).  ``java()`` adds the Java-only flag
``(?d)`` so that ``.`` stops only at ``\\n`` (as in Python), not at ``\\r``.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Must equal the archive tool's classification rules.
# ---------------------------------------------------------------------------
PREFIXES = ("host::", "source::", "sourcetype::")
ACCESS_SOURCETYPE = r"(access|apache|nginx|iis|httpd|lb)"
SYSLOG_SOURCETYPE = r"syslog"
ACCESS_SOURCE = r"(/var/log/(nginx|apache2?|httpd)|access\.log)"
SYSLOG_SOURCE = r"/var/log/syslog"
ACCESS_MESSAGE = (
    r"^\S+\s+\S+\s+\S+\s+\[[^\]]+\]\s+\""
    r"(?:GET|POST|PUT|DELETE|HEAD|OPTIONS|PATCH|CONNECT|TRACE)\s"
)
SYSLOG_MESSAGE = r"^<\d+>[A-Z][a-z]{2}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}\s+\S+"
CLOUD_TRAIL_SOURCETYPE = r"aws:cloudtrail"
VPC_FLOW_SOURCETYPE = r"aws:cloudwatchlogs:vpcflow"
# Router default kind (re-parse of stored documents): sourcetype only, no "lb".
ROUTER_ACCESS_SOURCETYPE = r"(access|nginx|apache|httpd|iis)"
ROUTER_SYSLOG_SOURCETYPE = r"syslog"
# Indices whose raw bytes are always read as Latin-1.
LATIN1_INDICES = ("apache", "nginx", "syslog", "vpc_flowlogs")
# Reasons for message-based and fallback classification.
REASON_ACCESS_MESSAGE = "message=access_log_pattern"
REASON_SYSLOG_MESSAGE = "message=syslog_pattern"
REASON_FALLBACK = "fallback=generic"
# event.category set by each parser.
CATEGORY_ACCESS, CATEGORY_SYSLOG, CATEGORY_GENERIC = "web", "host", "unknown"
# event.dataset of the older fixed per-index parsers.
LEGACY_DATASETS = {"apache": "apache.access", "nginx": "nginx.access", "syslog": "syslog"}

# ---------------------------------------------------------------------------
# Our own values for the two documented-only kinds (no code to match exists).
# ---------------------------------------------------------------------------
REASON_CLOUD_TRAIL_MESSAGE = "message=cloud_trail_pattern"
REASON_VPC_FLOW_MESSAGE = "message=vpc_flow_pattern"
CATEGORY_CLOUD_TRAIL, CATEGORY_VPC_FLOW = "cloud", "network"

# Kinds, in the order of their rule codes below.
ACCESS_LOG, SYSLOG, CLOUD_TRAIL, VPC_FLOW, GENERIC = (
    "access_log", "syslog", "cloud_trail", "vpc_flow", "generic")
KINDS = (ACCESS_LOG, SYSLOG, CLOUD_TRAIL, VPC_FLOW, GENERIC)

# ---------------------------------------------------------------------------
# Our own grok building blocks (the original names refer to a pattern library
# outside the archive tool; these are simplified equivalents).
# ---------------------------------------------------------------------------
IPORHOST = r"[0-9A-Za-z][0-9A-Za-z.:_-]*"
DATA = r".*?"
GREEDYDATA = r".*"
WORD = r"\w+"
NUMBER = r"[+-]?(?:[0-9]+(?:\.[0-9]+)?)"
POSINT = r"[1-9][0-9]*"
NOTSPACE = r"\S+"
USERNAME = r"[a-zA-Z0-9._-]+"
IPV4 = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
IPV6 = r"[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?:(?:\.[0-9]{1,3}){3})?(?:%[0-9A-Za-z]+)?"
IP = "(?:" + IPV6 + "|" + IPV4 + ")"
MONTH = r"[A-Z][a-z]{2}"
HTTPDATE = r"[0-9]{2}/" + MONTH + r"/[0-9]{4}:[0-9]{2}:[0-9]{2}:[0-9]{2} [+-][0-9]{4}"
SYSLOGTIMESTAMP = MONTH + r" +[0-9]{1,2} [0-9]{2}:[0-9]{2}:[0-9]{2}"


def g(p: str) -> str:
    return "(" + p + ")"


# ---------------------------------------------------------------------------
# The field order and literals of the four grok templates must equal the archive
# tool's; the blocks they are filled with are the ones above.
# ---------------------------------------------------------------------------
ACCESS_TAIL = (
    r"\[" + g(HTTPDATE) + r"\] \"" + g(WORD) + " " + g(DATA) + " HTTP/" + g(NUMBER) + r"\" "
    + g(NUMBER) + " " + g(NUMBER) + r" \"" + g(DATA) + r"\" \"" + g(DATA) + r"\""
)
ACCESS_GROK = g(IPORHOST) + " (?:" + g(DATA) + "|-) (?:" + g(DATA) + "|-) " + ACCESS_TAIL
# The part of an access line before its bracketed date, when that part is already cut out: host, ident and
# auth, tried once per run of host characters (so long lines cost linear time).
ACCESS_HEAD_JAVA = r"(?<![0-9A-Za-z.:_-])[.:_-]*+([0-9A-Za-z][0-9A-Za-z.:_-]*+) ([^ ]*+) (.*) $"
ACCESS_FIELDS = (
    "client_ip", "http_ident", "http_auth", "http_request_timestamp", "http_request_method",
    "url_original", "http_version", "http_response_status_code", "http_response_body_bytes",
    "http_request_referrer", "user_agent_original",
)

SYSLOG_GROK = (
    "<" + g(POSINT) + ">" + g(SYSLOGTIMESTAMP) + " " + g(NOTSPACE) + " " + g(DATA)
    + r"(?:\[" + g(POSINT) + r"\])?: " + g(GREEDYDATA)
)
SYSLOG_FIELDS = (
    "log_syslog_priority", "syslog_timestamp", "syslog_hostname", "syslog_program",
    "process_pid", "syslog_message",
)

SSHD_FAILED_GROK = (
    "Failed password for (?:invalid user )?" + g(USERNAME) + " from " + g(IP)
    + " port " + g(NUMBER) + " " + GREEDYDATA
)
SSHD_FIELDS = ("sshd_user_name", "source_ip", "source_port")

SUDO_GROK = (
    g(USERNAME) + " : TTY=" + g(DATA) + " ; PWD=" + g(DATA) + " ; USER=" + g(USERNAME)
    + " ; COMMAND=" + g(GREEDYDATA)
)
SUDO_FIELDS = ("sudo_user_name", "sudo_tty", "sudo_pwd", "sudo_user", "sudo_command")

# Version-2 flow log: 14 single-space separated tokens, action ACCEPT/REJECT/-.
VPC_MESSAGE = r"^2( \S+){11} (ACCEPT|REJECT|-) \S+$"
VPC_FIELDS = (
    "version", "account_id", "interface_id", "srcaddr", "dstaddr", "srcport", "dstport",
    "protocol", "packets", "bytes", "start", "end", "action", "log_status",
)


def java(p: str) -> str:
    """Spark (Java) form of a shared pattern."""
    return "(?d)" + p


def java_ci(p: str) -> str:
    return "(?di)" + p


def java_py(p: str) -> str:
    """Spark form of a classification pattern: Unicode ``\\s \\S \\d`` like Python's ``re``."""
    return "(?dU)" + p


def java_py_ci(p: str) -> str:
    return "(?dUi)" + p


def re2(p: str) -> str:
    """DuckDB (RE2) form of a shared pattern."""
    return p


def re2_ci(p: str) -> str:
    return "(?i)" + p
