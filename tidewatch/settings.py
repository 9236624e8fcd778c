"""Tunable limits and the fixed word lists the detections depend on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # sessions
    max_events_per_log_type: int | None = None
    max_evidence_items: int | None = None
    keep_raw_documents: bool = True
    session_overlap_seconds: int = 1800
    session_initial_lookback_seconds: int = 259200
    # hardening
    internal_networks: tuple[str, ...] = ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16")
    control_plane_ports: tuple[int, ...] = (2021, 4900, 5601, 9200, 9300, 9598)
    control_plane_protocols: tuple[str, ...] = ("ntp", "dhcp")
    unknown_protocol: str = "unknown"
    # behaviours
    entity_mode: str = "asset_sensor"
    min_sessions_for_ml: int = 2
    max_session_refs: int = 200
    behavior_overlap_seconds: int = 300
    behavior_initial_lookback_seconds: int = 3600
    # model
    trees: int = 300
    sample_size: int = 256
    seed: int = 42
    contamination: float = 0.05
    min_training_rows: int = 20
    training_min_quality: int = 80
    retrain_seconds: int = 21600
    excluded_feedback: tuple[str, ...] = ("false_positive", "benign_expected")
    # health
    max_missing_percent: float = 5.0
    max_excluded_percent: float = 80.0
    min_ready_behaviors: int = 20
    max_unscored_behaviors: int = 200


DEFAULTS = Settings()

# ---- Fixed values: lists below must equal the values of the deployed rules. ----

# Log files that are tailed.
TAILED_LOG_TYPES = (
    "conn", "dns", "http", "ssl", "x509", "files",
    "ftp", "smtp", "ssh", "irc", "ldap", "ldap_search", "postgresql", "quic", "rdp", "dhcp", "ntp",
    "smb_files", "smb_mapping", "dce_rpc", "kerberos", "ntlm",
    "pe", "tunnel", "traceroute", "weird", "notice", "analyzer",
    "known_hosts", "known_services", "known_certs", "software",
)
# Log files that are never tailed; the first one is a name prefix.
SKIPPED_LOG_FILES = (
    "conn-summary", "stdout", "stderr", "reporter", "capture_loss",
    "stats", "telemetry", "loaded_scripts", "packet_filter",
)
JUNK_LOG_TYPES = (
    "stdout", "stderr", "packet_filter", "telemetry", "stats",
    "reporter", "capture_loss", "loaded_scripts",
)
PLATFORM_IPS = ("168.63.129.16", "169.254.169.254")
BROADCAST_IPS = ("10.51.1.255", "ff02::1", "ff02::2")
AGENT_SOFTWARE_NAME = "WALinuxAgent"
RESET_NOISE_PORT = 23456
RESET_NOISE_SOURCE = "10.51.1.13"
RESET_NOISE_DESTINATIONS = ("40.119.104.0", "40.119.108.0", "40.87.188.0")
PACKAGE_DOMAINS = (
    "azure.deb-backend.debian.cloud", "azure.deb.debian.cloud", "download.opensuse.org",
    "download.docker.com", "packages.microsoft.com", "artifacts.elastic.co",
)
PACKAGE_AGENTS = ("apt-http", "apt ", "libwww-perl", "python-urllib")
PACKAGE_NOISE_TYPE = "package_update"
PACKAGE_NOISE_REASON = "known package manager or repository traffic"

# Flow export.
FLOW_NOISE_IPS = ("168.63.129.16", "169.254.169.254")
FLOW_EXPORTER_IPS = ("10.51.1.15",)
FLOW_COLLECTOR_IPS = ("10.51.1.11",)
FLOW_EXPORT_PORTS = (2055,)
IP_PROTOCOLS = {
    1: "icmp", 2: "igmp", 6: "tcp", 17: "udp", 41: "ipv6", 47: "gre",
    50: "esp", 51: "ah", 58: "ipv6-icmp", 89: "ospf", 132: "sctp",
}

# Service names.
SERVICE_ALIASES = {"ssl": "tls", "ldap_tcp": "ldap", "ldap_udp": "ldap", "dce-rpc": "dce_rpc"}
PROTOCOL_PRIORITY = (
    "http", "dns", "tls", "ssh", "ftp", "ftp-data", "smb", "ldap", "smtp", "irc",
    "postgresql", "ntp", "dhcp", "dce_rpc", "ntlm", "gssapi",
)
INFER_LOG_TYPES = ("http", "dns", "ssl", "ssh", "ftp", "smtp", "ldap", "irc")
INFER_PORTS = {53: "dns", 80: "http", 443: "tls", 22: "ssh", 21: "ftp", 25: "smtp", 389: "ldap", 636: "ldaps"}
HARDEN_LOG_TYPES = (
    ("dns", "dns"), ("http", "http"), ("ssl", "tls"), ("tls", "tls"), ("ssh", "ssh"),
    ("ldap", "ldap"), ("ftp", "ftp"), ("smtp", "smtp"), ("dhcp", "dhcp"), ("ntp", "ntp"),
)
HARDEN_PORTS = {
    22: "ssh", 25: "smtp", 53: "dns", 67: "dhcp", 68: "dhcp", 80: "http", 123: "ntp",
    389: "ldap", 443: "tls", 636: "ldaps", 5353: "mdns", 5355: "llmnr", 1900: "ssdp",
}
SEMANTIC_PORTS = {
    2021: "data_prepper_ingest", 4900: "data_prepper_metrics", 5601: "opensearch_dashboards",
    9200: "opensearch_api", 9300: "opensearch_transport", 9598: "vector_metrics",
}

# Behaviour eligibility.
EXCLUDED_CATEGORIES = ("control_plane", "malformed_raw")
NOISE_TOKENS = ("broadcast", "control_plane", "dhcp", "link_local", "malformed_raw", "multicast", "ntp")
TRUSTED_CERT_WORDS = ("ok", "valid", "success", "trusted")
TRUTHY_WORDS = ("1", "true", "yes", "y", "on", "ok", "success")

# Routes of the typed raw tables (log type -> route); anything else is "other".
ROUTES = {
    "conn": "conn", "dns": "dns", "http": "http", "ssl": "ssl", "files": "files",
    "weird": "weird", "notice": "notice", "dce_rpc": "dce-rpc", "smb_files": "smb",
    "smb_mapping": "smb", "kerberos": "kerberos", "x509": "x509", "ntlm": "ntlm",
    "ssh": "ssh", "ftp": "ftp", "ldap": "ldap",
}

# Health.
REQUIRED_LOG_TYPES = ("conn", "dns", "http", "ssl", "files", "notice", "weird", "ssh")
FRESHNESS_LIMITS = {"raw": (300, 900), "session": (900, 1800), "behavior": (1800, 3600), "flow": (1800, 7200)}
COMPONENT_LABELS = {
    "opensearch": "OpenSearch", "dashboards": "Dashboards", "dataprepper": "Data Prepper",
    "vector": "Vector sensors", "raw_ingestion": "Raw Zeek ingestion", "sessionizer": "Sessionizer",
    "behaviorizer": "Behaviorizer", "ml": "ML & findings", "elastalert": "ElastAlert2",
    "netflow": "NetFlow", "docker": "Docker runtime",
}

# Feature vectors, in vector order.
FEATURES_ASSET_15M = (
    "session_count", "unique_destination_ip_count", "unique_destination_port_count", "unique_protocol_count",
    "network_bytes_sum", "network_packets_sum", "avg_session_duration", "max_session_duration",
    "external_destination_count", "internal_destination_count", "inbound_count", "outbound_count", "internal_count",
    "same_subnet_count", "same_spoke_count", "same_spoke_cross_subnet_count", "same_vnet_cross_subnet_count",
    "cross_spoke_count", "internal_unknown_count", "inbound_external_count", "outbound_external_count",
    "external_external_count", "unique_external_source_ip_count", "unique_external_destination_ip_count",
    "unique_counterpart_ip_count", "unique_inbound_destination_port_count", "unique_outbound_destination_port_count",
    "rejected_inbound_count",
    "dns_session_count", "dns_unique_query_count", "dns_nxdomain_count", "dns_nxdomain_ratio", "dns_txt_count",
    "dns_long_query_count", "dns_max_query_length", "dns_avg_query_length", "dns_max_label_length", "dns_avg_label_count",
    "http_session_count", "http_unique_host_count", "http_unique_user_agent_count", "http_error_4xx_count",
    "http_error_5xx_count", "http_response_body_bytes_sum", "http_download_count",
    "files_count", "files_total_bytes_sum", "files_unique_mime_type_count", "files_hash_count",
    "tls_session_count", "tls_unique_sni_count", "tls_invalid_cert_count", "tls_sni_mismatch_count",
    "tls_self_signed_count", "tls_expired_cert_count", "tls_unique_issuer_count", "tls_unique_subject_count",
    "tls_resumed_count",
    "ssh_session_count", "ssh_external_session_count", "ssh_nonstandard_port_count", "ssh_auth_success_count",
    "ssh_auth_attempt_sum", "notice_count", "weird_count",
)
_TOPOLOGY_ONLY = set(FEATURES_ASSET_15M[13:28])
FEATURES_HOST_HOURLY = tuple(f for f in FEATURES_ASSET_15M if f not in _TOPOLOGY_ONLY)


@dataclass(frozen=True)
class FeatureSpec:
    """A named, ordered feature vector and the window it is computed over."""

    feature_set: str
    behavior_type: str
    window: str
    window_seconds: int
    vector: tuple[str, ...]
    dns_long_query_length: int = 80


ASSET_15M = FeatureSpec("asset_15m_v1", "asset_15m", "15m", 900, FEATURES_ASSET_15M)
HOST_HOURLY = FeatureSpec("host_hourly_v1", "host_hourly", "1h", 3600, FEATURES_HOST_HOURLY)
FEATURE_SPECS = {s.feature_set: s for s in (ASSET_15M, HOST_HOURLY)}
