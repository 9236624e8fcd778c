"""SQL building blocks of the checks, over the same view texts the Spark queries read."""

from __future__ import annotations

from tidewatch.sources.adapters import FLOWS_SQL, LINES_SQL, RAW_SQL, SUBNETS, oracle_text
from tidewatch.operators.behaviors import SCOPES

RAW = oracle_text(RAW_SQL)
LINES = oracle_text(LINES_SQL)
FLOWS = oracle_text(FLOWS_SQL)

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def v4(x: str) -> str:
    return (f"CASE WHEN regexp_full_match({x}, '({_OCTET}\\.){{3}}{_OCTET}') THEN CAST(split_part({x}, '.', 1) AS BIGINT) * 16777216 + "
            f"CAST(split_part({x}, '.', 2) AS BIGINT) * 65536 + CAST(split_part({x}, '.', 3) AS BIGINT) * 256 + CAST(split_part({x}, '.', 4) AS BIGINT) END")


def private(x: str) -> str:
    """Special-purpose v4 ranges; of v6 only the prefixes that occur in the views."""
    ranges = ((0, 16777215), (167772160, 184549375), (2130706432, 2147483647), (2851995648, 2852061183), (2886729728, 2887778303),
              (3221225472, 3221225727), (3221225984, 3221226239), (3232235520, 3232301055), (3323068416, 3323199487),
              (3325256704, 3325256959), (3405803776, 3405804031), (4026531840, 4294967295))
    inside = " OR ".join(f"n BETWEEN {a} AND {b}" for a, b in ranges)
    return (f"(SELECT CASE WHEN n IS NOT NULL THEN ({inside}) AND n NOT IN (3221225481, 3221225482) WHEN {x} LIKE 'fd00::%' OR {x} LIKE '2001:db8::%' THEN true "
            f"WHEN {x} LIKE 'ff02::%' THEN false END FROM (SELECT {v4(x)} AS n))")


def raw(sql: str) -> str:
    return f"WITH raw AS ({RAW}) {sql}"


_SYNTH = """'synthetic:' || substr(sha256(concat_ws('|', sensor, log_type, strftime(make_timestamp(us - us % 60000000), '%Y-%m-%dT%H:%M:%S') || '.000Z',
    coalesce(orig_h, src), coalesce(orig_p, p), coalesce(resp_h, dst), resp_p)), 1, 32)"""


def bb(x: str) -> str:
    return (f"CASE WHEN count(*) FILTER (WHERE log_type = 'conn') > 0 THEN first({x} ORDER BY us, raw_id) FILTER (WHERE log_type = 'conn') "
            f"ELSE first({x} ORDER BY us, raw_id) END")


def seen(x: str) -> str:
    return f"first({x} ORDER BY us, raw_id) FILTER (WHERE {x} IS NOT NULL)"


def first_of(x: str, *types: str) -> str:
    listed = ", ".join(f"'{t}'" for t in types)
    return f"first({x} ORDER BY us, raw_id) FILTER (WHERE log_type IN ({listed}))"


def pick(*names: str) -> str:
    return "coalesce(" + ", ".join([bb(n) for n in names] + [seen(n) for n in names]) + ")"


def distinct_list(values: str, *types: str) -> str:
    """Order-preserving distinct of a list expression over the events of the types, as text."""
    listed = ", ".join(f"'{t}'" for t in types)
    return (f"(SELECT string_agg(v, '|' ORDER BY o) FROM (SELECT v, min(row(us, raw_id, i)) AS o FROM (SELECT p.us, p.raw_id, u.v, u.i FROM prepared p, "
            f"LATERAL (SELECT unnest({values}) AS v, generate_subscripts({values}, 1) AS i) u WHERE p.key = s.key AND p.log_type IN ({listed})) z "
            f"WHERE v IS NOT NULL AND v <> '' GROUP BY v) y)")


PREPARED = f"""raw AS MATERIALIZED ({RAW}),
keyed AS MATERIALIZED (SELECT *, coalesce(uid, community_id, {_SYNTH}) AS key FROM raw WHERE log_type <> 'x509'),
certs AS (SELECT DISTINCT * FROM raw WHERE log_type = 'x509'),
shown AS (SELECT DISTINCT key, fp FROM (SELECT key, unnest(cert_chain_fps) AS fp FROM keyed WHERE log_type IN ('ssl', 'tls'))),
prepared AS MATERIALIZED (SELECT * FROM keyed UNION ALL BY NAME SELECT c.*, s.key FROM shown s JOIN certs c ON c.fingerprint = s.fp)"""


def prepared(sql: str) -> str:
    return f"WITH {PREPARED} {sql}"


SESS = f"""{PREPARED},
grouped AS MATERIALIZED (SELECT key, count(*) AS event_count, min(us) AS first_us, max(us) AS last_us, list_sort(list(DISTINCT log_type)) AS log_types,
    {seen('uid')} AS uid, {pick('community_id')} AS community_id, {bb('us')} AS ts_us,
    {pick('orig_h', 'src')} AS src_ip, {pick('orig_p', 'p')} AS src_port, {pick('resp_h', 'dst')} AS dst_ip, {pick('resp_p')} AS dst_port,
    {pick('local_orig')} AS l_orig, {pick('local_resp')} AS l_resp, {pick('proto')} AS transport, {pick('sensor')} AS sensor,
    nullif({bb('service')}, '') AS service, {first_of('conn_state', 'conn')} AS state, {first_of('history', 'conn')} AS history,
    {first_of('duration', 'conn')} AS duration,
    nullif(coalesce({bb('orig_bytes')}, 0) + coalesce({bb('resp_bytes')}, 0), 0) AS bytes,
    nullif(coalesce({bb('orig_pkts')}, 0) + coalesce({bb('resp_pkts')}, 0), 0) AS packets
    FROM prepared GROUP BY key),
sess AS MATERIALIZED (SELECT *, coalesce(uid, community_id, key) AS session_id,
    coalesce(l_orig, {private('src_ip')}) AS src_local, coalesce(l_resp, {private('dst_ip')}) AS dst_local,
    CASE lower(service) WHEN 'ssl' THEN 'tls' WHEN 'ssl, http' THEN 'http' WHEN 'dns' THEN 'dns' WHEN 'ssh' THEN 'ssh' ELSE
        CASE WHEN list_contains(log_types, 'http') THEN 'http' WHEN list_contains(log_types, 'dns') THEN 'dns' WHEN list_contains(log_types, 'ssl') THEN 'tls'
             WHEN list_contains(log_types, 'ssh') THEN 'ssh' WHEN list_contains(log_types, 'ftp') THEN 'ftp' WHEN list_contains(log_types, 'smtp') THEN 'smtp'
             WHEN list_contains(log_types, 'ldap') THEN 'ldap' WHEN list_contains(log_types, 'irc') THEN 'irc' ELSE
             CASE dst_port WHEN 53 THEN 'dns' WHEN 80 THEN 'http' WHEN 443 THEN 'tls' WHEN 22 THEN 'ssh' WHEN 21 THEN 'ftp' WHEN 25 THEN 'smtp'
                  WHEN 389 THEN 'ldap' WHEN 636 THEN 'ldaps' END END END AS protocol
    FROM grouped)"""


def sessions(sql: str) -> str:
    return f"WITH {SESS} {sql}"


def _net(ip: str, field: int) -> str:
    ordered = sorted(SUBNETS, key=lambda s: -int(s[3].split("/")[1]))
    whens = " ".join(f"WHEN {ip} LIKE '{'.'.join(s[3].split('.')[:int(s[3].split('/')[1]) // 8])}.%' THEN '{s[field]}'" for s in ordered)
    return f"CASE {whens} END"


def _hardened_protocol() -> str:
    types = " ".join(f"WHEN list_contains(log_types, '{t}') THEN '{p}'" for t, p in (
        ("dns", "dns"), ("http", "http"), ("ssl", "tls"), ("tls", "tls"), ("ssh", "ssh"), ("ldap", "ldap"), ("ftp", "ftp"), ("smtp", "smtp"), ("dhcp", "dhcp"), ("ntp", "ntp")))
    ports = " ".join(f"WHEN {n} THEN '{p}'" for n, p in (
        (22, "ssh"), (25, "smtp"), (53, "dns"), (67, "dhcp"), (68, "dhcp"), (80, "http"), (123, "ntp"), (389, "ldap"), (443, "tls"), (636, "ldaps"),
        (5353, "mdns"), (5355, "llmnr"), (1900, "ssdp")))
    return f"coalesce(protocol, CASE {types} END, CASE dst_port {ports} END, 'unknown')"


_TOPO = ", ".join(f"{_net(side + '_ip', i)} AS {side}_{name}" for side in ("src", "dst") for i, name in ((0, "spoke"), (1, "vnet"), (2, "subnet"), (3, "subnet_cidr")))
HARD = f"""{SESS},
topo AS (SELECT * EXCLUDE (protocol), protocol AS built_protocol, {_hardened_protocol()} AS hard_protocol, {_TOPO},
    coalesce({private('src_ip')}, false) AS s_in, coalesce({private('dst_ip')}, false) AS d_in FROM sess),
scoped AS (SELECT *,
    CASE WHEN s_in AND d_in THEN CASE WHEN src_subnet_cidr = dst_subnet_cidr THEN 'same_subnet' WHEN src_spoke = dst_spoke THEN 'same_spoke_cross_subnet'
         WHEN src_vnet = dst_vnet THEN 'same_vnet_cross_subnet' WHEN src_spoke <> dst_spoke THEN 'cross_spoke' ELSE 'internal_unknown' END
         WHEN s_in THEN 'outbound_external' WHEN d_in THEN 'inbound_external' ELSE 'external_external' END AS scope,
    CASE WHEN s_in AND d_in THEN 'internal' WHEN s_in THEN 'outbound' WHEN d_in THEN 'inbound' ELSE 'external_or_unknown' END AS direction,
    CASE WHEN s_in THEN src_ip WHEN d_in THEN dst_ip END AS asset_ip, CASE WHEN s_in THEN 'source' WHEN d_in THEN 'destination' END AS asset_side,
    CASE WHEN s_in THEN src_subnet WHEN d_in THEN dst_subnet END AS asset_subnet
    FROM topo),
noise AS (SELECT key, bool_or(ndr_noise) AS noisy, bool_or(coalesce(message, '') <> '' AND uid IS NULL AND orig_h IS NULL AND resp_h IS NULL) AS fragment FROM prepared GROUP BY key),
flowed AS (SELECT s.* EXCLUDE (hard_protocol), hard_protocol AS protocol, noisy, fragment,
    src_ip IS NOT NULL AND dst_ip IS NOT NULL AND src_port IS NOT NULL AND dst_port IS NOT NULL AND uid IS NOT NULL AS flow_based,
    CASE WHEN session_id LIKE 'synthetic:%' THEN 'synthetic' WHEN uid IS NOT NULL THEN 'uid' ELSE 'community_id' END AS key_type,
    list_filter([CASE WHEN hard_protocol IN ('ntp', 'dhcp') THEN 'protocol:' || hard_protocol END, CASE WHEN dst_port IN (2021, 4900, 5601, 9200, 9300, 9598) THEN 'destination_port:' || dst_port END,
        CASE WHEN src_port IN (2021, 4900, 5601, 9200, 9300, 9598) THEN 'source_port:' || src_port END,
        CASE dst_port WHEN 9200 THEN 'opensearch_api' WHEN 2021 THEN 'data_prepper_ingest' WHEN 4900 THEN 'data_prepper_metrics' WHEN 5601 THEN 'opensearch_dashboards' WHEN 9300 THEN 'opensearch_transport' WHEN 9598 THEN 'vector_metrics' END,
        CASE src_port WHEN 9200 THEN 'opensearch_api' WHEN 2021 THEN 'data_prepper_ingest' WHEN 4900 THEN 'data_prepper_metrics' WHEN 5601 THEN 'opensearch_dashboards' WHEN 9300 THEN 'opensearch_transport' WHEN 9598 THEN 'vector_metrics' END],
        lambda x: x IS NOT NULL) AS control
    FROM scoped s JOIN noise n ON n.key = s.key),
hard AS MATERIALIZED (SELECT *, len(control) > 0 AS excluded,
    CASE WHEN len(control) > 0 THEN 'control_plane' WHEN NOT flow_based AND list_contains(log_types, 'dhcp') THEN 'control_plane'
         WHEN NOT flow_based AND fragment THEN 'malformed_raw' WHEN noisy THEN 'noise' WHEN NOT flow_based THEN 'non_flow' END AS category,
    array_to_string(CASE WHEN len(control) > 0 THEN list_distinct_ordered ELSE other END, '|') AS noise_reasons FROM (
        SELECT *, control AS list_distinct_ordered,
            list_concat(CASE WHEN noisy THEN ['package_update', 'known package manager or repository traffic'] ELSE [] END,
            CASE WHEN flow_based THEN [] WHEN list_contains(log_types, 'dhcp') THEN ['non_flow:dhcp'] WHEN fragment THEN ['malformed_raw_event'] ELSE ['non_flow:synthetic'] END) AS other FROM flowed))"""


def hardened(sql: str) -> str:
    return f"WITH {HARD} {sql}"


def ip_reason(x: str, role: str) -> str:
    """Only the reasons that the views can produce."""
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} = 'not-an-ip' THEN 'invalid_ip' WHEN {x} LIKE 'ff02::%' THEN '{role}_multicast' END"


BEH = f"""{HARD},
eligibility AS MATERIALIZED (SELECT *, list_sort(list_distinct(list_filter([CASE WHEN NOT flow_based THEN 'not_flow_based' END, CASE WHEN excluded THEN 'session_excluded_from_behavior' END,
    CASE WHEN category IN ('control_plane', 'malformed_raw') THEN category END, {ip_reason('src_ip', 'source')}, {ip_reason('dst_ip', 'destination')},
    CASE WHEN protocol = 'unknown' AND coalesce(dst_port, 0) = 0 THEN 'unknown_port_zero' END], lambda x: x IS NOT NULL))) AS reasons FROM hard),
rows_all AS MATERIALIZED (SELECT *, len(reasons) = 0 AS eligible, asset_ip AS entity, coalesce(sensor, '') AS sensor_key, first_us - first_us % 900000000 AS window_us,
    s_in AS a_src_local, d_in AS a_dst_local FROM eligibility WHERE asset_ip IS NOT NULL),
used AS MATERIALIZED (SELECT * FROM rows_all WHERE eligible)"""
WIN = "entity, sensor_key AS sensor, window_us"
BY_WIN = "entity, sensor_key, window_us"


def behaviors(sql: str) -> str:
    return f"WITH {BEH} {sql}"


def flows(sql: str) -> str:
    return f"WITH flow AS ({FLOWS}) {sql}"


def lines(sql: str) -> str:
    return f"WITH lines AS ({LINES}) {sql}"


SCOPE_NAMES = SCOPES
