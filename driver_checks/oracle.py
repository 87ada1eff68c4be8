"""The rules stated again in SQL over the derived attributes, for DuckDB."""

from __future__ import annotations

import re

from driver_checks.derived import AS_OF_SQL, RESOURCE, SERVICE, attributes_sql, json_text

ALNUM = re.compile("[A-Za-z0-9]")


def has(column: str, *terms: str) -> str:
    """Whole-term search written for a regex engine without look-around."""
    tests = []
    for term in terms:
        left = "(^|[^A-Za-z0-9])" if ALNUM.match(term[0]) else ""
        right = "($|[^A-Za-z0-9])" if ALNUM.match(term[-1]) else ""
        tests.append(f"regexp_matches({column}, '(?i){left}{re.escape(term)}{right}')")
    return "(" + " OR ".join(tests) + ")"


def first(*rules, default: str) -> str:
    """``CASE`` over ``(condition, label)``; labels are text."""
    return "CASE " + " ".join(f"WHEN {c} THEN '{label}'" for c, label in rules) + f" ELSE '{default}' END"


def terms(column: str, *rules, default: str) -> str:
    return first(*[(has(column, *needles), label) for needles, label in rules], default=default)


def text(value: str) -> str:
    return f"COALESCE({value}, '')"


def filled(*values: str) -> str:
    return "COALESCE(" + ", ".join(f"NULLIF({v}, '')" for v in values) + ", '')"


def score(*parts) -> str:
    return "(" + " + ".join(f"(CASE WHEN {c} THEN {p} ELSE 0 END)" for c, p in parts) + ")"


def banded(*extra) -> str:
    bands = [("level = 'Critical'", 40), ("level = 'High'", 30), ("level = 'Medium'", 20), ("level = 'Low'", 10)]
    return score(*bands, *extra)


LEVEL = (
    "CASE WHEN sev >= 9 THEN 'Critical' WHEN sev >= 7 THEN 'High' WHEN sev >= 4 THEN 'Medium' "
    "WHEN sev >= 1 THEN 'Low' WHEN sev > 0 THEN 'Informational' ELSE 'Unknown' END"
)
FLAT_LEVEL = (
    "CASE WHEN severity >= 9 THEN 'Critical' WHEN severity >= 7 THEN 'High' WHEN severity >= 4 THEN 'Medium' "
    "WHEN severity >= 1 THEN 'Low' ELSE 'Informational' END"
)
ACTION = "has_service AND action_type IS NOT NULL"
CONDITIONS = {
    "act": ACTION,
    "net": ACTION + " AND has_net",
    "inst": "has_resource_content AND has_instance",
    "iface": "has_resource_content AND has_instance AND interface_kind = 3",
    "api": ACTION + " AND has_api",
    "acct": ACTION + " AND has_api AND has_remote_account",
    "call": ACTION + " AND has_api AND call_has_remote",
    "svc": "has_service AND service_has_remote",
    "dns": ACTION + " AND has_dns_action",
    "key": "has_resource_content AND has_key",
    "bucket": "has_resource_content AND has_bucket",
    "cluster": "has_resource_content AND has_cluster",
    "k8s": ACTION + " AND has_k8s_call",
    "info": "has_service AND k IN (16, 17, 18, 20)",
    "box": "has_service AND k IN (16, 17, 18, 20) AND has_container",
    "run": "has_service AND has_runtime",
    "scan": "has_service AND has_scan",
    "file": "has_service AND has_scan AND file_count >= 1",
    "ecs": "has_resource_content AND has_ecs",
    "db": "has_resource_content AND has_db",
    "login": "has_service AND has_login",
}


def at(place: str, value: str) -> str:
    """The value where its object exists, else NULL."""
    return f"CASE WHEN {CONDITIONS[place]} THEN {value} END"


def word(place: str, value: str) -> str:
    return text(at(place, value))


# Parsed and mapped copies.
TABLE = f"""a AS ({attributes_sql('events')}),
t AS (SELECT * EXCLUDE (arn, region, title, description), finding_id AS Id, activity_type AS ActivityType, arn AS Arn, account_id AS AccountId,
  region AS Region, COALESCE(part, 'aws') AS PartitionName, schema_version AS SchemaVersion,
  CAST(TRUNC(severity) AS INTEGER) AS SeverityInt, created_at AS TimeCreated, updated_at AS TimeGenerated,
  title AS Title, description AS Description,
  has_resource_content AND resource_type IS NOT NULL AS typed_resource,
  CASE WHEN has_resource_content THEN resource_type END AS rtype,
  CASE WHEN has_service THEN action_type END AS atype
  FROM a)"""


def newest(lookback: str | None = "30", source: str = "t", *ties: str) -> str:
    where = f"WHERE TimeGenerated >= {AS_OF_SQL} - INTERVAL '{lookback}' DAY" if lookback else ""
    return (
        f"SELECT * FROM {source} {where} QUALIFY ROW_NUMBER() OVER (PARTITION BY Id ORDER BY TimeGenerated DESC, "
        "TimeCreated DESC NULLS LAST, SeverityInt DESC NULLS LAST, ActivityType DESC, SchemaVersion DESC, "
        f"AccountId DESC, Region DESC, Arn DESC{''.join(f', {c} DESC' for c in ties)}) = 1"
    )


QUALITY = score(
    ("Id <> ''", 20), ("ActivityType <> ''", 20), ("sev > 0", 20), ("AccountId <> ''", 20), ("Region <> ''", 20)
)


def with_base(select: str, lookback: str = "30", gates: bool = True, name: str = "b", more: str = "") -> str:
    """``select`` over ``b``, the base view with the attributes of each newest copy."""
    gate = "WHERE SchemaVersion LIKE '2.%' AND score >= 60" if gates else ""
    return f"""WITH {TABLE},
n AS ({newest(lookback)}),
s AS (SELECT *, CASE WHEN SeverityInt IS NULL OR SeverityInt < 0 OR SeverityInt > 10 THEN 0.0e0
  ELSE CAST(SeverityInt AS DOUBLE) END AS sev FROM n),
q AS (SELECT *, {QUALITY} AS score, {LEVEL} AS level, COALESCE(TimeCreated, TimeGenerated) AS EventTime FROM s),
{name} AS (SELECT * FROM q {gate}){more}
{select}"""


def with_table(select: str) -> str:
    return f"WITH {TABLE}\n{select}"


RESOURCE_TEXT = json_text(RESOURCE)
SERVICE_TEXT = f"CASE WHEN has_service THEN {json_text(SERVICE)} ELSE '{{}}' END"


CONTENT_HASH = (
    "CAST('0x' || substr(md5(concat_ws(chr(1), "
    + ", ".join(f"COALESCE({c}, chr(2))" for c in ("Title", "Description", "PartitionName", RESOURCE_TEXT, SERVICE_TEXT))
    + ")), 1, 15) AS BIGINT)"
)


def _member(name: str, value: str, quoted: bool = True) -> str:
    shown = f"CAST(to_json(CAST({value} AS VARCHAR)) AS VARCHAR)" if quoted else value
    return f"'\"{name}\":' || COALESCE(CASE WHEN {value} IS NOT NULL THEN {shown} END, 'null')"


def json_time(value: str) -> str:
    return f"'\"' || strftime({value}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z\"'"


# The finding rebuilt from the table, in the member order of the base view; severity is a whole double.
RAW_JSON = "'{' || " + " || ',' || ".join(
    [
        _member("accountId", "AccountId"),
        _member("arn", "Arn"),
        _member("createdAt", json_time("TimeCreated"), False),
        _member("description", "Description"),
        _member("id", "Id"),
        _member("partition", "PartitionName"),
        _member("region", "Region"),
        _member("resource", RESOURCE_TEXT, False),
        _member("schemaVersion", "SchemaVersion"),
        _member("service", SERVICE_TEXT, False),
        _member("severity", "CAST(CAST(SeverityInt AS DOUBLE) AS VARCHAR)", False),
        _member("title", "Title"),
        _member("type", "ActivityType"),
        _member("updatedAt", json_time("TimeGenerated"), False),
    ]
) + " || '}'"

# A stored row as JSON text, in column order.
ROW_JSON = "'{' || " + " || ',' || ".join(
    [
        _member("AccountId", "AccountId"),
        _member("ActivityType", "ActivityType"),
        _member("Arn", "Arn"),
        _member("Description", "Description"),
        _member("Id", "Id"),
        _member("Partition", "PartitionName"),
        _member("Region", "Region"),
        _member("ResourceDetails", RESOURCE_TEXT, False),
        _member("SchemaVersion", "SchemaVersion"),
        _member("ServiceDetails", SERVICE_TEXT, False),
        _member("Severity", "CAST(SeverityInt AS VARCHAR)", False),
        _member("TimeCreated", json_time("TimeCreated"), False),
        _member("TimeGenerated", json_time("TimeGenerated"), False),
        _member("Title", "Title"),
    ]
) + " || '}'"

COMMON = (
    "TimeGenerated, EventTime, Id AS FindingId, ActivityType AS FindingType, sev AS Severity, level AS SeverityLevel, "
    f"{text('title')} AS Title, {text('description')} AS Description, AccountId AS AwsAccountId, Region AS AwsRegion"
    f", {RAW_JSON} AS RawJson"
)
BASE_SELECT = f"""SELECT {COMMON}, TimeGenerated AS UpdatedTime,
  CASE WHEN has_service THEN detector_id ELSE '' END AS DetectorId, PartitionName AS "Partition",
  CASE WHEN has_service THEN 'guardduty' ELSE '' END AS ServiceName, {text('rtype')} AS ResourceType,
  {text('atype')} AS ActionType, score AS DataQualityScore, SchemaVersion, '1.5.0' AS ParserVersion,
  'AWSGuardDuty_Main' AS RecordSource FROM b"""


def columns(**named: str) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in named.items())


# D1
NETWORK_FILTER = (
    "(COALESCE(atype, '') = 'NETWORK_CONNECTION' OR "
    + has("ActivityType", "DNS", "Network", "Backdoor", "Trojan", "DDoS", "Port", "Tor", "Cryptocurrency", "Malware")
    + " OR lower(ActivityType) LIKE '%ec2/%' OR lower(ActivityType) LIKE '%behavior:%')"
)
NETWORK_CATEGORY = terms(
    "ActivityType",
    (("Backdoor",), "Backdoor"),
    (("Trojan",), "Trojan"),
    (("DDoS", "DenialOfService"), "DDoS"),
    (("Tor",), "Anonymization"),
    (("Cryptocurrency",), "Cryptocurrency Mining"),
    (("DNS",), "DNS Abuse"),
    (("Port",), "Port Scanning"),
    default="Network Anomaly",
)
NETWORK = f"""network AS (SELECT *, {banded(
    ("ThreatCategory IN ('Backdoor', 'Trojan')", 20),
    ("RemoteCountry <> '' AND RemoteCountry <> 'United States'", 10),
    ("IsBlocked = false", 10),
)} AS NetworkRiskScore FROM (SELECT {COMMON}, level, {columns(
    ThreatCategory=NETWORK_CATEGORY,
    ConnectionDirection=word("net", "direction"),
    TrafficDirection=first(
        (f"{word('net', 'direction')} = 'INBOUND'", "Inbound"),
        (f"{word('net', 'direction')} = 'OUTBOUND'", "Outbound"),
        default="Unknown",
    ),
    Protocol=word("net", "protocol"),
    IsBlocked=at("net", "blocked"),
    LocalPort=f"CAST({at('net', 'local_port')} AS INTEGER)",
    LocalPortName=word("net", "local_port_name"),
    RemoteIp=word("net", "remote_ip"),
    RemoteIpV6=word("net", "remote_ip6"),
    RemotePort=f"CAST({at('net', 'remote_port')} AS INTEGER)",
    RemotePortName=word("net", "remote_port_name"),
    RemoteCountry=word("net", "remote_country"),
    RemoteCountryCode=word("net", "remote_country_code"),
    RemoteCity=word("net", "remote_city"),
    RemoteLatitude=at("net", "remote_lat"),
    RemoteLongitude=at("net", "remote_lon"),
    RemoteOrganization=word("net", "remote_org"),
    RemoteIsp=word("net", "remote_isp"),
    RemoteAsn=word("net", "remote_asn"),
    RemoteAsnOrg=word("net", "remote_asn_org"),
    InstanceId=word("inst", "instance_id"),
    InstanceType=word("inst", "instance_type"),
    InstanceState=word("inst", "instance_state"),
    Platform=word("inst", "platform"),
    LaunchTime=at("inst", "launched_at"),
    AvailabilityZone=word("inst", "zone"),
    ImageId=word("inst", "image_id"),
    ImageDescription=word("inst", "image_text"),
    NetworkInterfaceId=word("iface", "interface_id"),
    VpcId=word("iface", "vpc_id"),
    SubnetId=word("iface", "subnet_id"),
    PrivateIp=word("iface", "private_ip"),
    PrivateDnsName=word("iface", "private_dns"),
    PublicIp=word("iface", "public_ip"),
    PublicDnsName=word("iface", "public_dns"),
    SecurityGroupIds=word(
        "iface", "CASE group_count WHEN 2 THEN group_a || ',' || group_b WHEN 1 THEN group_a ELSE '' END"
    ),
    ParserVersion="'1.5.0'",
    RecordSource="'AWSGuardDuty_Network'",
)} FROM b WHERE {NETWORK_FILTER}) AS typed)"""
NO_GEO = (
    "'' AS EnrichedCountry, '' AS EnrichedState, '' AS EnrichedCity, CAST(NULL AS DOUBLE) AS EnrichedLatitude, "
    "CAST(NULL AS DOUBLE) AS EnrichedLongitude"
)


def with_network(select: str, lookback: str = "30") -> str:
    return with_base(select, lookback, more=",\n" + NETWORK)


# D7
SESSIONS = f"""sessions AS (SELECT *, CASE WHEN SrcIpAddr = '' AND DstIpAddr = '' THEN 'Missing IP addresses'
  WHEN NetworkProtocol = '' THEN 'Missing protocol' WHEN EventStartTime IS NULL THEN 'Missing timestamp'
  ELSE 'Compliant' END AS ASIMCompliance FROM (SELECT {columns(
    TimeGenerated="TimeGenerated",
    RawJson="RawJson",
    EventType="'NetworkSession'",
    EventSchemaVersion="'0.2.7'",
    EventVendor="'AWS'",
    EventProduct="'GuardDuty'",
    EventProductVersion="'1.0'",
    EventCount="1",
    EventStartTime="EventTime",
    EventEndTime="EventTime",
    EventResult="'Success'",
    EventSeverity="SeverityLevel",
    EventOriginalSeverity="CAST(CAST(Severity AS INTEGER) AS VARCHAR) || '.0'",
    EventMessage="Title",
    EventOriginalType="FindingType",
    EventOriginalUid="FindingId",
    EventUid="'guardduty-' || FindingId",
    SrcIpAddr=filled("PrivateIp", "PublicIp"),
    SrcPortNumber="LocalPort",
    SrcHostname="InstanceId",
    SrcDvcId="InstanceId",
    SrcDvcIdType="CASE WHEN InstanceId <> '' THEN 'Other' ELSE '' END",
    SrcGeoCountry="AwsRegion",
    SrcGeoRegion="AwsRegion",
    SrcDomain="VpcId",
    SrcDomainType="CASE WHEN VpcId <> '' THEN 'Other' ELSE '' END",
    DstIpAddr="RemoteIp",
    DstPortNumber="RemotePort",
    DstGeoCountry="RemoteCountry",
    DstGeoCity="RemoteCity",
    DstGeoRegion="RemoteCountry",
    DstHostname="PublicDnsName",
    NetworkProtocol="upper(Protocol)",
    NetworkDirection="TrafficDirection",
    NetworkSessionId="FindingId",
    NetworkBytes="0",
    NetworkPackets="0",
    NetworkApplicationProtocol=(
        "CASE RemotePort WHEN 80 THEN 'HTTP' WHEN 443 THEN 'HTTPS' WHEN 53 THEN 'DNS' WHEN 22 THEN 'SSH' "
        "WHEN 3389 THEN 'RDP' WHEN 25 THEN 'SMTP' WHEN 21 THEN 'FTP' ELSE '' END"
    ),
    DvcId="InstanceId",
    DvcIdType="CASE WHEN InstanceId <> '' THEN 'Other' ELSE '' END",
    DvcHostname="InstanceId",
    DvcOs="CASE WHEN Platform = 'windows' THEN 'Windows' WHEN Platform IN ('linux', '') THEN 'Linux' ELSE Platform END",
    DvcOsVersion="''",
    DvcAction="'Allow'",
    DvcInterface="NetworkInterfaceId",
    ThreatName="FindingType",
    ThreatCategory="ThreatCategory",
    ThreatRiskLevel=(
        "CASE SeverityLevel WHEN 'Critical' THEN 95 WHEN 'High' THEN 80 WHEN 'Medium' THEN 50 WHEN 'Low' THEN 20 "
        "WHEN 'Informational' THEN 10 ELSE CAST(Severity * 10 AS INTEGER) END"
    ),
    ThreatOriginalRiskLevel="CAST(CAST(Severity AS INTEGER) AS VARCHAR) || '.0'",
    ThreatField="'DstIpAddr'",
    ThreatIpAddr="RemoteIp",
    ThreatIsActive="true",
    ThreatFirstReportedTime="EventTime",
    ThreatLastReportedTime="EventTime",
    RuleName="FindingType",
    RuleNumber="0",
    RuleAction="'Alert'",
)} FROM network WHERE RemoteIp <> '') AS mapped)"""


def with_sessions(select: str, lookback: str = "30") -> str:
    return with_base(select, lookback, more=",\n" + NETWORK + ",\n" + SESSIONS)


# D2
IDENTITY_FILTER = (
    "(COALESCE(atype, '') = 'AWS_API_CALL' OR "
    + has("ActivityType", "IAM", "Stealth", "Policy", "Credential", "UnauthorizedAPI", "Persistence", "PrivilegeEscalation")
    + ")"
)
IDENTITY = f"""raw_identity AS (SELECT {COMMON}, level, {text('atype')} AS action, {columns(
    ApiName=filled(at("api", "api"), at("dns", "dns_domain"), "'Unknown'"),
    ServiceName_API=filled(at("api", "api_service"), f"split_part({at('api', 'api')}, '.', 1)", "'Unknown'"),
    CallerType=filled(at("api", "caller_type"), "'Unknown'"),
    ErrorCode=word("api", "error_code"),
    UserAgent=filled(at("api", "user_agent"), "'Unknown'"),
    RemoteAccountId=filled(at("acct", "remote_account"), "AccountId"),
    UserName=filled(
        at("acct", "CASE WHEN affiliated THEN 'true' WHEN NOT affiliated THEN 'false' END"),
        at("key", "key_user"),
        at("key", "regexp_extract(key_principal, 'user/([^/]+)', 1)"),
    ),
    AccessKeyId=filled(at("acct", "remote_key"), at("key", "key_id")),
    PrincipalId=filled(at("acct", "remote_principal"), at("key", "key_principal")),
    SessionName=word("acct", "session_name"),
    UserType=first(
        (f"{at('key', 'key_user_type')} = 'IAMUser'", "IAM User"),
        (f"{at('key', 'key_user_type')} = 'Root'", "Root Account"),
        (f"{at('key', 'key_user_type')} = 'AssumedRole'", "Assumed Role"),
        (f"{at('acct', 'session_name')} IS NOT NULL", "Assumed Role"),
        (f"{at('key', 'key_id')} IS NOT NULL", "IAM User"),
        default="Unknown",
    ),
    ResourceArn=filled("CASE WHEN has_resource_content THEN resource_arn END", at("key", "key_id")),
    ResourceUserName=word("key", "key_user"),
    ResourceUserType=word("key", "key_user_type"),
    ResourceInstanceId=word("inst", "instance_id"),
    ResourceInstanceType=word("inst", "instance_type"),
    RemoteIp_API=filled(at("call", "call_ip"), at("svc", "service_ip"), at("net", "remote_ip")),
    RemoteCountry_API=filled(at("call", "remote_country"), at("svc", "service_country")),
    RemoteCity_API=filled(at("call", "remote_city"), at("svc", "service_city")),
    RemoteOrganization_API=filled(at("call", "remote_org"), at("svc", "remote_org")),
    RemoteIsp_API=filled(at("call", "remote_isp"), at("svc", "remote_isp")),
)} FROM b WHERE {IDENTITY_FILTER}),
judged AS (SELECT *, {columns(
    ActionResult=first(
        ("ErrorCode <> '' AND ErrorCode <> 'Success'", "Failure"),
        ("ErrorCode = 'Success'", "Success"),
        (has("FindingType", "Unauthorized"), "Failure"),
        (has("FindingType", "Stealth"), "Success"),
        ("ApiName <> ''", "Success"),
        default="Unknown",
    ),
    FindingCategory=terms(
        "FindingType",
        (("Stealth", "StealthyBehavior"), "Stealth Activity"),
        (("Policy", "PolicyViolation"), "Policy Violation"),
        (("Credential", "CredentialAccess"), "Credential Compromise"),
        (("UnauthorizedAPI", "Unauthorized"), "Unauthorized Access"),
        (("Persistence", "PersistentThreat"), "Persistence"),
        (("PrivilegeEscalation", "Escalation"), "Privilege Escalation"),
        (("Reconnaissance", "Recon"), "Reconnaissance"),
        (("Discovery", "Enum"), "Discovery"),
        default="IAM Activity",
    ),
    AuthenticationMethod=first(
        ("SessionName <> ''", "Assumed Role"),
        ("AccessKeyId <> '' AND UserType = 'Root Account'", "Root Access Key"),
        ("AccessKeyId <> ''", "Access Key"),
        default="Unknown",
    ),
    ThreatIndicators=first(
        ("RemoteCountry_API IN ('China', 'Russia', 'North Korea', 'Iran')", "High-Risk Geography"),
        (has("RemoteOrganization_API", "Tor", "VPN", "Proxy"), "Anonymization Service"),
        (has("UserAgent", "curl", "wget", "python", "boto"), "Programmatic Access"),
        (has("ApiName", "CreateUser", "AttachUserPolicy", "CreateRole"), "Privilege Operations"),
        default="",
    ),
    DataQuality=first(
        ("FindingId = ''", "Missing FindingId"),
        ("ApiName = '' AND action = 'AWS_API_CALL'", "Missing API Name"),
        ("RemoteIp_API = '' AND action = 'AWS_API_CALL'", "Missing Remote IP"),
        default="Good",
    ),
)} FROM raw_identity),
identity AS (SELECT * EXCLUDE (level, action), CASE WHEN level = 'High' AND ActionResult = 'Success' THEN 90
  WHEN level = 'High' AND ActionResult = 'Failure' THEN 70 WHEN level = 'Medium' AND ActionResult = 'Success' THEN 60
  WHEN level = 'Medium' AND ActionResult = 'Failure' THEN 40 WHEN level = 'Low' THEN 20 ELSE 10 END AS RiskScore
  FROM judged WHERE DataQuality = 'Good')"""


def with_identity(select: str, lookback: str = "30") -> str:
    return with_base(select, lookback, more=",\n" + IDENTITY)


# D3
S3_FILTER = (
    "(COALESCE(rtype, '') = 'S3Bucket' OR "
    + has(
        "ActivityType", "S3/", "Policy:S3", "Stealth:S3", "Discovery:S3", "Impact:S3", "Exfiltration:S3", "PenTest:S3",
        "Backdoor:S3", "Trojan:S3",
    )
    + ")"
)
STORAGE = f"""storage AS (SELECT * EXCLUDE (level), {banded(
    ("IsPubliclyExposed", 30),
    ("EncryptionType IN ('NONE', '')", 20),
    ("S3RiskCategory = 'Data Exfiltration'", 10),
)} AS S3RiskScore FROM (SELECT *, EffectivePermission = 'PUBLIC' OR COALESCE(AclAllowsPublicRead, false)
  OR COALESCE(AclAllowsPublicWrite, false) OR COALESCE(PolicyAllowsPublicRead, false)
  OR COALESCE(PolicyAllowsPublicWrite, false) AS IsPubliclyExposed FROM (SELECT {COMMON}, level, {columns(
    S3RiskCategory=terms(
        "ActivityType",
        (("BucketPublicAccessGranted", "BucketBlockPublicAccessDisabled"), "Public Exposure"),
        (("BucketEncryptionDisabled",), "Encryption Disabled"),
        (("ServerAccessLoggingDisabled",), "Audit Log Disabled"),
        (("Discovery",), "Reconnaissance"),
        (("Exfiltration",), "Data Exfiltration"),
        (("Impact",), "Data Impact"),
        (("PenTest",), "Penetration Testing"),
        default="S3 Anomaly",
    ),
    BucketName=word("bucket", "bucket"),
    BucketArn=word("bucket", "bucket_arn"),
    BucketType=word("bucket", "bucket_type"),
    BucketCreatedAt=at("bucket", "bucket_created_at"),
    BucketOwnerId=word("bucket", "bucket_owner"),
    EncryptionType=word("bucket", "encryption"),
    KmsKeyArn=word("bucket", "kms_arn"),
    EffectivePermission=word("bucket", "effective_permission"),
    BlockPublicAcls=at("bucket", "block_acls"),
    IgnorePublicAcls=at("bucket", "ignore_acls"),
    BlockPublicPolicy=at("bucket", "block_policy"),
    RestrictPublicBuckets=at("bucket", "restrict_buckets"),
    AccountBlockPublicAcls=at("bucket", "account_block_acls"),
    AccountIgnorePublicAcls=at("bucket", "account_ignore_acls"),
    AccountBlockPublicPolicy=at("bucket", "account_block_policy"),
    AccountRestrictPublicBuckets=at("bucket", "account_restrict_buckets"),
    AclAllowsPublicRead=at("bucket", "acl_read"),
    AclAllowsPublicWrite=at("bucket", "acl_write"),
    PolicyAllowsPublicRead=at("bucket", "policy_read"),
    PolicyAllowsPublicWrite=at("bucket", "policy_write"),
    CallerUserName=word("key", "key_user"),
    CallerUserType=word("key", "key_user_type"),
    CallerAccessKeyId=word("key", "key_id"),
    CallerPrincipalId=word("key", "key_principal"),
    ApiName=word("api", "api"),
    RemoteIp=filled(at("call", "call_ip"), at("svc", "service_ip")),
    RemoteCountry=filled(at("call", "remote_country"), at("svc", "service_country")),
    ParserVersion="'1.5.0'",
    RecordSource="'AWSGuardDuty_S3'",
)} FROM b WHERE {S3_FILTER}) AS typed) AS flagged)"""

# D4
EKS_FILTER = "(COALESCE(rtype, '') IN ('EKSCluster', 'Container') OR " + has(
    "ActivityType",
    "Kubernetes/",
    "Runtime/",
    *[f"{t}:Kubernetes" for t in ("CredentialAccess", "DefenseEvasion", "Discovery", "Execution", "Impact")],
    *[f"{t}:Kubernetes" for t in ("Persistence", "PrivilegeEscalation", "Collection")],
    *[f"{t}:Runtime" for t in ("CredentialAccess", "DefenseEvasion", "Discovery", "Execution", "Impact")],
    *[f"{t}:Runtime" for t in ("Persistence", "PrivilegeEscalation", "Exfiltration")],
) + ")"
KUBERNETES = f"""kubernetes AS (SELECT * EXCLUDE (level), {banded(
    ("K8sIsPrivileged", 20),
    ("K8sThreatCategory IN ('Privilege Escalation', 'Credential Access')", 15),
    ("K8sUserType = 'ServiceAccount' AND K8sThreatCategory <> 'Discovery'", 10),
)} AS K8sRiskScore FROM (SELECT {COMMON}, level, {columns(
    K8sThreatCategory=terms(
        "ActivityType",
        (("PrivilegeEscalation",), "Privilege Escalation"),
        (("CredentialAccess",), "Credential Access"),
        (("Persistence",), "Persistence"),
        (("DefenseEvasion",), "Defense Evasion"),
        (("Discovery",), "Discovery"),
        (("Execution",), "Execution"),
        (("Impact",), "Impact"),
        (("Exfiltration",), "Exfiltration"),
        (("Collection",), "Collection"),
        default="Kubernetes Anomaly",
    ),
    ClusterName=word("cluster", "cluster"),
    ClusterArn=word("cluster", "cluster"),
    ClusterStatus=word("cluster", "cluster_status"),
    ClusterCreatedAt=at("cluster", "cluster_created_at"),
    K8sApiName=word("k8s", "request_uri"),
    K8sApiVerb=word("k8s", "verb"),
    K8sStatusCode=f"CAST({at('k8s', 'status_code')} AS INTEGER)",
    K8sSourceIp=word("k8s", "source_ip"),
    K8sUserAgent=word("k8s", "k8s_agent"),
    K8sIsAdminCall=f"contains(lower({word('k8s', 'parameters')}), 'admin')",
    K8sUserName=word("info", "k8s_user"),
    K8sUserType=first(
        (f"lower({at('info', 'k8s_user')}) LIKE 'system:serviceaccount:%'", "ServiceAccount"),
        (f"lower({at('info', 'k8s_user')}) LIKE 'system:%'", "System"),
        (f"{at('info', 'k8s_user')} IS NOT NULL", "User"),
        default="Unknown",
    ),
    K8sUserGroups=word("info", "CASE WHEN user_group IS NULL THEN '[]' ELSE '[\"' || user_group || '\"]' END"),
    K8sNamespace=word("info", "namespace"),
    K8sObjectKind=word("info", "object_kind"),
    K8sObjectName=word("info", "object_name"),
    K8sContainerImage=word("box", "image"),
    K8sContainerName=word("box", "container"),
    K8sIsPrivileged=at("box", "privileged"),
    RuntimeProcess=word("run", "process"),
    RuntimeProcessPath=word("run", "process_path"),
    RuntimeProcessPid=f"CAST({at('run', 'pid')} AS INTEGER)",
    RuntimeProcessUser=word("run", "process_user"),
    RuntimeProcessArgs=word("run", "process_hash"),
    RuntimeContext=word("run", "command_line"),
    RuntimeFilePath=word("run", "target_path"),
    K8sRemoteIp=word("k8s", "source_ip"),
    K8sRemoteCountry=word("net", "remote_country"),
    ParserVersion="'1.5.0'",
    RecordSource="'AWSGuardDuty_EKS'",
)} FROM b WHERE {EKS_FILTER}) AS typed)"""

# D5
MALWARE_FILTER = (
    "("
    + has(
        "ActivityType", "Execution:EC2/MaliciousFile", "Execution:EC2/SuspiciousFile", "Execution:ECS/MaliciousFile",
        "Execution:ECS/SuspiciousFile", "Execution:Kubernetes/MaliciousFile", "Backdoor:EC2/C&CActivity", "Trojan:EC2/",
        "Behavior:EC2/NetworkPortUnusual",
    )
    + " OR (COALESCE(rtype, '') = 'Instance' AND "
    + has("ActivityType", "Execution", "Backdoor", "Trojan")
    + "))"
)


def _file(name: str) -> str:
    parts = " || ',' || ".join(
        f"'\"{key}\":' || {value}"
        for key, value in (
            ("fileName", f"'\"{name}\"'"),
            ("filePath", "'\"' || file_path || '\"'"),
            ("fileSha256", "COALESCE('\"' || file_hash || '\"', 'null')"),
            ("volumeArn", "'\"' || volume_arn || '\"'"),
        )
    )
    return f"'{{' || {parts} || '}}'"


THREATS_JSON = (
    "'[{' || concat_ws(',', CASE file_count "
    f"WHEN 2 THEN '\"filePaths\":[' || {_file('payload.bin')} || ',' || {_file('second.bin')} || ']' "
    f"WHEN 1 THEN '\"filePaths\":[' || {_file('payload.bin')} || ']' WHEN 0 THEN '\"filePaths\":[]' END, "
    "'\"name\":\"' || threat || '\"') || '}]'"
)
MALWARE = f"""malware AS (SELECT * EXCLUDE (level), {banded(
    ("ScanResultStatus = 'THREATS_FOUND'", 25),
    ("MalwareCategory IN ('Ransomware', 'Rootkit')", 20),
    ("MalwareCategory = 'Remote Access Trojan'", 15),
    ("MalwareCategory = 'Backdoor / C2'", 15),
    ("ThreatFileSha256 <> ''", 10),
)} AS MalwareRiskScore FROM (SELECT *, {first(
    (has("ThreatName", "EICAR", "Test"), "Test File"),
    (has("ThreatName", "Trojan", "RAT"), "Remote Access Trojan"),
    (has("ThreatName", "Ransom", "Ransomware"), "Ransomware"),
    (has("ThreatName", "Coin", "Miner", "XMR"), "Cryptominer"),
    (has("ThreatName", "Backdoor", "C2", "C&C"), "Backdoor / C2"),
    (has("ThreatName", "Rootkit"), "Rootkit"),
    (has("ThreatName", "Worm"), "Worm"),
    (has("ThreatName", "Spyware", "Keylogger"), "Spyware"),
    ("ScanResultStatus = 'THREATS_FOUND'", "Malware (unclassified)"),
    default="Suspicious File",
)} AS MalwareCategory FROM (SELECT {COMMON}, level, {columns(
    ScanId=word("scan", "scan_id"),
    ScanType=word("scan", "scan_type"),
    ScanStartedAt=at("scan", "scan_started_at"),
    ScanCompletedAt=at("scan", "scan_done_at"),
    ScanResultStatus=word("scan", "scan_status"),
    TriggerFindingId=word("scan", "trigger_id"),
    ThreatName=word("scan", "threat"),
    ThreatFilePath=word("file", "file_path"),
    ThreatFileName=word("file", "'payload.bin'"),
    ThreatFileSha256=word("file", "file_hash"),
    ThreatVolumeArn=word("file", "volume_arn"),
    ThreatCount=f"CAST({at('scan', 'file_count')} AS INTEGER)",
    AllThreatNames=word("scan", THREATS_JSON),
    InstanceId=word("inst", "instance_id"),
    InstanceType=word("inst", "instance_type"),
    InstanceState=word("inst", "instance_state"),
    Platform=word("inst", "platform"),
    ImageId=word("inst", "image_id"),
    AvailabilityZone=word("inst", "zone"),
    VpcId=word("iface", "vpc_id"),
    PrivateIp=word("iface", "private_ip"),
    PublicIp=word("iface", "public_ip"),
    EcsClusterName=word("ecs", "ecs_cluster"),
    EcsClusterArn=word("ecs", "ecs_cluster"),
    EcsTaskArn=word("ecs", "ecs_task"),
    EcsContainerImage=word("ecs", "image"),
    ParserVersion="'1.5.0'",
    RecordSource="'AWSGuardDuty_Malware'",
)} FROM b WHERE {MALWARE_FILTER}) AS typed) AS named)"""

# D6
RDS_FILTER = (
    "(COALESCE(rtype, '') = 'RDSDBInstance' OR "
    + has(
        "ActivityType", "RDS/", "CredentialAccess:RDS", "Discovery:RDS", "Impact:RDS", "Exfiltration:RDS", "PenTest:RDS"
    )
    + ")"
)
DATABASE = f"""databases AS (SELECT * EXCLUDE (level), {banded(
    ("DbPubliclyAccessible", 20),
    ("DbStorageEncrypted = false", 15),
    ("RdsThreatCategory = 'Brute Force'", 15),
    ("RdsThreatCategory = 'Data Exfiltration'", 10),
)} AS RdsRiskScore FROM (SELECT {COMMON}, level, {columns(
    RdsThreatCategory=terms(
        "ActivityType",
        (("CredentialAccess",), "Credential Access"),
        (("BruteForce",), "Brute Force"),
        (("AnomalousBehavior",), "Anomalous Behaviour"),
        (("Discovery",), "Reconnaissance"),
        (("Exfiltration",), "Data Exfiltration"),
        (("Impact",), "Data Impact"),
        (("PenTest",), "Penetration Testing"),
        default="RDS Anomaly",
    ),
    DbInstanceId=word("db", "db_id"),
    DbClusterId=word("db", "db_cluster"),
    DbEngine=word("db", "db_engine"),
    DbEngineVersion=word("db", "db_version"),
    DbInstanceClass=word("db", "db_class"),
    DbInstancePort=f"CAST({at('db', 'db_port')} AS INTEGER)",
    DbInstanceStatus=word("db", "db_status"),
    DbStorageEncrypted=at("db", "db_encrypted"),
    DbPubliclyAccessible=at("db", "db_public"),
    DbMultiAz=at("db", "db_multi_az"),
    DbAvailabilityZone=word("db", "db_zone"),
    LoginUser=word("login", "login_user"),
    LoginApplication=word("login", "login_app"),
    LoginFailedCount=f"CAST({at('login', 'failed_logins')} AS INTEGER)",
    LoginSuccessCount=f"CAST({at('login', 'good_logins')} AS INTEGER)",
    CallerUserName=word("key", "key_user"),
    CallerUserType=word("key", "key_user_type"),
    CallerAccessKeyId=word("key", "key_id"),
    CallerPrincipalId=word("key", "key_principal"),
    ApiName=word("api", "api"),
    RemoteIp_RDS=word("login", "service_ip"),
    RemoteCountry_RDS=word("login", "service_country"),
    RemoteCity_RDS=word("login", "service_city"),
    RemoteOrg_RDS=word("login", "remote_org"),
    ParserVersion="'1.5.0'",
    RecordSource="'AWSGuardDuty_RDS'",
)} FROM b WHERE {RDS_FILTER}) AS typed)"""

# B7
QUALITY_CATEGORY = first(
    ("Id = ''", "Missing FindingId"),
    ("ActivityType = ''", "Missing FindingType"),
    ("SeverityInt IS NULL OR SeverityInt NOT BETWEEN 0 AND 10", "Invalid Severity"),
    ("AccountId = ''", "Missing AccountId"),
    ("Region = ''", "Missing Region"),
    ("TimeCreated IS NULL OR TimeGenerated IS NULL", "Missing Timestamp"),
    (
        "NOT has_resource_content OR (resource_type IS NULL AND resource_arn IS NULL AND NOT has_key AND NOT has_ecs "
        "AND NOT has_cluster AND NOT has_instance AND NOT has_db AND NOT has_bucket)",
        "Missing ResourceDetails",
    ),
    ("NOT has_service", "Missing ServiceDetails"),
    ("SchemaVersion = ''", "Missing Schema Version"),
    ("SchemaVersion NOT LIKE '2.%'", "Unsupported Schema Version"),
    default="Valid",
)


def with_quality(select: str, lookback: str = "30") -> str:
    return f"""WITH {TABLE}, quality AS (SELECT TimeGenerated, Id, ActivityType, {QUALITY_CATEGORY} AS QualityCategory,
  SchemaVersion, AccountId, Region FROM t WHERE TimeGenerated >= {AS_OF_SQL} - INTERVAL '{lookback}' DAY)
{select}"""


# B1, B2
MISSING = (
    "concat_ws(', ', CASE WHEN account_id = '' THEN 'accountId' END, "
    "CASE WHEN created_at IS NULL THEN 'createdAt' END, CASE WHEN finding_id = '' THEN 'id' END, "
    "CASE WHEN region = '' THEN 'region' END, CASE WHEN schema_version = '' THEN 'schemaVersion' END, "
    "CASE WHEN severity IS NULL THEN 'severity' END, CASE WHEN activity_type = '' THEN 'type' END)"
)
FINDING_ERROR = (
    f"CASE WHEN {MISSING} <> '' THEN 'finding is missing required fields: ' || {MISSING} "
    "WHEN severity < 0 OR severity > 10 THEN 'severity must be between 0 and 10' END"
)
# A3, A4: error of the export form of a copy, by form number.
BATCH_ERROR = (
    "CASE e % 12 WHEN 3 THEN 'findings must be a non-empty array' WHEN 4 THEN 'every finding must be an object' "
    "WHEN 5 THEN 'line is not valid JSON' END"
)
EVENT_ERROR = (
    f"COALESCE({BATCH_ERROR}, CASE e % 12 WHEN 1 THEN 'event source must be aws.guardduty' "
    "WHEN 6 THEN 'event detail must be an object' WHEN 7 THEN 'unrecognized event format' END)"
)
# A batch of two copies gives two rows.
MIXED = f"""mixed AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE e % 12 = 2),
checked AS (SELECT *, COALESCE({EVENT_ERROR}, {FINDING_ERROR}) AS contract_error FROM mixed)"""
