"""Findings derived from the ``events`` table.

Every event becomes one copy of a finding; three neighbouring events share a finding id. The attributes of a copy are
plain SQL expressions that Spark and DuckDB read alike. Spark turns them into JSON text and runs the product on it;
the oracle never builds JSON and states the rules over the attributes instead.
"""

from __future__ import annotations

from datetime import datetime, timezone

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"

# Finding types of the derived data, by class number.
TYPES = (
    "Backdoor:EC2/C&CActivity.B!DNS",
    "Trojan:EC2/DNSDataExfiltration",
    "CryptoCurrency:EC2/BitcoinTool.B!DNS",
    "Recon:EC2/PortProbeUnprotectedPort",
    "UnauthorizedAccess:EC2/TorClient",
    "Behavior:EC2/NetworkPortUnusual",
    "Stealth:IAMUser/CloudTrailLoggingDisabled",
    "Policy:IAMUser/RootCredentialUsage",
    "CredentialAccess:IAMUser/AnomalousBehavior",
    "Persistence:IAMUser/AnomalousBehavior",
    "PrivilegeEscalation:IAMUser/AnomalousBehavior",
    "Policy:S3/BucketBlockPublicAccessDisabled",
    "Stealth:S3/ServerAccessLoggingDisabled",
    "Discovery:S3/MaliciousIPCaller",
    "Exfiltration:S3/AnomalousBehavior",
    "PenTest:S3/KaliLinux",
    "PrivilegeEscalation:Kubernetes/PrivilegedContainer",
    "Discovery:Kubernetes/SuccessfulAnonymousAccess",
    "Execution:Runtime/NewBinaryExecuted",
    "Execution:EC2/MaliciousFile",
    "Execution:Kubernetes/MaliciousFile",
    "CredentialAccess:RDS/AnomalousBehavior.SuccessfulBruteForce",
    "Discovery:RDS/MaliciousIPCaller",
    "Impact:EC2/WinRMBruteForce",
)

NET = "k IN (0, 1, 2, 3, 4, 5, 19, 23)"
API = "k IN (6, 7, 8, 9, 10, 11, 12, 13, 14, 16)"
S3 = "k BETWEEN 11 AND 15"
EKS = "k IN (16, 17, 18, 20)"
SCAN = "k IN (0, 19, 20)"
RDS = "k IN (21, 22)"


def pick(index: str, *values, default="NULL") -> str:
    """``CASE index WHEN 0 THEN ...``; ``None`` stands for NULL."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        return str(value).lower() if isinstance(value, bool) else (
            str(value) if isinstance(value, (int, float)) else "'" + value + "'"
        )

    whens = " ".join(f"WHEN {i} THEN {literal(v)}" for i, v in enumerate(values))
    return f"CASE {index} {whens} ELSE {default} END"


def when(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


def flag(step: int) -> str:
    """True, false or absent, by event."""
    return pick(f"(h + {step}) % 3", True, False, None)


def text_of(number: str) -> str:
    return f"CAST({number} AS STRING)"


# Attributes that others build on.
FIRST = {
    "e": "event_id",
    "u": "user_id",
    "k": "(event_id + user_id) % 24",
    # The newest of three neighbours always has the same event_id % 3, so variations follow a mix of both numbers.
    "h": "event_id * 7 + user_id * 13",
    "ts": "ts",
}
# Attribute name: portable expression over ``e``, ``u``, ``k``, ``h`` and ``ts``.
ATTRIBUTES = {
    "finding_id": f"CASE WHEN e % 311 = 0 THEN '' ELSE 'f-' || {text_of('e - e % 3')} END",
    "activity_type": f"CASE WHEN h % 313 = 0 THEN '' ELSE {pick('k', *TYPES)} END",
    "account_id": f"CASE WHEN h % 37 = 0 THEN '' ELSE lpad({text_of('u')}, 12, '0') END",
    "region": f"CASE WHEN h % 47 = 0 THEN '' ELSE {pick('u % 4', 'us-east-1', 'us-west-2', 'eu-west-1', 'ap-south-1')} END",
    "arn": f"'arn:aws:guardduty:finding/' || lpad({text_of('e')}, 12, '0')",
    "part": pick("h % 20", "aws-cn", None, default="'aws'"),
    "schema_version": "CASE WHEN h % 41 = 0 THEN '1.0' WHEN h % 43 = 0 THEN '' ELSE '2.0' END",
    "severity": (
        "CASE WHEN h % 211 = 0 THEN 12.5e0 WHEN h % 223 = 0 THEN -1.5e0 WHEN h % 227 = 0 THEN NULL "
        "ELSE CAST(h % 103 AS DOUBLE) / 10e0 END"
    ),
    "created_at": "CASE WHEN h % 53 = 0 THEN NULL ELSE ts - INTERVAL '5' MINUTE END",
    "updated_at": "ts",
    "title": f"CASE WHEN h % 59 = 0 THEN NULL ELSE 'Fund é ' || {text_of('h % 100')} END",
    "description": f"CASE WHEN h % 61 = 0 THEN NULL ELSE 'Copy ' || {text_of('e')} END",
    "confidence": pick("h % 50", 101.5, -1, default="h % 100"),
    "has_service": "h % 71 <> 0",
    "has_resource_content": "h % 73 <> 0",
    "detector_id": f"'d-' || {text_of('u % 7')}",
    "resource_type": (
        f"CASE WHEN h % 67 = 0 THEN NULL WHEN {NET} THEN 'Instance' WHEN {S3} THEN 'S3Bucket' "
        f"WHEN k = 18 THEN 'Container' WHEN {EKS} THEN 'EKSCluster' WHEN {RDS} THEN 'RDSDBInstance' "
        "ELSE 'AccessKey' END"
    ),
    "action_type": (
        f"CASE WHEN h % 29 = 0 THEN NULL WHEN {NET} THEN 'NETWORK_CONNECTION' WHEN {API} THEN 'AWS_API_CALL' "
        f"WHEN {EKS} THEN 'KUBERNETES_API_CALL' WHEN {RDS} THEN 'RDS_LOGIN_ATTEMPT' END"
    ),
    # network connection
    "has_net": NET + " AND h % 31 <> 1",
    "direction": pick("h % 5", "INBOUND", "OUTBOUND", "UNKNOWN", "OUTBOUND", None),
    "protocol": pick("h % 7", "TCP", "UDP", "icmp", None, "TCP", "", "TCP"),
    "blocked": flag(0),
    "local_port": when("h % 11 <> 0", "1024 + u % 60000"),
    "local_port_name": pick("h % 4", "Unknown", None, "HTTP", "SSH"),
    "remote_port": pick("h % 9", 80, 443, 53, 22, 3389, 25, 21, 8080, None),
    "remote_port_name": pick("h % 5", "HTTPS", "DNS", None, "SSH", ""),
    "remote_ip": (
        "CASE WHEN h % 13 = 0 THEN NULL WHEN h % 10 < 3 THEN '198.51.100.7' "
        f"ELSE '203.0.' || {text_of('u % 200')} || '.' || {text_of('h % 250')} END"
    ),
    "remote_ip6": when("h % 13 = 0", f"'2001:db8::' || {text_of('h % 9999')}"),
    "remote_country": pick("h % 6", "United States", "China", "Germany", "Russia", "", None),
    "remote_country_code": pick("h % 6", "US", "CN", "DE", "RU", "", None),
    "remote_city": pick("h % 5", "Seattle", "Berlin", None, "Lima", "Oslo"),
    "remote_org": pick("h % 8", "Tor Exit", "Example VPN", "TorServers", "Proxy-Net", "Acme", None, "Acme", "Vpnish"),
    "remote_isp": pick("h % 3", "Example ISP", None, "Other ISP"),
    "remote_asn": pick("h % 4", "64500", "64501", None, "64502"),
    "remote_asn_org": pick("h % 4", "Example Network", None, "Acme", "Other"),
    "remote_lat": when("h % 5 <> 2", "CAST(h % 90 AS DOUBLE) + 0.5e0"),
    "remote_lon": when("h % 5 <> 2", "CAST(h % 180 AS DOUBLE) * -1e0 - 0.25e0"),
    # instance
    "has_instance": f"({NET} OR k = 6) AND h % 17 <> 3",
    "instance_id": f"'i-' || {text_of('u % 997')}",
    "instance_type": pick("u % 3", "t3.micro", "m5.large", None),
    "instance_state": pick("h % 2", "running", "stopped"),
    "platform": pick("h % 4", "windows", "linux", "Ubuntu", None),
    "launched_at": when("h % 7 <> 0", "ts - INTERVAL '10' DAY"),
    "zone": pick("u % 2", "us-west-2a", "us-west-2b"),
    "image_id": f"'ami-' || {text_of('u % 50')}",
    "image_text": pick("u % 3", "base image", None, "Büro"),
    "interface_kind": "CASE WHEN h % 17 < 3 THEN h % 17 ELSE 3 END",
    "interface_id": f"'eni-' || {text_of('u % 600')}",
    "vpc_id": f"'vpc-' || {text_of('u % 9')}",
    "subnet_id": f"'subnet-' || {text_of('u % 30')}",
    "private_ip": when("h % 19 <> 5", f"'10.0.' || {text_of('u % 250')} || '.' || {text_of('h % 200')}"),
    "private_dns": f"'ip-' || {text_of('u % 250')}",
    "public_ip": when("h % 2 = 0", f"'192.0.2.' || {text_of('u % 250')}"),
    "public_dns": when("h % 2 = 0", f"'ec2-' || {text_of('u % 250')}"),
    "group_count": pick("h % 4", 2, 1, 0, None),
    "group_a": f"'sg-' || {text_of('u % 40')}",
    "group_b": f"'sg-b' || {text_of('u % 40')}",
    # API call
    "has_api": API + " AND h % 23 <> 4",
    "api": pick(
        "h % 9", "CreateUser", "iam.ListUsers", "GetObject", "AttachUserPolicy", None, "CreateRole", "DeleteTrail",
        "StopLogging", "AssumeRole",
    ),
    "api_service": pick("h % 4", "s3.amazonaws.com", None, "iam.amazonaws.com", None),
    "caller_type": pick("h % 3", "Remote IP", None, "Domain"),
    "error_code": pick("h % 5", "AccessDenied", "Success", None, "", None),
    "user_agent": pick("h % 7", "aws-cli/2.0", "curl/8", "python-requests", "boto3/1.0", None, "Wget", "console"),
    "call_has_remote": "h % 3 = 0",
    "service_has_remote": "h % 3 <> 2",
    "call_ip": when("h % 4 <> 0", f"'100.64.' || {text_of('u % 250')} || '.' || {text_of('h % 250')}"),
    "service_ip": f"'100.65.' || {text_of('u % 250')} || '.' || {text_of('h % 250')}",
    "service_country": pick("h % 4", "Iran", "France", None, "North Korea"),
    "service_city": pick("h % 4", "Shiraz", "Paris", None, "Nampo"),
    "has_remote_account": "h % 2 = 0",
    "remote_account": when("h % 4 = 0", f"lpad({text_of('u + 1')}, 12, '9')"),
    "affiliated": pick("h % 6", True, None, False, None, None, None),
    "remote_key": when("h % 8 = 0", f"'AKIAR' || {text_of('u % 300')}"),
    "remote_principal": when("h % 10 = 0", f"'AROAR' || {text_of('u % 300')}"),
    "session_name": when("h % 12 = 0", f"'session-' || {text_of('u % 20')}"),
    "has_dns_action": "k IN (7, 10) AND h % 2 = 1",
    "dns_domain": pick("h % 3", "evil.example", "c2.example", None),
    # access key
    "has_key": f"({API} OR {S3} OR {RDS}) AND h % 5 <> 0",
    "key_user": pick("h % 4", "alice", None, "bob", ""),
    "key_user_type": pick("h % 6", "IAMUser", "Root", "AssumedRole", "Federated", None, "IAMUser"),
    "key_id": when("h % 7 <> 1", f"'AKIA' || {text_of('u % 300')}"),
    "key_principal": pick("h % 3", "AIDA:user/carol/x", "AIDA1234", None),
    "resource_arn": when("h % 6 = 0", f"'arn:aws:iam::' || {text_of('u')}"),
    # bucket
    "has_bucket": S3 + " AND h % 19 <> 2",
    "bucket": f"'bucket-' || {text_of('u % 80')}",
    "bucket_arn": f"'arn:aws:s3:::bucket-' || {text_of('u % 80')}",
    "bucket_type": pick("h % 2", "Destination", None),
    "bucket_created_at": when("h % 3 <> 0", "ts - INTERVAL '400' DAY"),
    "bucket_owner": pick("h % 4", "owner-1", "owner-2", None, "owner-3"),
    "encryption": pick("h % 4", "NONE", "aws:kms", None, "AES256"),
    "kms_arn": when("h % 4 = 1", f"'arn:aws:kms:key/' || {text_of('u % 10')}"),
    "block_acls": flag(0),
    "ignore_acls": flag(1),
    "block_policy": flag(2),
    "restrict_buckets": pick("h % 2", True, False),
    "account_block_acls": flag(1),
    "account_ignore_acls": flag(2),
    "account_block_policy": flag(0),
    "account_restrict_buckets": pick("h % 5", True, None, False, None, True),
    "acl_read": pick("h % 9", True, False, None, False, None, False, False, None, False),
    "acl_write": pick("h % 11", True, False, None, default="false"),
    "policy_read": pick("h % 13", True, False, None, default="false"),
    "policy_write": pick("h % 7", None, False, None, default="false"),
    "effective_permission": pick("h % 5", "PUBLIC", "NOT_PUBLIC", None, "NOT_PUBLIC", "UNKNOWN"),
    # cluster
    "has_cluster": EKS + " AND h % 13 <> 6",
    "cluster": f"'cluster-' || {text_of('u % 12')}",
    "cluster_status": pick("h % 2", "ACTIVE", None),
    "cluster_created_at": when("h % 4 <> 0", "ts - INTERVAL '90' DAY"),
    "has_k8s_call": "k IN (16, 17, 20)",
    "request_uri": pick("h % 3", "/api/v1/pods", "/apis/rbac", None),
    "verb": pick("h % 3", "create", "list", "delete"),
    "source_ip": when("h % 5 <> 0", f"'172.16.' || {text_of('u % 250')} || '.' || {text_of('h % 250')}"),
    "k8s_agent": pick("h % 4", "kubectl/1.29", None, "helm", "curl"),
    "status_code": pick("h % 3", 200, 403, None),
    "parameters": pick("h % 4", "name=cluster-ADMIN", "name=view", None, "role=administrator"),
    "k8s_user": pick(
        "h % 5", "system:serviceaccount:kube-system:default", "System:node:a", "eve", None, "SYSTEM:serviceaccount:x:y"
    ),
    "user_group": pick("h % 3", "system:masters", None, "dev"),
    "namespace": pick("u % 3", "default", "kube-system", "prod"),
    "object_kind": pick("h % 3", "pods", "deployments", None),
    "object_name": f"'object-' || {text_of('u % 70')}",
    "has_container": "h % 8 <> 0",
    "image": pick("h % 3", "nginx:latest", "busybox", None),
    "container": f"'container-' || {text_of('u % 30')}",
    "privileged": flag(2),
    "has_runtime": "k IN (18, 20)",
    "process": pick("h % 3", "bash", "xmrig", None),
    "process_path": pick("h % 3", "/bin/bash", "/tmp/xmrig", None),
    "pid": when("h % 6 <> 0", "100 + h % 30000"),
    "process_user": pick("h % 2", "root", None),
    "process_hash": when("h % 2 = 0", f"'hash-' || {text_of('e')}"),
    "command_line": pick("h % 4", "nc -e", None, "sh -c id", "wget x"),
    "target_path": pick("h % 3", "/usr/bin/nc", None, "/bin/sh"),
    # malware scan
    "has_scan": SCAN + " AND h % 4 <> 3",
    "scan_id": f"'scan-' || {text_of('e')}",
    "scan_type": pick("h % 2", "GUARDDUTY_INITIATED", "ON_DEMAND"),
    "scan_started_at": "ts - INTERVAL '30' MINUTE",
    "scan_done_at": when("h % 6 <> 0", "ts - INTERVAL '20' MINUTE"),
    "trigger_id": f"'t-' || {text_of('h % 500')}",
    "scan_status": pick("h % 3", "THREATS_FOUND", "NO_THREATS_FOUND", None),
    "threat": pick(
        "h % 14", "EICAR-Test-File", "Win.Trojan.Agent", "Ransom.Locky", "XMR-Miner", "Linux/Backdoor.C2", "Rootkit.A",
        "Worm/Mirai", "Spyware.X", "Generic.Gen", "AWORM", "Keylogger 9", None, "PUA C&C", "Trojanized",
    ),
    "file_count": pick("h % 5", 2, 1, 0, None, 1),
    "file_path": f"'/data/' || {text_of('u % 90')}",
    "file_hash": when("h % 3 <> 1", f"'sha-' || {text_of('h % 1000')}"),
    "volume_arn": f"'arn:aws:ec2:volume/' || {text_of('u % 60')}",
    "has_ecs": "k = 20 AND h % 2 = 0",
    "ecs_cluster": f"'ecs-' || {text_of('u % 6')}",
    "ecs_task": f"'task-' || {text_of('u % 60')}",
    # database
    "has_db": RDS + " AND h % 11 <> 7",
    "db_id": f"'db-' || {text_of('u % 45')}",
    "db_cluster": when("h % 2 = 0", f"'dbc-' || {text_of('u % 9')}"),
    "db_engine": pick("u % 3", "postgres", "mysql", "aurora"),
    "db_version": pick("u % 2", "15.4", "8.0"),
    "db_class": pick("h % 2", "db.r6g.large", None),
    "db_port": pick("h % 3", 5432, 3306, None),
    "db_status": pick("h % 2", "available", None),
    "db_encrypted": flag(1),
    "db_zone": pick("u % 2", "us-west-2a", None),
    "db_multi_az": flag(2),
    "db_public": flag(0),
    "has_login": RDS + " AND h % 9 <> 8",
    "login_user": pick("h % 3", "admin", "app", None),
    "login_app": pick("h % 2", "psql", None),
    "failed_logins": pick("h % 4", 0, 12, 3, None),
    "good_logins": pick("h % 5", 1, 0, None, 2, 5),
}

STRING, NUMBER, BOOLEAN, TIME, RAW = "string", "number", "boolean", "time", "raw"


def string(name: str):
    return STRING, name


def number(name: str):
    return NUMBER, name


def boolean(name: str):
    return BOOLEAN, name


def moment(name: str):
    return TIME, name


def constant(value: str):
    return RAW, "'" + value + "'"


def only(condition: str, value):
    """A member that is there when the condition holds."""
    return "only", (condition, value)


def items(*values):
    """An array; an item that is null is left out."""
    return "items", values


def choose(*cases):
    """The value of the first ``(condition, value)`` that holds, no member when none does."""
    return "choose", cases


def json_value(value) -> str:
    """Spark SQL for a template value as a struct, array or scalar."""
    if isinstance(value, dict):
        members = ", ".join(f"'{key}', {json_value(value[key])}" for key in sorted(value))
        return f"named_struct({members})"
    kind, body = value
    if kind == TIME:
        return f"date_format({body}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
    if kind == "only":
        return f"CASE WHEN {body[0]} THEN {json_value(body[1])} END"
    if kind == "choose":
        cases = " ".join(f"WHEN {c} THEN {_any_kind(v)}" for c, v in body)
        return f"CASE {cases} END"
    if kind == "items":
        return "array_compact(array(" + ", ".join(json_value(v) for v in body) + "))"
    return body


EMPTY = ((RAW, "'[]'"), (RAW, "'{}'"))


def _any_kind(value) -> str:
    """The value as a variant, so that the cases of one member may differ in kind."""
    if value in EMPTY:
        return f"parse_json({value[1]})"
    return f"to_variant_object({json_value(value)})"


def json_sql(template: dict) -> str:
    """Spark SQL for the JSON text of a template; null members are left out, keys are sorted."""
    return f"to_json({json_value(template)})"


def json_text(value, nulls: bool = False) -> str:
    """DuckDB SQL for the compact JSON text of a template value with sorted keys, as a stored variant is rendered.

    Null members are left out, but inside a ``choose`` they read ``null``: there the value was made a variant with
    them. Whole numbers are rendered without a fraction.
    """
    if isinstance(value, dict):
        members = []
        for key in sorted(value):
            inner = json_text(value[key], nulls)
            members.append(f"'\"{key}\":' || " + (f"COALESCE({inner}, 'null')" if nulls else f"({inner})"))
        return "('{' || concat_ws(',', " + ", ".join(members) + ") || '}')"
    kind, body = value
    if kind == TIME:
        return f"'\"' || strftime({body}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z\"'"
    if kind == STRING:
        return f"CASE WHEN {body} IS NOT NULL THEN CAST(to_json(CAST({body} AS VARCHAR)) AS VARCHAR) END"
    if kind == RAW:
        return f"'\"' || {body} || '\"'"
    if kind == BOOLEAN:
        return f"CASE WHEN {body} THEN 'true' WHEN NOT ({body}) THEN 'false' END"
    if kind == NUMBER:
        return f"CASE WHEN {body} = floor({body}) THEN CAST(CAST({body} AS BIGINT) AS VARCHAR) ELSE CAST({body} AS VARCHAR) END"
    if kind == "only":
        return f"CASE WHEN {body[0]} THEN {json_text(body[1], nulls)} END"
    if kind == "choose":
        cases = " ".join(f"WHEN {c} THEN {v[1] if v in EMPTY else json_text(v, True)}" for c, v in body)
        return f"CASE {cases} END"
    return "'[' || concat_ws(',', " + ", ".join(json_text(v, nulls) for v in body) + ") || ']'"


INTERFACE = {
    "networkInterfaceId": string("interface_id"),
    "privateDnsName": string("private_dns"),
    "privateIpAddress": string("private_ip"),
    "publicDnsName": string("public_dns"),
    "publicIp": string("public_ip"),
    "securityGroups": choose(
        (
            "group_count = 2",
            items(
                {"groupId": string("group_a"), "groupName": constant("a")},
                {"groupId": string("group_b"), "groupName": constant("b")},
            ),
        ),
        ("group_count = 1", items({"groupId": string("group_a"), "groupName": constant('a')})),
        ("group_count = 0", constant("[]")),
    ),
    "subnetId": string("subnet_id"),
    "vpcId": string("vpc_id"),
}
BLOCK = {
    "blockPublicAcls": boolean("block_acls"),
    "blockPublicPolicy": boolean("block_policy"),
    "ignorePublicAcls": boolean("ignore_acls"),
    "restrictPublicBuckets": boolean("restrict_buckets"),
}
ACCOUNT_BLOCK = {key: boolean("account_" + name) for key, (_, name) in BLOCK.items()}
FILE = {
    "fileName": constant('payload.bin'),
    "filePath": string("file_path"),
    "fileSha256": string("file_hash"),
    "volumeArn": string("volume_arn"),
}
RESOURCE = {
    "accessKeyDetails": only(
        "has_key",
        {
            "accessKeyId": string("key_id"),
            "principalId": string("key_principal"),
            "userName": string("key_user"),
            "userType": string("key_user_type"),
        },
    ),
    "ecsClusterDetails": only(
        "has_ecs",
        {
            "arn": string("ecs_cluster"),
            "name": string("ecs_cluster"),
            "taskDetails": {"arn": string("ecs_task"), "containers": items({"image": string("image")})},
        },
    ),
    "eksClusterDetails": only(
        "has_cluster",
        {
            "arn": string("cluster"),
            "createdAt": moment("cluster_created_at"),
            "name": string("cluster"),
            "status": string("cluster_status"),
        },
    ),
    "instanceDetails": only(
        "has_instance",
        {
            "availabilityZone": string("zone"),
            "imageDescription": string("image_text"),
            "imageId": string("image_id"),
            "instanceId": string("instance_id"),
            "instanceState": string("instance_state"),
            "instanceType": string("instance_type"),
            "launchTime": moment("launched_at"),
            "networkInterfaces": choose(
                ("interface_kind = 1", constant("[]")),
                ("interface_kind = 2", constant("{}")),
                ("interface_kind = 3", items(INTERFACE)),
            ),
            "platform": string("platform"),
        },
    ),
    "rdsDbInstanceDetails": only(
        "has_db",
        {
            "availabilityZone": string("db_zone"),
            "dbClusterIdentifier": string("db_cluster"),
            "dbInstanceClass": string("db_class"),
            "dbInstanceIdentifier": string("db_id"),
            "dbInstancePort": number("db_port"),
            "dbInstanceStatus": string("db_status"),
            "engine": string("db_engine"),
            "engineVersion": string("db_version"),
            "multiAz": boolean("db_multi_az"),
            "publiclyAccessible": boolean("db_public"),
            "storageEncrypted": boolean("db_encrypted"),
        },
    ),
    "resourceArn": string("resource_arn"),
    "resourceType": string("resource_type"),
    "s3BucketDetails": only(
        "has_bucket",
        items(
            {
                "arn": string("bucket_arn"),
                "createdAt": moment("bucket_created_at"),
                "defaultServerSideEncryption": {
                    "encryptionType": string("encryption"),
                    "kmsMasterKeyArn": string("kms_arn"),
                },
                "name": string("bucket"),
                "owner": {"id": string("bucket_owner")},
                "publicAccess": {
                    "effectivePermission": string("effective_permission"),
                    "permissionConfiguration": {
                        "accountLevelPermissions": {"blockPublicAccess": ACCOUNT_BLOCK},
                        "bucketLevelPermissions": {
                            "accessControlList": {
                                "allowsPublicReadAccess": boolean("acl_read"),
                                "allowsPublicWriteAccess": boolean("acl_write"),
                            },
                            "blockPublicAccess": BLOCK,
                            "bucketPolicy": {
                                "allowsPublicReadAccess": boolean("policy_read"),
                                "allowsPublicWriteAccess": boolean("policy_write"),
                            },
                        },
                    },
                },
                "type": string("bucket_type"),
            }
        ),
    ),
}

RESOURCE = {key: only("has_resource_content", value) for key, value in RESOURCE.items()}


def remote(ip: str, country: str, city: str) -> dict:
    return {
        "city": {"cityName": string(city)},
        "country": {"countryName": string(country)},
        "ipAddressV4": string(ip),
        "organization": {"isp": string("remote_isp"), "org": string("remote_org")},
    }


CONNECTION_REMOTE = {
    **remote("remote_ip", "remote_country", "remote_city"),
    "country": {"countryCode": string("remote_country_code"), "countryName": string("remote_country")},
    "geoLocation": {"lat": number("remote_lat"), "lon": number("remote_lon")},
    "ipAddressV6": string("remote_ip6"),
    "organization": {
        "asn": string("remote_asn"),
        "asnOrg": string("remote_asn_org"),
        "isp": string("remote_isp"),
        "org": string("remote_org"),
    },
}
SERVICE = {
    "action": only(
        "action_type IS NOT NULL",
        {
            "actionType": string("action_type"),
            "awsApiCallAction": only(
                "has_api",
                {
                    "api": string("api"),
                    "callerType": string("caller_type"),
                    "errorCode": string("error_code"),
                    "remoteAccountDetails": only(
                        "has_remote_account",
                        {
                            "accessKeyId": string("remote_key"),
                            "accountId": string("remote_account"),
                            "affiliated": boolean("affiliated"),
                            "principalId": string("remote_principal"),
                            "sessionName": string("session_name"),
                        },
                    ),
                    "remoteIpDetails": only("call_has_remote", remote("call_ip", "remote_country", "remote_city")),
                    "serviceName": string("api_service"),
                    "userAgent": string("user_agent"),
                },
            ),
            "dnsRequestAction": only("has_dns_action", {"domain": string("dns_domain")}),
            "kubernetesApiCallAction": only(
                "has_k8s_call",
                {
                    "parameters": string("parameters"),
                    "requestUri": string("request_uri"),
                    "sourceIPs": items(string("source_ip")),
                    "statusCode": number("status_code"),
                    "userAgent": string("k8s_agent"),
                    "verb": string("verb"),
                },
            ),
            "networkConnectionAction": only(
                "has_net",
                {
                    "blocked": boolean("blocked"),
                    "connectionDirection": string("direction"),
                    "localPortDetails": {"port": number("local_port"), "portName": string("local_port_name")},
                    "protocol": string("protocol"),
                    "remoteIpDetails": CONNECTION_REMOTE,
                    "remotePortDetails": {"port": number("remote_port"), "portName": string("remote_port_name")},
                },
            ),
        },
    ),
    "additionalInfo": only(
        EKS,
        {
            "kubernetesUserGroups": items(string("user_group")),
            "kubernetesUserName": string("k8s_user"),
            "kubernetesWorkloadDetails": {
                "containers": only(
                    "has_container",
                    items(
                        {
                            "image": string("image"),
                            "name": string("container"),
                            "securityContext": {"privileged": boolean("privileged")},
                        }
                    ),
                ),
                "name": string("object_name"),
                "namespace": string("namespace"),
                "type": string("object_kind"),
            },
        },
    ),
    "detectorId": string("detector_id"),
    "ebsVolumeScanDetails": only(
        "has_scan",
        {
            "scanCompletedAt": moment("scan_done_at"),
            "scanId": string("scan_id"),
            "scanResultDetails": {"scanResultStatus": string("scan_status")},
            "scanStartedAt": moment("scan_started_at"),
            "scanType": string("scan_type"),
            "threats": items(
                {
                    "filePaths": choose(
                        ("file_count = 2", items(FILE, {**FILE, "fileName": constant("second.bin")})),
                        ("file_count = 1", items(FILE)),
                        ("file_count = 0", constant("[]")),
                    ),
                    "name": string("threat"),
                }
            ),
            "triggerFindingId": string("trigger_id"),
        },
    ),
    "rdsLoginAttemptAction": only(
        "has_login",
        {
            "loginAttributes": items(
                {
                    "application": string("login_app"),
                    "failedLoginAttempts": number("failed_logins"),
                    "successfulLoginAttempts": number("good_logins"),
                    "user": string("login_user"),
                }
            ),
            "remoteIpDetails": remote("service_ip", "service_country", "service_city"),
        },
    ),
    "remoteIpDetails": only("service_has_remote", remote("service_ip", "service_country", "service_city")),
    "runtimeDetails": only(
        "has_runtime",
        {
            "context": {
                "commandLineExample": string("command_line"),
                "targetProcess": {"executablePath": string("target_path")},
            },
            "process": {
                "executablePath": string("process_path"),
                "executableSha256": string("process_hash"),
                "name": string("process"),
                "pid": number("pid"),
                "user": string("process_user"),
            },
        },
    ),
    "serviceName": constant('guardduty'),
}
FINDING = {
    "accountId": string("account_id"),
    "arn": string("arn"),
    "confidence": number("confidence"),
    "createdAt": moment("created_at"),
    "description": string("description"),
    "id": string("finding_id"),
    "partition": string("part"),
    "region": string("region"),
    "resource": RESOURCE,
    "schemaVersion": string("schema_version"),
    "service": only("has_service", SERVICE),
    "severity": number("severity"),
    "title": string("title"),
    "type": string("activity_type"),
    "updatedAt": moment("updated_at"),
}


def attributes_sql(source: str) -> str:
    """SELECT of all attributes of every event in ``source``; read alike by Spark and DuckDB."""
    first = ", ".join(f"{sql} AS {name}" for name, sql in FIRST.items())
    rest = ", ".join(f"{sql} AS {name}" for name, sql in ATTRIBUTES.items())
    return f"SELECT e, u, k, h, ts, {rest} FROM (SELECT {first} FROM {source}) AS first_attributes"
