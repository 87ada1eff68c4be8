from __future__ import annotations

import copy
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, base, envelope, table
from watchtide.operators.base import BASE_COLUMNS, base_findings
from watchtide.operators.database import DATABASE_COLUMNS, database_findings
from watchtide.operators.identity import IDENTITY_COLUMNS, identity_findings
from watchtide.operators.kubernetes import KUBERNETES_COLUMNS, kubernetes_findings
from watchtide.operators.malware import MALWARE_COLUMNS, malware_findings
from watchtide.operators.network import NETWORK_COLUMNS, network_findings
from watchtide.operators.newest import newest_per_key
from watchtide.operators.quality import quality_categories
from watchtide.operators.sessions import SESSION_COLUMNS, network_sessions
from watchtide.operators.storage import STORAGE_COLUMNS, storage_findings
from watchtide.settings import Settings


def variant(finding, **changes):
    other = copy.deepcopy(finding)
    other.update(changes)
    return other


def test_column_counts():
    counts = [len(c) for c in (NETWORK_COLUMNS, IDENTITY_COLUMNS, STORAGE_COLUMNS, KUBERNETES_COLUMNS)]
    counts += [len(c) for c in (MALWARE_COLUMNS, DATABASE_COLUMNS, SESSION_COLUMNS, BASE_COLUMNS)]
    assert counts == [55, 38, 43, 43, 41, 39, 59, 24]


def test_golden_rows(spark, finding, small_finding):
    """Both shapes of one network finding through every view."""
    small_finding["id"] = "f2"
    rows = base(spark, finding, envelope(small_finding))
    main = {r.FindingId: r for r in rows.collect()}
    for r in main.values():
        assert (r.Severity, r.SeverityLevel, r.ResourceType, r.ActionType) == (7.0, "High", "Instance", "NETWORK_CONNECTION")
        assert (r.DataQualityScore, r.ParserVersion, str(r.EventTime)) == (100, "1.5.0", "2025-03-18 04:06:00.500000")
    raw = json.loads(main["f1"].RawJson)
    assert list(raw) == sorted(raw, key=lambda k: list(raw).index(k)) and len(raw) == 14
    assert raw["resource"] == finding["resource"] and raw["service"] == finding["service"] and raw["severity"] == 7.0 and raw["updatedAt"] == "2025-03-18T19:30:45.123456Z"
    network = {r.FindingId: r for r in network_findings(rows).collect()}
    assert (network["f1"].NetworkRiskScore, network["f2"].NetworkRiskScore) == (70, 60)
    assert (network["f1"].SecurityGroupIds, network["f2"].SecurityGroupIds) == ("sg-web,sg-ops", "")
    assert {r.ThreatCategory for r in network.values()} == {"Trojan"}
    assert {r.TrafficDirection for r in network.values()} == {"Inbound"}
    assert network["f2"].IsBlocked is None and network["f1"].EnrichedCountry == ""
    sessions = {r.NetworkSessionId: r for r in network_sessions(network_findings(rows)).collect()}
    for r in sessions.values():
        assert (r.SrcIpAddr, r.SrcPortNumber, r.DstIpAddr, r.DstPortNumber) == ("172.31.5.20", 40000, "198.18.7.21", 53)
        assert (r.NetworkProtocol, r.NetworkApplicationProtocol, r.ThreatRiskLevel) == ("UDP", "DNS", 80)
        assert (r.DvcOs, r.ASIMCompliance, r.EventOriginalSeverity) == ("Linux", "Compliant", "7.0")
    assert (sessions["f1"].DvcInterface, sessions["f2"].DvcInterface) == ("eni-20", "")
    bag = json.loads(sessions["f1"].AdditionalFields)
    assert len(bag) == 15 and bag["GuardDutyFindingId"] == "f1" and bag["LaunchTime"].startswith("2025-02-01T08:15:00")
    malware = malware_findings(rows).collect()
    assert [(r.MalwareCategory, r.MalwareRiskScore, r.ThreatCount) for r in malware] == [("Suspicious File", 30, None)] * 2
    for view in (identity_findings, storage_findings, kubernetes_findings, database_findings):
        assert view(rows).count() == 0
    assert {r.QualityCategory for r in quality_categories(table(spark, finding, small_finding), "7d", AS_OF).collect()} == {"Valid"}


def test_newest_copy_wins_before_any_gate(spark, finding):
    copies = [
        variant(finding, id="a", updatedAt="2025-03-18T10:00:00Z", severity=5),
        variant(finding, id="a", updatedAt="2025-03-18T12:00:00Z", severity=9, schemaVersion="1.0"),
        variant(finding, id="b", updatedAt="2025-03-18T12:00:00Z", severity=7),
        variant(finding, id="b", updatedAt="2025-03-18T11:00:00Z", severity=2),
        variant(finding, id="b", updatedAt="2025-02-20T11:00:00Z", severity=1),
        variant(finding, id="c", updatedAt="2025-02-20T11:00:00Z"),
        variant(finding, id="d", updatedAt="2025-03-18T12:00:00Z", type="Recon:EC2/Portscan"),
        variant(finding, id="d", updatedAt="2025-03-18T11:00:00Z", type="Policy:S3/X"),
        variant(finding, id="", accountId="", severity=0, region=""),
    ]
    found = {r.FindingId: (r.Severity, r.FindingType) for r in base(spark, *copies).collect()}
    assert found == {"b": (7.0, finding["type"]), "d": (7.0, "Recon:EC2/Portscan")}
    ungated = base(spark, *copies, settings=Settings(data_validation=False))
    scores = {r.FindingId: (r.DataQualityScore, r.SeverityLevel) for r in ungated.collect()}
    assert scores == {"a": (100, "Critical"), "b": (100, "High"), "d": (100, "High"), "": (20, "Unknown")}
    assert {r.FindingId for r in base(spark, *copies, lookback="3650d").collect()} == {"b", "c", "d"}
    narrow = Settings(max_severity=6.0)
    assert {r.FindingId: r.Severity for r in base(spark, *copies, settings=narrow).collect()} == {"b": 0.0, "d": 0.0}


def test_newest_copy_does_not_depend_on_order_or_skew(spark):
    random.seed(3)
    rows = [("hot" if i % 3 == 0 else f"k{i % 200}", i, f"arn-{i}") for i in range(3000)]
    expected = {}
    for key, time, arn in rows:
        expected[key] = max(expected.get(key, (-1, "")), (time, arn))
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "Id STRING, TimeGenerated INT, Arn STRING").repartition(5)
        once = newest_per_key(df)
        assert {r.Id: (r.TimeGenerated, r.Arn) for r in once.collect()} == expected
        assert newest_per_key(once).count() == len(expected)


def test_network_terms(spark, finding):
    def shaped(i, kind="Recon:EC2/Portscan", **action):
        other = variant(finding, id=f"n{i}", type=kind, severity=2)
        connection = other["service"]["action"]["networkConnectionAction"]
        connection.update(action)
        return other

    remote = finding["service"]["action"]["networkConnectionAction"]["remoteIpDetails"]
    rows = [
        shaped(1, blocked=True),
        shaped(2, blocked="false", connectionDirection="OUTBOUND"),
        shaped(3, remoteIpDetails={**remote, "country": {"countryName": "Chile"}}, connectionDirection="SIDEWAYS"),
        shaped(4, "Trojan:EC2/DNS!DNS"),
        shaped(5, "UnauthorizedAccess:EC2/Tor!Relay"),
        shaped(6, "Impact:IAM/Portless"),
    ]
    rows[5]["service"]["action"]["actionType"] = "OTHER"
    rows[0]["resource"]["instanceDetails"]["networkInterfaces"][0]["securityGroups"] = [{"groupId": "a"}, {"groupId": "b"}]
    found = {r.FindingId: r for r in network_findings(base(spark, *rows)).collect()}
    assert set(found) == {"n1", "n2", "n3", "n4", "n5"}
    assert [found[f"n{i}"].NetworkRiskScore for i in range(1, 6)] == [20, 30, 30, 50, 30]
    assert [found[f"n{i}"].TrafficDirection for i in (1, 2, 3)] == ["Inbound", "Outbound", "Unknown"]
    assert (found["n4"].ThreatCategory, found["n5"].ThreatCategory) == ("Trojan", "Anonymization")
    assert found["n1"].SecurityGroupIds == "a,b"


def test_session_filters(spark, finding):
    no_ip, no_protocol = variant(finding, id="x"), variant(finding, id="y")
    no_ip["service"]["action"]["networkConnectionAction"]["remoteIpDetails"] = {"ipAddressV6": "2001:db8::1"}
    no_protocol["service"]["action"]["networkConnectionAction"]["protocol"] = ""
    network = network_findings(base(spark, finding, no_ip, no_protocol))
    assert [r.NetworkSessionId for r in network_sessions(network).collect()] == ["f1"]
    kept = {r.NetworkSessionId: r.ASIMCompliance for r in network_sessions(network, compliant_only=False).collect()}
    assert kept == {"f1": "Compliant", "y": "Missing protocol"}


def identity_case(finding, i, severity=8, kind="Policy:IAMUser/X", call=None, key=None):
    other = variant(finding, id=f"i{i}", type=kind, severity=severity)
    other["service"] = {"action": {"actionType": "AWS_API_CALL", "awsApiCallAction": call or {}}}
    other["resource"] = {"resourceType": "AccessKey", "accessKeyDetails": key or {}}
    return other


def test_identity_rules(spark, finding):
    ip = {"remoteIpDetails": {"ipAddressV4": "192.0.2.1", "country": {"countryName": "Iran"}}}
    rows = [
        identity_case(finding, 1, call={**ip, "api": "iam.CreateUser", "errorCode": "AccessDenied"}),
        identity_case(finding, 2, call={**ip, "api": "X", "remoteAccountDetails": {"affiliated": False, "sessionName": "s"}}),
        identity_case(finding, 3, severity=9, call=ip, key={"accessKeyId": "A", "userType": "Root"}),
        identity_case(finding, 4, severity=5, call={**ip, "errorCode": "Success"}, key={"principalId": "a:user/eve/z"}),
        identity_case(finding, 5, call={"api": "NoAddress"}),
        identity_case(finding, 6, kind="Stealth:IAMUser/Y", call=ip, severity=2),
    ]
    found = {r.FindingId: r for r in identity_findings(base(spark, *rows)).collect()}
    assert set(found) == {"i1", "i2", "i3", "i4", "i6"}
    assert [found[f"i{i}"].RiskScore for i in (1, 2, 3, 4, 6)] == [70, 90, 10, 60, 20]
    assert (found["i1"].ServiceName_API, found["i1"].ActionResult) == ("iam", "Failure")
    assert (found["i2"].UserName, found["i2"].UserType, found["i2"].AuthenticationMethod) == ("false", "Assumed Role", "Assumed Role")
    assert (found["i3"].UserType, found["i3"].AuthenticationMethod, found["i3"].ApiName) == ("Root Account", "Root Access Key", "Unknown")
    assert (found["i4"].UserName, found["i4"].RemoteAccountId) == ("eve", "210987654321")
    assert (found["i6"].FindingCategory, found["i1"].ThreatIndicators) == ("Stealth Activity", "High-Risk Geography")


def test_storage_exposure(spark, finding):
    def bucket(i, kind="Policy:S3/X", **details):
        return variant(finding, id=f"s{i}", type=kind, severity=2, resource={"resourceType": "S3Bucket", "s3BucketDetails": [details]})

    def flagged(scope, flag, value):
        return {"permissionConfiguration": {"bucketLevelPermissions": {scope: {flag: value}}}}

    aes = {"encryptionType": "AES256"}
    rows = [
        bucket(1, publicAccess={"effectivePermission": "PUBLIC"}, defaultServerSideEncryption=aes),
        bucket(2, publicAccess=flagged("accessControlList", "allowsPublicReadAccess", True), defaultServerSideEncryption=aes),
        bucket(3, publicAccess=flagged("bucketPolicy", "allowsPublicWriteAccess", False), defaultServerSideEncryption=aes),
        bucket(4, defaultServerSideEncryption={"encryptionType": "NONE"}),
        bucket(5, kind="Exfiltration:S3/Y"),
        variant(finding, id="s6", type="Discovery:S3/Z", severity=2, resource={"resourceType": "Other", "s3BucketDetails": {}}),
    ]
    found = {r.FindingId: r for r in storage_findings(base(spark, *rows)).collect()}
    assert [found[f"s{i}"].IsPubliclyExposed for i in range(1, 7)] == [True, True, False, False, False, False]
    assert [found[f"s{i}"].S3RiskScore for i in range(1, 7)] == [40, 40, 10, 30, 40, 30]
    assert (found["s5"].S3RiskCategory, found["s6"].S3RiskCategory) == ("Data Exfiltration", "Reconnaissance")


def test_kubernetes_scores(spark, finding):
    def pod(i, user, privileged, kind="Execution:Kubernetes/X", parameters=None):
        info = {
            "kubernetesUserName": user,
            "kubernetesWorkloadDetails": {"containers": [{"securityContext": {"privileged": privileged}}]},
        }
        call = {"parameters": parameters, "sourceIPs": []}
        service = {"additionalInfo": info, "action": {"actionType": "K", "kubernetesApiCallAction": call}}
        return variant(finding, id=f"k{i}", type=kind, severity=2, service=service, resource={"resourceType": "EKSCluster"})

    rows = [
        pod(1, "system:serviceaccount:a:b", True),
        pod(2, "SYSTEM:node:x", False, parameters="grant ADMIN"),
        pod(3, "eve", None, kind="CredentialAccess:Kubernetes/X"),
        pod(4, "system:serviceaccount:a:b", None, kind="Discovery:Kubernetes/X"),
        pod(5, None, None, kind="Other:Thing/Y"),
    ]
    found = {r.FindingId: r for r in kubernetes_findings(base(spark, *rows)).collect()}
    assert [found[f"k{i}"].K8sUserType for i in range(1, 6)] == ["ServiceAccount", "System", "User", "ServiceAccount", "Unknown"]
    assert [found[f"k{i}"].K8sRiskScore for i in range(1, 6)] == [40, 10, 25, 10, 10]
    assert (found["k2"].K8sIsAdminCall, found["k1"].K8sIsAdminCall, found["k1"].K8sSourceIp) == (True, False, "")
    assert found["k5"].K8sThreatCategory == "Kubernetes Anomaly"


@pytest.mark.parametrize("shared", [True, False])
def test_malware_categories(spark, finding, shared):
    from watchtide.operators.malware import READS

    names = {
        "EICAR-Test-File": ("Test File", 35),
        "Win.Trojan.X": ("Remote Access Trojan", 50),
        "Ransom.X": ("Ransomware", 55),
        "XMR-Miner": ("Cryptominer", 35),
        "A C&C B": ("Backdoor / C2", 50),
        "Rootkit.A": ("Rootkit", 55),
        "Worm/X": ("Worm", 35),
        "Keylogger 9": ("Spyware", 35),
        "AWORM": ("Malware (unclassified)", 35),
    }
    rows = []
    for i, name in enumerate(names):
        threat = {"name": name, "filePaths": [{"fileName": "a"}, {"fileName": "b"}]}
        scan = {"scanResultDetails": {"scanResultStatus": "THREATS_FOUND"}, "threats": [threat]}
        rows.append(variant(finding, id=f"m{i}", type="Execution:EC2/MaliciousFile", severity=2, service={"ebsVolumeScanDetails": scan}))
    found = malware_findings(base(spark, *rows, reads=() if shared else READS)).collect()
    assert {r.ThreatName: (r.MalwareCategory, r.MalwareRiskScore) for r in found} == names
    assert {(r.ThreatCount, r.ThreatFileName) for r in found} == {(2, "a")}
    assert json.loads(found[0].AllThreatNames)[0]["filePaths"][1] == {"fileName": "b"}


def test_database_scores(spark, finding):
    def instance(i, kind, **details):
        return variant(finding, id=f"d{i}", type=kind, severity=2, resource={"resourceType": "RDSDBInstance", "rdsDbInstanceDetails": details})

    rows = [
        instance(1, "Discovery:RDS/X", publiclyAccessible=True, storageEncrypted=False, dbInstancePort=5432),
        instance(2, "CredentialAccess:RDS/A.BruteForce", publiclyAccessible=None, storageEncrypted=True),
        instance(3, "Other/BruteForce"),
        instance(4, "Exfiltration:RDS/X"),
    ]
    rows[0]["service"]["rdsLoginAttemptAction"] = {"loginAttributes": [{"user": "u", "failedLoginAttempts": 3}]}
    found = {r.FindingId: r for r in database_findings(base(spark, *rows)).collect()}
    assert [found[f"d{i}"].RdsRiskScore for i in range(1, 5)] == [45, 10, 25, 20]
    assert [found[f"d{i}"].RdsThreatCategory for i in (1, 2, 3)] == ["Reconnaissance", "Credential Access", "Brute Force"]
    assert (found["d1"].LoginUser, found["d1"].LoginFailedCount, found["d1"].DbInstancePort) == ("u", 3, 5432)


def test_quality_categories_in_order(spark, finding):
    cases = [
        ("Missing FindingId", variant(finding, id="", type="")),
        ("Missing FindingType", variant(finding, type="", severity=11)),
        ("Invalid Severity", variant(finding, severity=11, accountId="")),
        ("Missing AccountId", variant(finding, accountId="", region="")),
        ("Missing Region", variant(finding, region="", createdAt=None)),
        ("Missing Timestamp", variant(finding, createdAt=None, resource={})),
        ("Missing ResourceDetails", variant(finding, resource={}, service={})),
        ("Missing ResourceDetails", variant(finding, resource=None)),
        ("Missing ServiceDetails", variant(finding, service={}, schemaVersion="")),
        ("Missing Schema Version", variant(finding, schemaVersion="")),
        ("Unsupported Schema Version", variant(finding, schemaVersion="1.0")),
        ("Valid", variant(finding, resource={"other": 1}, service={"other": 1})),
        ("Valid", finding),
    ]
    found = quality_categories(table(spark, *[c for _, c in cases]), "7d", AS_OF)
    assert sorted(r.QualityCategory for r in found.collect()) == sorted(c for c, _ in cases)


def test_base_read_from_files_equals_memory(spark, finding, tmp_path):
    from watchtide.operators.network import READS
    from watchtide.sources.table import findings, write_findings

    rows = [variant(finding, id=f"r{i}", severity=i % 11) for i in range(40)]
    path = str(tmp_path / "t")
    write_findings(table(spark, *rows), path)
    stored = network_findings(base_findings(findings(spark, path, "7d", AS_OF), "7d", AS_OF, reads=READS))
    memory = network_findings(base(spark, *rows))
    assert sorted(stored.collect()) == sorted(memory.collect())
    assert stored.filter(F.col("RawJson") == "").count() == 0
