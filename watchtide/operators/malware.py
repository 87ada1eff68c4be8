"""Malware-scan findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchtide.functions.severity import severity_points
from watchtide.functions.text import first_match, has, not_empty
from watchtide.functions.variant import Read, with_reads

_SCAN = ".ebsVolumeScanDetails"
_THREAT = _SCAN + ".threats[0]"
_FILE = _THREAT + ".filePaths[0]"
_INSTANCE = ".instanceDetails"
_INTERFACE = _INSTANCE + ".networkInterfaces[0]"
_ECS = ".ecsClusterDetails"

# Finding types of malware findings, and the broader terms that count on an instance.
TYPE_TERMS = (
    "Execution:EC2/MaliciousFile",
    "Execution:EC2/SuspiciousFile",
    "Execution:ECS/MaliciousFile",
    "Execution:ECS/SuspiciousFile",
    "Execution:Kubernetes/MaliciousFile",
    "Backdoor:EC2/C&CActivity",
    "Trojan:EC2/",
    "Behavior:EC2/NetworkPortUnusual",
)
INSTANCE_TERMS = ("Execution", "Backdoor", "Trojan")
# Category and the terms of a threat name that select it, first match wins.
CATEGORIES = (
    ("Test File", ("EICAR", "Test")),
    ("Remote Access Trojan", ("Trojan", "RAT")),
    ("Ransomware", ("Ransom", "Ransomware")),
    ("Cryptominer", ("Coin", "Miner", "XMR")),
    ("Backdoor / C2", ("Backdoor", "C2", "C&C")),
    ("Rootkit", ("Rootkit",)),
    ("Worm", ("Worm",)),
    ("Spyware", ("Spyware", "Keylogger")),
)
UNNAMED_THREAT, DEFAULT_CATEGORY = "Malware (unclassified)", "Suspicious File"
THREATS_FOUND = "THREATS_FOUND"
RECORD_SOURCE = "AWSGuardDuty_Malware"

READS = (
    Read("ScanId", "service", _SCAN + ".scanId"),
    Read("ScanType", "service", _SCAN + ".scanType"),
    Read("ScanStartedAt", "service", _SCAN + ".scanStartedAt", "timestamp"),
    Read("ScanCompletedAt", "service", _SCAN + ".scanCompletedAt", "timestamp"),
    Read("TriggerFindingId", "service", _SCAN + ".triggerFindingId"),
    Read("ScanResultStatus", "service", _SCAN + ".scanResultDetails.scanResultStatus"),
    Read("ThreatName", "service", _THREAT + ".name"),
    Read("ThreatFilePath", "service", _FILE + ".filePath"),
    Read("ThreatFileName", "service", _FILE + ".fileName"),
    Read("ThreatFileSha256", "service", _FILE + ".fileSha256"),
    Read("ThreatVolumeArn", "service", _FILE + ".volumeArn"),
    Read("_files", "service", _THREAT + ".filePaths", "array<variant>"),
    Read("AllThreatNames", "service", _SCAN + ".threats"),
    Read("InstanceId", "resource", _INSTANCE + ".instanceId"),
    Read("InstanceType", "resource", _INSTANCE + ".instanceType"),
    Read("InstanceState", "resource", _INSTANCE + ".instanceState"),
    Read("Platform", "resource", _INSTANCE + ".platform"),
    Read("ImageId", "resource", _INSTANCE + ".imageId"),
    Read("AvailabilityZone", "resource", _INSTANCE + ".availabilityZone"),
    Read("VpcId", "resource", _INTERFACE + ".vpcId"),
    Read("PrivateIp", "resource", _INTERFACE + ".privateIpAddress"),
    Read("PublicIp", "resource", _INTERFACE + ".publicIp"),
    Read("EcsClusterName", "resource", _ECS + ".name"),
    Read("EcsClusterArn", "resource", _ECS + ".arn"),
    Read("EcsTaskArn", "resource", _ECS + ".taskDetails.arn"),
    Read("EcsContainerImage", "resource", _ECS + ".taskDetails.containers[0].image"),
)

MALWARE_COLUMNS = (
    "TimeGenerated",
    "EventTime",
    "FindingId",
    "FindingType",
    "MalwareCategory",
    "Severity",
    "SeverityLevel",
    "MalwareRiskScore",
    "Title",
    "Description",
    "AwsAccountId",
    "AwsRegion",
    "ScanId",
    "ScanType",
    "ScanStartedAt",
    "ScanCompletedAt",
    "ScanResultStatus",
    "TriggerFindingId",
    "ThreatName",
    "ThreatFilePath",
    "ThreatFileName",
    "ThreatFileSha256",
    "ThreatVolumeArn",
    "ThreatCount",
    "AllThreatNames",
    "InstanceId",
    "InstanceType",
    "InstanceState",
    "Platform",
    "ImageId",
    "AvailabilityZone",
    "VpcId",
    "PrivateIp",
    "PublicIp",
    "EcsClusterName",
    "EcsClusterArn",
    "EcsTaskArn",
    "EcsContainerImage",
    "ParserVersion",
    "RecordSource",
    "RawJson",
)


def malware_findings(base: DataFrame) -> DataFrame:
    """Scan results with the first threat of each scan. ``ThreatCount`` counts that threat's files."""
    kind = F.col("FindingType")
    wanted = has(kind, *TYPE_TERMS) | ((F.col("ResourceType") == "Instance") & has(kind, *INSTANCE_TERMS))
    rows = with_reads(base.filter(wanted), READS)
    name, category = F.col("ThreatName"), F.col("MalwareCategory")
    found = F.col("ScanResultStatus") == THREATS_FOUND
    named = [(has(name, *terms), label) for label, terms in CATEGORIES]
    return (
        rows.withColumns(
            {
                "ThreatCount": F.when(F.col("_files").isNotNull(), F.size("_files")),
                "MalwareCategory": first_match([*named, (found, UNNAMED_THREAT)], DEFAULT_CATEGORY),
                "RecordSource": F.lit(RECORD_SOURCE),
            }
        )
        .withColumn(
            "MalwareRiskScore",
            severity_points(
                F.col("SeverityLevel"),
                (found, 25),
                (category.isin("Ransomware", "Rootkit"), 20),
                (category == "Remote Access Trojan", 15),
                (category == "Backdoor / C2", 15),
                (not_empty(F.col("ThreatFileSha256")), 10),
            ),
        )
        .select(*MALWARE_COLUMNS)
    )
