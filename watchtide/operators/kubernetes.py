"""Kubernetes audit and runtime findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchtide.functions.severity import severity_points
from watchtide.functions.text import classify, contains, first_match, has, is_true, not_empty, starts_with
from watchtide.functions.variant import Read, with_reads

_CLUSTER = ".eksClusterDetails"
_CALL = ".action.kubernetesApiCallAction"
_INFO = ".additionalInfo"
_WORKLOAD = _INFO + ".kubernetesWorkloadDetails"
_RUNTIME = ".runtimeDetails"

# Terms of finding types and resource types that make a finding a Kubernetes finding.
TYPE_TERMS = (
    "Kubernetes/",
    "Runtime/",
    "CredentialAccess:Kubernetes",
    "DefenseEvasion:Kubernetes",
    "Discovery:Kubernetes",
    "Execution:Kubernetes",
    "Impact:Kubernetes",
    "Persistence:Kubernetes",
    "PrivilegeEscalation:Kubernetes",
    "Collection:Kubernetes",
    "CredentialAccess:Runtime",
    "DefenseEvasion:Runtime",
    "Discovery:Runtime",
    "Execution:Runtime",
    "Impact:Runtime",
    "Persistence:Runtime",
    "PrivilegeEscalation:Runtime",
    "Exfiltration:Runtime",
)
RESOURCE_TYPES = ("EKSCluster", "Container")
# Category and the terms that select it, first match wins.
CATEGORIES = (
    ("Privilege Escalation", ("PrivilegeEscalation",)),
    ("Credential Access", ("CredentialAccess",)),
    ("Persistence", ("Persistence",)),
    ("Defense Evasion", ("DefenseEvasion",)),
    ("Discovery", ("Discovery",)),
    ("Execution", ("Execution",)),
    ("Impact", ("Impact",)),
    ("Exfiltration", ("Exfiltration",)),
    ("Collection", ("Collection",)),
)
DEFAULT_CATEGORY = "Kubernetes Anomaly"
RECORD_SOURCE = "AWSGuardDuty_EKS"

READS = (
    Read("ClusterName", "resource", _CLUSTER + ".name"),
    Read("ClusterArn", "resource", _CLUSTER + ".arn"),
    Read("ClusterStatus", "resource", _CLUSTER + ".status"),
    Read("ClusterCreatedAt", "resource", _CLUSTER + ".createdAt", "timestamp"),
    Read("K8sApiName", "service", _CALL + ".requestUri"),
    Read("K8sApiVerb", "service", _CALL + ".verb"),
    Read("K8sSourceIp", "service", _CALL + ".sourceIPs[0]"),
    Read("K8sUserAgent", "service", _CALL + ".userAgent"),
    Read("K8sStatusCode", "service", _CALL + ".statusCode", "int"),
    Read("_parameters", "service", _CALL + ".parameters"),
    Read("K8sUserName", "service", _INFO + ".kubernetesUserName"),
    Read("K8sUserGroups", "service", _INFO + ".kubernetesUserGroups"),
    Read("K8sNamespace", "service", _WORKLOAD + ".namespace"),
    Read("K8sObjectKind", "service", _WORKLOAD + ".type"),
    Read("K8sObjectName", "service", _WORKLOAD + ".name"),
    Read("K8sContainerImage", "service", _WORKLOAD + ".containers[0].image"),
    Read("K8sContainerName", "service", _WORKLOAD + ".containers[0].name"),
    Read("K8sIsPrivileged", "service", _WORKLOAD + ".containers[0].securityContext.privileged", "boolean"),
    Read("RuntimeProcess", "service", _RUNTIME + ".process.name"),
    Read("RuntimeProcessPath", "service", _RUNTIME + ".process.executablePath"),
    Read("RuntimeProcessPid", "service", _RUNTIME + ".process.pid", "int"),
    Read("RuntimeProcessUser", "service", _RUNTIME + ".process.user"),
    Read("RuntimeProcessArgs", "service", _RUNTIME + ".process.executableSha256"),
    Read("RuntimeContext", "service", _RUNTIME + ".context.commandLineExample"),
    Read("RuntimeFilePath", "service", _RUNTIME + ".context.targetProcess.executablePath"),
    Read("K8sRemoteCountry", "service", ".action.networkConnectionAction.remoteIpDetails.country.countryName"),
)

KUBERNETES_COLUMNS = (
    "TimeGenerated",
    "EventTime",
    "FindingId",
    "FindingType",
    "K8sThreatCategory",
    "Severity",
    "SeverityLevel",
    "K8sRiskScore",
    "Title",
    "Description",
    "AwsAccountId",
    "AwsRegion",
    "ClusterName",
    "ClusterArn",
    "ClusterStatus",
    "ClusterCreatedAt",
    "K8sApiName",
    "K8sApiVerb",
    "K8sStatusCode",
    "K8sSourceIp",
    "K8sUserAgent",
    "K8sIsAdminCall",
    "K8sUserName",
    "K8sUserType",
    "K8sUserGroups",
    "K8sNamespace",
    "K8sObjectKind",
    "K8sObjectName",
    "K8sContainerImage",
    "K8sContainerName",
    "K8sIsPrivileged",
    "RuntimeProcess",
    "RuntimeProcessPath",
    "RuntimeProcessPid",
    "RuntimeProcessUser",
    "RuntimeProcessArgs",
    "RuntimeContext",
    "RuntimeFilePath",
    "K8sRemoteIp",
    "K8sRemoteCountry",
    "ParserVersion",
    "RecordSource",
    "RawJson",
)


def kubernetes_findings(base: DataFrame) -> DataFrame:
    """API calls, workloads and processes of clusters. ``RuntimeProcessArgs`` carries the executable's hash."""
    kind = F.col("FindingType")
    rows = with_reads(base.filter(F.col("ResourceType").isin(*RESOURCE_TYPES) | has(kind, *TYPE_TERMS)), READS)
    user = F.col("K8sUserName")
    category = F.col("K8sThreatCategory")
    return (
        rows.withColumns(
            {
                "K8sIsAdminCall": contains(F.col("_parameters"), "admin"),
                "K8sUserType": first_match(
                    [
                        (starts_with(user, "system:serviceaccount:"), "ServiceAccount"),
                        (starts_with(user, "system:"), "System"),
                        (not_empty(user), "User"),
                    ],
                    "Unknown",
                ),
                "K8sRemoteIp": F.col("K8sSourceIp"),
                "K8sThreatCategory": classify(kind, CATEGORIES, DEFAULT_CATEGORY),
                "RecordSource": F.lit(RECORD_SOURCE),
            }
        )
        .withColumn(
            "K8sRiskScore",
            severity_points(
                F.col("SeverityLevel"),
                (is_true(F.col("K8sIsPrivileged")), 20),
                (category.isin("Privilege Escalation", "Credential Access"), 15),
                ((F.col("K8sUserType") == "ServiceAccount") & (category != "Discovery"), 10),
            ),
        )
        .select(*KUBERNETES_COLUMNS)
    )
