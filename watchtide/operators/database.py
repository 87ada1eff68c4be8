"""Database findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchtide.functions.severity import severity_points
from watchtide.functions.text import classify, has, is_false, is_true
from watchtide.functions.variant import Read, with_reads

_DB = ".rdsDbInstanceDetails"
_LOGIN = ".rdsLoginAttemptAction"
_ATTEMPT = _LOGIN + ".loginAttributes[0]"
_REMOTE = _LOGIN + ".remoteIpDetails"
_KEY = ".accessKeyDetails"

# Terms of finding types that make a finding a database finding.
TYPE_TERMS = ("RDS/", "CredentialAccess:RDS", "Discovery:RDS", "Impact:RDS", "Exfiltration:RDS", "PenTest:RDS")
# Category and the terms that select it, first match wins.
CATEGORIES = (
    ("Credential Access", ("CredentialAccess",)),
    ("Brute Force", ("BruteForce",)),
    ("Anomalous Behaviour", ("AnomalousBehavior",)),
    ("Reconnaissance", ("Discovery",)),
    ("Data Exfiltration", ("Exfiltration",)),
    ("Data Impact", ("Impact",)),
    ("Penetration Testing", ("PenTest",)),
)
DEFAULT_CATEGORY = "RDS Anomaly"
RECORD_SOURCE = "AWSGuardDuty_RDS"

READS = (
    Read("DbInstanceId", "resource", _DB + ".dbInstanceIdentifier"),
    Read("DbClusterId", "resource", _DB + ".dbClusterIdentifier"),
    Read("DbEngine", "resource", _DB + ".engine"),
    Read("DbEngineVersion", "resource", _DB + ".engineVersion"),
    Read("DbInstanceClass", "resource", _DB + ".dbInstanceClass"),
    Read("DbInstancePort", "resource", _DB + ".dbInstancePort", "int"),
    Read("DbInstanceStatus", "resource", _DB + ".dbInstanceStatus"),
    Read("DbStorageEncrypted", "resource", _DB + ".storageEncrypted", "boolean"),
    Read("DbAvailabilityZone", "resource", _DB + ".availabilityZone"),
    Read("DbMultiAz", "resource", _DB + ".multiAz", "boolean"),
    Read("DbPubliclyAccessible", "resource", _DB + ".publiclyAccessible", "boolean"),
    Read("LoginUser", "service", _ATTEMPT + ".user"),
    Read("LoginApplication", "service", _ATTEMPT + ".application"),
    Read("LoginFailedCount", "service", _ATTEMPT + ".failedLoginAttempts", "int"),
    Read("LoginSuccessCount", "service", _ATTEMPT + ".successfulLoginAttempts", "int"),
    Read("RemoteIp_RDS", "service", _REMOTE + ".ipAddressV4"),
    Read("RemoteCountry_RDS", "service", _REMOTE + ".country.countryName"),
    Read("RemoteCity_RDS", "service", _REMOTE + ".city.cityName"),
    Read("RemoteOrg_RDS", "service", _REMOTE + ".organization.org"),
    Read("CallerUserName", "resource", _KEY + ".userName"),
    Read("CallerUserType", "resource", _KEY + ".userType"),
    Read("CallerAccessKeyId", "resource", _KEY + ".accessKeyId"),
    Read("CallerPrincipalId", "resource", _KEY + ".principalId"),
    Read("ApiName", "service", ".action.awsApiCallAction.api"),
)

DATABASE_COLUMNS = (
    "TimeGenerated",
    "EventTime",
    "FindingId",
    "FindingType",
    "RdsThreatCategory",
    "Severity",
    "SeverityLevel",
    "RdsRiskScore",
    "Title",
    "Description",
    "AwsAccountId",
    "AwsRegion",
    "DbInstanceId",
    "DbClusterId",
    "DbEngine",
    "DbEngineVersion",
    "DbInstanceClass",
    "DbInstancePort",
    "DbInstanceStatus",
    "DbStorageEncrypted",
    "DbPubliclyAccessible",
    "DbMultiAz",
    "DbAvailabilityZone",
    "LoginUser",
    "LoginApplication",
    "LoginFailedCount",
    "LoginSuccessCount",
    "CallerUserName",
    "CallerUserType",
    "CallerAccessKeyId",
    "CallerPrincipalId",
    "ApiName",
    "RemoteIp_RDS",
    "RemoteCountry_RDS",
    "RemoteCity_RDS",
    "RemoteOrg_RDS",
    "ParserVersion",
    "RecordSource",
    "RawJson",
)


def database_findings(base: DataFrame) -> DataFrame:
    """Database instances, login attempts and callers. The first category wins, so brute force rarely shows."""
    kind = F.col("FindingType")
    rows = with_reads(base.filter((F.col("ResourceType") == "RDSDBInstance") | has(kind, *TYPE_TERMS)), READS)
    category = F.col("RdsThreatCategory")
    return (
        rows.withColumns(
            {
                "RdsThreatCategory": classify(kind, CATEGORIES, DEFAULT_CATEGORY),
                "RecordSource": F.lit(RECORD_SOURCE),
            }
        )
        .withColumn(
            "RdsRiskScore",
            severity_points(
                F.col("SeverityLevel"),
                (is_true(F.col("DbPubliclyAccessible")), 20),
                (is_false(F.col("DbStorageEncrypted")), 15),
                (category == "Brute Force", 15),
                (category == "Data Exfiltration", 10),
            ),
        )
        .select(*DATABASE_COLUMNS)
    )
