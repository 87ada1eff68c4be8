"""Object-storage findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchtide.functions.severity import severity_points
from watchtide.functions.text import classify, first_text, has, is_empty, is_true
from watchtide.functions.variant import Read, with_reads

_BUCKET = ".s3BucketDetails[0]"
_ENCRYPTION = _BUCKET + ".defaultServerSideEncryption"
_ACCESS = _BUCKET + ".publicAccess"
_ON_BUCKET = _ACCESS + ".permissionConfiguration.bucketLevelPermissions"
_ON_ACCOUNT = _ACCESS + ".permissionConfiguration.accountLevelPermissions"
_KEY = ".accessKeyDetails"
_CALL = ".action.awsApiCallAction"

# Terms of finding types that make a finding a storage finding.
TYPE_TERMS = (
    "S3/",
    "Policy:S3",
    "Stealth:S3",
    "Discovery:S3",
    "Impact:S3",
    "Exfiltration:S3",
    "PenTest:S3",
    "Backdoor:S3",
    "Trojan:S3",
)
# Category and the terms that select it, first match wins.
CATEGORIES = (
    ("Public Exposure", ("BucketPublicAccessGranted", "BucketBlockPublicAccessDisabled")),
    ("Encryption Disabled", ("BucketEncryptionDisabled",)),
    ("Audit Log Disabled", ("ServerAccessLoggingDisabled",)),
    ("Reconnaissance", ("Discovery",)),
    ("Data Exfiltration", ("Exfiltration",)),
    ("Data Impact", ("Impact",)),
    ("Penetration Testing", ("PenTest",)),
)
DEFAULT_CATEGORY = "S3 Anomaly"
RECORD_SOURCE = "AWSGuardDuty_S3"


def _block_reads(prefix: str, scope: str) -> tuple[Read, ...]:
    flags = ("blockPublicAcls", "ignorePublicAcls", "blockPublicPolicy", "restrictPublicBuckets")
    return tuple(
        Read(prefix + flag[0].upper() + flag[1:], "resource", f"{scope}.blockPublicAccess.{flag}", "boolean")
        for flag in flags
    )


READS = (
    Read("BucketName", "resource", _BUCKET + ".name"),
    Read("BucketArn", "resource", _BUCKET + ".arn"),
    Read("BucketType", "resource", _BUCKET + ".type"),
    Read("BucketCreatedAt", "resource", _BUCKET + ".createdAt", "timestamp"),
    Read("BucketOwnerId", "resource", _BUCKET + ".owner.id"),
    Read("EncryptionType", "resource", _ENCRYPTION + ".encryptionType"),
    Read("KmsKeyArn", "resource", _ENCRYPTION + ".kmsMasterKeyArn"),
    *_block_reads("", _ON_BUCKET),
    *_block_reads("Account", _ON_ACCOUNT),
    Read("AclAllowsPublicRead", "resource", _ON_BUCKET + ".accessControlList.allowsPublicReadAccess", "boolean"),
    Read("AclAllowsPublicWrite", "resource", _ON_BUCKET + ".accessControlList.allowsPublicWriteAccess", "boolean"),
    Read("PolicyAllowsPublicRead", "resource", _ON_BUCKET + ".bucketPolicy.allowsPublicReadAccess", "boolean"),
    Read("PolicyAllowsPublicWrite", "resource", _ON_BUCKET + ".bucketPolicy.allowsPublicWriteAccess", "boolean"),
    Read("EffectivePermission", "resource", _ACCESS + ".effectivePermission"),
    Read("CallerUserName", "resource", _KEY + ".userName"),
    Read("CallerUserType", "resource", _KEY + ".userType"),
    Read("CallerAccessKeyId", "resource", _KEY + ".accessKeyId"),
    Read("CallerPrincipalId", "resource", _KEY + ".principalId"),
    Read("_call_ip", "service", _CALL + ".remoteIpDetails.ipAddressV4"),
    Read("_service_ip", "service", ".remoteIpDetails.ipAddressV4"),
    Read("_call_country", "service", _CALL + ".remoteIpDetails.country.countryName"),
    Read("_service_country", "service", ".remoteIpDetails.country.countryName"),
    Read("ApiName", "service", _CALL + ".api"),
)

STORAGE_COLUMNS = (
    "TimeGenerated",
    "EventTime",
    "FindingId",
    "FindingType",
    "S3RiskCategory",
    "Severity",
    "SeverityLevel",
    "S3RiskScore",
    "Title",
    "Description",
    "AwsAccountId",
    "AwsRegion",
    "BucketName",
    "BucketArn",
    "BucketType",
    "BucketCreatedAt",
    "BucketOwnerId",
    "EncryptionType",
    "KmsKeyArn",
    "IsPubliclyExposed",
    "EffectivePermission",
    "BlockPublicAcls",
    "IgnorePublicAcls",
    "BlockPublicPolicy",
    "RestrictPublicBuckets",
    "AccountBlockPublicAcls",
    "AccountIgnorePublicAcls",
    "AccountBlockPublicPolicy",
    "AccountRestrictPublicBuckets",
    "AclAllowsPublicRead",
    "AclAllowsPublicWrite",
    "PolicyAllowsPublicRead",
    "PolicyAllowsPublicWrite",
    "CallerUserName",
    "CallerUserType",
    "CallerAccessKeyId",
    "CallerPrincipalId",
    "ApiName",
    "RemoteIp",
    "RemoteCountry",
    "ParserVersion",
    "RecordSource",
    "RawJson",
)


def storage_findings(base: DataFrame) -> DataFrame:
    """Buckets named by storage findings (the first of each finding), their exposure and encryption."""
    kind = F.col("FindingType")
    rows = with_reads(base.filter((F.col("ResourceType") == "S3Bucket") | has(kind, *TYPE_TERMS)), READS)
    exposed = F.col("EffectivePermission") == "PUBLIC"
    for flag in ("AclAllowsPublicRead", "AclAllowsPublicWrite", "PolicyAllowsPublicRead", "PolicyAllowsPublicWrite"):
        exposed = exposed | is_true(F.col(flag))
    encryption = F.col("EncryptionType")
    return (
        rows.withColumns(
            {
                "RemoteIp": first_text(F.col("_call_ip"), F.col("_service_ip")),
                "RemoteCountry": first_text(F.col("_call_country"), F.col("_service_country")),
                "S3RiskCategory": classify(kind, CATEGORIES, DEFAULT_CATEGORY),
                "IsPubliclyExposed": exposed,
                "RecordSource": F.lit(RECORD_SOURCE),
            }
        )
        .withColumn(
            "S3RiskScore",
            severity_points(
                F.col("SeverityLevel"),
                (F.col("IsPubliclyExposed"), 30),
                ((encryption == "NONE") | is_empty(encryption), 20),
                (F.col("S3RiskCategory") == "Data Exfiltration", 10),
            ),
        )
        .select(*STORAGE_COLUMNS)
    )
