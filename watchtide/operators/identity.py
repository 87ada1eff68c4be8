"""Identity and API-call findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from watchtide.functions.text import classify, first_match, first_text, has, is_empty, not_empty
from watchtide.functions.variant import Read, with_reads

_CALL = ".action.awsApiCallAction"
_ACCOUNT = _CALL + ".remoteAccountDetails"
_CALL_REMOTE = _CALL + ".remoteIpDetails"
_REMOTE = ".remoteIpDetails"
_KEY = ".accessKeyDetails"

# Terms of finding types that make a finding an identity finding.
TYPE_TERMS = ("IAM", "Stealth", "Policy", "Credential", "UnauthorizedAPI", "Persistence", "PrivilegeEscalation")
# Category and the terms that select it, first match wins.
CATEGORIES = (
    ("Stealth Activity", ("Stealth", "StealthyBehavior")),
    ("Policy Violation", ("Policy", "PolicyViolation")),
    ("Credential Compromise", ("Credential", "CredentialAccess")),
    ("Unauthorized Access", ("UnauthorizedAPI", "Unauthorized")),
    ("Persistence", ("Persistence", "PersistentThreat")),
    ("Privilege Escalation", ("PrivilegeEscalation", "Escalation")),
    ("Reconnaissance", ("Reconnaissance", "Recon")),
    ("Discovery", ("Discovery", "Enum")),
)
DEFAULT_CATEGORY = "IAM Activity"
# What marks a caller as suspicious.
RISKY_COUNTRIES = ("China", "Russia", "North Korea", "Iran")
ANONYMIZERS = ("Tor", "VPN", "Proxy")
SCRIPT_AGENTS = ("curl", "wget", "python", "boto")
PRIVILEGE_CALLS = ("CreateUser", "AttachUserPolicy", "CreateRole")
# Risk by severity band and result; every other pair scores 10.
RISK = (("High", "Success", 90), ("High", "Failure", 70), ("Medium", "Success", 60), ("Medium", "Failure", 40))
LOW_RISK, OTHER_RISK = 20, 10

READS = (
    Read("_api", "service", _CALL + ".api"),
    Read("_domain", "service", ".action.dnsRequestAction.domain"),
    Read("_api_service", "service", _CALL + ".serviceName"),
    Read("_caller_type", "service", _CALL + ".callerType"),
    Read("ErrorCode", "service", _CALL + ".errorCode"),
    Read("_user_agent", "service", _CALL + ".userAgent"),
    Read("_call_ip", "service", _CALL_REMOTE + ".ipAddressV4"),
    Read("_service_ip", "service", _REMOTE + ".ipAddressV4"),
    Read("_connection_ip", "service", ".action.networkConnectionAction.remoteIpDetails.ipAddressV4"),
    Read("_call_country", "service", _CALL_REMOTE + ".country.countryName"),
    Read("_service_country", "service", _REMOTE + ".country.countryName"),
    Read("_call_city", "service", _CALL_REMOTE + ".city.cityName"),
    Read("_service_city", "service", _REMOTE + ".city.cityName"),
    Read("_call_org", "service", _CALL_REMOTE + ".organization.org"),
    Read("_service_org", "service", _REMOTE + ".organization.org"),
    Read("_call_isp", "service", _CALL_REMOTE + ".organization.isp"),
    Read("_service_isp", "service", _REMOTE + ".organization.isp"),
    Read("_remote_account", "service", _ACCOUNT + ".accountId"),
    Read("_affiliated", "service", _ACCOUNT + ".affiliated"),
    Read("_remote_key", "service", _ACCOUNT + ".accessKeyId"),
    Read("_remote_principal", "service", _ACCOUNT + ".principalId"),
    Read("SessionName", "service", _ACCOUNT + ".sessionName"),
    Read("ResourceUserName", "resource", _KEY + ".userName"),
    Read("ResourceUserType", "resource", _KEY + ".userType"),
    Read("_key", "resource", _KEY + ".accessKeyId"),
    Read("_principal", "resource", _KEY + ".principalId"),
    Read("_resource_arn", "resource", ".resourceArn"),
    Read("ResourceInstanceId", "resource", ".instanceDetails.instanceId"),
    Read("ResourceInstanceType", "resource", ".instanceDetails.instanceType"),
)

IDENTITY_COLUMNS = (
    "TimeGenerated",
    "EventTime",
    "FindingId",
    "FindingType",
    "FindingCategory",
    "Severity",
    "SeverityLevel",
    "RiskScore",
    "Title",
    "Description",
    "AwsAccountId",
    "AwsRegion",
    "ApiName",
    "ServiceName_API",
    "CallerType",
    "ActionResult",
    "ErrorCode",
    "UserAgent",
    "RemoteAccountId",
    "UserName",
    "UserType",
    "AccessKeyId",
    "PrincipalId",
    "SessionName",
    "AuthenticationMethod",
    "ResourceArn",
    "ResourceUserName",
    "ResourceUserType",
    "ResourceInstanceId",
    "ResourceInstanceType",
    "RemoteIp_API",
    "RemoteCountry_API",
    "RemoteCity_API",
    "RemoteOrganization_API",
    "RemoteIsp_API",
    "ThreatIndicators",
    "DataQuality",
    "RawJson",
)


def is_identity() -> Column:
    """Which rows of the base view are identity findings, before their quality is judged."""
    return (F.col("ActionType") == "AWS_API_CALL") | has(F.col("FindingType"), *TYPE_TERMS)


def with_calls(rows: DataFrame) -> DataFrame:
    """The call, its caller and ``DataQuality`` of rows that carry the ``READS``; rows stay as they are otherwise."""
    kind, col = F.col("FindingType"), F.col
    api_call = col("ActionType") == "AWS_API_CALL"
    unknown = F.lit("Unknown")
    typed = rows.withColumns(
        {
            "ApiName": first_text(col("_api"), col("_domain"), unknown),
            "ServiceName_API": first_text(col("_api_service"), F.regexp_extract("_api", r"^([^\.]+)", 1), unknown),
            "CallerType": first_text(col("_caller_type"), unknown),
            "UserAgent": first_text(col("_user_agent"), unknown),
            "RemoteIp_API": first_text(col("_call_ip"), col("_service_ip"), col("_connection_ip")),
            "RemoteCountry_API": first_text(col("_call_country"), col("_service_country")),
            "RemoteCity_API": first_text(col("_call_city"), col("_service_city")),
            "RemoteOrganization_API": first_text(col("_call_org"), col("_service_org")),
            "RemoteIsp_API": first_text(col("_call_isp"), col("_service_isp")),
            "RemoteAccountId": first_text(col("_remote_account"), col("AwsAccountId")),
            "UserName": first_text(
                col("_affiliated"), col("ResourceUserName"), F.regexp_extract("_principal", "user/([^/]+)", 1)
            ),
            "AccessKeyId": first_text(col("_remote_key"), col("_key")),
            "PrincipalId": first_text(col("_remote_principal"), col("_principal")),
            "ResourceArn": first_text(col("_resource_arn"), col("_key")),
            "UserType": first_match(
                [
                    (col("ResourceUserType") == "IAMUser", "IAM User"),
                    (col("ResourceUserType") == "Root", "Root Account"),
                    (col("ResourceUserType") == "AssumedRole", "Assumed Role"),
                    (not_empty(col("SessionName")), "Assumed Role"),
                    (not_empty(col("_key")), "IAM User"),
                ],
                "Unknown",
            ),
            "FindingCategory": classify(kind, CATEGORIES, DEFAULT_CATEGORY),
        }
    )
    key = col("AccessKeyId")
    return typed.withColumns(
        {
            "ActionResult": first_match(
                [
                    (not_empty(col("ErrorCode")) & (col("ErrorCode") != "Success"), "Failure"),
                    (col("ErrorCode") == "Success", "Success"),
                    (has(kind, "Unauthorized"), "Failure"),
                    (has(kind, "Stealth"), "Success"),
                    (not_empty(col("ApiName")), "Success"),
                ],
                "Unknown",
            ),
            "AuthenticationMethod": first_match(
                [
                    (not_empty(col("SessionName")), "Assumed Role"),
                    (not_empty(key) & (col("UserType") == "Root Account"), "Root Access Key"),
                    (not_empty(key), "Access Key"),
                ],
                "Unknown",
            ),
            "ThreatIndicators": first_match(
                [
                    (col("RemoteCountry_API").isin(*RISKY_COUNTRIES), "High-Risk Geography"),
                    (has(col("RemoteOrganization_API"), *ANONYMIZERS), "Anonymization Service"),
                    (has(col("UserAgent"), *SCRIPT_AGENTS), "Programmatic Access"),
                    (has(col("ApiName"), *PRIVILEGE_CALLS), "Privilege Operations"),
                ],
                "",
            ),
            "DataQuality": first_match(
                [
                    (is_empty(col("FindingId")), "Missing FindingId"),
                    (api_call & is_empty(col("ApiName")), "Missing API Name"),
                    (api_call & is_empty(col("RemoteIp_API")), "Missing Remote IP"),
                ],
                "Good",
            ),
        }
    )


def identity_findings(base: DataFrame) -> DataFrame:
    """API calls and the identities behind them.

    ``UserName`` prefers the account's ``affiliated`` flag, so it can read ``true`` or ``false``; a Critical finding
    scores like an unbanded one. Both are what existing users of the view get.
    """
    level, col = F.col("SeverityLevel"), F.col
    judged = with_calls(with_reads(base.filter(is_identity()), READS)).filter(col("DataQuality") == "Good")
    risk = F.when(level == "Low", LOW_RISK).otherwise(OTHER_RISK)
    for band, result, score in RISK:
        risk = F.when((level == band) & (col("ActionResult") == result), score).otherwise(risk)
    return judged.withColumn("RiskScore", risk).select(*IDENTITY_COLUMNS)
