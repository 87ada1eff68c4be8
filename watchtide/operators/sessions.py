"""Network findings as normalised network sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchtide.functions.text import first_match, first_text, is_empty, json_bag, not_empty

# Constants of the session schema.
CONSTANTS = {
    "EventType": "NetworkSession",
    "EventSchemaVersion": "0.2.7",
    "EventVendor": "AWS",
    "EventProduct": "GuardDuty",
    "EventProductVersion": "1.0",
    "EventCount": 1,
    "EventResult": "Success",
    "NetworkBytes": 0,
    "NetworkPackets": 0,
    "DvcOsVersion": "",
    "DvcAction": "Allow",
    "ThreatIsActive": True,
    "RuleNumber": 0,
    "RuleAction": "Alert",
}
UID_PREFIX = "guardduty-"
# Application by remote port, risk by severity band, system by platform.
PORT_APPLICATIONS = (
    (80, "HTTP"),
    (443, "HTTPS"),
    (53, "DNS"),
    (22, "SSH"),
    (3389, "RDP"),
    (25, "SMTP"),
    (21, "FTP"),
)
RISK_LEVELS = (("Critical", 95), ("High", 80), ("Medium", 50), ("Low", 20), ("Informational", 10))
SYSTEMS = (("windows", "Windows"), ("linux", "Linux"))
DEFAULT_SYSTEM = "Linux"
COMPLIANT = "Compliant"

SESSION_COLUMNS = (
    "TimeGenerated",
    "EventType",
    "EventSchemaVersion",
    "EventVendor",
    "EventProduct",
    "EventProductVersion",
    "EventCount",
    "EventStartTime",
    "EventEndTime",
    "EventResult",
    "EventSeverity",
    "EventOriginalSeverity",
    "EventMessage",
    "EventOriginalType",
    "EventOriginalUid",
    "EventUid",
    "SrcIpAddr",
    "SrcPortNumber",
    "SrcHostname",
    "SrcDvcId",
    "SrcDvcIdType",
    "SrcGeoCountry",
    "SrcGeoRegion",
    "SrcDomain",
    "SrcDomainType",
    "DstIpAddr",
    "DstPortNumber",
    "DstGeoCountry",
    "DstGeoCity",
    "DstGeoRegion",
    "DstHostname",
    "NetworkProtocol",
    "NetworkDirection",
    "NetworkSessionId",
    "NetworkBytes",
    "NetworkPackets",
    "NetworkApplicationProtocol",
    "DvcId",
    "DvcIdType",
    "DvcHostname",
    "DvcOs",
    "DvcOsVersion",
    "DvcAction",
    "DvcInterface",
    "ThreatName",
    "ThreatCategory",
    "ThreatRiskLevel",
    "ThreatOriginalRiskLevel",
    "ThreatField",
    "ThreatIpAddr",
    "ThreatIsActive",
    "ThreatFirstReportedTime",
    "ThreatLastReportedTime",
    "RuleName",
    "RuleNumber",
    "RuleAction",
    "AdditionalFields",
    "ASIMCompliance",
    "RawJson",
)


def network_sessions(network: DataFrame, compliant_only: bool = True) -> DataFrame:
    """Session rows of network findings with a remote address.

    The source is always the monitored side, inbound connections included, and result and action are constants even
    for blocked ones. ``compliant_only=False`` keeps the rows the compliance filter drops.
    """
    col = F.col
    instance, score, level = col("InstanceId"), col("Severity"), col("SeverityLevel")

    def other_if_set(name: str):
        return F.when(not_empty(col(name)), F.lit("Other")).otherwise(F.lit(""))

    risk = (score * 10).cast("int")
    for band, value in reversed(RISK_LEVELS):
        risk = F.when(level == band, F.lit(value)).otherwise(risk)
    application = first_match([(col("RemotePort") == port, name) for port, name in PORT_APPLICATIONS], "")
    platform = col("Platform")
    system = F.when(not_empty(platform), platform).otherwise(F.lit(DEFAULT_SYSTEM))
    for name, label in SYSTEMS:
        system = F.when(platform == name, F.lit(label)).otherwise(system)
    extra = json_bag(
        col("AwsAccountId"),
        col("AwsRegion"),
        col("VpcId"),
        col("SubnetId"),
        instance,
        col("InstanceType"),
        col("SecurityGroupIds"),
        col("NetworkInterfaceId"),
        col("RemoteOrganization"),
        col("RemoteIsp"),
        col("RemoteAsn"),
        col("FindingId").alias("GuardDutyFindingId"),
        platform,
        col("ImageId"),
        col("LaunchTime"),
    )
    same = {
        "EventStartTime": "EventTime",
        "EventEndTime": "EventTime",
        "EventSeverity": "SeverityLevel",
        "EventMessage": "Title",
        "EventOriginalType": "FindingType",
        "EventOriginalUid": "FindingId",
        "SrcPortNumber": "LocalPort",
        "SrcHostname": "InstanceId",
        "SrcDvcId": "InstanceId",
        "SrcGeoCountry": "AwsRegion",
        "SrcGeoRegion": "AwsRegion",
        "SrcDomain": "VpcId",
        "DstIpAddr": "RemoteIp",
        "DstPortNumber": "RemotePort",
        "DstGeoCountry": "RemoteCountry",
        "DstGeoCity": "RemoteCity",
        "DstGeoRegion": "RemoteCountry",
        "DstHostname": "PublicDnsName",
        "NetworkDirection": "TrafficDirection",
        "NetworkSessionId": "FindingId",
        "DvcId": "InstanceId",
        "DvcHostname": "InstanceId",
        "DvcInterface": "NetworkInterfaceId",
        "ThreatName": "FindingType",
        "ThreatIpAddr": "RemoteIp",
        "ThreatFirstReportedTime": "EventTime",
        "ThreatLastReportedTime": "EventTime",
        "RuleName": "FindingType",
    }
    mapped = {
        **{name: F.lit(value) for name, value in CONSTANTS.items()},
        **{name: col(source) for name, source in same.items()},
        "EventOriginalSeverity": score.cast("string"),
        "EventUid": F.concat(F.lit(UID_PREFIX), col("FindingId")),
        "SrcIpAddr": first_text(col("PrivateIp"), col("PublicIp")),
        "SrcDvcIdType": other_if_set("InstanceId"),
        "SrcDomainType": other_if_set("VpcId"),
        "NetworkProtocol": F.upper(col("Protocol")),
        "NetworkApplicationProtocol": application,
        "DvcIdType": other_if_set("InstanceId"),
        "DvcOs": system,
        "ThreatRiskLevel": risk,
        "ThreatOriginalRiskLevel": score.cast("string"),
        "ThreatField": F.lit("DstIpAddr"),
        "AdditionalFields": extra,
    }
    sessions = (
        network.filter(not_empty(col("RemoteIp")))
        .withColumns(mapped)
        .withColumn(
            "ASIMCompliance",
            first_match(
                [
                    (is_empty(col("SrcIpAddr")) & is_empty(col("DstIpAddr")), "Missing IP addresses"),
                    (is_empty(col("NetworkProtocol")), "Missing protocol"),
                    (col("EventTime").isNull(), "Missing timestamp"),
                ],
                COMPLIANT,
            ),
        )
    )
    if compliant_only:
        sessions = sessions.filter(col("ASIMCompliance") == COMPLIANT)
    return sessions.select(*SESSION_COLUMNS)
